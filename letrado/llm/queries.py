"""The registered queries of this subpackage, one per operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letrado.llm import (
    bpe, conversation_repair, html_extract, importance, line_dedup, ngram_lm, packing, pii, quality_rules, rule_ensemble,
    simhash, token_counts, vptree,
)
from letrado.llm.common import documents, fold_remainder, prepare
from letrado.sources.tables import read_table

JSON_VOCABULARY = "byte_bpe_50k.json"
RANK_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SEQUENCE = 1024
QUALITY_CUT = 0.3

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_quality_rules(documents(spark, sf_dir), out_col="rules")
    return judged.select("doc_id", *[F.col("rules")[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


ORACLE["op1_quality_rules"] = quality_rules.ORACLE_SQL


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path(JSON_VOCABULARY), max_length=SEQUENCE)


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = rule_ensemble.fit_rules(docs, read_table(spark, sf_dir, "labels"))
    scored = rule_ensemble.score_quality(docs, model)
    return scored.select("doc_id", (fold_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    counted = token_counts.count_tokens(docs, public_tokenizers.path(JSON_VOCABULARY))
    return counted.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                          "n_tokens", (F.col("n_tokens") > SEQUENCE).alias("over_limit"))


@query
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold_remainder(F.col("doc_id"), 7) == 2
    scores, _ = ngram_lm.score_documents(documents(spark, sf_dir), ~held_out)
    return scores.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan_documents(documents(spark, sf_dir), rule=pii.Disclosure(everywhere=True))
    spans = F.col("spans")
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
              for kind in pii.KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(pii.joined_spans(spans, True).cast("binary"), 256).alias("base_sha256"),
                        pii.joined_spans(spans).alias("spans"))


@query
def op7_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vptree.nearest(vectors, F.col("vec_id") % 100 == 0, k=10, factor=1.0)


ORACLE["op7_vantage_point_search"] = vptree.ORACLE_SQL


@query
def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANK_VOCABULARY)
    ids = bpe.encode_texts(documents(spark, sf_dir), path).select("doc_id", "ids")
    both = bpe.decode_ids(ids, path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_extract.extract_text(pages, html_extract.fit_page_model(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=2)
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.dedup_lines(docs, out_col="lines")
    return found.select("doc_id", F.col("lines")["n_lines"].alias("n_lines"), F.col("lines")["n_dropped"].alias("n_dropped"),
                        F.sha2(F.col("lines")["clean_text"].cast("binary"), 256).alias("kept_sha256"))


ORACLE["op11_line_dedup"] = line_dedup.ORACLE_SQL


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark").select("text"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair_turns(conversation_repair.damage(turns))
