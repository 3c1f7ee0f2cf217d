"""From raw documents to packed training sequences.

Five stages, each by one operator of ``letrado.llm``.  A stage gets the Parquet
table that its predecessor wrote and works on all of it; all but the last return
the columns of the documents they were given.

1. quality_classifier  documents scored below QUALITY_CUT go
2. quality_rules       failing lines go, documents rejected by the rules go
3. simhash_near_dedup  one document of each group of near copies stays
4. pii                 personal data and disclosing terms are generalised
5. packing             pieces of documents placed in sequences

Null texts count as empty (and are rejected by the rules); a null id is kept;
of rows that repeat one stays; an empty table gives an empty table.  Where a
stage changes the text, ``n_chars`` (if there) follows it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letrado.llm import packing as packs
from letrado.llm import pii as privacy
from letrado.llm import quality_rules as rules
from letrado.llm import rule_ensemble, simhash
from letrado.llm.common import free_name, prepare
from letrado.session import scratch_path
from letrado.sources.tables import read_table

QUALITY_CUT = 0.3
SHINGLE, MAX_BITS = 3, 2
VOCABULARY, SEQUENCE = "byte_bpe_50k.json", 1024


def _recount(changed: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``; n_chars, if there, is the length of the text as it is now."""
    kinds = dict(like.dtypes)
    return changed.select(*[F.length("text").cast(kinds[c]).alias(c) if c == "n_chars" else F.col(c) for c in like.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = rule_ensemble.fit_rules(docs, read_table(spark, sf_dir, "labels"))
    score = free_name(docs, "quality_score")
    scored = rule_ensemble.score_quality(docs, model, out_col=score)
    return scored.where(F.col(score) >= QUALITY_CUT).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    verdict = free_name(docs, "quality_rules")
    judged = rules.apply_quality_rules(docs, out_col=verdict)
    kept = judged.where(F.col(verdict)["kept"]).withColumn("text", F.col(verdict)["clean_text"])
    return _recount(kept, docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.keep_one_of_each(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _recount(privacy.sanitise(docs, rule=privacy.Disclosure(everywhere=True)), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packs.pack(docs, public_tokenizers.path(VOCABULARY), max_length=SEQUENCE, keep_cache=False)


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", quality_rules),
          ("simhash_near_dedup", simhash_near_dedup), ("pii", pii), ("packing", packing)]

#: A fitted model, fingerprints and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; the rows of the last one."""
    out = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, out, sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
    return out
