"""The pipeline's stages, the registered queries and the README's promises about them."""

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from letrado.llm.queries import ORACLE, QUERIES
from letrado.session import scratch_path


@pytest.fixture(scope="module")
def labelled(tmp_path_factory, spark):
    """Documents with planted cases, and their labels, as a folder of tables."""
    rng = random.Random(9)
    names = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(names) + ("." if i % 8 == 7 or i == n - 1 else "") for i in range(n))

    docs = [(i, prose(120)) for i in range(120)]
    junk = [(1000 + i, " ".join(w + "###" for w in prose(100).split(" "))) for i in range(60)]
    copies = [(2000 + i, docs[5][1]) for i in range(40)]
    private = [(3000 + i, prose(60) + f" Mail user{i}@corp.example.com today. " + prose(30)) for i in range(10)]
    root = str(tmp_path_factory.mktemp("tables"))
    every = docs + junk + copies + private
    (spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in every], "doc_id long, text string, lang string, source string, n_chars long")
     .write.parquet(f"{root}/documents.parquet"))
    (spark.createDataFrame([(i, int(not 1000 <= i < 2000), 0) for i, _ in every], "doc_id long, quality int, toxic int")
     .write.parquet(f"{root}/labels.parquet"))
    return root


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "simhash_near_dedup", "pii", "packing"]


def test_stage_decisions_take_effect(spark, labelled):
    docs = spark.read.parquet(f"{labelled}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, "test")
        stage(spark, docs, labelled).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        seen.append({r.doc_id: r.text for r in docs.collect()})
    scored, judged, single, clean = seen
    assert not any(1000 <= i < 2000 for i in scored) and set(range(120)) <= set(scored)
    assert set(range(120)) <= set(judged)
    assert not any(2000 <= i < 3000 for i in single) and set(range(120)) <= set(single)
    assert all("@" not in t for t in clean.values()) and all(3000 + i in clean for i in range(10))
    assert docs.where("n_chars != length(text)").count() == 0
    packed = corpus_pipeline.packing(spark, docs, labelled).collect()
    assert {r.doc_id for r in packed} == set(clean)


def test_stages_on_messy_and_empty_tables(spark, clashing, no_rows, labelled):
    for table in (clashing, no_rows):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, labelled)
            assert out.columns == table.columns, name
            assert out.count() <= table.count()
    assert corpus_pipeline.packing(spark, no_rows, labelled).count() == 0


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(ORACLE[name])
    names = [d[0] for d in res.description]
    df = E.queries()[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(names)
    assert Counter(map(tuple, df.select(*names).collect())) == Counter(res.fetchall())


COLUMNS = {
    2: "doc_id start length ids_crc32 doc_tokens sequence_id offset", 3: "doc_id held_out score predicted",
    4: "doc_id n_bytes n_tokens over_limit",
    5: "doc_id held_out n_tokens n_known train_tokens base_score score",
    6: "doc_id n_email n_ip n_card n_phone base_sha256 spans", 8: "doc_id n_tokens ids_sha256 decoded_sha256",
    9: "page_id url text n_chars", 10: "doc_id fingerprint component_id",
}


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_query_returns_its_columns_for_every_row(spark, number):
    name = next(n for n in QUERIES if n.startswith(f"op{number}_"))
    df = E.queries()[name](spark, SF_SMALL)
    assert df.columns == COLUMNS[number].split()
    table = spark.read.parquet(f"{SF_SMALL}/{'pages' if number == 9 else 'documents'}.parquet")
    assert df.select(F.col(df.columns[0])).distinct().count() == table.count()
