import random

import pytest

from letrado.llm.common import prepare

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use for their own columns
CLASHES = ("kept", "score", "row_number", "fingerprint", "spans", "ids", "n_tokens", "quality_rules", "text_statistics",
           "text_parts", "quality_score", "id", "fp", "row")


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]


def prose(rng, words, vocabulary=None):
    names = vocabulary or ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    out = [rng.choice(names) for _ in range(words)]
    return " ".join(w + ("." if i % 9 == 8 or i == words - 1 else "") for i, w in enumerate(out))


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty and very long texts, copies, near copies, repeated rows and ids."""
    rng = random.Random(5)
    plain = [prose(rng, 60) for _ in range(6)]
    near = plain[0].split(" ")
    near[30] = "changed"
    long = "\n".join(prose(rng, 400) for _ in range(60))
    rows = [(i, t, "en", "src0", len(t)) for i, t in enumerate(plain)]
    rows += [(10, plain[0], "en", "src1", 5), (11, " ".join(near), None, None, None), (12, long, "en", "src0", len(long)),
             (13, None, "de", "src0", 0), (14, "", "de", "src0", 0), (15, " \n\t ", None, "src2", 4), (16, "one", "en", "s", 3),
             (None, plain[1], "en", "src0", 1), (None, None, None, None, None), (17, "x" * 50_000, "en", "src0", 50_000),
             (18, plain[2], "en", "src0", 3), (18, plain[2], "en", "src0", 3), (19, "Mail a.b@c.example.org now", "en", "s", 1),
             (20, "é ñ 日本 <|endoftext|>   z\r\n", "en", "s", 2)]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    prepare(spark)
    return spark.createDataFrame(messy_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(spark, messy):
    from pyspark.sql import functions as F
    out = messy
    for c in CLASHES:
        out = out.withColumn(c, F.lit("taken"))
    return out.cache()


@pytest.fixture(scope="session")
def no_rows(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)
