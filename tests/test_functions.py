from pyspark.sql import functions as F

from letrado.functions.scalar import clean_double, norm_text, round2, status_meta, strip_ws


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("x")).alias("y")).first()["y"]


def test_norm_text_accents_and_spaces(spark):
    assert one(spark, norm_text, "são paulo") == "SAO PAULO"
    assert one(spark, norm_text, "  SP  ") == "SP"
    assert one(spark, norm_text, "São João d'Água") == "SAO JOAO D'AGUA"


def test_norm_text_decomposed_input_and_compat_chars(spark):
    assert one(spark, norm_text, "Sa\u0303o") == "SAO"      # NFD input
    # as Python's strip/upper/NFKD: the ordinal indicator folds to a lower-case o
    assert one(spark, norm_text, "N\u00ba 1") == "No 1"
    assert one(spark, norm_text, "\u00bd") == "12"          # one half, as NFKD gives
    assert one(spark, norm_text, "\tRio\n") == "RIO"         # tabs/newlines trimmed
    assert one(spark, norm_text, None) is None


def test_norm_text_equals_unicodedata_on_adversarial_rows(spark):
    import random
    import unicodedata
    rng = random.Random(1)
    texts = ["Nghệ An", "ﬁm de ½ ㎏", "Ǆ ŉ ß", "𝐀𝟙 🄀 ⑴", "日本 Ω", "a\u0301\u0323", "\u1E9E", "x" * 5000 + "ệ"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x1E00, 0x2500), rng.randrange(0xF900, 0xFFEF),
                                      rng.randrange(0x1D400, 0x1F200)])) for _ in range(12)) for _ in range(300)]
    texts = [t for t in texts if t == t.strip()]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
           .orderBy("i").select(norm_text("x")).collect()]
    upper = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
             .orderBy("i").selectExpr("upper(x)").collect()]
    for t, u, g in zip(texts, upper, got):
        assert g == "".join(c for c in unicodedata.normalize("NFKD", u) if ord(c) < 128), t
    assert got[0] == "NGHE AN"


def test_strip_ws_keeps_inner_spaces(spark):
    assert one(spark, strip_ws, " a  b\t") == "a  b"


def test_round2_half_away_on_decimal_ties(spark):
    for v, want in [(61.5949999, 61.59), (61.595, 61.6), (1e13 + 0.25, 1e13 + 0.25), (1e30, 1e30), (-0.005, -0.01), (50.015, 50.02), (0.125, 0.13), (-0.125, -0.13), (2.675, 2.68), (1.005, 1.01)]:
        assert one(spark, round2, v, "x double") == want


def test_round2_equals_decimal_arithmetic(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal
    rng = random.Random(2)
    values = [rng.uniform(-100, 100) for _ in range(500)] + [rng.randrange(-10**6, 10**6) / 1000 for _ in range(500)]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
           .orderBy("i").select(round2("x")).collect()]
    twelve = Decimal("0.000000000001")
    assert got == [float(Decimal(repr(v)).quantize(twelve, ROUND_HALF_UP).quantize(Decimal("0.01"), ROUND_HALF_UP))
                   for v in values]


def test_clean_double_turns_nan_into_null(spark):
    assert one(spark, clean_double, float("nan"), "x double") is None
    assert one(spark, clean_double, 1.5, "x double") == 1.5


def test_status_meta_three_ways(spark):
    df = spark.createDataFrame([(75.0, 70.0), (65.0, 70.0), (70.0, None), (None, 70.0)], "i double, m double")
    got = [r[0] for r in df.select(status_meta("i", "m")).collect()]
    assert got == ["ATINGIDA", "NAO_ATINGIDA", "SEM_META", "SEM_META"]
