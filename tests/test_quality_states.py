"""Quality from stored states, and distinct counts from sketches, against their exact forms."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from letrado.plans import quality, sketches
from letrado.plans.quality_states import QualityStates

RULES = {("silver", "t"): {"key_cols": ["id", "ano"], "critical_cols": ["id", "v", "absent"], "min_rows": 3}}
SCHEMA = "id string, ano int, indicador_alfabetizacao double, v string"
DAYS = {"2024-01-01": [("a", 2001, 50.0, "x"), ("a", 2001, 101.0, None), (None, 2001, None, "x"), ("a", None, 5.0, "x")],
        "2024-01-02": [("a", 2001, 1.0, "x"), (None, 2001, 2.0, "x"), ("b", 1800, -3.0, None)],
        "2024-01-03": []}


def same(a, b):
    assert sorted(rows(a, *quality.REPORT_COLS), key=str) == sorted(rows(b, *quality.REPORT_COLS), key=str)


@pytest.fixture()
def states(spark, tmp_root):
    s = QualityStates(spark, tmp_root, RULES)
    for day, values in DAYS.items():
        s.add(day, "silver", "t", spark.createDataFrame(values, SCHEMA))
    return s


def test_report_over_days_equals_the_report_over_all_rows(spark, states):
    every = spark.createDataFrame([r for v in DAYS.values() for r in v], SCHEMA)
    same(states.report(consistency=None), quality.run_entity_checks(every, "t", "silver", RULES["silver", "t"]))
    one = spark.createDataFrame(DAYS["2024-01-02"], SCHEMA)
    same(states.report(["2024-01-02"], None), quality.run_entity_checks(one, "t", "silver", RULES["silver", "t"]))


def test_a_day_written_again_replaces_its_state(spark, states):
    new = [("z", 2005, 7.0, "x")]
    states.add("2024-01-01", "silver", "t", spark.createDataFrame(new, SCHEMA))
    every = spark.createDataFrame(new + DAYS["2024-01-02"], SCHEMA)
    same(states.report(consistency=None), quality.run_entity_checks(every, "t", "silver", RULES["silver", "t"]))


def test_an_entity_without_states_is_a_failing_row(spark, states):
    states.rules = {**RULES, ("gold", "none"): {"key_cols": ["id"]}}
    row = states.report(consistency=None).where("entity = 'none'").first()
    assert row.check_name == "arquivo_existente" and not row.passed


def test_sketches_merge_to_every_level_within_their_error(spark):
    n = 60_000
    ind = spark.range(n * 2).select((F.col("id") % n).cast("string").alias("id_municipio"),
                                    (2000 + F.col("id") % 3).cast("int").alias("ano"))
    mun = spark.range(n).select(F.col("id").cast("string").alias("id_municipio"), (F.col("id") % 2).cast("string").alias("id_uf"))
    stored = sketches.municipality_sketches(ind, mun)
    assert stored.count() == 6
    got = sketches.compare(stored, ind, mun)
    assert got.count() == 6 + 2 + 3 + 1 and got.where("NOT within_error").count() == 0
    total = sketches.estimate(stored, []).first()[0]
    assert abs(total - n) <= 3 * sketches.STANDARD_ERROR * n
