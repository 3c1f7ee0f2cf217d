"""Silver stored by municipality: joins and windows per municipality move no row of the fact."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from letrado.operators.integrity import referential_filter
from letrado.plans import features, gold, silver
from letrado.queries import QUERIES, bronze
from letrado.sources.bucketed import BucketedSilver


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def stored(spark):
    import tempfile
    b = bronze(spark, SF_SMALL)
    s = silver.build_silver(b)
    layer = BucketedSilver(spark, tempfile.mkdtemp(prefix="letrado-test-"), "bucket_test", buckets=4)
    tables = {e: s[e] for e in ("ufs", "municipios", "meta_brasil", "meta_municipio")}
    # the fact before its integrity check, so that the semi-join is planned on stored tables too
    tables["indicador_alfabetizacao"] = silver.prepare_indicador(b["indicador_alfabetizacao"])
    yield layer.write_all(tables)
    layer.drop(list(tables))


def exchanges(df):
    """The keys of the hash exchanges of the plan that ran."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return [", ".join(re.sub(r"#\d+L?", "", keys).split(", ")[:-1]) for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", final)]


def four_steps(fact, municipios, goals):
    df = referential_filter(fact, municipios, "id_municipio")
    df = df.join(gold.goals_by_year(goals), "id_municipio", "left").join(municipios, "id_municipio", "left")
    by = Window.partitionBy("id_municipio").orderBy("ano")
    return df.withColumn("lag1", F.lag("indicador_alfabetizacao", 1).over(by)).withColumn("lag2", F.lag("indicador_alfabetizacao", 2).over(by))


def test_semi_join_goal_join_name_join_and_lags_move_nothing(spark, stored, no_broadcast):
    s = stored
    assert exchanges(four_steps(s["indicador_alfabetizacao"], s["municipios"], s["meta_municipio"])) == []
    loose = {e: spark.createDataFrame(s[e].collect(), s[e].schema) for e in ("indicador_alfabetizacao", "municipios", "meta_municipio")}
    moved = exchanges(four_steps(loose["indicador_alfabetizacao"], loose["municipios"], loose["meta_municipio"]))
    assert moved.count("id_municipio") >= 3             # the same without the stored distribution


def test_gold_from_stored_tables_moves_the_fact_only_for_the_national_goal(spark, stored, no_broadcast):
    s = dict(stored)
    s["indicador_alfabetizacao"] = silver.finish_indicador(s["indicador_alfabetizacao"], s["municipios"])
    im = gold.build_gold(s)["indicador_municipio"]
    found = exchanges(im)
    assert found.count("ano") == 2 and found.count("id_municipio") <= 1      # fact and goals by year; the dimension with its states
    want = QUERIES["indicador_municipio"](spark, SF_SMALL)
    assert sorted(rows(im.select(*want.columns)), key=str) == sorted(rows(want), key=str)


def test_with_small_dimensions_broadcast_the_fact_is_not_moved_at_all(spark, stored):
    s = dict(stored)
    s["indicador_alfabetizacao"] = silver.finish_indicador(s["indicador_alfabetizacao"], s["municipios"])
    ml = features.build_ml_features(gold.build_gold(s)["indicador_municipio"])
    ml.write.format("noop").mode("overwrite").save()
    fact = ml._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Exchange hashpartitioning(id_municipio" not in fact, fact
    want = QUERIES["ml_features"](spark, SF_SMALL)
    assert sorted(rows(ml.select(*want.columns)), key=str) == sorted(rows(want), key=str)


def test_unstored_plan_joins_goals_and_names_on_one_distribution(spark, no_broadcast):
    """Without stored tables the fact moves for the de-duplication and once by municipality."""
    found = exchanges(features.build_ml_features(gold.build_gold(silver.build_silver(bronze(spark, SF_SMALL)))["indicador_municipio"]))
    assert found.count("id_municipio, ano") == 2          # fact and goals, to drop duplicates; no join or window asks for it again
