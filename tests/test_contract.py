"""Driver contract, oracle agreement on sf0.001 and physical-plan properties."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from letrado.sources.tables import DRIVER_TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "indicador_medio_nacional" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    own = set(E.QUERIES)
    assert len(own & set(E.oracle_sql())) >= len(own) - 3


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    return repr(v) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", ["painel_nacional", "evolucao_uf", "indicador_municipio", "ml_features",
                                  "quality_report", "stream_upsert", "silver_alunos", "alert_windows"])
def test_matches_oracle_small(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    s = sorted("|".join(_norm(r[c]) for c in order) for r in df.collect())
    o = sorted("|".join(_norm(r[ocols.index(c)]) for c in order) for r in res.fetchall())
    assert s == o


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_in_any_query(spark):
    for name in E.QUERIES:
        fn = E.queries()[name]
        if name in ("ml_predict", "ml_evaluate", "partition_roundtrip", "dual_format_export"):
            continue
        plan = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = E.queries()["silver_indicador"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_partition_filter_reaches_the_scan(spark):
    df = E.queries()["partition_roundtrip"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(gold_date" in plan or "PartitionFilters: [" in plan
    assert "ano" in plan


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()   # AQE's final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_joins_are_broadcast(spark):
    plan = _final_plan(E.queries()["indicador_municipio"](spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 3          # states, national goals, codes


def test_group_aggregates_are_partial_before_the_exchange(spark):
    plan = E.queries()["painel_nacional"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and "partial_count" in plan

