from letrado.plans import observability as obs

SCHEMA = "run_id string, stage string, entity string, status string"


def overall(spark, events):
    return obs.run_status(spark.createDataFrame(events, SCHEMA)).first()["overall_status"]


def test_partial_bronze_alone_keeps_success(spark):
    ev = [("r", "bronze", "a", "SUCCESS"), ("r", "bronze", "b", "FAILED"), ("r", "silver", "a", "SUCCESS"),
          ("r", "gold", "g", "SUCCESS"), ("r", "quality", "validation", "SUCCESS")]
    assert overall(spark, ev) == "SUCCESS"
    st = {r["stage"]: r["status"] for r in obs.stage_status(spark.createDataFrame(ev, SCHEMA)).collect()}
    assert st["bronze"] == "PARTIAL"


def test_partial_silver_and_quality_warnings_make_partial(spark):
    ev = [("r", "bronze", "a", "SUCCESS"), ("r", "silver", "a", "SUCCESS"), ("r", "silver", "b", "FAILED"),
          ("r", "gold", "g", "SUCCESS"), ("r", "quality", "validation", "SUCCESS")]
    assert overall(spark, ev) == "PARTIAL"
    ev2 = [("r", "silver", "a", "SUCCESS"), ("r", "quality", "validation", "WARNINGS")]
    assert overall(spark, ev2) == "PARTIAL"


def test_failed_stage_fails_the_run(spark):
    ev = [("r", "silver", "a", "SUCCESS"), ("r", "gold", "g", "FAILED")]
    assert overall(spark, ev) == "FAILED"


def test_freshness_counts_whole_days(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "_ingestion_timestamp string")
    empty = spark.createDataFrame([], "_ingestion_timestamp string")
    r = {x["entity"]: x for x in obs.freshness({"old": df, "none": empty}, "2024-01-03 06:00:00").collect()}
    assert r["old"]["age_hours"] == 54.0 and r["old"]["status"] == "stale"
    assert r["none"]["status"] == "no_data"
    fresh = obs.freshness({"x": df}, "2024-01-02 00:30:00").first()
    assert fresh["status"] == "healthy" and fresh["age_hours"] == 24.5


def test_gold_completeness_lists_missing(spark):
    t = {"indicador_municipio": spark.range(3), "evolucao_uf": spark.range(0)}
    r = obs.gold_completeness(spark, t).first()
    assert r["status"] == "incomplete" and r["found"] == "indicador_municipio"
    assert r["missing"] == "evolucao_uf,painel_nacional"


def test_health_composite(spark):
    ok = spark.createDataFrame([("a", True), ("b", True)], "check string, ok boolean")
    bad = spark.createDataFrame([("a", True), ("b", False)], "check string, ok boolean")
    assert obs.health(ok).first()["overall"] == "healthy"
    assert obs.health(bad).first()["overall"] == "degraded"
