"""Full pipeline run into a scratch folder: every layer is written and the
written gold equals the registered query of the same table."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from letrado.plans import job, probes
from letrado.queries import QUERIES
from letrado.sources import io


def test_full_run_writes_every_layer(spark, tmp_root):
    out = job.run_pipeline(spark, SF_SMALL, tmp_root, "2024-01-31",
                           stages=("bronze", "silver", "gold", "quality", "health"))
    assert out["overall_status"] in ("SUCCESS", "PARTIAL")
    assert out["quality"]["total"] == 36
    ev = spark.read.parquet(f"{tmp_root}/monitoring/run_events")
    assert ev.where(F.col("status") == "FAILED").count() == 0

    painel = io.read_layer(spark, tmp_root, "gold", "painel_nacional", "2024-01-31").drop("_gold_timestamp")
    want = QUERIES["painel_nacional"](spark, SF_SMALL)
    assert painel.select(*want.columns).exceptAll(want).count() == 0
    assert want.exceptAll(painel.select(*want.columns)).count() == 0

    ml = io.read_layer(spark, tmp_root, "gold", "ml_features", "2024-01-31")
    assert ml.count() == QUERIES["ml_features"](spark, SF_SMALL).count()

    rejects = {(r.entity, r.reason): r.n_rows for r in spark.read.parquet(f"{tmp_root}/monitoring/reject_counts").collect()}
    for entity in {e for e, _ in rejects}:
        assert rejects[entity, "entrada"] == sum(n for (e, r), n in rejects.items() if e == entity and r != "entrada")
    assert spark.read.parquet(f"{tmp_root}/monitoring/rejected_rows").where("row IS NULL").count() == 0
    metrics = spark.read.parquet(f"{tmp_root}/monitoring/ingestion_metrics")
    assert metrics.where("rejected_rows < 0 OR duration_s IS NULL OR uri IS NULL").count() == 0
    report = spark.read.parquet(f"{tmp_root}/monitoring/run_reports").first()
    assert report.overall_status == out["overall_status"] and report.ended > report.started and report.n_events == out["events"]

    # re-running the same date replaces that date's partitions
    job.run_pipeline(spark, SF_SMALL, tmp_root, "2024-01-31", stages=("bronze",))
    assert io.read_layer(spark, tmp_root, "bronze", "ufs", "2024-01-31").count() == 25
    assert spark.read.parquet(f"{tmp_root}/monitoring/run_events").select("run_id").distinct().count() == 2


def test_run_with_stream_merges_events(spark, tmp_root):
    out = job.run_pipeline(spark, SF_SMALL, tmp_root, "2024-01-31",
                           stages=("bronze", "stream", "silver", "gold"))
    assert out["overall_status"] in ("SUCCESS", "PARTIAL")
    ind = io.read_layer(spark, tmp_root, "silver", "indicador_alfabetizacao", "2024-01-31")
    want = QUERIES["stream_upsert"](spark, SF_SMALL)
    got = ind.select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    q = spark.read.parquet(f"{tmp_root}/monitoring/quarantine")
    n, stored = q.count(), spark.read.parquet(f"{tmp_root}/silver/streaming_events").count()
    assert n > 0

    # the same date again: the same events, not twice; all four gold tables exported
    job.run_pipeline(spark, SF_SMALL, tmp_root, "2024-01-31", stages=("stream", "silver", "export"))
    assert spark.read.parquet(f"{tmp_root}/silver/streaming_events").count() == stored
    assert spark.read.parquet(f"{tmp_root}/monitoring/quarantine").count() == n
    for table in job.GOLD_TABLES:
        kept = io.read_layer(spark, tmp_root, "gold", table, "2024-01-31").count()
        assert spark.read.parquet(f"{tmp_root}/export/{table}/parquet").count() == kept
        assert spark.read.option("header", True).csv(f"{tmp_root}/export/{table}/csv").count() == kept


def test_gold_is_not_built_on_a_failed_silver(spark, tmp_root, monkeypatch):
    job.run_pipeline(spark, SF_SMALL, tmp_root, "2024-01-31", stages=("bronze",))

    def broken(*_, **__):
        raise ValueError("x" * 2000)

    monkeypatch.setattr(job.silver, "transform_alunos", broken)
    out = job.run_pipeline(spark, SF_SMALL, tmp_root, "2024-01-31", stages=("silver", "gold", "export", "quality", "health"))
    assert out["overall_status"] == "FAILED" and out["quality"] is None
    events = spark.read.parquet(f"{tmp_root}/monitoring/run_events").where(F.col("run_id") == out["run_id"])
    assert events.where("stage = 'gold' AND status = 'ABORTED'").count() == 4
    assert events.where("status = 'FAILED' AND length(details) > 2000").count() >= 1       # the whole error text
    assert events.where("stage IN ('export', 'quality', 'health')").count() == 0


def test_no_events_at_all_is_an_empty_table(spark, tmp_root):
    assert io.read_events(spark, tmp_root, "2024-01-31").count() == 0
    out = job.run_pipeline(spark, SF_SMALL, tmp_root, "2024-01-31", stages=("bronze", "silver"))
    assert out["overall_status"] == "SUCCESS"


DAY = "2024-01-31"


def test_metrics_come_from_the_writes_and_equal_the_reject_counts(spark, tmp_root, monkeypatch):
    job.run_pipeline(spark, SF_SMALL, tmp_root, DAY, stages=("bronze",))

    def second_pass(*_, **__):
        raise AssertionError("the job counted bronze again")

    monkeypatch.setattr(job.rejects, "reject_counts", second_pass)
    out = job.run_pipeline(spark, SF_SMALL, tmp_root, DAY, stages=("silver",))
    assert out["overall_status"] == "SUCCESS"
    monkeypatch.undo()
    stored = spark.read.parquet(f"{tmp_root}/monitoring/reject_counts").drop("date")
    want = QUERIES["reject_counts"](spark, SF_SMALL)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, want.select(*stored.columns).collect()))
    metrics = spark.read.parquet(f"{tmp_root}/monitoring/ingestion_metrics")
    assert metrics.where("bronze_rows <> silver_rows + duplicate_rows + rejected_rows").count() == 0


def test_a_stage_that_ran_twice_is_counted_from_the_tables(spark, tmp_root, monkeypatch):
    job.run_pipeline(spark, SF_SMALL, tmp_root, DAY, stages=("bronze",))
    monkeypatch.setattr(probes.WriteProbe, "whole", lambda self, e, written: e != "alunos")
    job.run_pipeline(spark, SF_SMALL, tmp_root, DAY, stages=("silver",))
    stored = spark.read.parquet(f"{tmp_root}/monitoring/reject_counts").drop("date")
    want = QUERIES["reject_counts"](spark, SF_SMALL)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, want.select(*stored.columns).collect()))


def test_models_can_be_scored_after_an_observed_write(spark, tmp_root):
    job.run_pipeline(spark, SF_SMALL, tmp_root, DAY, stages=("bronze", "silver"))
    assert QUERIES["ml_predict"](spark, SF_SMALL).count() > 0


def test_events_that_do_not_parse_leave_silver_unwritten(spark, tmp_root, monkeypatch):
    job.run_pipeline(spark, SF_SMALL, tmp_root, DAY, stages=("bronze", "stream"))

    def broken(*_, **__):
        raise ValueError("no parse")

    monkeypatch.setattr(job, "prepare_events", broken)
    out = job.run_pipeline(spark, SF_SMALL, tmp_root, DAY, stages=("stream", "silver", "gold"))
    assert out["overall_status"] == "FAILED"
    assert not os.path.exists(f"{tmp_root}/silver/indicador_alfabetizacao")     # not half a table
    assert io.read_layer(spark, tmp_root, "silver", "municipios", DAY).count() > 0


def test_a_dimension_that_fails_takes_its_dependants_along(spark, tmp_root, monkeypatch):
    job.run_pipeline(spark, SF_SMALL, tmp_root, DAY, stages=("bronze",))

    def broken(*_, **__):
        raise ValueError("no municipalities")

    monkeypatch.setattr(job.silver, "transform_municipios", broken)
    out = job.run_pipeline(spark, SF_SMALL, tmp_root, DAY, stages=("silver",))
    assert out["overall_status"] == "FAILED"
    events = spark.read.parquet(f"{tmp_root}/monitoring/run_events").where(F.col("run_id") == out["run_id"])
    failed = {r["entity"] for r in events.where("stage = 'silver' AND status = 'FAILED'").collect()}
    assert {"municipios", "indicador_alfabetizacao", "alunos", "meta_municipio"} <= failed and "ufs" not in failed


@pytest.mark.parametrize("where", ["quality", "status"])
def test_a_run_that_breaks_leaves_its_audit(spark, tmp_root, monkeypatch, where):
    def broken(*_, **__):
        raise ValueError("broken stage")

    if where == "quality":
        monkeypatch.setattr(job.quality, "quality_report", broken)
        out = job.run_pipeline(spark, SF_SMALL, tmp_root, DAY, stages=("quality",))
        assert out["quality"] is None and out["overall_status"] != "SUCCESS"
    else:
        monkeypatch.setattr(job, "_silver", broken)
        with pytest.raises(ValueError):
            job.run_pipeline(spark, SF_SMALL, tmp_root, DAY, stages=("silver",))
    events = spark.read.parquet(f"{tmp_root}/monitoring/run_events")
    assert events.where("status = 'FAILED' AND details LIKE '%broken stage%'").count() == 1
    assert spark.read.parquet(f"{tmp_root}/monitoring/run_reports").count() == 1
