"""Full pipeline run: bronze -> silver -> gold -> features -> quality -> health.

Every stage reads what the previous stage wrote (which also cuts lineage) and
writes one partition per run date, so re-running a date is idempotent and a
lost executor only re-runs its tasks.  Gold, export and everything after them
are not run on a silver that failed: what an earlier run left under that date
must not pass for this run's.  The driver only sequences stages and keeps a
run-event list (one entry per stage entity); all data work is Spark jobs.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letrado.plans import features, gold, observability, probes, quality, rejects, silver
from letrado.plans.lazy import LazyTables
from letrado.session import remove_folder, scratch_path
from letrado.sources import io, mapping
from letrado.streaming.events import FLAT_COLS, enrich_events, prepare_events
from letrado.streaming.upsert import QUARANTINE_COLS

STAGES = ("bronze", "stream", "silver", "gold", "export", "quality", "health")
GOLD_TABLES = ("indicador_municipio", "evolucao_uf", "painel_nacional", "ml_features")
RUN_EVENT_SCHEMA = ("run_id string, ts timestamp, stage string, entity string, status string, "
                    "details string, duration_s double")
REPORT_SCHEMA = ("run_id string, run_date date, started timestamp, ended timestamp, duration_s double, "
                 "overall_status string, n_events int")


class RunLog:
    """Audit trail of one run; written once as a table at the end."""

    def __init__(self, run_id: str):
        self.run_id = run_id
        self.rows: list[tuple] = []

    def event(self, stage: str, entity: str, status: str, details: str = "", duration_s: float = 0.0):
        self.rows.append((self.run_id, dt.datetime.now(dt.timezone.utc), stage, entity, status,
                          details, float(duration_s)))

    def failed(self, stage: str, entity: str | None = None) -> bool:
        return any(r[2] == stage and entity in (None, r[3]) and r[4] == "FAILED" for r in self.rows)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, RUN_EVENT_SCHEMA)


def _timed(log: RunLog, stage: str, entity: str, fn, verdict=lambda out: ("SUCCESS", "")):
    t0 = time.time()
    try:
        out = fn()
        log.event(stage, entity, *verdict(out), time.time() - t0)
        return out
    except Exception as e:  # noqa: BLE001 - a failed entity is recorded, the run goes on
        log.event(stage, entity, "FAILED", f"{type(e).__name__}: {e}", time.time() - t0)
        return None


def _silver(spark: SparkSession, log: RunLog, root: str, run_date: str, run_ts: str, with_stream: bool,
            entities: Sequence[str]) -> None:
    """Write every silver entity, counted while it is written.  An entity whose input is not whole (the events did not
    parse, a dimension failed) is not written: what an earlier run left stays, and the run says so."""
    session = probes.observed_session(spark)

    def bronze_of(e):
        return lambda: io.read_layer(session, root, "bronze", e, run_date).drop("_source", "_batch_date")
    b = LazyTables({e: bronze_of(e) for e in entities})
    stream, parsed, half = None, scratch_path(spark, "events"), set()
    if with_stream:
        def parse():  # parsed once; three outputs read it
            prepare_events(io.read_events(session, root, run_date)).write.parquet(parsed)
            return session.read.parquet(parsed)
        events = _timed(log, "silver", "events", parse)
        if events is None:
            half = {"indicador_alfabetizacao"}
        else:
            _timed(log, "silver", "quarantine", lambda: events.where(~F.col("is_valid")).select(*QUARANTINE_COLS)
                   .write.mode("overwrite").parquet(f"{root}/monitoring/quarantine/date={run_date}"))
            stream = events.where(F.col("is_valid")).select(*FLAT_COLS)
            _timed(log, "silver", "streaming_events", lambda: io.write_layer(
                enrich_events(stream, F.lit(run_date).cast("date")), root, "silver", "streaming_events", run_date))

    def written(e):
        return io.read_layer(session, root, "silver", e, run_date).drop("_silver_timestamp")

    probe = probes.WriteProbe()
    s = silver.build_silver(b, stream=stream, keep_lineage=True, dims=written, probe_of=probe.of)
    counts, again = [], []
    for entity in s:
        needs = [d for d in silver.DIMENSIONS.get(entity, ()) if log.failed("silver", d)]
        if entity in half or needs:
            log.event("silver", entity, "FAILED", f"not written: no whole input ({', '.join(needs) or 'events'})")
            continue

        def write(e=entity):
            rows, staged = s[e], None
            if io.LAYOUT.get(("silver", e), {}).get("cluster"):
                # range bounds are sampled from the rows first: computed rows would be made, and counted, twice
                staged = scratch_path(spark, f"staged-{e}")
                rows.write.parquet(staged)
                rows = session.read.parquet(staged)
            io.write_layer(io.add_audit_columns(rows, "silver", run_ts), root, "silver", e, run_date)
            if staged:
                remove_folder(spark, staged)
            if probe.whole(e, written(e)):
                return probe.counts(e)
            again.append(e)                        # a stage was run again, so its rows were counted twice
            return []
        counts += _timed(log, "silver", entity, write) or []
    remove_folder(spark, parsed)

    def account():
        dims = {e: written(e) for e in ("ufs", "municipios")}
        recounted = rejects.reject_counts(b, dims).where(F.col("entity").isin(again)).collect() if again else []
        _account(spark, log, root, run_date, counts + [tuple(r) for r in recounted], b, dims)
    _timed(log, "accounting", "rejects", account)


def _account(spark: SparkSession, log: RunLog, root: str, run_date: str, counts: list, b, dims) -> None:
    """Reject counts and ingestion metrics from what the writes counted; the rejected rows from bronze."""
    path = f"{root}/monitoring/reject_counts/date={run_date}"
    spark.createDataFrame(counts, probes.REJECT_SCHEMA).write.mode("overwrite").parquet(path)   # a handful of rows an entity
    rejects.rejected_rows(b, dims).write.mode("overwrite").parquet(f"{root}/monitoring/rejected_rows/date={run_date}")
    took = spark.createDataFrame([(e, st, d, p) for _, _, g, e, st, p, d in log.rows if g == "silver"],
                                 "entity string, stage_status string, duration_s double, details string")
    (observability.ingestion_metrics(spark.read.parquet(path)).join(F.broadcast(took), "entity", "left")
     .select("entity", F.lit(run_date).cast("date").alias("run_date"),
             F.concat(F.lit(f"{root}/silver/"), "entity").alias("uri"), "bronze_rows", "silver_rows", "duplicate_rows",
             "rejected_rows", F.coalesce("stage_status", "status").alias("status"), "duration_s")
     .write.mode("overwrite").parquet(f"{root}/monitoring/ingestion_metrics/date={run_date}"))


def run_pipeline(spark: SparkSession, sf_dir: str, root: str, run_date: str,
                 run_ts: str | None = None, stages: Sequence[str] = STAGES) -> dict:
    """One run for ``run_date``; a run keeps its own audit, also when the date is run again."""
    run_ts = run_ts or f"{run_date} 00:00:00"
    started = dt.datetime.now(dt.timezone.utc)
    run_id = f"run_{run_date.replace('-', '')}_{uuid.uuid4().hex[:8]}"
    log = RunLog(run_id)
    summary = None
    try:
        summary = _stages(spark, sf_dir, root, run_date, run_ts, stages, log)
    except Exception as e:
        log.event("run", "pipeline", "FAILED", f"{type(e).__name__}: {e}")
        raise
    finally:        # whatever happened, the run leaves its audit
        status, ended = _report(spark, log, root, run_date, started)
    return {"run_id": run_id, "overall_status": status, "quality": summary, "events": len(log.rows),
            "started": started.isoformat(), "ended": ended.isoformat(), "duration_s": (ended - started).total_seconds()}


def _report(spark: SparkSession, log: RunLog, root: str, run_date: str, started: dt.datetime) -> tuple[str, dt.datetime]:
    events = log.frame(spark)
    events.drop("run_id").write.mode("errorifexists").parquet(f"{root}/monitoring/run_events/run_id={log.run_id}")
    overall = observability.run_status(events).first()
    status = overall["overall_status"] if overall else "FAILED"
    ended = dt.datetime.now(dt.timezone.utc)
    spark.createDataFrame([(log.run_id, dt.date.fromisoformat(run_date), started, ended, (ended - started).total_seconds(), status,
                            len(log.rows))], REPORT_SCHEMA).drop("run_id").write.parquet(
        f"{root}/monitoring/run_reports/run_id={log.run_id}")
    return status, ended


def _stages(spark: SparkSession, sf_dir: str, root: str, run_date: str, run_ts: str, stages: Sequence[str], log: RunLog) -> dict | None:
    """Run the stages; the quality summary, if there is one."""
    if "bronze" in stages:
        for entity, df in mapping.bronze_entities(spark, sf_dir).items():
            _timed(log, "bronze", entity, lambda df=df, e=entity: io.write_layer(
                io.add_audit_columns(df, "bronze", run_ts), root, "bronze", e, run_date))

    if "stream" in stages:
        # the producer side: one NDJSON line per event, partitioned by run day
        _timed(log, "stream", "events", lambda: io.write_events(
            mapping.stream_messages(spark.read.parquet(f"{sf_dir}/events.parquet")), root, run_date))

    if "silver" in stages:
        _silver(spark, log, root, run_date, run_ts, "stream" in stages, list(mapping.bronze_entities(spark, sf_dir)))

    def silver_of(e):
        return io.read_layer(spark, root, "silver", e, run_date).drop("_silver_timestamp")

    blocked = log.failed("silver")
    if blocked:
        for table in GOLD_TABLES if "gold" in stages else ():
            log.event("gold", table, "ABORTED", "silver failed")
    elif "gold" in stages:
        sv = LazyTables({e: (lambda e=e: silver_of(e)) for e in
                         ("ufs", "municipios", "indicador_alfabetizacao", "meta_brasil", "meta_uf", "meta_municipio")})
        g = gold.build_gold(sv)
        for table in g:
            _timed(log, "gold", table, lambda t=table: io.write_layer(
                io.add_audit_columns(g[t], "gold", run_ts), root, "gold", t, run_date))
        _timed(log, "gold", "ml_features", lambda: io.write_layer(
            io.add_audit_columns(features.build_ml_features(
                io.read_layer(spark, root, "gold", "indicador_municipio", run_date).drop("_gold_timestamp")),
                "gold", run_ts), root, "gold", "ml_features", run_date))

    blocked = blocked or log.failed("gold")
    if "export" in stages and not blocked:
        for table in GOLD_TABLES:
            _timed(log, "export", table, lambda t=table: io.export_dual(
                io.read_layer(spark, root, "gold", t, run_date), [f"{root}/export/{t}"]))

    summary = None
    if "quality" in stages and not blocked:
        def loader(layer, entity):
            return lambda: io.read_layer(spark, root, layer, entity, run_date)

        def validate():
            report = quality.quality_report({k: loader(*k) for k in quality.ENTITY_RULES}, spark=spark)
            path = f"{root}/monitoring/quality_reports/date={run_date}"
            report.withColumn("timestamp", F.lit(run_ts).cast("timestamp")).write.mode("overwrite").parquet(path)
            return quality.quality_summary(spark.read.parquet(path)).first().asDict()  # one row

        def verdict(found: dict) -> tuple[str, str]:
            return ("FAILED_NO_CHECKS" if found["total"] == 0 else "WARNINGS" if found["failed"] > 0 else "SUCCESS",
                    f"pass_rate={found['pass_rate']}")
        summary = _timed(log, "quality", "validation", validate, verdict)

    if "health" in stages and not blocked:
        def health():
            fresh = observability.freshness(
                {e: io.read_layer(spark, root, "bronze", e, run_date)
                 for e in ("indicador_alfabetizacao", "municipios")}, run_ts)
            comp = observability.gold_completeness(
                spark, {t: io.read_layer(spark, root, "gold", t, run_date) for t in observability.REQUIRED_GOLD})
            base = f"{root}/monitoring/health_checks/date={run_date}"
            fresh.write.mode("overwrite").parquet(f"{base}/freshness")
            comp.write.mode("overwrite").parquet(f"{base}/completeness")
            checks = (spark.read.parquet(f"{base}/freshness")
                      .select(F.concat(F.lit("fresh_"), "entity").alias("check"), (F.col("status") == "healthy").alias("ok"))
                      .unionByName(spark.read.parquet(f"{base}/completeness")
                                   .select(F.lit("gold_complete").alias("check"), (F.col("status") == "healthy").alias("ok"))))
            observability.health(checks).write.mode("overwrite").parquet(f"{base}/overall")
        _timed(log, "health", "checks", health)

    return summary
