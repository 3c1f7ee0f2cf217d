"""Freshness, completeness, alert windows, metrics and run-status roll-up.

All of them are aggregates over tables (the written layers, the stream, the
run-event log), so they run on the cluster like any other job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letrado.functions.scalar import round2

# Freshness limit, alert rules (sum of errors over 5 minutes
# above 5; mean pass rate over 5 minutes below 80), required gold tables.
MAX_AGE_HOURS = 25
ALERT_WINDOW_SECONDS = 300
ALERT_WINDOW = f"{ALERT_WINDOW_SECONDS} seconds"
ALERT_MAX_ERRORS = 5
ALERT_MIN_PASS_RATE = 80.0
REQUIRED_GOLD = ("indicador_municipio", "evolucao_uf", "painel_nacional")

def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def freshness(entities: Mapping[str, DataFrame], as_of: str, ts_col: str = "_ingestion_timestamp",
              max_age_hours: float = MAX_AGE_HOURS) -> DataFrame:
    """Age of the newest row of each entity at ``as_of``; whole days count
    (the age is computed in microseconds, not in a seconds-of-day field)."""
    now = F.lit(as_of).cast("timestamp_ntz")
    parts = []
    for name, df in entities.items():
        a = df.agg(F.max(F.col(ts_col).cast("timestamp_ntz")).alias("last_ingestion"))
        age_us = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_ingestion").cast("timestamp"))
        age_h = round2(age_us / F.lit(3.6e9), 1)
        parts.append(a.select(
            F.lit(name).alias("entity"), "last_ingestion", age_h.alias("age_hours"),
            F.when(F.col("last_ingestion").isNull(), F.lit("no_data"))
             .when(age_us <= F.lit(int(max_age_hours * 3.6e9)), F.lit("healthy"))
             .otherwise(F.lit("stale")).alias("status")))
    return _union(parts)


def tables_with_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Names of the tables that hold a row; reads one row of each, not the table."""
    return _union([df.limit(1).select(F.lit(n).alias("table_name")) for n, df in tables.items()])


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
                   for n, df in tables.items()])


def gold_completeness(spark: SparkSession, tables: Mapping[str, DataFrame],
                      required: Sequence[str] = REQUIRED_GOLD) -> DataFrame:
    """One row: healthy/incomplete, found and missing tables (sorted)."""
    present = {n: tables[n] for n in required if n in tables}
    found = (tables_with_rows(present) if present
             else spark.createDataFrame([], "table_name string"))
    req = spark.createDataFrame([(n,) for n in required], "table_name string")
    missing = req.join(found, "table_name", "left_anti")
    tagged = (found.select("table_name", F.lit(True).alias("ok"))
              .unionByName(missing.select("table_name", F.lit(False).alias("ok"))))
    a = tagged.agg(
        F.array_sort(F.collect_list(F.when(F.col("ok"), F.col("table_name")))).alias("f"),
        F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("table_name")))).alias("m"))
    return a.select(
        F.when(F.size("m") == 0, F.lit("healthy")).otherwise(F.lit("incomplete")).alias("status"),
        F.concat_ws(",", "f").alias("found"), F.concat_ws(",", "m").alias("missing"))


def event_metrics(events: DataFrame, ts_col: str = "event_timestamp", valid_col: str = "is_valid") -> DataFrame:
    """Validated events as pipeline metrics (ts, n_records, pipeline_errors, pass_rate).  An event
    without a time counts at its receipt, and without that at no time (NULL)."""
    ts = F.col(ts_col)
    if "_received_at" in events.columns:
        ts = F.coalesce(ts, F.col("_received_at").cast("timestamp_ntz"))
    return events.select(ts.alias("ts"), F.lit(1).cast("bigint").alias("n_records"),
                         F.when(F.col(valid_col), 0).otherwise(1).cast("bigint").alias("pipeline_errors"),
                         F.when(F.col(valid_col), 100.0).otherwise(0.0).alias("pass_rate"))


def alert_windows(metrics: DataFrame, window: str = ALERT_WINDOW) -> DataFrame:
    """The two alert rules over metrics (ts, n_records, pipeline_errors, pass_rate) per tumbling
    window: sum of errors too high, mean pass rate (weighted by records) too low.  Metrics
    without a time stand in a row of their own, with no window."""
    def rules(groups) -> DataFrame:
        weight = F.sum("n_records")
        return groups.agg(F.sum("n_records").alias("n_events"), F.sum("pipeline_errors").alias("n_errors"),
                          round2(F.sum(F.col("pass_rate") * F.col("n_records")) / weight).alias("pass_rate"))

    timed = rules(metrics.where(F.col("ts").isNotNull()).groupBy(F.window("ts", window).alias("w"))).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_events", "n_errors", "pass_rate")
    none = F.lit(None).cast(timed.schema["window_start"].dataType)
    untimed = rules(metrics.where(F.col("ts").isNull()).groupBy()).where(F.col("n_events") > 0).select(
        none.alias("window_start"), none.alias("window_end"), "n_events", "n_errors", "pass_rate")
    return alert_flags(timed.unionByName(untimed))


def alert_flags(windows: DataFrame) -> DataFrame:
    """The two rules on windows (n_errors, pass_rate)."""
    return windows.withColumns({
        "alert_errors": F.col("n_errors") > ALERT_MAX_ERRORS, "alert_quality": F.col("pass_rate") < ALERT_MIN_PASS_RATE})


def ingestion_metrics(rejects: DataFrame) -> DataFrame:
    """From reject counts, per entity: rows in (cells of a wide table; events counted by a write that
    merges a stream among them), kept, duplicates and rejects, which add up; an entity with no kept
    row failed."""
    def total(*reasons: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("reason").isin(*reasons), F.col("n_rows"))), F.lit(0)).cast("bigint")

    a = rejects.groupBy("entity").agg(
        total("entrada", "entrada_stream").alias("bronze_rows"), total("mantidas").alias("silver_rows"),
        total("duplicada").alias("duplicate_rows"), total("sem_chave", "sem_valor", "orfa").alias("rejected_rows"))
    return a.withColumn("status", F.when(F.col("silver_rows") > 0, F.lit("SUCCESS")).otherwise(F.lit("FAILED")))


def stage_status(events: DataFrame) -> DataFrame:
    """Run-event log (run_id, stage, entity, status) -> one status per stage.

    A stage is FAILED when every entity failed, PARTIAL when some did;
    quality reports WARNINGS when checks failed and FAILED_NO_CHECKS when
    none ran."""
    s = F.col("status")
    a = events.groupBy("run_id", "stage").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(s.isin("FAILED", "ABORTED")).alias("n_failed"),
        F.count_if(s.isin("PARTIAL", "WARNINGS", "FAILED_NO_CHECKS")).alias("n_partial"),
        F.max(F.when(s.isin("WARNINGS", "FAILED_NO_CHECKS"), s)).alias("quality_flag"))
    return a.select(
        "run_id", "stage",
        F.when(F.col("n_failed") == F.col("n"), F.lit("FAILED"))
         .when(F.col("quality_flag").isNotNull(), F.col("quality_flag"))
         .when((F.col("n_failed") > 0) | (F.col("n_partial") > 0), F.lit("PARTIAL"))
         .otherwise(F.lit("SUCCESS")).alias("status"))


def run_status(events: DataFrame) -> DataFrame:
    """Overall status per run: FAILED if bronze/silver/gold failed or the run
    aborted; PARTIAL if silver or gold was partial or quality not clean;
    otherwise SUCCESS.  A partial bronze stage alone keeps SUCCESS."""
    st = stage_status(events)
    stg, s = F.col("stage"), F.col("status")
    a = st.groupBy("run_id").agg(
        F.count_if(s.isin("FAILED", "ABORTED") & (stg != "quality")).alias("n_failed"),
        F.count_if(((stg.isin("silver", "gold")) & (s == "PARTIAL"))
                   | ((stg == "quality") & (s != "SUCCESS"))).alias("n_partial"))
    return a.select(
        "run_id",
        F.when(F.col("n_failed") > 0, F.lit("FAILED"))
         .when(F.col("n_partial") > 0, F.lit("PARTIAL"))
         .otherwise(F.lit("SUCCESS")).alias("overall_status"))


def health(checks: DataFrame) -> DataFrame:
    """(check, ok) rows -> healthy only when every check is ok."""
    return checks.agg(F.bool_and("ok").alias("_all")).select(
        F.when(F.coalesce(F.col("_all"), F.lit(False)), F.lit("healthy")).otherwise(F.lit("degraded"))
         .alias("overall"))
