"""Alert windows over the stream of metrics.

Event-time windows with a watermark, kept in a versioned table: a micro-batch adds
its partial sums per window, so the table is the state, readable at any version.
The watermark is the greatest metric time of the batches before, less ``delay``;
it is part of the same commit as the sums, so a batch that is run again after a
crash decides as it did before.

A metric whose window had ended at the watermark is late; it goes to the side table,
as does one without a time.  Windows and side table together hold every metric
once: the rules over all metrics are the rules over both.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from letrado.functions.scalar import round2
from letrado.plans.observability import ALERT_WINDOW, ALERT_WINDOW_SECONDS, alert_flags
from letrado.sources.versioned import VersionedTable

# How long after its time a metric still counts in its window.
DELAY_SECONDS = 600
LATE, UNDATED = "atrasada", "sem_timestamp"
METRIC_COLS = ["ts", "n_records", "pipeline_errors", "pass_rate"]
DAY = "_day"
WINDOW_SCHEMA = "window_start timestamp_ntz, n_events bigint, n_errors bigint, weighted double, _day date"
LATE_SCHEMA = "ts timestamp_ntz, n_records bigint, pipeline_errors bigint, pass_rate double, reason string, _day date"


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


class AlertWindows:
    def __init__(self, spark: SparkSession, path: str, delay_seconds: float = DELAY_SECONDS):
        self.spark, self.delay_us = spark, int(delay_seconds * 1_000_000)
        self.window_us = ALERT_WINDOW_SECONDS * 1_000_000
        self.table = VersionedTable(spark, f"{path.rstrip('/')}/windows")
        self.side = VersionedTable(spark, f"{path.rstrip('/')}/late")

    def create(self) -> None:
        for table, ddl in ((self.table, WINDOW_SCHEMA), (self.side, LATE_SCHEMA)):
            if not table.versions():
                table.create(self.spark.createDataFrame([], ddl).schema, [DAY])

    def watermark(self, stream: str, version: int | None = None) -> int | None:
        """Microseconds since the epoch; None before the first dated metric."""
        return self.table.manifest(version).get("watermark", {}).get(stream)

    def add(self, metrics: DataFrame, stream: str, batch: int) -> None:
        """One micro-batch of metrics (METRIC_COLS)."""
        if batch <= self.table.manifest()["applied"].get(stream, -1):
            return
        mark = self.watermark(stream)
        # not window(): that leaves rows without a time out
        us = _micros(F.col("ts"))
        start = us - F.pmod(us, F.lit(self.window_us))
        at = metrics.select(*METRIC_COLS, F.timestamp_micros(start).cast("timestamp_ntz").alias("window_start"))
        closed = F.lit(False) if mark is None else F.coalesce(start + self.window_us <= F.lit(mark), F.lit(False))
        reason = F.when(F.col("ts").isNull(), F.lit(UNDATED)).when(closed, F.lit(LATE))
        at = at.withColumn("reason", reason).persist()
        try:
            aside = at.where(F.col("reason").isNotNull())
            self.side.append(aside.select(*METRIC_COLS, "reason", F.to_date("ts").alias(DAY)), stream, batch)
            sums = (at.where(F.col("reason").isNull()).groupBy("window_start")
                    .agg(F.sum("n_records").alias("n_events"), F.sum("pipeline_errors").alias("n_errors"),
                         F.sum(F.col("pass_rate") * F.col("n_records")).alias("weighted"))
                    .withColumn(DAY, F.to_date("window_start")))
            newest = at.agg(F.max(_micros(F.col("ts"))).alias("m")).first()["m"]        # one row
            marks = [m for m in (mark, None if newest is None else newest - self.delay_us) if m is not None]
            self.table.append(sums, stream, batch, lambda current: {
                "watermark": {**current.get("watermark", {}), **({stream: max(marks)} if marks else {})}})
        finally:
            at.unpersist()

    def compact(self) -> None:
        """Partial sums to one row per window; the side table's batches to days."""
        self.table.rewrite(self._sums)
        self.side.rewrite(lambda rows: rows.repartition(DAY))

    @staticmethod
    def _sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy("window_start", DAY).agg(*[F.sum(c).alias(c) for c in ("n_events", "n_errors", "weighted")])

    def windows(self, version: int | None = None) -> DataFrame:
        """The alert windows of the metrics that were in time, as ``alert_windows`` gives them."""
        sums = self._sums(self.table.rows(version))
        return alert_flags(sums.select("window_start", (F.col("window_start") + F.expr(f"INTERVAL {ALERT_WINDOW}")).alias("window_end"),
                                       "n_events", "n_errors", round2(F.col("weighted") / F.col("n_events")).alias("pass_rate")))

    def late(self, version: int | None = None) -> DataFrame:
        """Late and undated metrics with their reason."""
        return self.side.rows(version).drop(DAY)


def start_alert_stream(spark: SparkSession, metrics: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                       delay_seconds: float = DELAY_SECONDS, flush: str = "60 seconds", compact_every: int = 60) -> StreamingQuery:
    """Keep the alert windows of a stream of metrics (``observability.event_metrics`` of the events) under ``path``."""
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    AlertWindows(spark, path, delay_seconds).create()

    def add(batch: DataFrame, batch_id: int) -> None:
        alerts = AlertWindows(batch.sparkSession, path, delay_seconds)
        alerts.add(batch, stream_id, batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            alerts.compact()

    w = metrics.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=flush)).start()
