"""Micro-batch sink of the event stream: nothing is lost, nothing is overwritten.

Every delivery of a micro-batch ends in exactly one place:

1. invalid / corrupt / implausibly dated events -> ``quarantine/batch=<key>``
   with their reason;
2. valid events -> the event log ``streaming_events/batch=<key>``; readers drop
   redeliveries by the hash of the whole message (``event_log``);
3. the batch's ranked measurements -> ``changes/batch=<key>``.

The stored silver indicador is never read or written here.  Readers rank it
together with the changes (``current_indicador``), so a late, older event loses
against a newer one whenever it arrives, and ``compact`` writes the ranked
result to a *new* folder.  ``<key>`` is the stream's id and the batch number:
a replayed batch rewrites its own folders, another stream's batches stay.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from letrado.plans import silver
from letrado.streaming.events import FLAT_COLS, enrich_events

QUARANTINE_COLS = ["event_id", "reject_reason", "id_municipio", "ano", "_indicador_raw", "_corrupt_record"]
META_COLS = ("_message_id", "_message_hash", "_received_at")
RANK_COLS = ["id_municipio", "ano", "indicador_alfabetizacao", "quantidade_matriculas", *silver.LINEAGE_COLS]


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None only if the path does not exist.  Any other
    error (permission, damaged file, time-out) is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


class IndicadorUpsert:
    """``foreachBatch`` callable.  Paths are folders of the shared store."""

    def __init__(self, changes_path: str, quarantine_root: str, events_root: str, stream_id: str = "stream",
                 event_types=None, skip_null: bool = True):
        self.changes_path = changes_path.rstrip("/")
        self.quarantine_root = quarantine_root.rstrip("/")
        self.events_root = events_root.rstrip("/")
        self.stream_id = stream_id
        self.event_types = event_types
        self.skip_null = skip_null

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            key = f"batch={self.stream_id}-{batch_id}"
            meta = _present(batch, META_COLS)
            self._write(batch.where(~F.col("is_valid")).select(*QUARANTINE_COLS, *meta), f"{self.quarantine_root}/{key}")
            valid = batch.where(F.col("is_valid"))
            self._write(enrich_events(valid.select(*FLAT_COLS, *meta)), f"{self.events_root}/{key}")
            changes = silver.stream_measurements(valid, self.event_types, self.skip_null)
            self._write(silver.rank_measurements(changes).select(*RANK_COLS), f"{self.changes_path}/{key}")
        finally:
            batch.unpersist()

    @staticmethod
    def _write(df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").parquet(path)


def event_log(spark: SparkSession, events_root: str) -> DataFrame:
    """Stored events, each message once however often it was delivered."""
    log = spark.read.parquet(events_root)
    first = Window.partitionBy("_message_hash").orderBy("_received_at", "batch")
    return log.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def current_indicador(spark: SparkSession, indicador_path: str, changes_path: str, municipios: DataFrame) -> DataFrame:
    """Silver indicador with the stream's changes: one row per (id_municipio, ano), with lineage."""
    rows = read_if_present(spark, indicador_path)
    changes = read_if_present(spark, changes_path)
    parts = [df.select(*RANK_COLS) for df in (rows, changes) if df is not None]
    if not parts:
        raise FileNotFoundError(f"neither {indicador_path} nor {changes_path} exists")
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return silver.finish_indicador(silver.rank_measurements(both), municipios, keep_lineage=True)


def compact(spark: SparkSession, indicador_path: str, changes_path: str, municipios: DataFrame, out_path: str) -> str:
    """Write ``current_indicador`` to the new folder ``out_path``; the folders it reads stay as they are."""
    if out_path.rstrip("/") in (indicador_path.rstrip("/"), changes_path.rstrip("/")):
        raise ValueError("compact writes to a new folder")
    merged = current_indicador(spark, indicador_path, changes_path, municipios)
    (merged.repartitionByRange("ano", "_bucket", "id_municipio").write.mode("errorifexists")
           .partitionBy("ano", "_bucket").parquet(out_path))
    return out_path


def stream_accounting(events: DataFrame) -> DataFrame:
    """Where the deliveries of ``events`` (prepared, with ``_message_hash``) end:
    received = stored + redelivered + the quarantined of every reason.

    One partial aggregate per message, then per outcome; quarantined deliveries
    are all kept, so only valid messages can be redeliveries.
    """
    per = (events.groupBy("_message_hash", F.col("reject_reason").alias("reason"))
           .agg(F.count(F.lit(1)).alias("n")))
    bad = F.col("reason").isNotNull()
    rows = F.array(
        F.struct(F.lit("received").alias("outcome"), F.lit(None).cast("string").alias("reason"), F.col("n").alias("n")),
        F.struct(F.when(bad, F.lit("quarantined")).otherwise(F.lit("stored")).alias("outcome"),
                 F.col("reason").alias("reason"), F.when(bad, F.col("n")).otherwise(F.lit(1)).cast("bigint").alias("n")),
        F.struct(F.lit("redelivered").alias("outcome"), F.lit(None).cast("string").alias("reason"),
                 F.when(bad, F.lit(0)).otherwise(F.col("n") - 1).cast("bigint").alias("n")))
    return per.select(F.inline(rows)).groupBy("outcome", "reason").agg(F.sum("n").alias("n_events"))
