"""The event stream's tables with a commit log: merge table, event log, quarantine.

``IndicadorTable`` holds the ranked measurements of silver and of the stream.  A
micro-batch appends its own ranked rows; ``compact`` folds them into the
(ano, _bucket) partitions they touch and commits one new version.  A reader ranks
the base with the changes that came since, not with every change ever written.

``EventLog`` holds deliveries (good ones, or the quarantine).  Its ``compact``
gathers the small folders of the micro-batches into day partitions of files of
about ``target_bytes``; a day whose files are full already is added to, not
rewritten.

All of them take a (stream, batch) once, so a replayed micro-batch after a crash
at any step leaves each table with its rows once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from letrado.plans import silver
from letrado.sources.versioned import VersionedTable, file_slots, spread_rows
from letrado.streaming.events import FLAT_COLS, enrich_events
from letrado.streaming.redelivery import FLAG
from letrado.streaming.upsert import META_COLS, QUARANTINE_COLS, RANK_COLS

TARGET_BYTES = 128 << 20
DAY = "_day"


class IndicadorTable:
    """Ranked measurements, one row per (id_municipio, ano) in the base."""

    PARTITION = ("ano", "_bucket")

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path)

    @staticmethod
    def _ranked(rows: DataFrame) -> DataFrame:
        return silver.rank_measurements(rows.select(*RANK_COLS)).withColumn("_bucket", silver.bucket_of())

    def create(self, indicador: DataFrame) -> bool:
        """From the silver indicador (with lineage) that the batch job wrote; False if the table is there already."""
        rows = self._ranked(indicador)
        if not self.table.create(rows.schema, self.PARTITION):
            return False
        self.table.append(rows, "silver", 0)
        self.compact()
        return True

    def upsert(self, valid: DataFrame, stream: str, batch: int, event_types=None, skip_null: bool = True) -> int:
        """One micro-batch of valid, flat events."""
        return self.table.append(self._ranked(silver.stream_measurements(valid, event_types, skip_null)), stream, batch)

    def compact(self) -> int:
        return self.table.rewrite(lambda rows: self._ranked(rows).repartitionByRange(*self.PARTITION, "id_municipio"))

    def current(self, municipios: DataFrame, version: int | None = None) -> DataFrame:
        """Silver indicador at a version (the newest if not given), with lineage."""
        return silver.finish_indicador(self._ranked(self.table.rows(version)), municipios, keep_lineage=True)


class EventLog:
    """Deliveries by day of receipt; rows keep the schema they were created with."""

    def __init__(self, spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES):
        self.table, self.target_bytes = VersionedTable(spark, path), target_bytes

    @staticmethod
    def _dated(rows: DataFrame) -> DataFrame:
        return rows.withColumn(DAY, F.to_date("_received_at"))

    def append(self, rows: DataFrame, stream: str, batch: int) -> int:
        dated = self._dated(rows)
        if not self.table.versions():
            self.table.create(dated.schema, [DAY])
        return self.table.append(dated, stream, batch)

    def compact(self) -> int:
        """Small folders to day partitions; only days with room in their files are rewritten."""
        manifest = self.table.manifest()
        sizes = {day: [self.table.sizes(f"base/{f}") for f in folders] for day, folders in manifest["base"].items()}

        def full(day: str, folders: list[str]) -> bool:
            files = sum(n for n, _ in sizes.get(day, ()))
            return files > 0 and sum(b for _, b in sizes[day]) >= files * self.target_bytes // 2

        pending = sum(self.table.sizes(f"changes/{f}")[1] for f in manifest["changes"])
        rewritten = sum(b for day, found in sizes.items() if not full(day, []) for _, b in found)
        slots = file_slots(pending + rewritten, self.target_bytes)
        return self.table.rewrite(lambda rows: spread_rows(rows, [DAY], slots), keep=full)

    def deliveries(self, version: int | None = None) -> DataFrame:
        return self.table.rows(version)

    def messages(self, version: int | None = None) -> DataFrame:
        """Each message once, however often it was delivered: by the flag it was stored with, else by ranking."""
        if FLAG in self.table.schema(self.table.manifest(version)).names:
            return self.table.rows(version).where(~F.col(FLAG)).drop(FLAG)
        first = Window.partitionBy("_message_hash").orderBy("_received_at", "_message_id")
        return (self.table.rows(version).withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn"))


class VersionedUpsert:
    """``foreachBatch`` callable over the three tables.  A crash between them is mended by the batch's replay."""

    def __init__(self, table_path: str, quarantine_path: str, events_path: str, stream_id: str = "stream",
                 event_types=None, skip_null: bool = True, compact_every: int = 0):
        self.table_path, self.quarantine_path, self.events_path = table_path, quarantine_path, events_path
        self.stream_id, self.event_types, self.skip_null = stream_id, event_types, skip_null
        self.compact_every = compact_every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            meta = [c for c in (*META_COLS, FLAG) if c in batch.columns]
            valid = batch.where(F.col("is_valid"))
            quarantine, events = EventLog(spark, self.quarantine_path), EventLog(spark, self.events_path)
            quarantine.append(batch.where(~F.col("is_valid")).select(*QUARANTINE_COLS, *meta), self.stream_id, batch_id)
            events.append(enrich_events(valid.select(*FLAT_COLS, *meta)), self.stream_id, batch_id)
            table = IndicadorTable(spark, self.table_path)
            table.upsert(valid, self.stream_id, batch_id, self.event_types, self.skip_null)
        finally:
            batch.unpersist()
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            for each in (quarantine, events, table):
                each.compact()


def in_batches(events: DataFrame, batches: int, key: Column | str = "_message_hash") -> Sequence[DataFrame]:
    """Events dealt to micro-batches by a hash (the batch form of a stream, for queries and tests)."""
    return [events.where(F.pmod(F.xxhash64(key), F.lit(batches)) == b) for b in range(batches)]
