"""Structured Streaming entry point for the event stream.

The query is stateless: no watermark, so no event is dropped for being late,
early or undated, and no state store grows.  Redelivered messages are told apart
by their hash when the event log is read; the ranked changes are idempotent.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from letrado.session import checkpoint_root
from letrado.sources.queue_source import queue_messages
from letrado.streaming.events import prepare_events
from letrado.streaming.merge_table import VersionedUpsert
from letrado.streaming.redelivery import flag_redeliveries, use_rocksdb
from letrado.streaming.upsert import IndicadorUpsert

# Fixed stream settings: flush every 60 s, at most so many files a flush (a
# backlog is worked off over several batches).
FLUSH_INTERVAL = "60 seconds"
FILES_PER_FLUSH = 1000
# Gather the small folders of the versioned tables once an hour of 60 s batches.
COMPACT_EVERY = 60


def event_source(spark: SparkSession, source: str, fmt: str = "text", max_files_per_trigger: int | None = FILES_PER_FLUSH,
                 options: dict | None = None):
    """NDJSON files (one message per line), a Kafka topic (value = message) or a pull queue (``queue_source``).

    ``_message_id`` names the delivery: topic/partition/offset, or the file and
    the message's hash (a text source does not number lines)."""
    if fmt == "kafka":
        r = spark.readStream.format("kafka")
        for k, v in (options or {}).items():
            r = r.option(k, v)
        msg_id = F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
        return r.load().select(F.col("value").cast("string").alias("value"), msg_id.alias("_message_id"))
    if fmt == "queue":
        return queue_messages(spark, source, **(options or {})).select("value", "_message_id")
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(source).select("value", F.concat_ws("#", F.col("_metadata.file_path"), F.sha2("value", 256))
                                 .alias("_message_id"))


def start_event_stream(spark: SparkSession, source: str, changes_path: str, quarantine_root: str, events_root: str,
                       checkpoint: str | None = None, available_now: bool = False, fmt: str = "text",
                       max_files_per_trigger: int | None = FILES_PER_FLUSH,
                       options: dict | None = None) -> StreamingQuery:
    ckpt, stream_id = _stream_identity(spark, checkpoint)
    events = _received(event_source(spark, source, fmt, max_files_per_trigger, options))
    return _start(events, IndicadorUpsert(changes_path, quarantine_root, events_root, stream_id), ckpt, available_now)


def start_versioned_stream(spark: SparkSession, source: str, table_path: str, quarantine_path: str, events_path: str,
                           checkpoint: str | None = None, available_now: bool = False, fmt: str = "text",
                           max_files_per_trigger: int | None = FILES_PER_FLUSH, options: dict | None = None,
                           compact_every: int = COMPACT_EVERY, retention_seconds: float | None = None) -> StreamingQuery:
    """The event stream into tables with a commit log (``merge_table``); every ``compact_every`` batches their small
    folders are gathered.  The merge table at ``table_path`` must have been created.  With ``retention_seconds``
    redelivered messages are flagged on arrival, from state that is kept that long (``redelivery``)."""
    ckpt, stream_id = _stream_identity(spark, checkpoint)
    events = _received(event_source(spark, source, fmt, max_files_per_trigger, options))
    if retention_seconds is not None:
        use_rocksdb(spark)
        events = flag_redeliveries(events, retention_seconds)
    sink = VersionedUpsert(table_path, quarantine_path, events_path, stream_id, compact_every=compact_every)
    return _start(events, sink, ckpt, available_now)


def _stream_identity(spark: SparkSession, checkpoint: str | None) -> tuple[str, str]:
    ckpt = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/letrado/event_stream"
    # offsets belong to a checkpoint, so its path tells one stream's batch numbers from another's
    return ckpt, hashlib.sha256(ckpt.encode()).hexdigest()[:12]


def _received(messages: DataFrame) -> DataFrame:
    return prepare_events(messages.withColumn("_received_at", F.current_timestamp()))


def _start(events: DataFrame, sink, ckpt: str, available_now: bool) -> StreamingQuery:
    w = events.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=FLUSH_INTERVAL)
    return w.start()


def run_stream_for(query: StreamingQuery, seconds: float = 300.0) -> bool:
    """Let a started stream run for ``seconds`` (the consumer's default run
    time), then stop it; committed offsets make the next run resume."""
    finished = query.awaitTermination(seconds)
    if not finished:
        query.stop()
    return bool(finished)
