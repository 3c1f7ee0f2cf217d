"""Redelivered messages, told apart on arrival by bounded state.

State is one entry per message hash, on RocksDB, which expires ``retention`` after
the first delivery (the topic keeps messages that long, so none can come later).
Every delivery is put out, with ``_redelivery``: nothing is dropped for being late
or known, and a batch that is run again reads the state of the batch before it, so
it flags the same rows.  A message that comes very often streams through in chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Fixed value: the topic keeps messages for seven days.
RETENTION_SECONDS = 7 * 24 * 3600
FLAG = "_redelivery"
KEY = "_message_hash"
_SEEN = T.StructType([T.StructField("seen", T.BooleanType())])


class FirstDelivery(StatefulProcessor):
    def __init__(self, retention_ms: int):
        self.retention_ms = retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", _SEEN, ttlDurationMs=self.retention_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.seen.exists()
        if not known:
            self.seen.update((True,))       # not renewed by a redelivery: the retention counts from the first
        for chunk in rows:
            flags = [True] * len(chunk)
            if not known and flags:
                flags[0], known = False, True
            yield chunk.assign(**{FLAG: flags})

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """State with expiry needs the RocksDB store; to be called before the stream starts.  Expired entries go with the
    next batch of messages: batches without any would follow each other without end, and a run over what is
    available would not stop."""
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def flag_redeliveries(events: DataFrame, retention_seconds: float = RETENTION_SECONDS) -> DataFrame:
    """A stream of prepared events with ``_redelivery``: whether the message was delivered before."""
    # the rows of a stateful processor are named tuples, in which no name may begin with an underscore
    named = {c: f"in{c}" for c in events.columns}
    plain = events.withColumnsRenamed(named)
    schema = T.StructType([*plain.schema.fields, T.StructField(FLAG, T.BooleanType())])
    flagged = plain.groupBy(named[KEY]).transformWithStateInPandas(
        FirstDelivery(int(retention_seconds * 1000)), schema, outputMode="append", timeMode="ProcessingTime")
    return flagged.withColumnsRenamed({n: c for c, n in named.items()})
