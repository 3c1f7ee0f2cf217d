"""A pull queue with acknowledgements as a streaming source (Python Data Source).

``spark.readStream.format("letrado_queue").option("path", folder)`` delivers the
messages of a queue.  Offsets number the queue's segments (groups of messages that
were published together).  The engine's commit of a micro-batch is the
acknowledgement (it comes when the next batch begins): until then the same segments are delivered again after a failure.
Each run of a query that plans a segment counts as one delivery attempt of its
messages; after MAX_ATTEMPTS failed ones the segment goes to the dead letters and
the stream goes on without it.

``FileQueue`` keeps a queue in a folder that driver and executors share.  A real
broker takes its place by offering the same five methods.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Fixed value: deliveries of a message before it goes to the dead letters.
MAX_ATTEMPTS = 5
SEGMENTS_PER_BATCH = 100
SCHEMA = "value string, _message_id string, _attempt int"


class FileQueue:
    """Segments as NDJSON files 1, 2, 3...; each file is written beside and renamed, so it is there whole or not at all."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def publish(self, messages: list[str]) -> int:
        """Add one segment; its number.  Numbers rise for ever, as offsets do; one publisher at a time."""
        try:
            with open(f"{self.path}/last", encoding="utf-8") as f:
                number = int(f.read()) + 1
        except FileNotFoundError:
            number = 1
        self._write("last", str(number))
        self._write(f"segments/{number}", "".join(f"{json.dumps(m)}\n" for m in messages))
        return number

    def segments(self) -> list[int]:
        return self._numbers("segments")

    def read(self, number: int) -> Iterator[str]:
        with open(f"{self.path}/segments/{number}", encoding="utf-8") as f:
            for line in f:
                yield json.loads(line)

    def acknowledge(self, up_to: int) -> None:
        """All segments up to this one are done with: they are taken out of the queue."""
        for number in self.segments():
            if number <= up_to:
                for folder in ("segments", "attempts"):
                    self._remove(f"{folder}/{number}")

    def attempt(self, number: int) -> int:
        """Count one more delivery of a segment; how many there have been with it."""
        n = self.attempts(number) + 1
        self._write(f"attempts/{number}", str(n))
        return n

    def attempts(self, number: int) -> int:
        try:
            with open(f"{self.path}/attempts/{number}", encoding="utf-8") as f:
                return int(f.read())
        except FileNotFoundError:
            return 0

    def bury(self, number: int) -> None:
        """Put a segment to the dead letters."""
        os.makedirs(f"{self.path}/dead", exist_ok=True)
        os.replace(f"{self.path}/segments/{number}", f"{self.path}/dead/{number}")

    def dead_letters(self) -> list[str]:
        out = []
        for number in self._numbers("dead"):
            with open(f"{self.path}/dead/{number}", encoding="utf-8") as f:
                out += [json.loads(line) for line in f]
        return out

    def _numbers(self, folder: str) -> list[int]:
        try:
            return sorted(int(n) for n in os.listdir(f"{self.path}/{folder}") if n.isdigit())
        except FileNotFoundError:
            return []

    def _write(self, name: str, text: str) -> None:
        target = f"{self.path}/{name}"
        os.makedirs(os.path.dirname(target), exist_ok=True)
        draft = f"{target}.{os.getpid()}.draft"
        with open(draft, "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(draft, target)

    def _remove(self, name: str) -> None:
        try:
            os.remove(f"{self.path}/{name}")
        except FileNotFoundError:
            pass


class SegmentPartition(InputPartition):
    def __init__(self, number: int, attempt: int):
        self.number, self.attempt = number, attempt


class QueueReader(DataSourceStreamReader):
    def __init__(self, options):
        self.queue = FileQueue(options["path"])
        self.per_batch = int(options.get("segmentsPerBatch", SEGMENTS_PER_BATCH))
        self.max_attempts = int(options.get("maxAttempts", MAX_ATTEMPTS))
        self.known: dict[int, int] = {}         # attempts this run has counted: a batch may be planned several times
        self.told = 0

    def initialOffset(self) -> dict:
        return {"segment": 0}

    def latestOffset(self) -> dict:
        waiting = [n for n in self.queue.segments() if n > self.told][:self.per_batch]
        self.told = max([self.told, *waiting])
        return {"segment": self.told}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.told = max(self.told, end["segment"])
        out = []
        for number in self.queue.segments():
            if start["segment"] < number <= end["segment"]:
                if number not in self.known:
                    if self.queue.attempts(number) >= self.max_attempts:
                        self.queue.bury(number)
                        continue
                    self.known[number] = self.queue.attempt(number)
                out.append(SegmentPartition(number, self.known[number]))
        return out

    def read(self, partition: SegmentPartition) -> Iterator[tuple]:
        for i, message in enumerate(self.queue.read(partition.number)):
            yield message, f"{partition.number}/{i}", partition.attempt

    def commit(self, end: dict) -> None:
        self.queue.acknowledge(end["segment"])

    def stop(self) -> None:
        pass


class QueueSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "letrado_queue"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return QueueReader(self.options)


def queue_messages(spark: SparkSession, path: str, segments_per_batch: int = SEGMENTS_PER_BATCH, max_attempts: int = MAX_ATTEMPTS):
    """A stream of a queue's messages (value, _message_id, _attempt)."""
    spark.dataSource.register(QueueSource)
    return (spark.readStream.format("letrado_queue").option("path", path).option("segmentsPerBatch", str(segments_per_batch))
            .option("maxAttempts", str(max_attempts)).load())
