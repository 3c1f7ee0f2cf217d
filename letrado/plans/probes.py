"""Row counts taken while a layer is written.

A ``WriteProbe`` hangs an ``Observation`` on every step of a silver transform.  The
write that stores the entity counts them on the way, so the ingestion metrics need
no second pass over bronze.  ``reject_counts`` computes the same numbers from
the tables themselves.

A stage that is run again after an executor is lost can count its rows twice, as
accumulators do.  ``WriteProbe.whole`` tells: the kept rows must equal the rows of
the written table, read from its file footers.

An observed plan keeps the session's observation manager alive, and pyspark.ml
models cannot be scored in such a session; write in ``observed_session``.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from letrado.plans import silver
from letrado.session import apply_session_conf

#: an observation that has not arrived this long after its write has ended is given up
ARRIVAL_SECONDS = 60.0
REJECT_SCHEMA = "entity string, reason string, n_rows long"


def observed_session(spark: SparkSession) -> SparkSession:
    """A session of the same application for observed writes, with the same settings."""
    new = spark.newSession()
    new.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    apply_session_conf(new)
    return new


class WriteProbe:
    """Observations of one run's writes, by entity and step."""

    def __init__(self):
        self._steps: dict[str, list[tuple[str, Observation]]] = {}

    def of(self, entity: str):
        """The probe that a transform of ``entity`` is given."""
        steps = self._steps[entity] = []

        def probe(step: str, df: DataFrame, rows_each: int = 1) -> DataFrame:
            seen = Observation(f"{entity}-{step}")
            steps.append((step, seen))
            return df.observe(seen, (F.count(F.lit(1)) * F.lit(rows_each)).alias("n"))
        return probe

    def left_after(self, entity: str) -> list[tuple[str, int]]:
        """(step, rows left after it) of an entity that was written, in the order of its steps."""
        return [(step, _arrived(seen, f"{entity}: {step}")) for step, seen in self._steps.get(entity, ())]

    def counts(self, entity: str) -> list[tuple[str, str, int]]:
        """(entity, reason, n_rows): the input, what each step took, and what is kept; they add up."""
        out, before = [], 0
        for step, n in self.left_after(entity):
            if step in (silver.INPUT, silver.STREAM_INPUT):
                out.append((entity, step, n))
                before += n
            else:
                out.append((entity, step, before - n))
                before = n
        return [*out, (entity, silver.KEPT, before)] if out else []

    def whole(self, entity: str, written: DataFrame) -> bool:
        """Whether the kept rows are those of the written table (a count that Parquet footers answer)."""
        kept = [n for _, reason, n in self.counts(entity) if reason == silver.KEPT]
        return bool(kept) and kept[0] == written.count()


def _arrived(seen: Observation, name: str) -> int:
    found: list[int] = []
    waiting = threading.Thread(target=lambda: found.append(seen.get["n"]), daemon=True)
    waiting.start()
    waiting.join(ARRIVAL_SECONDS)
    if not found:
        raise TimeoutError(f"no metrics of {name}")
    return found[0]
