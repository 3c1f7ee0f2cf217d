"""Target-distribution importance resampling.

Every document's features (runs of words) are hashed into buckets; a bucket's
gain says how much more of the target's features than of the corpus' fall into
it, and a document's weight is the mean gain of its features, looked up in one
array for a whole batch.  Gumbel noise that depends on the id alone turns the
best ``share`` of scores into a weighted draw without replacement.

The draw needs no sort of the corpus.  Scores are written once; exact count jobs
over them bisect the score at which the draw ends (four halvings a job: the
counts at 15 thresholds), then the id at which it ends among equal scores.
Only the drawn rows are range-partitioned, sorted and numbered.

* null or empty text, or one without a word: no features, weight 0
* a null id is hashed as the empty text and comes after all ids
* rows with equal score and id are drawn in the order in which they were written
* no eligible document, or a share that rounds to none: nothing is drawn
* an empty table gives an empty table; an empty target leaves all gains about equal
* other columns are not returned
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letrado.llm.common import prepare, table_partitions
from letrado.session import materialize

#: a word is a run of digits, letters a-z and everything beyond ASCII; in UTF-8 the latter are the bytes from 0x80
_SEPARATE = bytes(b if b >= 0x80 or chr(b).isdigit() or "a" <= chr(b) <= "z" else b + 32 if "A" <= chr(b) <= "Z" else 0x20
                  for b in range(256))
LONGEST_CACHED = 64
MOST_CACHED = 300_000
HALVINGS = 4


@dataclass(frozen=True)
class Draw:
    max_run: int = 1
    buckets: int = 10_000
    seed: int = 2024
    min_words: int = 20
    percent: int = 10


class _Buckets(dict):
    """Feature -> bucket; long features are not kept, so that the memory of a worker is bounded in bytes."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        if len(feature) <= LONGEST_CACHED:
            if len(self) >= MOST_CACHED:
                self.clear()
            self[feature] = bucket
        return bucket


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text's UTF-8 bytes, A-Z in lower case."""
    return (text or b"").translate(_SEPARATE).split()


def hash_features(table: DataFrame, cols: list[str], text_col: str = "text", draw: Draw = Draw()) -> DataFrame:
    """``cols`` with n_words and the buckets of all features, packed as 32-bit numbers."""
    prepare(table.sparkSession)
    fields = [table.schema[c] for c in cols]
    max_run, buckets = draw.max_run, draw.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(buckets)
        for batch in batches:
            n_words, packed = [], []
            for text in batch.column(len(cols)).to_pylist():
                words = words_of(text)
                found = list(map(known.__getitem__, words))
                for n in range(2, max_run + 1):
                    found += [known[b" ".join(words[i:i + n])] for i in range(len(words) - n + 1)]
                n_words.append(len(words))
                packed.append(np.array(found, dtype="<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(cols)], pa.array(n_words, pa.int64()),
                                              pa.array(packed, pa.binary())], [*cols, "n_words", "features"])

    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "n_words long", "features binary"])
    return table.select(*cols, F.col(text_col).cast("binary")).mapInArrow(run, ddl)


def bucket_counts(features: DataFrame, draw: Draw = Draw()) -> np.ndarray:
    """How many features fall into each bucket; a task sends at most one row a bucket."""
    buckets = draw.buckets

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(packed, "<u4"), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], ["bucket", "n"])

    sums = features.select("features").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():          # at most ``buckets`` rows
        out[row["bucket"]] = row["n"]
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of the target's share to the corpus' share), per bucket."""
    n = len(corpus)
    all_s, all_t = float(corpus.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * all_s / ((float(s) + 1) * all_t)))
                     for s, t in zip(corpus, target)], dtype=np.int64)


def score_documents(features: DataFrame, gains: np.ndarray, id_col: str = "doc_id", draw: Draw = Draw()) -> DataFrame:
    """(id, n_words, n_features, weight, score) from hashed features and the array of gains."""
    key = F.concat(F.lit(f"{draw.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    kind = features.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids, n_words, packed, noise = batch.columns
            found = [np.frombuffer(p, "<u4") for p in packed.to_pylist()]
            sizes = np.array([len(f) for f in found], np.int64)
            flat = gains[np.concatenate([*found, np.empty(0, "<u4")])]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            sums = np.concatenate([[0], np.cumsum(flat)])
            weight = (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(sizes, 1)
            gumbel = [math.floor(-1000 * math.log(-math.log((x + 0.5) / 4294967296))) for x in noise.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [ids, n_words, pa.array(sizes), pa.array(weight, pa.int64()), pa.array(weight + np.array(gumbel, np.int64))],
                [id_col, "n_words", "n_features", "weight", "score"])

    return features.select(id_col, "n_words", "features", h.alias("h")).mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, n_features long, weight long, score long")


def _pivots(low: int, high: int) -> list[int]:
    """The thresholds that HALVINGS halvings of low..high may ask for, in rising order."""
    parts = 1 << HALVINGS
    return sorted({low + (high - low) * i // parts for i in range(1, parts)} | {low, high})


def bisect(rows: DataFrame, value: Column, low: int, high: int, need: int) -> int:
    """The least v in low..high with count(value <= v) >= need, by exact count jobs; count(value <= high) >= need holds."""
    while low < high:
        at = _pivots(low, high - 1)
        counts = rows.agg(*[F.count_if(value <= F.lit(p)).alias(f"c{i}") for i, p in enumerate(at)]).first()
        enough = next((i for i in range(len(at)) if counts[i] >= need), None)
        low, high = (at[-1] + 1 if enough is None else low if enough == 0 else at[enough - 1] + 1,
                     high if enough is None else at[enough])
    return low


def drawn_condition(scored: DataFrame, id_col: str, draw: Draw) -> tuple[Column, int]:
    """Which rows may be drawn (more only where score and id are equal), and how many are."""
    may = F.col("n_words") >= draw.min_words
    few = scored.where(may).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    k = draw.percent * few["n"] // 100
    if k == 0:
        return F.lit(False), 0
    eligible = scored.where(may)
    cut = -bisect(eligible, -F.col("score"), -few["high"], -few["low"], k)
    above, tied = F.col("score") > cut, F.col("score") == cut
    ties = eligible.where(tied).agg(F.min(id_col).alias("low"), F.max(id_col).alias("high"), F.count(id_col).alias("n")).first()
    need = k - eligible.where(above).count()
    if need > ties["n"]:                # ids do not suffice: rows without one are drawn too
        return may & (above | tied), k
    last = bisect(eligible.where(tied), F.col(id_col), ties["low"], ties["high"], need)
    return may & (above | (tied & F.coalesce(F.col(id_col) <= last, F.lit(False)))), k


def rank_drawn(drawn: DataFrame, id_col: str, k: int) -> DataFrame:
    """``drawn`` with rank 1..k by falling score, then rising id; rows beyond k get no rank."""
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("written").asc()]
    parts = table_partitions(drawn.sparkSession)
    cols = drawn.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in drawn.schema.fields)

    def number(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            local = np.arange(before + 1, before + n + 1)
            before += n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int64)), pa.array(local)],
                                             [*cols, "part", "place"])

    placed = materialize(drawn.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .mapInArrow(number, f"{fields}, part long, place long"), "drawn")
    sizes = sorted(tuple(r) for r in placed.groupBy("part").agg(F.max("place")).collect())      # one row a partition
    starts = list(zip([part for part, _ in sizes], accumulate([0, *[n for _, n in sizes]])))
    before = drawn.sparkSession.createDataFrame(starts, "part long, rows_before long")
    rank = F.col("place") + F.col("rows_before")
    return placed.join(F.broadcast(before), "part").select(*cols, F.when(rank <= k, rank).cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             draw: Draw = Draw()) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; rank is null where it is not drawn."""
    features = materialize(hash_features(docs, [id_col], text_col, draw), "importance-features")
    wanted = hash_features(target, [], target_text, draw)
    gains = gains_of(bucket_counts(features, draw), bucket_counts(wanted, draw))
    scored = materialize(score_documents(features, gains, id_col, draw)
                         .withColumn("written", F.monotonically_increasing_id()), "importance-scores")
    condition, k = drawn_condition(scored, id_col, draw)
    cols = [id_col, "n_features", "weight", "score"]
    rest = scored.where(~condition).select(*cols, F.lit(None).cast("long").alias("rank"))
    return rank_drawn(scored.where(condition), id_col, k).select(*cols, "rank").unionByName(rest)
