"""Line dedup by levelled sorted runs of line hashes; built-in functions only.

Documents arrive in batches of rising id.  A batch's distinct line hashes are
merge-anti-joined with the runs of all batches before it; what is left are the
lines that this batch holds first, and they make a new run.  A run is a Parquet
table, bucketed by the hash and sorted within its buckets, so the anti join
shuffles the batch but never a run.  When ``fanout`` runs of a level have
gathered, they are merged into one run of the next level.

A run's row names the document that keeps the line.  Each line hash has one
such row in all runs together, so however often a line occurs it is sent back
to one document: nothing about a hot line is ever gathered.

The key of a line is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in
lower case.  Keys of at least ``min_length`` code points stay only in the
document of smallest id that holds them; there all their lines stay.  Lines
with a shorter key always stay.

* null or empty text: one empty line, which stays
* rows that repeat an id are one document; they keep the same lines
* a null id: documents of equal text are one document; these come after all ids,
  ordered by the hash of their text
* an empty table gives an empty table; other columns pass through

Lines are told apart by 128 bits of hash; within one document, whose own lines
are looked up again, by 64 bits.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letrado.llm.common import free_name, table_partitions
from letrado.session import materialize, remove_folder, scratch_path

WHITE = " \t\n\x0b\x0c\r"
MIN_LENGTH = 10
BATCHES = 8
FANOUT = 4
HASH = ["h1", "h2"]


def lower_az(text: Column) -> Column:
    """A-Z in lower case, nothing else; ``lower`` does that for texts of ASCII alone."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def line_keys(text: Column) -> Column:
    """The key of each line of a text that is not null."""
    return F.transform(F.split(lower_az(text), "\n", -1), lambda line: F.btrim(line, F.lit(WHITE)))


def line_hashes(text: Column, min_length: int) -> Column:
    """The 64-bit hash of each line's key; null where the key is too short to count."""
    return F.transform(line_keys(text), lambda key: F.when(F.char_length(key) >= min_length, F.xxhash64(key)))


def in_sorted(values: Column, wanted: Column) -> Column:
    """Whether ``wanted`` is in the rising array ``values``, by binary search."""
    powers = F.sequence(F.ceil(F.log2(F.size(values) + 1)).cast("int"), F.lit(0), F.lit(-1))
    steps = F.transform(powers, lambda power: F.pow(F.lit(2.0), power).cast("int"))
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(values, at + step - 1) <= wanted, at + step).otherwise(at))
    return F.coalesce(F.get(values, below - 1) == wanted, F.lit(False))


class LineRuns:
    """Levels of runs; each run a bucketed, sorted table (h1, h2, no_id, unit) under the shared scratch folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = table_partitions(spark)
        self.levels: list[list[str]] = [[]]
        self.folders: dict[str, str] = {}

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def add(self, held: DataFrame) -> None:
        """Merge-anti-join one batch's distinct hashes with the runs; the rest becomes a run."""
        self._compact()
        for run in self.runs():
            held = held.join(self.spark.table(run).select(*HASH), HASH, "left_anti")
        self.levels[0].append(self._write(held))

    def rows(self) -> DataFrame:
        """Every line hash once, with the document that keeps it."""
        return self._union(self.runs())

    def drop(self) -> None:
        for run in self.runs():
            self._drop(run)
        self.levels = [[]]

    def _compact(self) -> None:
        for level in range(len(self.levels)):
            full = self.levels[level]
            if len(full) < self.fanout:
                return
            merged = self._write(self._union(full).repartition(self.buckets, *HASH))
            for run in full:
                self._drop(run)
            self.levels[level] = []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(merged)

    def _union(self, runs: list[str]) -> DataFrame:
        out = self.spark.table(runs[0])
        for run in runs[1:]:
            out = out.unionByName(self.spark.table(run))
        return out

    def _write(self, rows: DataFrame) -> str:
        run = f"letrado_line_run_{uuid.uuid4().hex}"
        self.folders[run] = scratch_path(self.spark, "line-run")
        (rows.write.format("parquet").option("path", self.folders[run]).bucketBy(self.buckets, *HASH).sortBy(*HASH)
             .saveAsTable(run))
        return run

    def _drop(self, run: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run}")
        remove_folder(self.spark, self.folders.pop(run))


def _unit(id_col: str, text: Column) -> list[Column]:
    """What counts as one document: its id, or without one its text."""
    return [F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text)).alias("unit")]


def _cuts(docs: DataFrame, id_col: str, batches: int) -> list[int]:
    """Rising ids that part the documents into batches of about equal count."""
    shares = [i / batches for i in range(1, batches)]
    found = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), shares, 10_000).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def first_holders(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(no_id, unit, kept): the sorted hashes of the lines that each document holds first."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    cuts = _cuts(docs, id_col, batches) if batches > 1 else []
    batch = F.when(F.col(id_col).isNull(), F.lit(len(cuts) + 1))
    for i, cut in enumerate(cuts):
        batch = batch.when(F.col(id_col).cast("long") <= cut, F.lit(i))
    pair = F.transform(F.array_distinct(line_keys(text)), lambda key: F.when(
        F.char_length(key) >= min_length, F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))))
    staged = scratch_path(spark, "line-hashes")
    (docs.select(batch.otherwise(F.lit(len(cuts))).alias("batch"), *_unit(id_col, text),
                 F.filter(pair, lambda p: p.isNotNull()).alias("lines"))
         .where(F.size("lines") > 0).write.partitionBy("batch").parquet(staged))
    hashed = spark.read.schema("no_id boolean, unit bigint, lines array<struct<h1: bigint, h2: bigint>>, batch int").parquet(staged)
    runs = LineRuns(spark, fanout)
    for b in range(len(cuts) + 2):
        lines = hashed.where(F.col("batch") == b).select("unit", F.inline("lines"))
        # a task sends one row a line, however many of its documents hold it
        runs.add(lines.groupBy(*HASH).agg(F.min("unit").alias("unit")).withColumn("no_id", F.lit(b == len(cuts) + 1)))
    kept = materialize(runs.rows().groupBy("no_id", "unit").agg(F.sort_array(F.collect_list("h1")).alias("kept")), "line-kept")
    runs.drop()
    remove_folder(spark, staged)
    return kept


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "line_dedup",
                min_length: int = MIN_LENGTH, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with ``out_col``: a struct of clean_text, n_lines and n_dropped."""
    kept = first_holders(docs, id_col, text_col, min_length, batches, fanout)
    names = {c: free_name(docs, f"line_{c}") for c in kept.columns}
    text = F.coalesce(F.col(text_col), F.lit(""))
    no_id, unit = _unit(id_col, text)
    keyed = docs.withColumns({names["no_id"]: no_id, names["unit"]: unit})
    both = keyed.join(kept.select(*[F.col(c).alias(n) for c, n in names.items()]), [names["no_id"], names["unit"]], "left")
    mine = F.coalesce(F.col(names["kept"]), F.array().cast("array<bigint>"))
    pairs = F.arrays_zip(F.split(text, "\n", -1).alias("line"), line_hashes(text, min_length).alias("hash"))
    stay = F.filter(pairs, lambda p: p["hash"].isNull() | in_sorted(mine, p["hash"]))
    lines = free_name(docs, "line_stay")
    out = both.withColumn(lines, F.transform(stay, lambda p: p["line"]))
    total = F.size(F.split(text, "\n", -1))
    return out.select(*docs.columns, F.struct(
        F.array_join(lines, "\n").alias("clean_text"), total.cast("long").alias("n_lines"),
        (total - F.size(lines)).cast("long").alias("n_dropped")).alias(out_col))


ORACLE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
lines AS (SELECT r, doc_id, unnest(a) AS line, unnest(range(len(a))) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS k FROM lines),
held AS (SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= {MIN_LENGTH} GROUP BY k),
judged AS (SELECT r, keyed.doc_id, line, pos, (keeper IS NULL OR keeper = keyed.doc_id) AS stays
           FROM keyed LEFT JOIN held ON keyed.k = held.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM judged GROUP BY r"""
