"""Partitioned Parquet layers, warehouse tables and exports.

Layout under one root (a shared folder of the cluster)::

    bronze/<entity>/ingestion_date=YYYY-MM-DD/
    silver/<entity>/processed_date=YYYY-MM-DD/[ano=YYYY/]
    gold/<table>/gold_date=YYYY-MM-DD/[ano=YYYY/]
    monitoring/<table>/...

Writes use dynamic partition overwrite, so re-running a date replaces exactly
that date; reads filter on the partition column, which Spark prunes before
listing files, and read every file of the partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letrado.sources.schemas import stored_schema

LAYER_DATE_COL = {"bronze": "ingestion_date", "silver": "processed_date", "gold": "gold_date"}

# Fixed write layout per table: extra partition column and clustering columns.
LAYOUT = {
    ("silver", "indicador_alfabetizacao"): {"partition": ["ano", "_bucket"], "cluster": ["id_municipio"]},
    ("gold", "indicador_municipio"): {"partition": ["ano"], "cluster": ["sigla_uf", "id_municipio"]},
    ("gold", "evolucao_uf"): {"partition": [], "cluster": ["id_uf", "ano"]},   # one row per state-year
    # read by state and by year alike: neither sorts before the other
    ("gold", "ml_features"): {"partition": [], "cluster": ["sigla_uf", "ano"], "interleave": True},
}


def layer_path(root: str, layer: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{entity}"


def add_audit_columns(df: DataFrame, layer: str, run_ts: str, source: str | None = None) -> DataFrame:
    """Run-level audit columns: one literal value per run."""
    ts = F.lit(run_ts).cast("timestamp")
    if layer == "bronze":
        cols = {"_source": F.lit(source or "driver_tables"), "_batch_date": F.to_date(ts)}
        if "_ingestion_timestamp" not in df.columns:
            cols["_ingestion_timestamp"] = ts.cast("timestamp_ntz")
        return df.withColumns(cols)
    if layer == "silver":
        return df.withColumn("_silver_timestamp", ts)
    return df.withColumn("_gold_timestamp", ts)


def clustered(df: DataFrame, partition: Sequence[str], cluster: Sequence[str]) -> DataFrame:
    """Range-partition on (partition..., cluster...) and sort inside each task:
    files get tight min/max statistics on the cluster columns and a large
    partition value is spread over many writers instead of one.

    Without cluster columns nothing is reshuffled: range bounds over
    low-cardinality partition values alone (a run date, a year) would put a
    whole value into one task.  The cluster list always ends in a
    high-cardinality key for that reason."""
    if not cluster:
        return df
    keys = list(partition) + list(cluster)
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


# Ranks a column is cut into for the interleaved key (2**RANK_BITS), and rows sampled to find them.
RANK_BITS = 8
RANK_SAMPLE = 20_000


def range_ranks(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Each column's place among about 2**RANK_BITS ranges of equal row counts, from a bounded sample of rows of
    smallest hash.  Only the layout depends on the sample, never the rows."""
    sample = df.select(*cols).orderBy(F.xxhash64(*cols, F.monotonically_increasing_id())).limit(RANK_SAMPLE).collect()
    out = []
    for i, c in enumerate(cols):
        values = sorted(r[i] for r in sample if r[i] is not None)
        cuts = sorted(set(values))
        if len(cuts) > 1 << RANK_BITS:
            cuts = sorted({values[len(values) * k >> RANK_BITS] for k in range(1 << RANK_BITS)})
        out.append(_place(F.col(c), [F.lit(v).cast(df.schema[c].dataType) for v in cuts]))
    return out


def _place(value: Column, cuts: Sequence[Column]) -> Column:
    """How many of the cuts are not above the value, spread over all bits: a column of few values weighs as much as
    one of many.  Null counts as none."""
    if not cuts:
        return F.lit(0)
    below = F.size(F.filter(F.array(*cuts), lambda cut: cut <= value))
    return F.coalesce(F.floor(below * F.lit(((1 << RANK_BITS) - 1) / len(cuts))).cast("int"), F.lit(0))


def interleaved_key(ranks: Sequence[Column]) -> Column:
    """One number whose bits are the ranks' bits in turn, the highest first: rows near in it are near in every rank."""
    key = F.lit(0).cast("bigint")
    for bit in range(RANK_BITS - 1, -1, -1):
        for rank in ranks:
            key = F.shiftleft(key, 1) + F.shiftright(rank, bit).bitwiseAND(F.lit(1))
    return key


def interleaved(df: DataFrame, cols: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows dealt and sorted by the interleaved key of ``cols``: files get tight statistics on each of them, so a
    filter on any one skips files."""
    key = interleaved_key(range_ranks(df, cols))
    spread = F.xxhash64(*[F.col(c) for c in df.columns])        # parts a key that many rows share
    keyed = df.withColumns({"__key": key, "__spread": spread})
    dealt = keyed.repartitionByRange(files, "__key", "__spread") if files else keyed.repartitionByRange("__key", "__spread")
    return dealt.sortWithinPartitions("__key", *cols).drop("__key", "__spread")


def file_bounds(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """(file, n_rows, low_<c>, high_<c>...) of each data file: what a reader's file statistics can skip by."""
    return (spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), *cols).groupBy("file")
            .agg(F.count(F.lit(1)).alias("n_rows"), *[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("low", F.min), ("high", F.max))]))


def skipped_share(bounds: DataFrame, col: str) -> DataFrame:
    """(value, skipped): the share of files that an equality filter on ``col`` need not read, per stored value bound."""
    values = bounds.select(F.col(f"low_{col}").alias("value")).unionByName(bounds.select(F.col(f"high_{col}").alias("value"))).distinct()
    held = F.col("value").between(F.col(f"low_{col}"), F.col(f"high_{col}"))
    # files times their own distinct bounds: metadata, not rows
    read = bounds.join(values, held).groupBy("value").agg(F.count(F.lit(1)).alias("read"))
    return read.select("value", (1 - F.col("read") / F.lit(bounds.count())).alias("skipped"))


def write_layer(df: DataFrame, root: str, layer: str, entity: str, run_date: str) -> str:
    date_col = LAYER_DATE_COL[layer]
    spec = LAYOUT.get((layer, entity), {"partition": [], "cluster": []})
    parts = [date_col] + list(spec["partition"])
    # the run date is one constant value: it is a folder level, never a range key
    laid = interleaved(df, spec["cluster"]) if spec.get("interleave") else clustered(df, spec["partition"], spec["cluster"])
    out = laid.withColumn(date_col, F.lit(run_date).cast("date"))
    path = layer_path(root, layer, entity)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts).parquet(path))
    return path


def read_layer(spark: SparkSession, root: str, layer: str, entity: str, run_date: str | None = None) -> DataFrame:
    """One run date of a layer table (all of its files); all dates if None.  Read
    with the declared schema where there is one."""
    declared = stored_schema(layer, entity)
    reader = spark.read if declared is None else spark.read.schema(declared)
    df = reader.parquet(layer_path(root, layer, entity))
    if run_date is None:
        return df
    date_col = LAYER_DATE_COL[layer]
    return df.where(F.col(date_col) == F.lit(run_date).cast("date")).drop(date_col)


def read_events(spark: SparkSession, root: str, date: str | None = None) -> DataFrame:
    """Event NDJSON of one day; if that day has no event, every day; without any
    event an empty table.  Only an absent folder counts as "no event": any other
    read error is raised."""
    base = f"{root.rstrip('/')}/bronze/streaming"
    if date:
        day = _text_if_present(spark, f"{base}/date={date}")
        if day is not None and not day.isEmpty():
            return day
    every = _text_if_present(spark, base)
    return spark.createDataFrame([], "value string") if every is None else every


def _text_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.text(path).select("value")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_events(messages: DataFrame, root: str, date: str) -> str:
    """NDJSON event sink partitioned by run day; writing a day again replaces it."""
    path = f"{root.rstrip('/')}/bronze/streaming"
    (messages.withColumn("date", F.lit(date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").text(path))
    return path


def save_table(df: DataFrame, table: str, partition: Sequence[str] = ()) -> None:
    """Warehouse load, truncating (``CREATE OR REPLACE ... AS``)."""
    w = df.write.mode("overwrite").format("parquet")
    if partition:
        w = w.partitionBy(*partition)
    w.saveAsTable(table)


def export_dual(df: DataFrame, paths: Sequence[str]) -> list[str]:
    """The same table as Parquet and as CSV with header under each path."""
    written = []
    for base in paths:
        pq = f"{base.rstrip('/')}/parquet"
        df.write.mode("overwrite").parquet(pq)
        # the CSV copy is written from the Parquet files: the table is computed once
        df.sparkSession.read.parquet(pq).write.mode("overwrite").option("header", True).csv(
            f"{base.rstrip('/')}/csv")
        written += [pq, f"{base}/csv"]
    return written


def create_namespaces(spark: SparkSession, names: Sequence[str] = ("bronze", "silver", "gold")) -> None:
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n} COMMENT 'medallion layer {n}'")
