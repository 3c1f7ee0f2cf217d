"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letrado.sources.tables import read_table

WORD_GAP = r"[\x20\x09-\x0D]+"


PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession, rows: int = 1000) -> None:
    """Let Python workers import this package, and bound what one Arrow batch
    holds: long texts come in few rows a batch."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = ":".join([PACKAGE_ROOT, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    prepare(spark)
    return read_table(spark, sf_dir, "documents").select(*(cols or ("doc_id", "text")))


def fold_remainder(doc_id: Column, parts: int) -> Column:
    """crc32(doc_id as text) mod ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(parts))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def table_partitions(spark: SparkSession) -> int:
    """Parts into which work is dealt: the session's shuffle partitions, which
    the cluster sizes for the job."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def release_memory(collect: bool = True) -> None:
    """Give memory that a task has freed back to the system: Python workers live on, beside those of later stages."""
    import ctypes
    import gc

    import pyarrow as pa
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:         # another C library: it keeps what it has
        pass


def keep_freed_memory(size: int = 128 << 20) -> None:
    """Let this process use again what it frees in arrays of up to ``size`` bytes, until release_memory(): taken from
    the system anew, every array of a megabyte is filled in page by page, which took a quarter of the CPU time."""
    import ctypes
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, size)                                # M_MMAP_THRESHOLD
        libc.mallopt(-1, 4 * size)                            # M_TRIM_THRESHOLD
    except (OSError, AttributeError):   # another C library: it keeps its ways
        pass


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps now: it learns of them from the driver's garbage
    collection, which a driver with memory to spare puts off.  The first collection leaves those of the last step,
    which what it frees still holds."""
    for _ in range(3):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
