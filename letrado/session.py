"""SparkSession construction and the few settings the pipeline relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results or plans; everything else is left to the cluster.
PIPELINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    # checkpoint files of unreachable DataFrames are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # scan splits and post-shuffle partitions sized for executor memory
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}

# Sizes that a cluster may set for itself: applied only where it has not.
SIZING_CONF = {"spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
               "spark.sql.parquet.compression.codec"}
REDUCER_BYTES = 256 << 20
DEFAULT_SHUFFLE_BYTES = 512 << 30


def partitions_for(shuffle_bytes: int) -> int:
    """Reducers of about 256 MB for the largest shuffle of a job; AQE coalesces
    its smaller ones.  Sized per job: map tasks times reducers is what the
    shuffle service has to keep track of."""
    return max(200, -(-shuffle_bytes // REDUCER_BYTES))


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "letrado", extra: dict | None = None,
                  shuffle_bytes: int = DEFAULT_SHUFFLE_BYTES) -> SparkSession:
    """``shuffle_partitions`` fixes the count (tests); otherwise it follows
    ``shuffle_bytes``, what the job's largest shuffle is expected to write."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(PIPELINE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    else:
        conf["spark.sql.shuffle.partitions"] = str(partitions_for(shuffle_bytes))
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (idempotent); the
    sizes that its cluster was configured with stay."""
    configured = spark.sparkContext.getConf()
    for k, v in PIPELINE_CONF.items():
        if k.startswith("spark.sql.") and not (k in SIZING_CONF and configured.contains(k)):
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Only a local master (unit
    tests on one machine) may leave it unset and gets a private temporary
    folder; on a cluster executors would write to their own disks.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="letrado-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root (unique per call)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/letrado/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of ours, on whatever file system it lies."""
    if "/letrado/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df, name: str):
    """Cut lineage by writing ``df`` as a Parquet table under the shared
    checkpoint folder and reading it back.

    One computation (an eager RDD checkpoint computes twice unless cached), the
    files survive executor loss, and the read-back relation carries real file
    sizes, so Catalyst/AQE keep making size-checked join decisions.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/letrado/mat/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
