"""Spark session defaults and the shared checkpoint location.

Everything in the library is a lazy DataFrame -> DataFrame transform; this
module only centralises the handful of settings the semantics depend on
(UTC session time zone, string-typed partition columns, AQE on).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on for correctness (not tuning).
SEMANTIC_CONF = {
    # Department codes such as "01", "2A" and "971" are strings; never let
    # partition discovery turn "01" into the integer 1.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    # Per-department refresh overwrites only the partitions it writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Scale settings: runtime re-planning, skew splitting, partition coalescing.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "geolake",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the library's settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {**SCALE_CONF, **SEMANTIC_CONF, **(extra or {})}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_semantic_conf(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a cluster run: enough initial shuffle partitions that each
    holds about ``target_partition_bytes`` of the input (AQE coalesces the
    small ones and splits skewed ones), never fewer than 3 waves of cores."""
    parts = max(3 * total_cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def apply_semantic_conf(spark: SparkSession) -> None:
    """Re-apply the settings correctness depends on to an existing session."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only a single-JVM session (tests, a laptop) without that setting gets a
    scratch folder; on a cluster its absence is an error, since executors do
    not see each other's local folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="geolake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new staging location under the shared checkpoint folder (each call
    gets its own, so concurrent runs never overwrite each other)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "staging", f"{name}-{uuid.uuid4().hex}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staged folder through Hadoop's FileSystem (any storage)."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def materialize(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut lineage: write ``df`` as Parquet to the shared checkpoint folder and
    return a DataFrame reading it back.  The plan runs once, nothing stays in
    executor memory, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a materialised table that nothing reads any more."""
    path = getattr(df, "_staged_at", None)
    if path is not None:
        delete_path(df.sparkSession, path)
