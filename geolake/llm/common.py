"""Shared helpers: tables, staged intermediates, null-safe row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, release, scratch_path

#: Names the operators use for the library's helpers.
drop_stage, scratch = release, scratch_path

#: Rows of one Arrow batch handed to a Python task: documents are up to some
#: hundred kB, so the default of 10,000 rows could be GBs.
ARROW_ROWS = 500

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def prepare(spark: SparkSession) -> None:
    """Session settings: bounded Arrow batches, and Spark's runtime Bloom
    filter (at most 8 MB) for joins that pick rows of tables over 16 MB."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "16MB")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the shared checkpoint folder
    and read it back, so later steps survive the loss of any executor."""
    return materialize(df, f"llm-{name}")


def collect_garbage(spark: SparkSession) -> None:
    """Shuffle files of finished steps stay on the executors until the driver
    has collected the objects that stand for them; in a loop of many short jobs
    that may take very long."""
    spark._jvm.System.gc()
