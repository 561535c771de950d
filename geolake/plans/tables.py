"""Access to the landed parquet tables of a scale-factor directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def round_doubles(df: DataFrame) -> DataFrame:
    """Normalise every floating column to float32 precision (kept as double).

    Sums and means differ in the last bits between engines (summation
    order).  Decimal rounding does not absorb that: this data has short
    decimal expansions, so exact means often sit on a decimal tie.  Binary
    rounding to 24 significant bits (IEEE nearest-even, identical in Spark
    and DuckDB) only disagrees if a 1-ulp difference straddles a float32
    midpoint (~1e-9 per value).
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.col(f.name).cast("float").cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
