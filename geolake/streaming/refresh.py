"""Incremental refresh from a landing folder with Structured Streaming.

The reference refreshes whole departments each time a department file is
(re)downloaded.  Here a file stream over the landing folder picks up newly
landed department files; every micro-batch is transformed with the same
batch operators and written with the "replace the departments present"
contract.  A department file is complete on its own (one file per
department), so per-batch department statistics are exact, and re-landing a
file simply replaces that department again (idempotent).  Progress is kept
in a checkpoint under the cluster's shared checkpoint folder, so a restarted
driver resumes where it stopped.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import checkpoint_dir
from ..sinks import tables as K


def department_file_stream(spark: SparkSession, landing: str, schema: StructType,
                           fmt: str = "csv", options: dict | None = None,
                           max_files_per_trigger: int = 16) -> DataFrame:
    """Streaming read of landed department files; adds ``departement`` from
    the file's base name (``75.csv`` -> ``75``)."""
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger",
                                                                 max_files_per_trigger)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(landing)
    return df.withColumn("departement",
                         F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1))


def run_department_refresh(stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
                           table: str, name: str, checkpoint: str | None = None,
                           available_now: bool = True):
    """Start the refresh query: transform each micro-batch and replace the
    departments it contains in ``table``.  Returns the StreamingQuery."""
    spark = stream.sparkSession

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        K.replace_present(transform(batch), table)

    w = (stream.writeStream.queryName(name).foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint or os.path.join(checkpoint_dir(spark), "streams", name)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
