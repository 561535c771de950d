"""What landed and what can be read: a probed list of sources, so that an
absent or unreadable one costs only itself.

A source is ``readable``, ``absent`` or ``corrupt``; the reason says why.  The
probe reads a source with Spark, to its end unless ``deep`` is off: a truncated
gzip file or a broken Parquet page shows only there.  Jobs refresh what was
read and leave the rows of absent and corrupt sources as they are.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_log = logging.getLogger(__name__)

#: Probes that run at once; their Spark jobs share the cluster.
PROBES = 8


@dataclass(frozen=True)
class Source:
    path: str
    status: str
    reason: str | None = None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever storage it is (a glob: matches)."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hpath)
    return found is not None and len(found) > 0


def _first_line(e: Exception) -> str:
    own = e.java_exception.toString() if isinstance(e, Py4JJavaError) else str(e)
    return own.split("\n")[0][:300]


def probe(spark: SparkSession, paths: Iterable[str], load: Callable[[str], DataFrame], deep: bool = True) -> list[Source]:
    """The status of each path, in order; ``load`` makes its DataFrame."""
    def one(path: str) -> Source:
        if not path_exists(spark, path):
            return Source(path, "absent", "no such path")
        try:
            df = load(path)
            if deep:
                df.write.format("noop").mode("overwrite").save()
        except (PySparkException, Py4JJavaError) as e:
            return Source(path, "corrupt", _first_line(e))
        return Source(path, "readable")

    with ThreadPoolExecutor(PROBES) as pool:
        found = list(pool.map(one, paths))
    for s in found:
        if s.status != "readable":
            _log.warning("source %s skipped: %s (%s)", s.path, s.status, s.reason)
    return found


def readable(found: Iterable[Source]) -> list[str]:
    return [s.path for s in found if s.status == "readable"]


def manifest(spark: SparkSession, found: Iterable[Source]) -> DataFrame:
    """(path, status, reason) as a table, to be kept with what was loaded."""
    return spark.createDataFrame([(s.path, s.status, s.reason) for s in found], "path string, status string, reason string")
