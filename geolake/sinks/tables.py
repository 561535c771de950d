"""Table maintenance: the refresh contracts of every dataset.

Two forms of each contract:

* a pure query (``*_query``): the table state after the refresh, as a lazy
  DataFrame (anti-join + union) — testable and composable;
* a catalog action that writes it: partitioned by ``departement`` (yearly
  datasets by ``year``, ``departement``) with dynamic partition overwrite, so
  a refresh rewrites only the partitions it was asked for and never touches
  the rest of a 100 TB table.

New data is always materialised to a staging location first, so a failed
read or transform aborts before anything is deleted.

Several catalog commands make up one refresh of a catalog table, and a driver
killed between them leaves a part of it.  With the session setting
``geolake.tables.root`` the same calls publish versioned tables under that
folder instead (:mod:`.versions`): one atomic commit per refresh, read with
:func:`read_table`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_semantic_conf, materialize, release, scratch_path
from .versions import VersionedTable


# ----------------------------------------------------------- query forms
def _requested_rows(requested: Iterable[str], key: str, within: dict | None) -> Column:
    """True for rows of the requested departments (of the ``within`` slice,
    e.g. one year); a NULL key is never requested."""
    cond = F.coalesce(F.col(key).isin(list(requested)), F.lit(False))
    for name, value in (within or {}).items():
        cond = cond & F.col(name).eqNullSafe(F.lit(value))
    return cond


def replace_departments_query(existing: DataFrame, new: DataFrame, requested: Iterable[str],
                              key: str = "departement", within: dict | None = None) -> DataFrame:
    """K1: drop the rows of the requested departments (even if the new data
    has none for them), then append the new rows.  With ``within`` (K6) only
    that slice of the table, e.g. ``{"year": 2023}``, is refreshed."""
    kept = existing.where(~_requested_rows(requested, key, within))
    return kept.unionByName(new, allowMissingColumns=True)


def replace_present_query(existing: DataFrame, new: DataFrame, key: str = "departement",
                          within: dict | None = None) -> DataFrame:
    """K2: replace only the departments present in the new data."""
    present = new.select(F.col(key).alias("_present")).where(F.col("_present").isNotNull()).distinct()
    same = existing[key] == present["_present"]
    for name, value in (within or {}).items():
        same = same & existing[name].eqNullSafe(F.lit(value))
    return existing.join(present, same, "left_anti").unionByName(new, allowMissingColumns=True)


# ---------------------------------------------------------- catalog actions
def bucketed_copy(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``df`` written as a table of the catalog, bucketed and sorted by ``key``:
    copies of the same number of buckets join on it without a shuffle."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """K8: create the database if missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def _exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def versioned(spark: SparkSession, table: str) -> VersionedTable | None:
    """The versioned table of that name, if the session publishes such ones."""
    root = spark.conf.get("geolake.tables.root", None)
    return VersionedTable(spark, f"{root.rstrip('/')}/{table.replace('.', '/')}") if root else None


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A published table, wherever the session publishes."""
    v = versioned(spark, table)
    return spark.table(table) if v is None else v.read()


def table_exists(spark: SparkSession, table: str) -> bool:
    v = versioned(spark, table)
    return _exists(spark, table) if v is None else v.exists()


@contextmanager
def _staged(df: DataFrame, table: str) -> Iterator[DataFrame]:
    """The new rows, written to the shared staging area first: the source is
    fully read before the target changes; each run stages under a name of its
    own, deleted afterwards."""
    apply_semantic_conf(df.sparkSession)
    staged = materialize(df, table.replace(".", "_"))
    try:
        yield staged
    finally:
        release(staged)


def _create(df: DataFrame, table: str, partition_by: list[str], bucket: tuple[str, int] | None = None) -> None:
    w = df.write.format("parquet")
    if bucket:
        w = w.bucketBy(bucket[1], bucket[0]).sortBy(bucket[0])
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(table)


def replace_departments(df: DataFrame, table: str, requested: Iterable[str], key: str = "departement",
                        within: dict | None = None, keep_if_empty: bool = False, bucket: tuple[str, int] | None = None) -> None:
    """K1 / K5 / K6: the requested departments are replaced, all others kept.
    With ``keep_if_empty`` a load without any row changes nothing.  ``bucket``
    (column, number) buckets and sorts a table that is made here.

    The table is partitioned by ``within``'s columns and ``key``.  Partitions
    of requested departments are overwritten (dynamic mode), requested ones
    without new rows dropped; new rows of other departments are appended, as
    in :func:`replace_departments_query`.
    """
    spark = df.sparkSession
    requested = list(requested)
    parts = [*(within or {}), key]
    with _staged(df, table) as staged:
        if keep_if_empty and table_exists(spark, table) and staged.isEmpty():
            return
        if (v := versioned(spark, table)) is not None:
            v.replace_departments(staged, requested, key, within)
            return
        if not _exists(spark, table):
            _create(staged, table, parts, bucket)
            return
        rows = staged.select(*spark.table(table).columns)
        asked = F.coalesce(F.col(key).isin(requested), F.lit(False))
        own = rows.where(asked)
        present = {r[0] for r in own.select(key).distinct().collect()}  # at most the requested ones
        prefix = "".join(f"`{n}` = '{v}', " for n, v in (within or {}).items())
        for dep in requested:
            if dep not in present:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({prefix}`{key}` = '{dep}')")
        if present:
            own.write.insertInto(table, overwrite=True)
        rest = rows.where(~asked)
        if not rest.isEmpty():
            rest.write.insertInto(table)


def replace_present(df: DataFrame, table: str, key: str = "departement",
                    within: dict | None = None) -> None:
    """K2: dynamic partition overwrite of the departments in the new data."""
    spark = df.sparkSession
    with _staged(df, table) as staged:
        if (v := versioned(spark, table)) is not None:
            v.replace_present(staged, key, within)
            return
        if not _exists(spark, table):
            _create(staged, table, [*(within or {}), key])
            return
        rows = staged.select(*spark.table(table).columns)
        rows.where(F.col(key).isNotNull()).write.insertInto(table, overwrite=True)
        unkeyed = rows.where(F.col(key).isNull())
        if not unkeyed.isEmpty():
            unkeyed.write.insertInto(table)


def replace_table(df: DataFrame, table: str, partition_by: str | None = "departement") -> None:
    """K3: full replace."""
    with _staged(df, table) as staged:
        if (v := versioned(df.sparkSession, table)) is not None:
            v.replace_table(staged, partition_by)
            return
        w = staged.write.mode("overwrite").format("parquet")
        if partition_by and partition_by in staged.columns:
            w = w.partitionBy(partition_by)
        w.saveAsTable(table)


def truncate_load(df: DataFrame, table: str) -> None:
    """K4: keep the table definition, replace all rows in one statement."""
    spark = df.sparkSession
    with _staged(df, table) as staged:
        if (v := versioned(spark, table)) is not None:
            v.replace_table(staged, None)
            return
        if not _exists(spark, table):
            _create(staged, table, [])
            return
        staged.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def drop_tables(spark: SparkSession, tables: Iterable[str]) -> None:
    """K5 reset: drop every table of a family."""
    for t in tables:
        if (v := versioned(spark, t)) is not None:
            v.drop()
        else:
            spark.sql(f"DROP TABLE IF EXISTS {t}")
