"""URL filters as a sort-merge range join.

A host's labels reversed, each closed by a dot, make its key
(``www.example.com`` -> ``com.example.www.``), so a rule for a host and all its
subdomains is the key interval that starts with the rule's own key.  Urls and
rules are dealt into slices of the key order; rows that share a key are split
by row id, so one hot host spreads over many slices.  Each slice is sorted and
swept once: rules open before the urls they cover, and a stack holds the
nested rules that are still active.  Rules opened in an earlier slice and
still active at a slice's first key are its first key's own prefixes, found by
an equi-join, so no rule list is broadcast and no range condition is joined.

Defined cases: a url that is null or lacks ``://`` has an empty host and path;
no rule fits it, since a rule needs a host.  Only A-Z are lower-cased, a port
stays part of the host.  Of the fitting rules the longest string (host and
path) wins, then the longer host; of one rule listed with both actions, block.
Rules without a host fit nothing.  Repeated rows are judged each on its own.
Without rows or rules the result is empty or all default.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, shuffle_parts

#: Keys drawn per slice to place the slice borders (balance only).
KEYS_PER_SLICE = 64


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, F.lit("://"))
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id",
               url_col: str = "url", default: str = "allow") -> DataFrame:
    """``rules``: (action, host, path).  Returns id, host, path, rule, verdict
    for every row of ``pages``."""
    spark = pages.sparkSession
    parts = shuffle_parts(spark)
    urls = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"))
    urls = urls.select("id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    urls = urls.withColumn("key", host_key(F.col("host")))
    rules = rules.select(F.lower("action").alias("action"), ascii_lower(F.col("host")).alias("host"),
                         F.coalesce(F.col("path"), F.lit("")).alias("path"))
    rules = rules.where("host <> ''").withColumn("key", host_key(F.col("host")))

    # Slice borders: (key, id) quantiles of a sample whose size follows the
    # number of slices, as Spark's own range partitioner draws them.
    total = urls.count()
    drawn = (urls.sample(False, min(1.0, KEYS_PER_SLICE * parts / max(total, 1)), 7)
             .select("key", F.coalesce("id", F.lit(-(1 << 63))).alias("id")).collect())
    drawn = sorted(set(map(tuple, drawn)))
    borders = [drawn[i] for i in range(KEYS_PER_SLICE, len(drawn), KEYS_PER_SLICE)]

    @F.pandas_udf("int")
    def slice_of(key: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(borders, (k, r)) for k, r in zip(key, row)], dtype="int32")

    lowest = F.lit(-(1 << 63)).cast("long")
    points = urls.select(slice_of("key", F.coalesce("id", lowest)).alias("slice"), "key",
                         F.lit(1).alias("kind"), "id", "host", "path", F.lit(None).cast("string").alias("action"))
    opened = rules.select(slice_of("key", lowest).alias("slice"), "key", F.lit(0).alias("kind"),
                          F.lit(None).cast("long").alias("id"), "host", "path", "action")
    # (later slice, prefix of its first key): one row per border and label.
    inside = [(i + 1, ".".join(labels[:n]) + ".") for i, (k, _) in enumerate(borders)
              for labels in [k.split(".")[:-1]] for n in range(1, len(labels) + 1)]
    first = spark.createDataFrame(inside, T.StructType([
        T.StructField("into", T.IntegerType()), T.StructField("key", T.StringType())]))
    carried = (opened.join(first, "key").where(F.col("into") > F.col("slice"))
               .select(F.col("into").alias("slice"), "key", "kind", "id", "host", "path", "action"))
    events = (points.unionByName(opened).unionByName(carried)
              .repartition(parts, "slice").sortWithinPartitions("slice", "key", "kind"))
    out = events.mapInPandas(_sweeper(default), T.StructType([
        T.StructField("id", T.LongType()), T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()), T.StructField("rule", T.StringType()),
        T.StructField("verdict", T.StringType())]))
    return out.withColumnRenamed("id", id_col)


class _Node:
    """An active host rule: its path rules, longest path first."""

    __slots__ = ("key", "rules", "lengths")

    def __init__(self, key):
        self.key, self.rules, self.lengths = key, {}, None

    def add(self, host, path, action):
        if self.rules.get(path, ("", ""))[1] != "block":
            self.rules[path] = (host + path, action)
        self.lengths = None

    def best(self, path):
        if self.lengths is None:
            self.lengths = sorted({len(p) for p in self.rules}, reverse=True)
        for n in self.lengths:
            if n <= len(path) and path[:n] in self.rules:
                return self.rules[path[:n]]
        return None


def _sweeper(default):
    def sweep(batches):
        current, stack = None, []
        for pdf in batches:
            rows = []
            ids = pdf["id"].astype("Int64")
            for where, key, kind, row, host, path, action in zip(
                    pdf["slice"], pdf["key"], pdf["kind"], ids, pdf["host"], pdf["path"], pdf["action"]):
                if where != current:
                    current, stack = where, []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1].key != key:
                        stack.append(_Node(key))
                    stack[-1].add(host, path, action)
                    continue
                won = None
                for node in reversed(stack):  # longer hosts first, so they win ties
                    fits = node.best(path)
                    if fits and (won is None or len(fits[0]) > len(won[0])):
                        won = fits
                rows.append((row, host, path, won[0] if won else None, won[1] if won else default))
            out = pd.DataFrame(rows, columns=["id", "host", "path", "rule", "verdict"])
            out["id"] = out["id"].astype("Int64")
            yield out
    return sweep
