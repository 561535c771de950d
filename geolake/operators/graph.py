"""Connected components of an edge table by alternating star contraction.

Each round hangs every node's larger neighbours on its smallest neighbour and
then re-hangs the smaller ones, until no edge changes; the edges then are stars
around each component's smallest node.  Minima combine on the map side, joins
on a hot node are split by adaptive execution, and each round is written to
the shared checkpoint folder.  Runs to convergence, without a round limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release


def _large_star(e: DataFrame, keys: list[str]) -> DataFrame:
    both = e.select(*keys, "a", "b").unionByName(e.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(*keys, "a").agg(F.min("b").alias("m")).select(*keys, "a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(low, [*keys, "a"]).where("b <> m")
            .select(*keys, F.col("m").alias("a"), "b").distinct())


def _small_star(e: DataFrame, keys: list[str]) -> DataFrame:
    # e holds a < b: b's smaller neighbours are its a's.
    low = e.groupBy(*keys, "b").agg(F.min("a").alias("m"))
    hung = e.join(low, [*keys, "b"])
    return (hung.where("a <> m").select(*keys, F.col("m").alias("a"), F.col("a").alias("b"))
            .unionByName(low.select(*keys, F.col("m").alias("a"), "b")).distinct())


def _state(e: DataFrame, keys: list[str]):
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64(*keys, "a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, id, comp) for every node that has an edge in ``edges`` (keys, a,
    b); ``comp`` is the smallest node reachable.  Edges link nodes of equal
    ``keys`` only; loops are ignored."""
    keys = list(keys)
    now = materialize(edges.where("a <> b").select(
        *keys, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc")
    state = _state(now, keys)
    while state[0]:
        new = materialize(_small_star(_large_star(now, keys), keys), "cc")
        new_state = _state(new, keys)
        release(now)
        now = new
        if new_state == state:
            break
        state = new_state
    return now.select(*keys, F.col("b").alias("id"), F.col("a").alias("comp")).unionByName(
        now.select(*keys, F.col("a").alias("id"), F.col("a").alias("comp")).distinct())
