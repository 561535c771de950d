"""Connected components of an edge table by alternating star contraction.

Each round hangs every node's larger neighbours on its smallest neighbour, then
re-hangs the smaller ones, until no edge changes; the edges then are stars
around each component's smallest node.  Minima combine on the map side, a round
is one job that also counts its edges, and is written to the shared checkpoint
folder.  Runs to convergence, without a round limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import collect_garbage, drop_stage, stage


def _round(e: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges a < b."""
    both = e.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.where("b > a").join(low, "a").where("b <> m").select(F.col("m").alias("a"), "b")
    least = large.groupBy("b").agg(F.min("a").alias("m"))
    hung = large.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return hung.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def _staged(e: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, staged, and their number and sum of hashes, counted by the
    job that writes them."""
    seen = Observation()
    out = stage(e.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), "star")
    return out, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every node that has an edge in ``edges`` (a, b); ``comp``
    is the smallest node reachable.  Loops are ignored.  The result is staged;
    ``drop_stage`` releases it."""
    now, state = _staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while state[0]:
        new, new_state = _staged(_round(now))
        drop_stage(now)
        collect_garbage(now.sparkSession)
        now = new
        if new_state == state:
            break
        state = new_state
    out = stage(now.select(F.col("b").alias("id"), F.col("a").alias("comp")).unionByName(
        now.select(F.col("a").alias("id"), F.col("a").alias("comp")).distinct()), "components")
    drop_stage(now)
    return out
