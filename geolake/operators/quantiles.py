"""Exact, skew-safe grouped quantiles (pandas ``quantile`` / linear interpolation).

Spark's ``percentile`` is exact too, but gathers every distinct value of a
group in one task.  This operator finds the wanted ranks by counting instead,
one way for every group size:

1. rows are counted per (group, measure, value), combined on the map side;
2. counts are summed per (group, measure, digit), where the digit is a
   monotone coarse value (256 steps per power of two), so a group has a few
   thousand digits at most, whatever its size;
3. a running sum over that small table finds the digit that holds each wanted
   rank ``floor``/``ceil`` of ``p * (n - 1)``, and the rank inside it;
4. with ``staged``, while a digit found holds more than BOUND different values, its range is
   divided again, evenly from its least to its largest value, and the wanted
   digits found among those (radix selection: each round divides by PARTS);
5. the values of the last digits are ranked (BOUND of them per window partition
   at most, or about a thousandth of a large group) and the wanted ones picked.

The interpolation ``lo + (hi - lo) * frac`` is the one pandas, Spark's
``percentile`` and DuckDB's ``quantile_cont`` use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, release

#: Digits per power of two.
STEPS = 256
#: Different values ranked in one window partition, and parts of a digit that
#: holds more.
BOUND, PARTS = 1 << 16, 1 << 16
_OFFSET = 1 << 20  # above STEPS * 1100, the range of a double's exponent


def digit(v: Column) -> Column:
    """A monotone integer of a double: equal or smaller for smaller values."""
    scaled = F.floor(F.log2(F.abs(v)) * STEPS) + _OFFSET
    return F.when(v > 0, scaled).when(v < 0, -scaled).otherwise(F.lit(0)).cast("long")


def _found(hist: DataFrame, path: list[str], wanted: Column) -> DataFrame:
    """Of each digit in ``hist`` (path, _c rows, _b rows before it) the wanted
    ranks it holds, from its own start: targets ``_t``."""
    moved = F.transform(wanted, lambda t: t.withField("r", t["r"] - F.col("_b")))
    here = F.filter(moved, lambda t: (t["r"] >= 0) & (t["r"] < F.col("_c")))
    return hist.select(*path, "_k", "_lo", "_hi", here.alias("_t")).where(F.size("_t") > 0)


_DIGIT = (F.sum, "_c", "_c"), (F.count, "_v", "_k"), (F.min, "_v", "_lo"), (F.max, "_v", "_hi")


def _digits(values: DataFrame, path: list[str]) -> DataFrame:
    """Per digit: rows, different values, least and largest value."""
    return values.groupBy(*path).agg(*(f(c).alias(name) for f, c, name in _DIGIT))


def exact_quantiles(df: DataFrame, keys: Sequence[str], specs: Sequence[tuple[str, float, str]],
                    weight: str | None = None, staged: bool = False) -> DataFrame:
    """Exact quantiles per group.

    ``specs`` is a list of ``(value_column, probability, output_name)``; with
    ``weight`` a row counts so many times.  Rows whose group key is NULL, and
    NULL or NaN values, are ignored (pandas semantics).  Returns one row per
    group that has at least one value for some measure, one column per spec
    (NULL if that measure had no values).

    The plan is lazy and divides once.  With ``staged`` its steps run here, each
    written to the checkpoint folder, and divide until BOUND holds.
    """
    keys = list(keys)
    measures = list(dict.fromkeys(v for v, _, _ in specs))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    times = F.col(weight) if weight else F.lit(1)
    stacked = df.where(known).select(*keys, times.cast("long").alias("_w"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("m"), F.col(m).cast("double").alias("v"))
        for i, m in enumerate(measures)])).alias("_mv"))
    values = (stacked.select(*keys, "_w", F.col("_mv.m").alias("_m"), F.col("_mv.v").alias("_v"))
              .where(F.col("_v").isNotNull() & ~F.isnan("_v")))
    group = [*keys, "_m"]
    keep = materialize if staged else (lambda t, name: t)
    # The filter is what a join on the digit would add to one use of the table
    # alone: with it every use is the same plan, run once.
    counts = values.groupBy(*group, "_v").agg(F.sum("_w").alias("_c")).withColumn("_d", digit(F.col("_v"))).where(F.col("_d").isNotNull())
    counts = keep(counts, "counts")

    path = [*group, "_d"]
    below = Window.partitionBy(*group).orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    hist = _digits(counts, path).withColumns({
        "_b": F.coalesce(F.sum("_c").over(below), F.lit(0)), "_n": F.sum("_c").over(Window.partitionBy(*group))})

    def targets_of(mi: int) -> Column:
        out = []
        for qi, (m, p, _) in enumerate(specs):
            if measures.index(m) != mi:
                continue
            pos = F.lit(float(p)) * (F.col("_n") - 1)
            for side, rank in enumerate((F.floor(pos), F.ceil(pos))):
                out.append(F.struct(F.lit(qi).alias("q"), F.lit(side).alias("side"), rank.cast("long").alias("r"),
                                    (pos - F.floor(pos)).alias("f")))
        return F.array(*out)

    wanted = F.lit(None)
    for mi in reversed(range(len(measures))):
        wanted = F.when(F.col("_m") == mi, targets_of(mi)).otherwise(wanted)
    targets, near = keep(_found(hist, path, wanted), "digits"), counts
    used = [counts, targets]
    # A round more for groups of very many close values.
    while staged and (targets.agg(F.max("_k")).first()[0] or 0) > BOUND:
        level = f"_d{len(path)}"
        width = F.col("_hi") - F.col("_lo")
        part = F.when(width > 0, F.floor((F.col("_v") - F.col("_lo")) / width * (PARTS - 1))).otherwise(0).cast("long")
        near = materialize(near.join(targets, path).select(*path, "_v", "_c", part.alias(level), "_t"), "near")
        asked = targets.select(*path, F.col("_t").alias("_asked"))
        below = Window.partitionBy(*path).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        hist = _digits(near, [*path, level]).withColumn("_b", F.coalesce(F.sum("_c").over(below), F.lit(0)))
        targets = materialize(_found(hist.join(asked, path), [*path, level], F.col("_asked")), "digits")
        near, path = near.drop("_t"), [*path, level]
        used += [near, targets]

    inside = Window.partitionBy(*path).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = near.join(targets, path).select(*keys, "_v", "_c", "_t", F.coalesce(F.sum("_c").over(inside), F.lit(0)).alias("_from"))
    hits = ranked.select(*keys, "_v", F.explode(F.filter("_t", lambda t: (
        t["r"] >= F.col("_from")) & (t["r"] < F.col("_from") + F.col("_c")))).alias("_t"))
    aggs = []
    for qi, (_, _, name) in enumerate(specs):
        q = F.col("_t.q") == qi
        lo = F.max(F.when(q & (F.col("_t.side") == 0), F.col("_v")))
        hi = F.max(F.when(q & (F.col("_t.side") == 1), F.col("_v")))
        aggs.append((lo + (hi - lo) * F.max(F.when(q, F.col("_t.f")))).alias(name))
    out = keep(hits.groupBy(*keys).agg(*aggs), "quantiles")
    for t in used:
        release(t)
    return out
