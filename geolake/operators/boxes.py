"""Points in the boxes of any table: a range join by a grid of many levels.

A box is entered in the cells of the level whose cells are just as large as its
longer side, so four cells cover it, be it the world or a house; a point looks
up its cell on each level that some box uses.  Rows and boxes meet by an
equi-join on (level, cell) and are refined by the exact, inclusive test.  Rows
are dealt evenly over the tasks first.  A cell that holds more than a thousandth
of all lookups is salted: its points are dealt over several keys, its boxes
repeated for each.

Defined cases: a row has any number of points (nothing matches without one) and
comes out once for each box that holds one of them, twice for two boxes of one
code.  Points with a NULL, NaN or infinite coordinate, or one beyond LIMIT, are
none.  Boxes with a NULL or NaN side, or with north < south or east < west,
hold nothing; infinite sides are sides.  The row's columns are carried in a
struct until the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Side of the smallest cell (degrees or metres), and the number of levels.
CELL, LEVELS = 2.0 ** -10, 64
#: The largest cell's side; no coordinate is larger.
LIMIT = 2.0 ** 53
#: A cell with more than one lookup in HOT_SHARE is salted: HOT_SHARE cells at most.
HOT_SHARE = 1000

_KEY = ["level", "cy", "cx"]


def _side(level: Column) -> Column:
    return F.lit(CELL) * F.pow(F.lit(2.0), level)


def _cell(v: Column, level: Column) -> Column:
    return F.floor(v / _side(level)).cast("long")


def box_cells(boxes: DataFrame, code: str = "departement") -> DataFrame:
    """(code, s, w, n, e, level, cy, cx): each box in the cells that cover it."""
    named = boxes.select(F.col(f"`{code}`").alias("code"), *(F.col(c).cast("double").alias(c[0]) for c in ("south", "west", "north", "east")))
    whole = named.where((F.col("s") <= F.col("n")) & (F.col("w") <= F.col("e")) & ~F.isnan("n") & ~F.isnan("e"))
    end = {c: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col(c))) for c in "swne"}
    longer = F.greatest(end["n"] - end["s"], end["e"] - end["w"])
    # A box of one point has no logarithm, and least() skips a NULL: level 0.
    fits = F.when(longer > CELL, F.ceil(F.log2(longer / CELL)).cast("int")).otherwise(F.lit(0))
    at = whole.withColumn("level", F.least(F.lit(LEVELS - 1), fits))
    for c, (lo, hi) in (("cy", "sn"), ("cx", "we")):
        at = at.withColumn(c, F.explode(F.sequence(_cell(end[lo], F.col("level")), _cell(end[hi], F.col("level")))))
    return at


def assign_to_boxes(df: DataFrame, points: Column, boxes: DataFrame, code: str = "departement") -> DataFrame:
    """One output row per (row, box that holds one of its points): the row's
    columns and the box's code.

    ``points``: ``array<struct<lat,lon>>``; ``boxes``: (code, south, west,
    north, east)."""
    if code in df.columns:
        raise ValueError(f"the rows have a column {code} already")
    cells = box_cells(boxes, code)
    levels = [r[0] for r in cells.select("level").distinct().collect()]   # LEVELS rows at most

    def known(v: Column) -> Column:
        return F.coalesce(F.abs(v) < LIMIT, F.lit(False))   # NaN is above every number
    found = F.array_distinct(F.filter(points, lambda p: known(p["lat"]) & known(p["lon"])))
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("own"), found.alias("p")).where(F.size("p") > 0)

    # A row's work are the boxes of its cells, which the size of a file does not
    # tell: rows are dealt out evenly before.
    dealt = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    # A lookup carries its point in columns of their own, for a compiled test,
    # and the row's points before it (NULL for the first).
    used = F.array(*(F.lit(i).cast("int") for i in sorted(levels))) if levels else F.array().cast("array<int>")
    each_point = dealt.select("own", "p", F.posexplode("p").alias("i", "at")).select(
        "own", F.col("at.lat").cast("double").alias("lat"), F.col("at.lon").cast("double").alias("lon"),
        F.when(F.col("i") > 0, F.slice("p", F.lit(1), F.col("i"))).alias("before"), F.explode(used).alias("level"))
    asked = each_point.select("*", _cell(F.col("lat"), F.col("level")).alias("cy"), _cell(F.col("lon"), F.col("level")).alias("cx"))

    # Cells by their share of the lookups: under HOT_SHARE of them are salted.
    total = (rows.agg(F.sum(F.size("p"))).first()[0] or 0) * len(levels)
    share = max(1, total // HOT_SHARE)
    busy = asked.groupBy(*_KEY).agg(F.count("*").alias("c")).where(F.col("c") > share).select(
        *_KEY, F.ceil(F.col("c") / share).cast("int").alias("salts"))
    salted = asked.join(F.broadcast(busy), _KEY, "left").withColumn(
        "salt", F.pmod(F.xxhash64("lat", "lon", F.monotonically_increasing_id()), F.coalesce("salts", F.lit(1)))).drop("salts")
    each = cells.join(F.broadcast(busy), _KEY, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)).cast("long") - 1))).drop("salts")

    # A point meets a box in one cell: the row comes out of the first of its
    # points inside the box.
    def inside(lat: Column, lon: Column) -> Column:
        return lat.between(F.col("s"), F.col("n")) & lon.between(F.col("w"), F.col("e"))
    again = F.exists("before", lambda p: inside(p["lat"], p["lon"]))
    met = salted.join(each, [*_KEY, "salt"]).where(
        inside(F.col("lat"), F.col("lon")) & (F.col("before").isNull() | ~again))
    return met.select("own.*", F.col("code").alias(code))
