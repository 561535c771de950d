"""Elevation rasters as cell tables: tile lists, mosaicking on department
grids, slope/aspect exposure classes, 4-connected exposure regions and their
polygons.

A raster is a table ``(departement, row, col, z)``; each department has a grid
of its own, a row ``(departement, a, e, c, f, nrows, ncols)`` of a small fixed
table (``a`` = pixel width in degrees, ``e`` = -pixel height, ``c``/``f`` =
west/north edge; at most one row per department, which bounds its broadcast).
Slopes are computed in double precision.  Neighbour values meet by a shuffle
on the cell, so no task holds a whole row, column or department.  Regions are
the connected components of same-class cells: exact labels inside tiles of
bounded size, then a graph job over the tile-border edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import xy
from ..session import materialize, release
from .graph import connected_components

# --- fixed values -----------------------------------------------------------
MIN_SLOPE_DEG = 2.0
METERS_PER_DEG = 111_320.0
Z_MIN, Z_MAX = -1000.0, 9000.0
CLASS_FLAT, CLASS_HIGH, CLASS_LOW, CLASS_MODERATE = (
    "flat", "high_exposure", "low_exposure", "moderate")
# --- end of fixed values ----------------------------------------------------

# cell id = row * stride + col; wider than any int column number, so ids of
# different cells never collide.
CELL_ID_STRIDE = 1 << 31


# ------------------------------------------------------------------- R1
def tile_name(lat: Column, lon: Column) -> Column:
    ns = F.when(lat >= 0, F.lit("N")).otherwise(F.lit("S"))
    ew = F.when(lon >= 0, F.lit("E")).otherwise(F.lit("W"))
    return F.format_string("Copernicus_DSM_COG_30_%s%02d_00_%s%03d_00_DEM",
                           ns, F.abs(lat).cast("int"), ew, F.abs(lon).cast("int"))


def tiles_for_bbox(boxes: DataFrame) -> DataFrame:
    """1-degree tiles touching each box: inclusive floor ranges of lat/lon."""
    lat = F.explode(F.sequence(F.floor("south").cast("int"), F.floor("north").cast("int")))
    lon = F.explode(F.sequence(F.floor("west").cast("int"), F.floor("east").cast("int")))
    t = boxes.select("departement", "west", "east", lat.alias("lat"))
    t = t.select("departement", "lat", lon.alias("lon"))
    return t.select("departement", "lat", "lon", tile_name(F.col("lat"), F.col("lon")).alias("tile"))


# ------------------------------------------------------------------- R2
def department_grid(boxes: DataFrame, a: float, e: float) -> DataFrame:
    """Grid of each box (south, west, north, east): origin at its north-west
    corner, as many whole pixels as fit its sides best."""
    return boxes.select(
        "departement", F.lit(float(a)).alias("a"), F.lit(float(e)).alias("e"),
        F.col("west").cast("double").alias("c"), F.col("north").cast("double").alias("f"),
        F.round((F.col("north") - F.col("south")) / abs(e)).cast("int").alias("nrows"),
        F.round((F.col("east") - F.col("west")) / abs(a)).cast("int").alias("ncols"))


def department_cells(tile_cells: DataFrame, boxes: DataFrame, grid: DataFrame) -> DataFrame:
    """Cells of 1-degree tiles on the grids of the departments they cover,
    clipped to each box.

    ``tile_cells``: (lat, lon, row, col, z), the tile's south-west corner and
    the cell's place from its north-west corner, at the grid's resolution.
    Several tiles of a department that cover one cell are ranked by (lat, lon).
    """
    tiles = tiles_for_bbox(boxes).join(grid, "departement").drop("tile")
    x = F.col("lon") + (F.col("col") + 0.5) * F.col("a")
    y = F.col("lat") + 1 + (F.col("row") + 0.5) * F.col("e")
    row = F.floor((y - F.col("f")) / F.col("e")).cast("int")
    col = F.floor((x - F.col("c")) / F.col("a")).cast("int")
    rank = ((F.col("lat") + 90) * 1000 + F.col("lon") + 180).cast("int")
    on = tile_cells.join(F.broadcast(tiles), ["lat", "lon"])   # a few tiles per department
    out = on.select("departement", rank.alias("tile_rank"), row.alias("row"), col.alias("col"), "z", "nrows", "ncols")
    inside = (F.col("row") >= 0) & (F.col("row") < F.col("nrows")) & (F.col("col") >= 0) & (F.col("col") < F.col("ncols"))
    return out.where(inside).drop("nrows", "ncols")


def mosaic(cells: DataFrame) -> DataFrame:
    """Merge overlapping tiles on the department grid: where several tiles
    cover a cell, the first tile (lowest ``tile_rank``) wins."""
    return (cells.groupBy("departement", "row", "col")
            .agg(F.min_by("z", "tile_rank").alias("z")))


# ------------------------------------------------------------------- R3
def _gradient(at: Column, size: Column, before: Column, own: Column, after: Column, step: Column) -> Column:
    """numpy.gradient along one axis: central difference inside, one-sided at
    the grid's edges; a missing value makes the result missing."""
    return (F.when(size < 2, F.lit(None).cast("double"))
            .when(at == 0, (after - own) / step)
            .when(at == size - 1, (own - before) / step)
            .otherwise((after - before) / (F.lit(2.0) * step)))


def slope_aspect(cells: DataFrame, grid: DataFrame) -> DataFrame:
    """Per cell slope (degrees) and aspect (downslope bearing, degrees).

    Every valid height goes to its own cell and its four neighbours, where
    they meet in one aggregate; a cell that is absent from the table is a
    nodata cell, as on the dense grid.
    """
    ok = cells.where((F.col("z") >= Z_MIN) & (F.col("z") <= Z_MAX))

    def to(role: str, dr: int, dc: int) -> Column:
        return F.struct(F.lit(role).alias("role"), (F.col("row") + dr).alias("row"), (F.col("col") + dc).alias("col"))
    spread = ok.select("departement", F.col("z").cast("double").alias("z"), F.explode(F.array(
        to("o", 0, 0), to("w", 0, 1), to("e", 0, -1), to("n", 1, 0), to("s", -1, 0))).alias("p"))
    near = spread.groupBy("departement", F.col("p.row").alias("row"), F.col("p.col").alias("col")).agg(
        *(F.max(F.when(F.col("p.role") == r, F.col("z"))).alias(r) for r in "owens"))
    g = near.withColumnRenamed("e", "ea").join(F.broadcast(grid.select(
        "departement", F.abs("a").alias("pa"), F.col("e").alias("pe"), "f", "nrows", "ncols")), "departement")
    g = g.where((F.col("row") >= 0) & (F.col("row") < F.col("nrows")) & (F.col("col") >= 0) & (F.col("col") < F.col("ncols")))
    center_lat = F.col("f") + F.floor(F.col("nrows") / 2) * F.col("pe")
    dx = F.col("pa") * METERS_PER_DEG * F.cos(F.radians(center_lat))
    dy = F.abs("pe") * METERS_PER_DEG
    g = g.select("departement", "row", "col",
                 _gradient(F.col("col"), F.col("ncols"), F.col("w"), F.col("o"), F.col("ea"), dx).alias("dzdx"),
                 _gradient(F.col("row"), F.col("nrows"), F.col("n"), F.col("o"), F.col("s"), dy).alias("dzdy"))
    slope = F.degrees(F.atan(F.sqrt(F.col("dzdx") ** 2 + F.col("dzdy") ** 2)))
    aspect = (F.degrees(F.atan2(-F.col("dzdx"), F.col("dzdy"))) + 360) % 360
    return g.select("departement", "row", "col", slope.alias("slope"), aspect.alias("aspect"))


def exposure_class(slope: Column, aspect: Column) -> Column:
    sloped = slope >= MIN_SLOPE_DEG
    south = (aspect >= 135) & (aspect <= 225)
    north = (aspect >= 315) | (aspect <= 45)
    return (F.when(slope.isNull(), F.lit(None).cast("string"))
            .when(sloped & south, CLASS_HIGH).when(sloped & north, CLASS_LOW)
            .when(sloped, CLASS_MODERATE).otherwise(CLASS_FLAT))


def classify_exposure(cells: DataFrame, grid: DataFrame) -> DataFrame:
    """Exposure class per cell; cells whose slope is undefined are excluded."""
    sa = slope_aspect(cells, grid)
    return sa.select("departement", "row", "col",
                     exposure_class(F.col("slope"), F.col("aspect")).alias("exposure")) \
        .where(F.col("exposure").isNotNull())


# ------------------------------------------------------------------- R4
# A task labels one tile of cells exactly: both sides are bounded.
TILE_ROWS, TILE_COLS = 256, 1024
_CLASS_CODES = {CLASS_FLAT: 0, CLASS_HIGH: 1, CLASS_LOW: 2, CLASS_MODERATE: 3}


def _label_tile(pdf):
    """Exact 4-connected labelling of one tile (numpy inside a task):
    horizontal runs, vertical run adjacency, minima hooked on and pointers
    jumped until nothing changes; every cell gets the smallest cell id of its
    component in the tile."""
    import numpy as np
    import pandas as pd

    pdf = pdf.sort_values(["row", "col"], kind="mergesort").reset_index(drop=True)
    row = pdf["row"].to_numpy(np.int64)
    col = pdf["col"].to_numpy(np.int64)
    cls = pdf["cls"].to_numpy(np.int64)
    n = len(pdf)
    new_run = np.ones(n, dtype=bool)
    if n > 1:
        new_run[1:] = (row[1:] != row[:-1]) | (col[1:] != col[:-1] + 1) | (cls[1:] != cls[:-1])
    run = np.cumsum(new_run) - 1
    start_id = (row * CELL_ID_STRIDE + col)[new_run]          # smallest cell id of each run
    # Vertical adjacency: cell (r, c) and (r + 1, c) of the same class.
    key = row * CELL_ID_STRIDE + col
    below = np.searchsorted(key, key + CELL_ID_STRIDE)
    has = below < n
    has[has] = key[below[has]] == key[has] + CELL_ID_STRIDE
    has[has] = cls[below[has]] == cls[has]
    a, b = run[has], run[below[has]]
    label = np.arange(len(start_id))
    while True:
        old = label.copy()
        low = np.minimum(label[a], label[b])
        for side in (a, b):
            np.minimum.at(label, label[side], low)   # hook the roots
            np.minimum.at(label, side, low)
        label = label[label]
        if (label == old).all():
            break
    return pd.DataFrame({"departement": pdf["departement"], "row": row.astype(np.int32),
                         "col": col.astype(np.int32), "cls": cls.astype(np.int32),
                         "label": start_id[label][run]})


def _ship_by_value() -> None:
    """Pickle this module's task functions by value, so Python workers run
    them without the package being installed on the executors."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def tile_labels(classes: DataFrame, tile_rows: int = TILE_ROWS, tile_cols: int = TILE_COLS) -> DataFrame:
    """Exact labels inside tiles; groups are (department, tile): bounded size."""
    _ship_by_value()
    code = F.create_map(*[x for k, v in _CLASS_CODES.items() for x in (F.lit(k), F.lit(v))])
    c = classes.select("departement", "row", "col", code[F.col("exposure")].alias("cls"),
                       F.floor(F.col("row") / tile_rows).alias("tr"), F.floor(F.col("col") / tile_cols).alias("tc"))
    return c.groupBy("departement", "tr", "tc").applyInPandas(
        _label_tile, "departement string, row int, col int, cls int, label long")


def region_cells(classes: DataFrame, tile_rows: int = TILE_ROWS, tile_cols: int = TILE_COLS) -> DataFrame:
    """Every classified cell with the id of its 4-connected region (the
    smallest cell id in it): tile labels merged across tile borders."""
    lab = materialize(tile_labels(classes, tile_rows, tile_cols), "labels")

    def touching(axis: str, size: int) -> DataFrame:
        after = lab.where(F.col(axis) % size == 0).select("departement", "cls", "row", "col", F.col("label").alias("b"))
        before = lab.where((F.col(axis) + 1) % size == 0).select("departement", "cls", "row", "col", F.col("label").alias("a"))
        return before.withColumn(axis, F.col(axis) + 1).join(after, ["departement", "cls", "row", "col"]) \
            .select("departement", "a", "b")
    edges = touching("row", tile_rows).unionByName(touching("col", tile_cols)).distinct()
    merged = connected_components(edges, ["departement"])
    cells = lab.join(merged.select("departement", F.col("id").alias("label"), "comp"), ["departement", "label"], "left")
    names = F.create_map(*[x for k, v in _CLASS_CODES.items() for x in (F.lit(v), F.lit(k))])
    return cells.select("departement", "row", "col", F.coalesce("comp", "label").alias("region_id"),
                        names[F.col("cls")].alias("exposure"))


def _on_grid(df: DataFrame, grid: DataFrame) -> DataFrame:
    return df.join(F.broadcast(grid.select("departement", "a", F.col("e").alias("e_grid"), "c", "f")), "departement")


def region_parts(classes: DataFrame, grid: DataFrame, tile_rows: int = TILE_ROWS,
                 tile_cols: int = TILE_COLS) -> DataFrame:
    """Vectorised regions as polygon parts: one rectangle per horizontal run
    of a region (WGS84), with its area in cells.  A region is the union of its
    parts; a region is never gathered into one row."""
    cells = region_cells(classes, tile_rows, tile_cols)
    w = Window.partitionBy("departement", "region_id", "row").orderBy("col")
    r = cells.select("*", (F.col("col") - F.row_number().over(w)).alias("_k"))
    runs = _on_grid(r.groupBy("departement", "region_id", "exposure", "row", "_k").agg(
        F.min("col").alias("col_start"), F.max("col").alias("col_end")), grid)
    x0 = F.col("c") + F.col("col_start") * F.col("a")
    x1 = F.col("c") + (F.col("col_end") + 1) * F.col("a")
    y0 = F.col("f") + F.col("row") * F.col("e_grid")
    y1 = F.col("f") + (F.col("row") + 1) * F.col("e_grid")
    ring = F.array(xy(x0, y0), xy(x1, y0), xy(x1, y1), xy(x0, y1), xy(x0, y0))
    return runs.select(
        "departement", "region_id", "exposure", "row", "col_start", "col_end",
        (F.col("col_end") - F.col("col_start") + 1).cast("long").alias("n_cells"),
        F.struct(F.lit("Polygon").alias("type"), F.array(F.array(ring)).alias("parts")).alias("geom"))


def region_shapes(classes: DataFrame, grid: DataFrame, tile_rows: int = TILE_ROWS,
                  tile_cols: int = TILE_COLS) -> DataFrame:
    """Per region: cell count, area (grid units squared) and ring count of
    its polygon (1 exterior + holes), without assembling any polygon.

    Holes come from the Euler number of the region under 4-connectivity,
    counted locally on 2x2 cell quads around every grid corner (Gray's
    bit-quad formula E4 = (Q1 - Q3 + 2 QD) / 4): each cell adds one bit to
    the four quads it belongs to, quads are summed per (corner, region) and
    then per region -- map-side combined aggregates, no region in one task.
    A region is connected, so holes = 1 - E4.
    """
    cells = region_cells(classes, tile_rows, tile_cols)
    corners = F.explode(F.array(
        F.struct((F.col("row") + 1).alias("vr"), (F.col("col") + 1).alias("vc"), F.lit(1).alias("b")),
        F.struct((F.col("row") + 1).alias("vr"), F.col("col").alias("vc"), F.lit(2).alias("b")),
        F.struct(F.col("row").alias("vr"), (F.col("col") + 1).alias("vc"), F.lit(4).alias("b")),
        F.struct(F.col("row").alias("vr"), F.col("col").alias("vc"), F.lit(8).alias("b"))))
    q = cells.select("departement", "region_id", "exposure", corners.alias("q")) \
        .groupBy("departement", "region_id", "exposure", "q.vr", "q.vc") \
        .agg(F.sum("q.b").alias("mask"), F.count(F.lit(1)).alias("bits"))
    per = q.groupBy("departement", "region_id", "exposure").agg(
        F.sum(F.when(F.col("bits") == 1, 1).otherwise(0)).alias("q1"),
        F.sum(F.when(F.col("bits") == 3, 1).otherwise(0)).alias("q3"),
        F.sum(F.when(F.col("mask").isin(6, 9), 1).otherwise(0)).alias("qd"),
        F.sum(F.when(F.col("bits") == 4, 4).otherwise(0) + F.when(F.col("bits") == 3, 3).otherwise(0)
              + F.when(F.col("bits") == 2, 2).otherwise(0) + F.when(F.col("bits") == 1, 1).otherwise(0))
        .alias("bit_total"))
    euler = (F.col("q1") - F.col("q3") + 2 * F.col("qd")) / 4
    n = (F.col("bit_total") / 4).cast("long")
    return _on_grid(per, grid).select("departement", "region_id", "exposure", n.alias("n_cells"),
                                      (n * F.abs(F.col("a") * F.col("e_grid"))).alias("area"),
                                      (F.lit(2) - euler).cast("long").alias("n_rings"))


def exposure_regions(classes: DataFrame, tile_rows: int = TILE_ROWS, tile_cols: int = TILE_COLS) -> DataFrame:
    """4-connected regions of equal exposure class, one row per region:
    id (= smallest cell id), class, cell count and extent."""
    cells = region_cells(classes, tile_rows, tile_cols)
    return cells.groupBy("departement", "region_id", "exposure").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.min("row").alias("row_min"), F.max("row").alias("row_max"),
        F.min("col").alias("col_min"), F.max("col").alias("col_max"))


# ------------------------------------------------------------ R4d rings
# Directions of unit boundary edges in grid coordinates (x = col, y = row,
# y growing southward): east, south, west, north.  Every cell's boundary is
# walked clockwise (top edge eastward), so a region's interior lies to the
# right of each of its boundary edges.
def boundary_edges(cells: DataFrame) -> DataFrame:
    """Directed unit edges on region boundaries: cell sides not shared with
    another cell of the same region (a side-count aggregate keyed by region,
    so a large region spreads over many tasks)."""
    def side(d: int, x: Column, y: Column, kind: str, kr: Column, kc: Column) -> Column:
        return F.struct(F.lit(d).alias("d"), x.alias("x"), y.alias("y"), F.lit(kind).alias("k"), kr.alias("kr"), kc.alias("kc"))
    r, c = F.col("row"), F.col("col")
    sides = F.explode(F.array(side(0, c, r, "h", r, c), side(1, c + 1, r, "v", r, c + 1),
                              side(2, c + 1, r + 1, "h", r + 1, c), side(3, c, r + 1, "v", r, c)))
    s = cells.select("departement", "region_id", "exposure", sides.alias("s"))
    g = s.groupBy("departement", "region_id", "exposure", "s.k", "s.kr", "s.kc").agg(
        F.count(F.lit(1)).alias("n"), F.first("s.d").alias("d"), F.first("s.x").alias("x"), F.first("s.y").alias("y"))
    return g.where(F.col("n") == 1).select("departement", "region_id", "exposure", "d", "x", "y")


def boundary_runs(edges: DataFrame) -> DataFrame:
    """Maximal straight runs of boundary edges: start (x, y), end (x1, y1) and
    direction.  Straight neighbours always follow each other on a ring, as two
    boundary lines cross only with opposite directions on each line."""
    flat = F.col("d") % 2 == 0
    e = edges.select("departement", "region_id", "exposure", "d",
                     F.when(flat, F.col("y")).otherwise(F.col("x")).alias("line"),
                     F.when(flat, F.col("x")).otherwise(F.col("y")).alias("at"))
    w = Window.partitionBy("departement", "region_id", "d", "line").orderBy("at")
    e = e.withColumn("k", F.col("at") - F.row_number().over(w))
    runs = e.groupBy("departement", "region_id", "exposure", "d", "line", "k").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    # Eastward and southward edges run from lo to hi + 1, the others from hi to lo - 1.
    ahead = F.col("d") < 2
    start = F.when(ahead, F.col("lo")).otherwise(F.col("hi"))
    end = F.when(ahead, F.col("hi") + 1).otherwise(F.col("lo") - 1)

    def coord(along: Column, want_x: bool) -> Column:
        return F.when(flat == F.lit(want_x), along).otherwise(F.col("line"))
    return runs.select("departement", "region_id", "exposure", "d", coord(start, True).alias("x"), coord(start, False).alias("y"),
                       coord(end, True).alias("x1"), coord(end, False).alias("y1"))


def region_rings(classes: DataFrame, grid: DataFrame, tile_rows: int = TILE_ROWS,
                 tile_cols: int = TILE_COLS) -> DataFrame:
    """Exact polygon rings of every region, in long form: one row per ring
    corner ``(departement, region_id, exposure, ring_id, seq, lon, lat)``
    plus the ring's signed area in cells (> 0 exterior, < 0 hole).

    Straight boundary runs get a successor (the run leaving their end; where a
    region touches itself diagonally, the right turn, which keeps 4-connected
    regions apart), then rings are ordered by pointer jumping: ring id =
    smallest run id on the cycle, rank = distance to the cycle's tail; log2
    (ring length) rounds, run to convergence, each staged and the one before
    deleted.  Rings are never gathered into one row.
    """
    key = ["departement", "region_id"]
    rid = (F.col("y") * CELL_ID_STRIDE + F.col("x")) * 4 + F.col("d")
    runs = boundary_runs(boundary_edges(region_cells(classes, tile_rows, tile_cols)))
    runs = materialize(runs.select("*", rid.alias("e")), "runs")
    after = runs.select(*key, F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("e").alias("ne"), F.col("d").alias("nd"))
    prefer = F.when(F.col("nd") == (F.col("d") + 1) % 4, 0).otherwise(1) * 4 + F.col("nd")
    succ = runs.join(after, [*key, "x1", "y1"]).groupBy(*key, "e").agg(F.min_by("ne", prefer).alias("s"))
    lab = materialize(succ.select(*key, "e", F.col("s").alias("j"), F.col("s").alias("next"), F.col("e").alias("m")), "ring")
    while True:
        hop = lab.select(*key, F.col("e").alias("j"), F.col("j").alias("j2"), F.col("m").alias("m2"))
        new = materialize(lab.join(hop, [*key, "j"]).select(
            *key, "e", F.col("j2").alias("j"), "next", F.least("m", "m2").alias("m"), (F.least("m", "m2") != F.col("m")).alias("moved")), "ring")
        release(lab)
        lab = new
        # Stable for one round: every window minimum is the cycle's.
        if lab.where("moved").isEmpty():
            break
    # Cut each cycle before its head and rank by the distance to the tail.
    last = F.col("next") == F.col("m")
    rank = materialize(lab.select(*key, "e", F.col("m").alias("ring_id"), F.when(~last, F.col("next")).alias("j"),
                                  F.when(last, 0).otherwise(1).cast("long").alias("r")), "rank")
    release(lab)
    while not rank.where(F.col("j").isNotNull()).isEmpty():
        hop = rank.select(*key, F.col("e").alias("j"), F.col("j").alias("j2"), F.col("r").alias("r2"))
        new = materialize(rank.join(hop, [*key, "j"], "left").select(
            *key, "ring_id", "e", F.col("j2").alias("j"), (F.col("r") + F.coalesce("r2", F.lit(0))).alias("r")), "rank")
        release(rank)
        rank = new
    out = runs.join(rank.select(*key, "ring_id", "e", "r"), [*key, "e"])
    cross = F.col("x") * F.col("y1") - F.col("x1") * F.col("y")
    stats = out.groupBy(*key, "ring_id").agg(F.count(F.lit(1)).alias("corners"), (F.sum(cross) / 2).cast("long").alias("ring_area"))
    return _on_grid(out.join(stats, [*key, "ring_id"]), grid).select(
        *key, "exposure", "ring_id", (F.col("corners") - 1 - F.col("r")).alias("seq"),
        (F.col("c") + F.col("x1") * F.col("a")).alias("lon"), (F.col("f") + F.col("y1") * F.col("e_grid")).alias("lat"), "ring_area")


def region_polygons(rings: DataFrame) -> DataFrame:
    """Regions as polygon geometries with holes, from :func:`region_rings`: a
    row holds one region's boundary, as a polygon value must."""
    corner = F.struct("seq", "lon", "lat")
    ring = rings.groupBy("departement", "region_id", "exposure", "ring_id", "ring_area").agg(
        F.array_sort(F.collect_list(corner)).alias("p"))
    points = F.transform("p", lambda q: xy(q["lon"], q["lat"]))
    closed = F.concat(points, F.slice(points, 1, 1))
    ring = ring.select("departement", "region_id", "exposure",
                       F.struct((F.col("ring_area") < 0).alias("hole"), F.col("ring_id"), closed.alias("ring")).alias("r"))
    region = ring.groupBy("departement", "region_id", "exposure").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    return region.select(
        "departement", "region_id", F.col("exposure").alias("exposition"),
        F.struct(F.lit("Polygon").alias("type"), F.array(F.transform("rs", lambda r: r["ring"])).alias("parts")).alias("geom"))
