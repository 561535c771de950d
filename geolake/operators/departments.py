"""Department assignment by bounding box (a range join without a join).

An element belongs to every requested department whose box contains one of
its anchor points (node position, way vertices, relation member vertices);
boxes overlap, so an element may be emitted once per matching department.

The box table is fixed (about 100 rows), so instead of a nested-loop range
join every row looks up the 1-degree cells its points fall in, in a constant
dense ``cell -> departments`` grid folded into the plan (O(1) per point), and
then refines with the exact inclusive box test.  No shuffle, no join, no
Python.  Any other box table goes through the grid join of :mod:`.boxes`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.departments import ALL_DEPARTMENTS, DEP_BBOX, cell_index
from .boxes import assign_to_boxes


def _grid(deps: list[str]):
    """Dense 1-degree grid over the boxes' extent: cell -> department indexes.

    Returned as constant array columns (parsed once from JSON text and folded
    into the plan), so a lookup is O(1) array indexing per point."""
    import json
    idx = cell_index(deps)
    lats = [c // 1000 - 90 for c in idx]
    lons = [c % 1000 - 180 for c in idx]
    lat0, lat1, lon0, lon1 = min(lats), max(lats), min(lons), max(lons)
    width = lon1 - lon0 + 1
    pos = {d: i for i, d in enumerate(deps)}
    cells = [[] for _ in range((lat1 - lat0 + 1) * width)]
    for c, ds in idx.items():
        la, lo = c // 1000 - 90, c % 1000 - 180
        cells[(la - lat0) * width + (lo - lon0)] = [pos[d] for d in ds]
    grid = F.from_json(F.lit(json.dumps(cells)), "array<array<int>>")
    boxes = F.from_json(F.lit(json.dumps([list(DEP_BBOX[d]) for d in deps])), "array<array<double>>")
    codes = F.array(*[F.lit(d) for d in deps])
    return grid, boxes, codes, lat0, lat1, lon0, lon1, width


def departments_of(points: Column, deps: Iterable[str] | None = None) -> Column:
    """``array<struct<lat,lon>>`` -> array of departments whose box holds a point."""
    deps = [d for d in (list(deps) if deps else ALL_DEPARTMENTS) if d in DEP_BBOX]
    if not deps:
        return F.array().cast("array<string>")
    grid, boxes, codes, lat0, lat1, lon0, lon1, width = _grid(deps)
    empty = F.array().cast("array<int>")
    pts = F.filter(points, lambda p: p["lat"].isNotNull() & p["lon"].isNotNull())

    def cell_deps(p):
        la, lo = F.floor(p["lat"]), F.floor(p["lon"])
        inside = la.between(lat0, lat1) & lo.between(lon0, lon1)
        i = ((la - lat0) * width + (lo - lon0) + 1).cast("int")
        return F.when(inside, F.element_at(grid, i)).otherwise(empty)

    cand = F.array_distinct(F.flatten(F.transform(pts, cell_deps)))

    def holds(i):
        b = F.element_at(boxes, i + 1)
        s, w, n, e = (F.element_at(b, k) for k in (1, 2, 3, 4))
        return F.exists(pts, lambda p: p["lat"].between(s, n) & p["lon"].between(w, e))
    return F.array_sort(F.transform(F.filter(cand, holds), lambda i: F.element_at(codes, i + 1)))


def _segment_hits_box(p0: Column, p1: Column, s, w, n, e) -> Column:
    """Closed segment p0-p1 meets the closed box (separating-axis test: the
    bounding ranges overlap and the box corners are not all strictly on one
    side of the segment's line)."""
    x0, y0, x1, y1 = p0["lon"], p0["lat"], p1["lon"], p1["lat"]
    overlap = ((F.greatest(x0, x1) >= w) & (F.least(x0, x1) <= e)
               & (F.greatest(y0, y1) >= s) & (F.least(y0, y1) <= n))
    dx, dy = x1 - x0, y1 - y0

    def side(cx, cy):
        return dx * (cy - y0) - dy * (cx - x0)
    c = [side(w, s), side(w, n), side(e, s), side(e, n)]
    all_pos = (c[0] > 0) & (c[1] > 0) & (c[2] > 0) & (c[3] > 0)
    all_neg = (c[0] < 0) & (c[1] < 0) & (c[2] < 0) & (c[3] < 0)
    return overlap & ~all_pos & ~all_neg


def _bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once for use inside interpreted lambdas."""
    return F.get(F.transform(F.array(value), fn), 0)


def departments_of_lines(lines: Column, deps: Iterable[str] | None = None) -> Column:
    """``array<array<struct<lat,lon>>>`` (polylines) -> departments whose box
    a polyline touches: a vertex inside or a segment crossing it.

    Candidates are the boxes of the grid cells under the element's extent
    (all boxes, if it spans more cells than there are boxes), refined by the
    extents and then by the exact segment test.  The cleaned lines
    and the extent are bound once per element (higher-order functions are
    interpreted without common-subexpression elimination)."""
    deps = [d for d in (list(deps) if deps else ALL_DEPARTMENTS) if d in DEP_BBOX]
    if not deps:
        return F.array().cast("array<string>")
    grid, boxes, codes, lat0, lat1, lon0, lon1, width = _grid(deps)
    idx = F.sequence(F.lit(0), F.lit(len(deps) - 1))
    ls = F.filter(F.transform(lines, lambda l: F.filter(
        l, lambda p: p["lat"].isNotNull() & p["lon"].isNotNull())), lambda l: F.size(l) > 0)

    def bounds(i):
        b = F.element_at(boxes, i + 1)
        return tuple(F.element_at(b, k) for k in (1, 2, 3, 4))   # s, w, n, e

    def with_lines(L):
        pts = F.flatten(L)
        ext = F.struct(F.array_min(F.transform(pts, lambda p: p["lon"])).alias("x0"),
                       F.array_max(F.transform(pts, lambda p: p["lon"])).alias("x1"),
                       F.array_min(F.transform(pts, lambda p: p["lat"])).alias("y0"),
                       F.array_max(F.transform(pts, lambda p: p["lat"])).alias("y1"))

        def with_extent(x):
            def near(i):
                s, w, n, e = bounds(i)
                return (x["x1"] >= w) & (x["x0"] <= e) & (x["y1"] >= s) & (x["y0"] <= n)

            def hits(i):
                def with_box(b):
                    s, w, n, e = (F.element_at(b, k) for k in (1, 2, 3, 4))

                    def line_hits(l):
                        single = F.get(l, 0)
                        point_in = single["lat"].between(s, n) & single["lon"].between(w, e)
                        segs = F.sequence(F.lit(0), F.size(l) - 2)
                        seg_in = F.exists(segs, lambda k: _segment_hits_box(
                            F.element_at(l, k + 1), F.element_at(l, k + 2), s, w, n, e))
                        return F.when(F.size(l) == 1, point_in).otherwise(seg_in)
                    return F.exists(L, line_hits)
                return _bind(F.element_at(boxes, i + 1), with_box)

            la0, la1 = F.greatest(F.floor(x["y0"]), F.lit(lat0)), F.least(F.floor(x["y1"]), F.lit(lat1))
            lo0, lo1 = F.greatest(F.floor(x["x0"]), F.lit(lon0)), F.least(F.floor(x["x1"]), F.lit(lon1))
            by_cell = F.transform(F.sequence(la0, la1), lambda la: F.transform(
                F.sequence(lo0, lo1), lambda lo: F.element_at(grid, ((la - lat0) * width + (lo - lon0) + 1).cast("int"))))
            cand = (F.when((la0 > la1) | (lo0 > lo1), F.array().cast("array<int>"))
                    .when((la1 - la0 + 1) * (lo1 - lo0 + 1) <= len(deps), F.array_distinct(F.flatten(F.flatten(by_cell))))
                    .otherwise(idx))
            return F.transform(F.filter(F.filter(cand, near), hits),
                               lambda i: F.element_at(codes, i + 1))
        return _bind(ext, with_extent)

    return F.array_sort(_bind(ls, with_lines))


def assign_departments(df: DataFrame, points: Column, deps: Iterable[str] | None = None,
                       boxes: DataFrame | None = None) -> DataFrame:
    """One output row per (row, matching department); unknown codes -> none.
    ``boxes`` (departement, south, west, north, east) are any boxes, of any
    number, in place of the fixed table."""
    if boxes is not None:
        return assign_to_boxes(df, points, boxes if deps is None else boxes.where(F.col("departement").isin(list(deps))))
    return df.select("*", F.explode(departments_of(points, deps)).alias("departement"))


def assign_departments_lines(df: DataFrame, lines: Column,
                             deps: Iterable[str] | None = None) -> DataFrame:
    """Polyline version of :func:`assign_departments` (ways, relations)."""
    return df.select("*", F.explode(departments_of_lines(lines, deps)).alias("departement"))


def point_array(lat: Column, lon: Column) -> Column:
    return F.array(F.struct(lat.cast("double").alias("lat"), lon.cast("double").alias("lon")))
