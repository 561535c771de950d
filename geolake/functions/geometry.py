"""Geometry as plain nested Spark data, built and inspected with Column math.

Canonical column type::

    geom: struct<type: string,
                 parts: array<array<array<struct<x: double, y: double>>>>>

part -> ring -> vertex; Point = [[[p]]], LineString = [[pts]],
MultiPoint = [[pts]], MultiLineString = [[line, line...]],
Polygon = [[exterior, hole...]], MultiPolygon = [polygon...].  x = lon,
y = lat (EPSG:4326).  Everything here is a higher-order Column expression
(``transform``/``filter``/``aggregate``), evaluated inside whole-stage
codegen; no geometry library and no Python UDF is involved.

OSM vertex arrays arrive as ``array<struct<lat: double, lon: double>>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOM_TYPE = ("struct<type:string,parts:array<array<array<"
             "struct<x:double,y:double>>>>>")


def xy(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("x"), lat.cast("double").alias("y"))


def _geom(kind: str, parts: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), parts.alias("parts"))


def point(lon: Column, lat: Column) -> Column:
    """Point from lon/lat; NULL when either is NULL (callers drop such rows)."""
    return F.when(lon.isNotNull() & lat.isNotNull(),
                  _geom("Point", F.array(F.array(F.array(xy(lon, lat))))))


def vertices(pts: Column) -> Column:
    """OSM ``array<struct<lat,lon>>`` -> ``array<struct<x,y>>``."""
    return F.transform(pts, lambda p: xy(p["lon"], p["lat"]))


def is_closed_ring(pts: Column) -> Column:
    """At least 4 vertices and first == last (exact coordinate equality)."""
    first = F.get(pts, 0)
    last = F.get(pts, F.size(pts) - 1)
    return F.coalesce(
        (F.size(pts) >= 4) & (first["lat"] == last["lat"]) & (first["lon"] == last["lon"]),
        F.lit(False))


def line(pts: Column) -> Column:
    """LineString from >= 2 vertices, else NULL."""
    return F.when(F.coalesce(F.size(pts) >= 2, F.lit(False)),
                  _geom("LineString", F.array(F.array(vertices(pts)))))


def polygon_or_null(pts: Column) -> Column:
    """Polygon when the ring is closed with >= 4 points, else NULL (dropped)."""
    return F.when(is_closed_ring(pts), _geom("Polygon", F.array(F.array(vertices(pts)))))


def polygon_or_line(pts: Column) -> Column:
    """Closed ring -> Polygon, otherwise >= 2 points -> LineString, else NULL."""
    return F.when(is_closed_ring(pts), _geom("Polygon", F.array(F.array(vertices(pts))))) \
        .otherwise(line(pts))


def _outer_closed(members: Column, require_way: bool) -> Column:
    def keep(m):
        c = (m["role"] == "outer") & m["geometry"].isNotNull() & is_closed_ring(m["geometry"])
        if require_way:
            c = c & (m["type"] == "way")
        return F.coalesce(c, F.lit(False))
    return F.filter(members, keep)


def multipolygon_from_members(members: Column) -> Column:
    """Relation -> MultiPolygon of its closed outer way members (one ring each,
    no holes; open outer segments are dropped, not stitched)."""
    rings = _outer_closed(members, require_way=True)
    return F.when(F.coalesce(F.size(rings) > 0, F.lit(False)),
                  _geom("MultiPolygon",
                        F.transform(rings, lambda m: F.array(vertices(m["geometry"])))))


def first_outer_polygon(members: Column) -> Column:
    """Relation -> Polygon of its first closed outer member (type not checked)."""
    rings = _outer_closed(members, require_way=False)
    return F.when(F.coalesce(F.size(rings) > 0, F.lit(False)),
                  _geom("Polygon", F.array(F.array(vertices(F.get(rings, 0)["geometry"])))))


def feature_geom(el_type: Column, lat: Column, lon: Column, pts: Column,
                 way_rule: str = "polygon_or_line") -> Column:
    """Mixed node/way element: node -> Point, way -> rule, others -> NULL."""
    rule = {"polygon_or_line": polygon_or_line, "polygon_or_null": polygon_or_null,
            "line": line}[way_rule]
    return F.when(el_type == "node", point(lon, lat)) \
        .when((el_type == "way") & pts.isNotNull(), rule(pts))


# ----------------------------------------------------------------- accessors
def all_points(geom: Column) -> Column:
    return F.flatten(F.flatten(geom["parts"]))


def st_x(geom: Column) -> Column:
    """X (lon) of a point geometry."""
    return F.get(all_points(geom), 0)["x"]


def st_y(geom: Column) -> Column:
    """Y (lat) of a point geometry."""
    return F.get(all_points(geom), 0)["y"]


def geom_stats(geom: Column, prefix: str = "geom") -> list[Column]:
    """Comparable summary of a geometry: type, part/vertex counts, bbox."""
    pts = all_points(geom)
    return [
        geom["type"].alias(f"{prefix}_type"),
        F.size(geom["parts"]).cast("long").alias(f"{prefix}_parts"),
        F.size(pts).cast("long").alias(f"{prefix}_points"),
        F.array_min(F.transform(pts, lambda p: p["x"])).alias(f"{prefix}_xmin"),
        F.array_min(F.transform(pts, lambda p: p["y"])).alias(f"{prefix}_ymin"),
        F.array_max(F.transform(pts, lambda p: p["x"])).alias(f"{prefix}_xmax"),
        F.array_max(F.transform(pts, lambda p: p["y"])).alias(f"{prefix}_ymax"),
    ]


def flatten_geom(df, col: str = "geom", prefix: str = "geom"):
    """Replace a geometry column by its :func:`geom_stats` columns."""
    others = [F.col(c) for c in df.columns if c != col]
    return df.select(*others, *geom_stats(F.col(col), prefix))


def bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (a let-binding).

    Higher-order functions are interpreted, without common-subexpression
    elimination; binding through a one-element ``transform`` keeps a value
    used several times from being recomputed."""
    return F.get(F.transform(F.array(value), fn), 0)


def map_points(geom: Column, fn) -> Column:
    """Apply ``fn(x, y) -> struct<x,y>`` to every vertex (e.g. reprojection)."""
    def moved(g):
        return F.when(g.isNotNull(), F.struct(
            g["type"].alias("type"),
            F.transform(g["parts"], lambda part: F.transform(
                part, lambda r: F.transform(r, lambda p: fn(p["x"], p["y"])))).alias("parts")))
    return bind(geom, moved)


def with_geom(df, geom: Column, col: str = "geom"):
    """``df`` with the geometry column, rows without a geometry dropped.  The
    geometry goes through a one-row explode, so the optimiser cannot copy its
    expression into a pushed-down filter."""
    return df.withColumn(col, F.explode(F.array(geom))).where(F.col(col).isNotNull())
