"""Text geometry parsing: WKT and ``"lat,lon"`` geopoints, as Column math."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import GEOM_TYPE, bind, xy
from .text import to_double

_KIND = {"POINT": "Point", "LINESTRING": "LineString", "POLYGON": "Polygon",
         "MULTIPOINT": "MultiPoint", "MULTILINESTRING": "MultiLineString",
         "MULTIPOLYGON": "MultiPolygon"}


def _vertex(s: Column) -> Column:
    nums = F.split(F.trim(s), r"\s+")
    return xy(F.get(nums, 0).try_cast("double"), F.get(nums, 1).try_cast("double"))


def _ring(s: Column) -> Column:
    return F.transform(F.split(s, ","), _vertex)


def _polygon(s: Column) -> Column:
    return F.transform(F.split(s, r"\)\s*,\s*\("), _ring)


# Coordinates text may hold only numbers, separators and parentheses.
_NUMERIC_BODY = r"^[-+0-9eE.,()\s]*$"


def parse_wkt(wkt: Column) -> Column:
    """WKT (points, lines and polygons with holes, single or multiple) -> geometry.

    NULL / empty text, an unknown type or any non-numeric coordinate gives a
    NULL geometry.
    """
    type_name = F.create_map(*[x for k, v in _KIND.items() for x in (F.lit(k), F.lit(v))])
    head = F.struct(
        type_name[F.upper(F.regexp_extract(wkt, r"^\s*([A-Za-z]+)", 1))].alias("t"),
        F.regexp_replace(F.regexp_replace(wkt, r"^[^(]*\(+", ""), r"\)+\s*$", "").alias("b"))

    def build(h):
        t, body = h["t"], h["b"]
        parts = (F.when(t.isin("Point", "LineString"), F.array(F.array(_ring(body))))
                 .when(t == "MultiPoint", F.array(F.array(_ring(F.translate(body, "()", "")))))
                 .when(t.isin("Polygon", "MultiLineString"), F.array(_polygon(body)))
                 .when(t == "MultiPolygon",
                       F.transform(F.split(body, r"\)\)\s*,\s*\(\("), _polygon)))
        ok = t.isNotNull() & body.rlike(_NUMERIC_BODY) & (F.trim(body) != "")

        def check(p):
            pts = F.flatten(F.flatten(p))
            good = ~F.exists(pts, lambda q: q["x"].isNull() | q["y"].isNull())
            return F.when(good, F.struct(t.alias("type"), p.alias("parts")))
        return F.when(ok, bind(parts, check))

    return F.coalesce(bind(head, build), F.lit(None).cast(GEOM_TYPE))


def find_geom_col(columns: list[str]) -> str | None:
    """Geometry text column: ``WKT`` first, then a column starting with ``geom``,
    then any column containing ``geom``."""
    for c in columns:
        if c.upper() == "WKT":
            return c
    for c in columns:
        if c.lower().startswith("geom"):
            return c
    for c in columns:
        if "geom" in c.lower():
            return c
    return None


def parse_geopoint(text: Column) -> tuple[Column, Column]:
    """``"lat,lon"`` -> (lat, lon) doubles; non-numeric parts -> NULL."""
    parts = F.split(text, ",")
    return to_double(F.get(parts, 0)), to_double(F.get(parts, 1))
