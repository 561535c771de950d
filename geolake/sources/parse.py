"""Text -> typed rows, as column expressions over any table of text.

Every parser works on a DataFrame with one text column (one record per row),
so large landed files are read splittably (one JSON object / CSV record per
line) and parsed in parallel; nothing is gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.geometry import GEOM_TYPE
from . import schemas as S

_COORDS = {
    "Point": "array<double>",
    "LineString": "array<array<double>>",
    "Polygon": "array<array<array<double>>>",
    "MultiPoint": "array<array<double>>",
    "MultiLineString": "array<array<array<double>>>",
    "MultiPolygon": "array<array<array<array<double>>>>",
}


_BAD = "_bad"


def record(col: Column, schema: StructType) -> Column:
    """JSON text -> struct of ``schema`` and ``_bad``: the text, where it is no
    JSON object.  (A value of another type than the schema's makes that field
    NULL and leaves the record.)"""
    wide = StructType([*schema.fields, S.StructField(_BAD, S.StringType())])
    parsed = F.from_json(col, wide, {"columnNameOfCorruptRecord": _BAD})
    return F.transform(F.array(parsed), lambda r: r.withField(_BAD, F.when(
        F.coalesce(*(F.when(r[f.name].isNotNull(), F.lit(True)) for f in schema.fields)).isNull(), r[_BAD])))[0]


def json_rejects(lines: DataFrame, schema: StructType, col: str = "value", place: Sequence[str] = ()) -> DataFrame:
    """The records that are no JSON object: ``place``, the text, the reason.
    Blank lines are no records."""
    bad = lines.where(F.trim(F.col(col)) != "").select(*place, record(F.col(col), schema)[_BAD].alias("record"))
    return bad.where(F.col("record").isNotNull()).withColumn("reason", F.lit("not a JSON object"))


def _records(lines: DataFrame, schema: StructType, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """``f`` and the columns ``keep`` for every record that is a JSON object."""
    f = lines.where(F.trim(F.col(col)) != "").select(record(F.col(col), schema).alias("f"), *keep)
    return f.where(F.col(f"f.{_BAD}").isNull())


def _xy(p: Column) -> Column:
    return F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))


def geojson_geometry(geometry: Column) -> Column:
    """GeoJSON geometry struct (type + raw coordinates text) -> geometry; a
    GeometryCollection has no one type and gives NULL."""
    t, raw = geometry["type"], geometry["coordinates"]

    def parts_of(kind: str) -> Column:
        c = F.from_json(raw, _COORDS[kind])
        if kind == "Point":
            return F.array(F.array(F.array(_xy(c))))
        if kind in ("LineString", "MultiPoint"):
            return F.array(F.array(F.transform(c, _xy)))
        if kind in ("Polygon", "MultiLineString"):
            return F.array(F.transform(c, lambda r: F.transform(r, _xy)))
        return F.transform(c, lambda poly: F.transform(poly, lambda r: F.transform(r, _xy)))

    expr = None
    for kind in _COORDS:
        g = F.struct(F.lit(kind).alias("type"), parts_of(kind).alias("parts"))
        expr = F.when(t == kind, g) if expr is None else expr.when(t == kind, g)
    return expr.otherwise(F.lit(None).cast(GEOM_TYPE))


def parse_features(lines: DataFrame, properties: StructType, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Line-delimited GeoJSON features -> ``properties.*`` + ``geom`` and the
    columns ``keep``."""
    schema = StructType([
        S.StructField("type", S.StringType()),
        S.StructField("properties", properties),
        S.StructField("geometry", S.GEOJSON_GEOMETRY),
    ])
    f = _records(lines, schema, col, keep)
    return f.select("f.properties.*", geojson_geometry(F.col("f.geometry")).alias("geom"), *keep)


def parse_properties(records: DataFrame, properties: StructType, col: str = "value") -> DataFrame:
    """Feature records with ``ordinal`` -> their ``properties`` (NULL allowed)."""
    schema = StructType([S.StructField("properties", properties)])
    return _records(records, schema, col, ["ordinal"]).select("f.properties", "ordinal")


def parse_osm(lines: DataFrame, col: str = "value") -> DataFrame:
    """Line-delimited Overpass elements -> element rows."""
    return _records(lines, S.OSM_ELEMENT, col).select("f.*").drop(_BAD)


def explode_results(pages: DataFrame, record: StructType, key: str = "results",
                    col: str = "value") -> DataFrame:
    """Paged API documents ``{key: [records]}`` (one page per row) -> records."""
    schema = StructType([S.StructField(key, S.ArrayType(record))])
    return pages.select(F.explode(F.from_json(F.col(col), schema)[key]).alias("r")).select("r.*")


def parse_entities(docs: DataFrame, col: str = "value") -> DataFrame:
    """Entity batch documents ``{"entities": {qid: entity}}`` -> one row per
    entity with ``missing`` as a flag (the key is present)."""
    m = F.from_json(F.col(col), S.ENTITIES_DOC)["entities"]
    e = docs.select(F.explode(m).alias("qid", "e"))
    return e.select("qid", F.col("e.missing").isNotNull().alias("missing"),
                    F.col("e.descriptions").alias("descriptions"), F.col("e.claims").alias("claims"))


def parse_delimited(lines: DataFrame, schema: str, sep: str = ";", col: str = "value") -> DataFrame:
    """Delimited text records -> typed columns via ``from_csv`` (JVM-side)."""
    return lines.select(F.from_csv(F.col(col), schema, {"sep": sep}).alias("r")).select("r.*")
