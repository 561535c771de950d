"""Scan contracts over landed files (the download itself is not part of the
library).  Each reader returns a lazy DataFrame with explicit types; the
column pruning and filters of the operators reach the scan.

CSV (with quoted separators and line ends), GeoJSON and Overpass documents are
split by byte ranges whatever their size and layout (``records``).  ``.gz``
files are read one task per file, so a per-department layout keeps that
parallel; repartition after the read when a single file is large.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import null_tokens
from . import parse as P
from . import schemas as S
from .manifest import Source, path_exists, probe, readable
from .records import json_records, read_delimited


_DEP = r"(?:0[1-9]|[1-8][0-9]|9[0-5]|2[AB]|97[0-9])"


def department_of(path: Column) -> Column:
    """The department that a file is landed for: a department code standing
    alone in its name (``75.geojsonl``, ``cadastre-75-sections.json``), else
    its nearest folder named like one; NULL without either."""
    name = F.regexp_extract(path, rf"(?:/|[-_.])({_DEP})(?=[-_.][^/]*$|$)", 1)
    folder = F.regexp_extract(path, rf"/({_DEP})(?=/)(?!.*/{_DEP}/)", 1)
    return F.coalesce(F.nullif(name, F.lit("")), F.nullif(folder, F.lit("")))


# ---------------------------------------------------------------------- CSV
def _stem() -> Column:
    """Base name of the record's file without extensions (e.g. ``75``)."""
    return F.regexp_extract("_file", r"([^./]+)[^/]*$", 1)


def read_dvf(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """DVF transactions, one file per (year, department); the department
    is the file's base name."""
    df = read_delimited(spark, path)
    return df.select(
        F.col("id_mutation"), F.col("nature_mutation"),
        F.col("valeur_fonciere").try_cast("double").alias("valeur_fonciere"),
        F.col("type_local"),
        F.col("surface_reelle_bati").try_cast("double").alias("surface_reelle_bati"),
        F.col("id_parcelle"), _stem().alias("departement"))


def read_crime(spark: SparkSession, path: str) -> DataFrame:
    """National crime statistics (';', text), with file order."""
    df = read_delimited(spark, path, ";", place=True)
    return df.select(
        "CODGEO_2025", F.col("annee").try_cast("int").alias("annee"), "indicateur",
        null_tokens(F.col("taux_pour_mille")).alias("taux_pour_mille"),
        null_tokens(F.col("nombre")).alias("nombre"), F.col("_place").alias("ordinal"))


def read_rents(spark: SparkSession, path: str) -> DataFrame:
    """S3: rent indicators (';', ISO-8859-1, decimal comma kept as text)."""
    return read_delimited(spark, path, ";", "ISO-8859-1").drop("_file")


def read_mens(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Monthly climate records per department file (';')."""
    df = read_delimited(spark, path, ";")
    cols = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f.dataType.typeName() != "string"
            else F.col(f.name) for f in S.MENS.fields]
    return df.select(*cols, _stem().alias("departement"))


def read_catnat(spark: SparkSession, path: str) -> DataFrame:
    """Natural-disaster declarations (';', all text)."""
    df = read_delimited(spark, path, ";").drop("_file")
    return df.select(*[null_tokens(F.col(f"`{c}`")).alias(c) for c in df.columns])


def detect_separator(spark: SparkSession, path: str) -> str:
    """';' when the header line contains one, else ','.  Reads one line."""
    first = spark.read.text(path).first()
    return ";" if first is not None and ";" in first[0] else ","


def read_building_table(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Building register CSV, all text, separator detected from the header."""
    return read_delimited(spark, path, sep or detect_separator(spark, path)).drop("_file")


def probe_department_files(spark: SparkSession, folder: str, deps: Sequence[str], extension: str) -> dict[str, Source]:
    """The landed file of each department, read to its end: department ->
    source.  Absent and unreadable ones cost only themselves."""
    found = probe(spark, [f"{folder}/{d}{extension}" for d in deps], spark.read.text)
    return dict(zip(deps, found))


# --------------------------------------------------------------------- JSON
def read_geojson(spark: SparkSession, path: str | Sequence[str], properties: StructType,
                 line_delimited: bool = True) -> DataFrame:
    """GeoJSON -> ``properties.*`` + ``geom`` + ``file_departement``, the
    department that the file is landed for.  Line-delimited features by
    default; FeatureCollection documents of any size and layout otherwise."""
    if line_delimited:
        records = spark.read.text(path).select("value", department_of(F.col("_metadata.file_path")).alias("file_departement"))
    else:
        records = json_records(spark, path, "features")[0].withColumn("file_departement", department_of(F.col("file")))
    return P.parse_features(records, properties, keep=["file_departement"])


def read_osm(spark: SparkSession, path: str, line_delimited: bool = True) -> DataFrame:
    """Overpass elements (line-delimited, or ``{"elements": [...]}``
    documents of any size).  Records that are no JSON object are left out;
    :func:`parse.json_rejects` lists them."""
    return P.parse_osm(spark.read.text(path) if line_delimited else json_records(spark, path, "elements")[0])


def read_atmo(spark: SparkSession, path: str, properties: StructType) -> DataFrame:
    """Atmo feature documents -> rows with a ``properties`` struct (NULL
    properties allowed)."""
    found, _ = json_records(spark, path, "features")
    return P.parse_properties(found.select("value", F.struct("file", "place").alias("ordinal")), properties)


def read_dpe(spark: SparkSession, path: str, record: StructType) -> DataFrame:
    """Paged API results, one page per file."""
    schema = StructType([S.StructField("results", S.ArrayType(record))])
    return (spark.read.schema(schema).option("multiLine", True).json(path)
            .select(F.explode("results").alias("r")).select("r.*"))


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Elevation cells ``(lat, lon, row, col, z)``: the south-west corner
    of the 1-degree tile and the cell's place from its north-west corner."""
    return spark.read.parquet(path)


def read_layers(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", deep: bool = True) -> DataFrame:
    """Several layers of differing schemas, stacked by column name
    (missing columns -> NULL).  A layer that is absent or cannot be read to its
    end is skipped with a warning; none readable is an error."""
    def load(path: str) -> DataFrame:
        return spark.read.format(fmt).load(path)

    found = probe(spark, paths, load, deep)
    if not readable(found):
        raise ValueError(f"none of the layers can be read: {[(s.path, s.reason) for s in found]}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(load, readable(found)))


def read_flood_layers(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Every flood-zone surface layer under ``root`` (name pattern
    ``*inondable_*_s_*``), searched recursively.  Columns are merged over the
    files (optional ones are NULL where absent); without a ``departement``
    column the nearest folder named like a department code gives it."""
    df = (spark.read.format(fmt).option("recursiveFileLookup", True).option("mergeSchema", True)
          .option("pathGlobFilter", "*inondable_*_s_*").load(root))
    if "departement" in df.columns:
        return df
    folder = F.regexp_extract(F.col("_metadata.file_path"), rf"/({_DEP})(?=/)(?!.*/{_DEP}/)", 1)
    return df.withColumn("departement", F.nullif(folder, F.lit("")))


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """A folder of Parquet files of differing optional columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Entity batch documents (one JSON document per line)."""
    return P.parse_entities(spark.read.text(path))
