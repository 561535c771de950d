"""Explicit schemas of the landed sources (never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType,
                               MapType, StringType, StructField, StructType)

LATLON = StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())])

OSM_MEMBER = StructType([
    StructField("type", StringType()), StructField("ref", LongType()),
    StructField("role", StringType()), StructField("geometry", ArrayType(LATLON)),
])

OSM_ELEMENT = StructType([
    StructField("type", StringType()), StructField("id", LongType()),
    StructField("lat", DoubleType()), StructField("lon", DoubleType()),
    StructField("center", LATLON),
    StructField("tags", MapType(StringType(), StringType())),
    StructField("geometry", ArrayType(LATLON)),
    StructField("members", ArrayType(OSM_MEMBER)),
])

# GeoJSON geometry with the coordinates kept as raw JSON text; decoded by
# type afterwards (their nesting depth depends on the type).
GEOJSON_GEOMETRY = StructType([
    StructField("type", StringType()), StructField("coordinates", StringType()),
])

DVF_COLUMNS = ["id_mutation", "nature_mutation", "valeur_fonciere", "type_local",
               "surface_reelle_bati", "id_parcelle"]

MENS = StructType([
    StructField("NUM_POSTE", LongType()), StructField("NOM_USUEL", StringType()),
    StructField("LAT", DoubleType()), StructField("LON", DoubleType()),
    StructField("ALTI", DoubleType()), StructField("AAAAMM", IntegerType()),
    StructField("TX", DoubleType()), StructField("TN", DoubleType()),
    StructField("TXAB", DoubleType()), StructField("NBJTX25", DoubleType()),
    StructField("NBJTX30", DoubleType()), StructField("NBJTX35", DoubleType()),
])

ENTITY = StructType([
    StructField("missing", StringType()),
    StructField("descriptions", MapType(StringType(), StructType([StructField("value", StringType())]))),
    StructField("claims", StructType([StructField("P18", ArrayType(StructType([
        StructField("mainsnak", StructType([StructField("datavalue", StructType([
            StructField("value", StringType())]))]))])))])),
])

ENTITIES_DOC = StructType([StructField("entities", MapType(StringType(), ENTITY))])

BOOL = BooleanType()
