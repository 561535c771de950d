"""Natural-hazard tables: storm history, wind zones, flood zones, clay
shrink-swell zones, coastal erosion and urban heat islands."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.crs import source_crs, to_wgs84
from ..functions.departments import in_departments_code, zfill_dep
from ..functions.text import parse_date

# --- fixed values -----------------------------------------------------------
STORM_LABELS = ["Tempête", "Vents Cycloniques"]
WIND_ZONES = {22: 1, 24: 2, 26: 3, 28: 4}
FLOOD_TYPES = {"01": "river_overflow", "02": "runoff", "03": "marine_submersion"}
FLOOD_SCENARIOS = {"01For": "high_probability", "02Moy": "medium_probability",
                   "03Mcc": "medium_probability_climate_change", "04Fai": "low_probability"}
CLAY_LEVELS = {1: "low", 2: "medium", 3: "high"}
# --- end of fixed values ----------------------------------------------------


def _lookup(mapping: dict, key: Column) -> Column:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return m[key]


# ------------------------------------------------------------------ storms
def storm_history(catnat: DataFrame, deps: Iterable[str]) -> DataFrame:
    """Storm declarations per commune: count, first and last start date.

    Input: cod_commune, lib_risque_jo, dat_deb (text).  Rows with a NULL
    commune are dropped; invalid dates count as declarations but not as
    dates.  Communes outside the departments (2- or 3-character codes) are
    dropped.
    """
    rows = (catnat.where(F.col("lib_risque_jo").isin(STORM_LABELS)
                         & F.col("cod_commune").isNotNull())
            .select(F.col("cod_commune").alias("code_commune"),
                    parse_date(F.col("dat_deb")).alias("d")))
    agg = rows.groupBy("code_commune").agg(
        F.count(F.lit(1)).alias("storm_count"),
        F.date_format(F.min("d"), "yyyy-MM-dd").alias("first_event"),
        F.date_format(F.max("d"), "yyyy-MM-dd").alias("last_event"))
    return agg.where(in_departments_code(F.col("code_commune"), list(deps)))


def storm_with_geometry(history: DataFrame, communes: DataFrame,
                        deps: Iterable[str]) -> DataFrame:
    """Inner join of the storm history with commune geometries of the
    requested departments; the department comes from the geometry table and
    the commune code must start with it."""
    deps = list(deps)
    geo = communes.where(F.col("departement").isin(deps)) \
        .select("code_commune", "departement", "geom")
    j = history.join(geo, "code_commune")
    return j.where(F.col("code_commune").startswith(F.col("departement"))) \
        .select("code_commune", "storm_count", "first_event", "last_event", "departement", "geom")


def wind_zones(df: DataFrame) -> DataFrame:
    """Eurocode wind speed -> zone 1..4 (other speeds -> NULL)."""
    v = F.col("V_B0").cast("string").try_cast("double")
    whole = F.when(v == F.floor(v), v.cast("int"))       # 22.5 is no zone
    return df.select(_lookup(WIND_ZONES, whole).alias("wind_zone"),
                     F.col("V_B0").alias("wind_speed_ms"), "geom")


# ------------------------------------------------------------------ floods
def flood_zones(layers: Sequence[DataFrame], dep: str | Column | None = None,
                src_epsg: int = 2154) -> DataFrame:
    """Union of flood-zone layers (by column name, missing -> NULL), labelled
    and reprojected; ``cours_deau`` is optional per layer."""
    out = None
    for layer in layers:
        out = layer if out is None else out.unionByName(layer, allowMissingColumns=True)
    if "cours_deau" not in out.columns:
        out = out.withColumn("cours_deau", F.lit(None).cast("string"))
    if "departement" not in out.columns:
        out = out.withColumn("departement", F.lit(dep) if isinstance(dep, str) else dep)
    return out.select(
        F.coalesce(_lookup(FLOOD_TYPES, F.col("typ_inond")), F.lit("unknown")).alias("flood_type"),
        F.coalesce(_lookup(FLOOD_SCENARIOS, F.col("scenario")), F.lit("unknown")).alias("scenario"),
        F.col("cours_deau").alias("watercourse"),
        F.col("id_tri").alias("tri_id"),
        "departement",
        to_wgs84(F.col("geom"), source_crs(out, src_epsg)).alias("geom"))


def clay_zones(df: DataFrame, deps: Iterable[str], src_epsg: int = 2154) -> DataFrame:
    """Clay shrink-swell exposure for the requested departments (codes are
    zero-padded to two characters; levels 1..3, anything else 'unknown')."""
    dep = zfill_dep(F.col("DPT"))
    num = F.col("NIVEAU").cast("string").try_cast("double")
    level = F.when(num == F.floor(num), num.cast("int"))
    return (df.where(dep.isin(list(deps)))
            .select(F.coalesce(_lookup(CLAY_LEVELS, level), F.lit("unknown")).alias("exposure_level"),
                    dep.alias("departement"),
                    to_wgs84(F.col("geom"), source_crs(df, src_epsg)).alias("geom")))


# ------------------------------------------------- pass-through geo layers
def coastal_erosion(df: DataFrame, src_epsg: Column | int | None = 2154) -> DataFrame:
    """All attribute columns as is; geometry reprojected when not WGS84."""
    if isinstance(src_epsg, Column):
        return df.withColumn("geom", to_wgs84(F.col("geom"), src_epsg))
    return df.withColumn("geom", to_wgs84(F.col("geom"), source_crs(df, src_epsg))).drop("src_epsg")


def icu_union(layers: Sequence[DataFrame]) -> DataFrame:
    """Urban heat-island layers of differing schemas, stacked by column name
    (missing -> NULL); each layer carries ``src_epsg`` for reprojection."""
    out = None
    for layer in layers:
        out = layer if out is None else out.unionByName(layer, allowMissingColumns=True)
    if "src_epsg" in out.columns:
        out = out.withColumn("geom", to_wgs84(F.col("geom"), F.col("src_epsg"))).drop("src_epsg")
    return out
