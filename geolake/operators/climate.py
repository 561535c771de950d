"""Climate station statistics, air-quality indices and pollen indices."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.departments import in_departments_any
from ..functions.geometry import point, st_x, st_y
from ..functions.text import nan_to_null, round_half_even

STATION_KEYS = ["NUM_POSTE", "NOM_USUEL", "LAT", "LON", "ALTI"]


def climate_stations(df: DataFrame, start_year: int = 2014) -> DataFrame:
    """Per station (and department file): mean max/min temperature, record
    maximum and days above 25/30/35 degrees per year, rounded half-to-even.

    Months from ``start_year`` on (no upper bound).  Stations with a NULL
    key, a NULL or zero coordinate are dropped; the sum of an all-NULL day
    count is 0.  Input: monthly rows with NUM_POSTE, NOM_USUEL, LAT, LON,
    ALTI, AAAAMM, TX, TN, TXAB, NBJTX25/30/35 and ``departement``.
    """
    num = ["TX", "TN", "TXAB", "NBJTX25", "NBJTX30", "NBJTX35"]
    rows = df.select("departement", *STATION_KEYS, "AAAAMM",
                     *[nan_to_null(F.col(c).cast("double")).alias(c) for c in num])
    rows = rows.where(F.floor(F.col("AAAAMM") / 100) >= start_year)
    for k in STATION_KEYS:
        rows = rows.where(F.col(k).isNotNull())
    agg = rows.groupBy("departement", *STATION_KEYS).agg(
        F.avg("TX").alias("avg_temp_max"),
        F.avg("TN").alias("avg_temp_min"),
        F.max("TXAB").alias("max_temp_recorded"),
        F.coalesce(F.sum("NBJTX30"), F.lit(0.0)).alias("t30"),
        F.coalesce(F.sum("NBJTX35"), F.lit(0.0)).alias("t35"),
        F.coalesce(F.sum("NBJTX25"), F.lit(0.0)).alias("t25"),
        F.count("AAAAMM").alias("months"))
    years = F.col("months") / 12
    agg = agg.where((F.col("LAT") != 0) & (F.col("LON") != 0))
    return agg.select(
        F.col("NUM_POSTE").alias("station_id"),
        F.col("NOM_USUEL").alias("station_name"),
        F.col("ALTI").alias("altitude"),
        "departement", "avg_temp_max", "avg_temp_min", "max_temp_recorded",
        round_half_even(F.col("t25") / years, 1).alias("avg_days_above_25"),
        round_half_even(F.col("t30") / years, 1).alias("avg_days_above_30"),
        round_half_even(F.col("t35") / years, 1).alias("avg_days_above_35"),
        point(F.col("LON"), F.col("LAT")).alias("geom"))


def air_quality(features: DataFrame, deps: Iterable[str] | None = None) -> DataFrame:
    """Daily air-quality index per commune from feature properties (WGS84
    coordinates taken from the properties); optional department filter."""
    p = "properties."
    out = features.where(F.col(p + "x_wgs84").isNotNull() & F.col(p + "y_wgs84").isNotNull()) \
        .select(F.col(p + "code_zone").alias("commune_code"),
                F.col(p + "lib_zone").alias("commune_name"),
                F.col(p + "code_qual").alias("quality_index"),
                F.col(p + "lib_qual").alias("quality_label"),
                F.col(p + "code_no2").alias("no2_index"),
                F.col(p + "code_o3").alias("o3_index"),
                F.col(p + "code_pm10").alias("pm10_index"),
                F.col(p + "code_pm25").alias("pm25_index"),
                F.col(p + "code_so2").alias("so2_index"),
                F.col(p + "source").alias("source"),
                F.col(p + "date_ech").alias("date"),
                point(F.col(p + "x_wgs84"), F.col(p + "y_wgs84")).alias("geom"),
                *([F.col("ordinal")] if "ordinal" in features.columns else []))
    return out.where(in_departments_any(F.col("commune_code"), deps))


POLLEN_FIELDS = [
    ("commune_name", "lib_zone"), ("quality_index", "code_qual"), ("quality_label", "lib_qual"),
    ("alert", "alerte"), ("responsible_pollen", "pollen_resp"),
    ("birch_index", "code_boul"), ("grass_index", "code_gram"), ("olive_index", "code_oliv"),
    ("ragweed_index", "code_ambr"), ("mugwort_index", "code_arm"), ("alder_index", "code_aul"),
    ("birch_conc", "conc_boul"), ("grass_conc", "conc_gram"), ("olive_conc", "conc_oliv"),
    ("ragweed_conc", "conc_ambr"), ("date", "date_ech"), ("source", "source"),
]


def commune_coords(air: DataFrame) -> DataFrame:
    """Commune code -> (lat, lon) from the air-quality table; for duplicate
    codes the last row (highest ``ordinal``) wins, NULL codes are dropped."""
    return (air.where(F.col("commune_code").isNotNull())
            .groupBy("commune_code")
            .agg(F.max_by(F.struct(st_y(F.col("geom")).alias("lat"),
                                   st_x(F.col("geom")).alias("lon")),
                          F.col("ordinal")).alias("c"))
            .select("commune_code", "c.lat", "c.lon"))


def pollen_with_coords(pollen: DataFrame, air: DataFrame) -> DataFrame:
    """Pollen indices placed at the commune coordinates of the air-quality
    table (inner lookup join: codes absent there are dropped)."""
    coords = commune_coords(air)
    props = F.coalesce(F.col("properties"), F.lit(None).cast(pollen.schema["properties"].dataType))
    rows = pollen.select(props.alias("pr")).where(
        F.col("pr.code_zone").isNotNull() & (F.col("pr.code_zone") != ""))
    rows = rows.select(F.col("pr.code_zone").alias("commune_code"),
                       *[F.col(f"pr.{src}").alias(dst) for dst, src in POLLEN_FIELDS])
    joined = rows.join(coords, "commune_code")
    return joined.select("commune_code", *[d for d, _ in POLLEN_FIELDS],
                         point(F.col("lon"), F.col("lat")).alias("geom"))
