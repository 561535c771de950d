"""Dataset jobs: one per output table, composed from sources, operators and
table refresh contracts.  All departments are processed by one Spark job
(no driver loop over departments); the department list only selects
partitions to refresh.

Each job takes the landed-files root (layout below, one folder per source)
and writes its table(s).  Layout, relative to ``root``::

    dvf/<year>/<dep>.csv.gz            crime/*.csv.gz       rents/<year>/<type>.csv
    meteo/<dep>.csv.gz                 catnat/*.csv         buildings/<table>/*.csv
    geojson/<layer>/{,<dep>/}*.{geojsonl,json}[.gz]   osm/*.jsonl   atmo/<feed>/*.json
    dpe/*.json                         dem/cells.parquet    flood/**  icu/*  erosion/*  clay/*.parquet
    plu/{documents,communes,zones,prescriptions}/*.parquet  wikidata/*.jsonl
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions.departments import ALL_DEPARTMENTS, bbox_table
from ..functions.geometry import st_x, st_y
from ..operators import (buildings, climate, communes, hazards, lookups, osm, planning,
                         prices, raster)
from ..session import release, scratch_path
from ..sinks import tables as K
from ..sources import readers as R
from ..sources.manifest import readable


def _p(root: str, *parts: str) -> str:
    return os.path.join(root, *parts)


def _props(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _deps(deps: Iterable[str] | None) -> list[str]:
    return list(deps) if deps else list(ALL_DEPARTMENTS)


def _read_departments(spark: SparkSession, folder: str, deps: Iterable[str] | None) -> tuple[list[str], list[str]]:
    """The requested departments whose landed file can be read, and the files.
    Those are the ones that a refresh replaces: a department without a readable
    file keeps its rows."""
    found = R.probe_department_files(spark, folder, _deps(deps), ".csv.gz")
    return [d for d, s in found.items() if s.status == "readable"], readable(found.values())


def _features(spark: SparkSession, root: str, layer: str, *names: str) -> DataFrame:
    """The features of a layer, landed as lines (``.geojsonl``) or as
    FeatureCollection documents (``.json``, ``.geojson``), any of them gzipped."""
    kinds = ((f"*.geojsonl{gz}", True) for gz in ("", ".gz")), ((f"*.{e}{gz}", False) for e in ("json", "geojson") for gz in ("", ".gz"))
    out = None
    for pattern, lines in (x for kind in kinds for x in kind):
        for path in (_p(root, "geojson", layer, pattern), _p(root, "geojson", layer, "*", pattern)):
            if R.path_exists(spark, path):
                rows = R.read_geojson(spark, path, _props(*names), line_delimited=lines)
                out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise FileNotFoundError(f"no features under {_p(root, 'geojson', layer)}")
    return out


def _known_departments(rows: DataFrame, what: str) -> DataFrame:
    """``rows``, none of which may lack its department: such a load would
    replace departments by nothing."""
    lost = rows.where(F.col("departement").isNull()).limit(1)
    if not lost.isEmpty():
        raise ValueError(f"{what}: features of no known department; land them in a file or folder named by its code")
    return rows


# ------------------------------------------------------------------ prices
def job_dvf(spark: SparkSession, root: str, year: int, deps=None) -> None:
    """D14 + D15: section and commune price statistics for one year."""
    deps, files = _read_departments(spark, _p(root, "dvf", str(year)), deps)
    if not deps:
        return
    dvf = R.read_dvf(spark, files)
    lines = prices.staged_sales(dvf)
    K.ensure_namespace(spark, "dvf_prices")
    K.replace_departments(prices.section_prices(dvf, lines).withColumn("year", F.lit(year)),
                          "dvf_prices.sections_stats", deps, within={"year": year})
    K.replace_departments(prices.commune_prices(dvf, lines).withColumn("year", F.lit(year)),
                          "dvf_prices.communes_stats", deps, within={"year": year})
    release(lines)


def job_dvf_sections(spark: SparkSession, root: str, deps=None) -> None:
    """Cadastral section geometries; a section's department is the one
    its file is landed for."""
    feats = _features(spark, root, "sections", "id", "commune", "prefixe", "code", "departement")
    K.ensure_namespace(spark, "dvf_prices")
    deps = _deps(deps)
    rows = lookups.sections_table(_known_departments(lookups.of_department(feats), "sections"))
    K.replace_departments(rows.where(F.col("departement").isin(deps)), "dvf_prices.sections", deps, keep_if_empty=True)


def job_commune_geoms(spark: SparkSession, root: str, deps=None) -> None:
    """Commune geometries; a commune's department is the one its file is
    landed for."""
    feats = _features(spark, root, "communes", "id", "nom", "departement")
    K.ensure_namespace(spark, "geom_utils")
    deps = _deps(deps)
    rows = lookups.commune_geoms(_known_departments(lookups.of_department(feats), "communes"))
    K.replace_departments(rows.where(F.col("departement").isin(deps)), "geom_utils.communes", deps, keep_if_empty=True)


# -------------------------------------------------------------- indicators
def job_crime(spark: SparkSession, root: str, year: int, deps=None) -> None:
    """Crime indicators pivoted per commune."""
    deps = _deps(deps)
    df = R.read_crime(spark, _p(root, "crime"))
    K.ensure_namespace(spark, "crime_stats")
    K.replace_departments(communes.crime_pivot(df, year, deps).withColumn("year", F.lit(year)),
                          "crime_stats.indicators", deps, within={"year": year})


RENT_YEARS = (2022, 2023, 2024, 2025)
RENT_TYPES = ("apartment_all", "apartment_t1_t2", "apartment_t3_plus", "house")


def job_rents(spark: SparkSession, root: str, year: int, deps=None) -> None:
    """Rent indicators (four property types) for a mapped year."""
    if year not in RENT_YEARS:
        raise ValueError(f"rents have no landed files for year {year}; years with files: {list(RENT_YEARS)}")
    frames = {t: R.read_rents(spark, _p(root, "rents", str(year), f"{t}.csv")) for t in RENT_TYPES}
    K.ensure_namespace(spark, "rents")
    K.replace_present(communes.rents_long(frames, deps).withColumn("year", F.lit(year)),
                      "rents.indicators", within={"year": year})


def _replace(rows: DataFrame, table: str, deps: list[str], mode: str, partition_by: str | None = "departement") -> None:
    """K3, or with ``mode="by_department"`` only the departments given."""
    if mode == "by_department":
        K.replace_departments(rows, table, deps)
    elif mode == "table":
        K.replace_table(rows, table, partition_by)
    else:
        raise ValueError(f"mode is table or by_department, not {mode}")


def job_climate(spark: SparkSession, root: str, deps=None, start_year: int = 2014, mode: str = "table") -> None:
    """Climate station statistics of the departments whose file can be
    read; without any, the table stays as it is."""
    deps, files = _read_departments(spark, _p(root, "meteo"), deps)
    if not deps:
        return
    K.ensure_namespace(spark, "climate")
    _replace(climate.climate_stations(R.read_mens(spark, files), start_year), "climate.stations", deps, mode)


# ------------------------------------------------------------------ hazards
def job_storm(spark: SparkSession, root: str, deps=None) -> None:
    """D23 + D24: wind zones (truncate + load) and storm history per commune."""
    deps = _deps(deps)
    wind = _features(spark, root, "wind", "V_B0").drop("file_departement")
    K.ensure_namespace(spark, "storm_risk")
    K.truncate_load(hazards.wind_zones(wind), "storm_risk.wind_zones")
    hist = hazards.storm_history(R.read_catnat(spark, _p(root, "catnat")), deps)
    com = K.read_table(spark, "geom_utils.communes")
    K.replace_departments(hazards.storm_with_geometry(hist, com, deps),
                          "storm_risk.catnat_storm", deps)


def job_flood(spark: SparkSession, root: str, deps=None) -> None:
    """Flood-risk zones of every surface layer found under flood/."""
    deps = _deps(deps)
    layers = R.read_flood_layers(spark, _p(root, "flood")).where(F.col("departement").isin(deps))
    K.ensure_namespace(spark, "flood_risk")
    K.replace_departments(hazards.flood_zones([layers]), "flood_risk.tri_zones", deps)


def job_clay(spark: SparkSession, root: str, deps=None) -> None:
    """Clay shrink-swell zones."""
    deps = _deps(deps)
    df = spark.read.parquet(_p(root, "clay"))
    K.ensure_namespace(spark, "clay_risk")
    K.replace_departments(hazards.clay_zones(df, deps), "clay_risk.rga_zones", deps)


def job_coastal(spark: SparkSession, root: str) -> None:
    """Coastal erosion (pass-through, reprojected)."""
    K.ensure_namespace(spark, "coastal")
    K.replace_table(hazards.coastal_erosion(spark.read.parquet(_p(root, "erosion"))),
                    "coastal.erosion", partition_by=None)


def job_icu(spark: SparkSession, root: str, paths: list[str]) -> None:
    """Urban heat islands from layers of differing schemas."""
    K.ensure_namespace(spark, "climate")
    K.replace_table(hazards.icu_union([R.read_layers(spark, paths)]), "climate.icu",
                    partition_by=None)


# -------------------------------------------------------------------- atmo
AIR_PROPS = _props("code_zone", "lib_zone", "code_qual", "lib_qual", "code_no2", "code_o3",
                   "code_pm10", "code_pm25", "code_so2", "source", "date_ech")


def job_air_quality(spark: SparkSession, root: str, deps=None) -> None:
    """Air-quality index per commune."""
    props = StructType(AIR_PROPS.fields + [StructField("x_wgs84", DoubleType()),
                                           StructField("y_wgs84", DoubleType())])
    feats = R.read_atmo(spark, _p(root, "atmo", "air"), props)
    K.ensure_namespace(spark, "climate")
    K.replace_table(climate.air_quality(feats, deps).drop("ordinal"), "climate.air_quality", partition_by=None)


def job_pollens(spark: SparkSession, root: str) -> None:
    """Pollen indices placed at air-quality commune coordinates."""
    props = _props("code_zone", *[s for _, s in climate.POLLEN_FIELDS])
    feats = R.read_atmo(spark, _p(root, "atmo", "pollen"), props)
    # The loaded table has no file order: of a commune's rows the latest date
    # is used, ties by coordinates.
    air = K.read_table(spark, "climate.air_quality")
    air = air.withColumn("ordinal", F.struct("date", st_x(F.col("geom")).alias("x"), st_y(F.col("geom")).alias("y")))
    K.replace_table(climate.pollen_with_coords(feats, air), "climate.pollens", partition_by=None)


# ------------------------------------------------------------- buildings
def job_dpe(spark: SparkSession, root: str, deps=None) -> None:
    """Multi-dwelling energy diagnostics."""
    deps = _deps(deps)
    rec = _props(*buildings.DPE_FIELDS, "_geopoint")
    K.ensure_namespace(spark, "energy")
    K.replace_departments(buildings.dpe_collectif(R.read_dpe(spark, _p(root, "dpe"), rec), deps),
                          "energy.dpe_collectif", deps)


def job_bdnb(spark: SparkSession, root: str, deps=None, reset: bool = False,
             src_epsg: int = 2154, buckets: int = buildings.BUCKETS) -> None:
    """The eight building tables, refreshed by department code, all
    bucketed alike on the building id so that they join without a shuffle."""
    deps = _deps(deps)
    K.ensure_namespace(spark, "bati")
    if reset:
        K.drop_tables(spark, [f"bati.{t}" for t in buildings.BUILDING_TABLES])
    for t in buildings.BUILDING_TABLES:
        path = _p(root, "buildings", t)
        if not R.path_exists(spark, path):
            continue        # a register may be landed without some satellites
        df = buildings.building_table(R.read_building_table(spark, path), src_epsg)
        K.replace_departments(df, f"bati.{t}", deps, key="code_departement_insee",
                              bucket=(buildings.KEY, buckets) if buildings.KEY in df.columns else None)


# ---------------------------------------------------------------- planning
def job_plu(spark: SparkSession, root: str, deps=None) -> None:
    """D31 + D32: planning zones and prescriptions of covered communes."""
    deps = _deps(deps)
    docs = R.read_folder(spark, _p(root, "plu", "documents"))
    coms = R.read_folder(spark, _p(root, "plu", "communes"))
    status = planning.document_status(docs, coms, deps)
    zones = R.read_folder(spark, _p(root, "plu", "zones"))
    presc = R.read_folder(spark, _p(root, "plu", "prescriptions"))
    K.ensure_namespace(spark, "plu")
    K.replace_departments(planning.covered_zones(zones, status), "plu.zones", deps)
    K.replace_departments(planning.covered_prescriptions(presc, status), "plu.prescriptions", deps)


# ------------------------------------------------------------------ raster
DEM_PIXEL = 1 / 1200   # degrees


def job_exposure(spark: SparkSession, root: str, deps=None, pixel: float = DEM_PIXEL) -> None:
    """Exposure polygons from the landed elevation tiles: every tile's
    cells go to the grids of the departments it touches, clipped to their
    boxes, and each department is classified on its own grid."""
    deps = _deps(deps)
    boxes = bbox_table(spark, deps)
    grid = raster.department_grid(boxes, pixel, -pixel)
    cells = raster.department_cells(R.read_cells(spark, _p(root, "dem", "cells.parquet")), boxes, grid)
    classes = raster.classify_exposure(raster.mosaic(cells), grid)
    polygons = raster.region_polygons(raster.region_rings(classes, grid))
    K.ensure_namespace(spark, "mnt")
    # Departments without polygons keep those they have.
    K.replace_present(polygons.drop("region_id"), "mnt.exposure")


def dem_tiles(spark: SparkSession, deps=None) -> DataFrame:
    """The elevation tiles to land for the departments."""
    return raster.tiles_for_bbox(bbox_table(spark, _deps(deps)))


# --------------------------------------------------------------------- OSM
OSM_TABLES = {
    "shops": ("shops", "K3"), "nightclubs": ("nightclubs", "K1"),
    "railways": ("railways", "K1"), "railway_stations": ("railway_stations", "K1"),
    "airports": ("airports", "K1"), "industry": ("industry", "K1"),
    "green_spaces": ("green_spaces", "K1"), "transport": ("transport", "K3"),
    "roads": ("roads", "K1"), "parking": ("parking", "K1"), "water": ("water", "K1"),
}
#: Layers whose tables stay as they are when a load has no row at all.
KEPT_IF_EMPTY = ("railways", "railway_stations")


def _publish_osm(el: DataFrame, layer: str, deps: list[str], mode: str, dedupe_osm: bool) -> None:
    table, kind = OSM_TABLES[layer]
    out = osm.osm_layer(el, layer, deps, dedupe=dedupe_osm)
    if kind == "K3":
        _replace(out, f"osm.{table}", deps, mode)
    else:
        K.replace_departments(out, f"osm.{table}", deps, keep_if_empty=layer in KEPT_IF_EMPTY)


def job_osm(spark: SparkSession, root: str, layer: str, deps=None, mode: str = "table", dedupe_osm: bool = False) -> None:
    """One OSM layer from the landed extract.  ``mode`` (T2) and
    ``dedupe_osm`` (T14: an element of several departments once) are options."""
    el = R.read_osm(spark, _p(root, "osm", "*.jsonl"))
    K.ensure_namespace(spark, "osm")
    _publish_osm(el, layer, _deps(deps), mode, dedupe_osm)


def stage_osm(spark: SparkSession, root: str) -> DataFrame:
    """Parse the landed extract once into Parquet in the shared staging area.

    JSON parsing is the expensive part of every OSM layer; the layers then
    read the columnar copy (pruned to the columns each one needs)."""
    path = scratch_path(spark, "osm_elements")
    R.read_osm(spark, _p(root, "osm", "*.jsonl")).write.partitionBy("type").parquet(path)
    out = spark.read.parquet(path)
    out._staged_at = path
    return out


def job_osm_all(spark: SparkSession, root: str, deps=None, mode: str = "table", dedupe_osm: bool = False) -> None:
    """D1-D7, D9-D12 in one run over a single parse of the extract."""
    el = stage_osm(spark, root)
    K.ensure_namespace(spark, "osm")
    for layer in OSM_TABLES:
        _publish_osm(el, layer, _deps(deps), mode, dedupe_osm)
    release(el)


def job_wiki_pois(spark: SparkSession, root: str, deps=None, mode: str = "table") -> None:
    """Wikidata-tagged POIs enriched with description and image."""
    el = R.read_osm(spark, _p(root, "osm", "*.jsonl"))
    ent = lookups.entity_enrichment(R.read_entities(spark, _p(root, "wikidata")))
    K.ensure_namespace(spark, "osm")
    _replace(osm.attach_wikidata(osm.osm_layer(el, "wiki_pois", _deps(deps)), ent), "osm.poi_wiki", _deps(deps), mode)


JOBS: dict[str, Callable] = {
    "dvf": job_dvf, "dvf-sections": job_dvf_sections, "commune-geoms": job_commune_geoms,
    "delinquance": job_crime, "rents": job_rents, "climate": job_climate,
    "storm-risk": job_storm, "flood-tri": job_flood, "clay-risk": job_clay,
    "coastal-erosion": job_coastal, "icu": job_icu, "air-quality": job_air_quality,
    "pollens": job_pollens, "dpe-collectif": job_dpe, "bdnb": job_bdnb, "plu": job_plu,
    "exposition": job_exposure, "wiki-pois": job_wiki_pois, "osm-all": job_osm_all,
    **{name.replace("_", "-"): (lambda layer: (lambda spark, root, deps=None, **options:
                                                job_osm(spark, root, layer, deps, **options)))(name)
       for name in OSM_TABLES},
}
