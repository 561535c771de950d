"""Registry of the queries the driver runs: name -> (spark, sf_dir) -> DataFrame.

Each entry binds driver tables to an operator input (``bindings``), runs the
library operator on the whole table and rounds floating outputs so results
compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import flatten_geom
from ..functions.crs import l93_to_lonlat
from ..operators import (buildings, climate, communes, hazards, lookups, osm, planning,
                         prices, raster)
from ..sinks import tables as sinks
from ..sources import parse as P
from ..sources import readers as R
from . import bindings as B
from .tables import round_doubles

Query = Callable[[SparkSession, str], DataFrame]


def q_section_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(prices.section_prices(B.dvf_input(spark, sf_dir)))


def q_commune_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(prices.commune_prices(B.dvf_input(spark, sf_dir)))


def q_crime_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(communes.crime_pivot(B.crime_input(spark, sf_dir), B.CRIME_YEAR,
                                              B.CRIME_DEPS))


def q_rents_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(communes.rents_long(B.rents_inputs(spark, sf_dir), B.RENT_DEPS))


def q_rents_replace_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = communes.rents_long(B.rents_inputs(spark, sf_dir, vintage=10))
    new = communes.rents_long(B.rents_inputs(spark, sf_dir), B.RENT_DEPS)
    return round_doubles(sinks.replace_present_query(old, new, "departement"))


def q_climate_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(flatten_geom(climate.climate_stations(
        B.meteo_input(spark, sf_dir), B.CLIMATE_START_YEAR)))


def q_storm_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hazards.storm_history(B.catnat_input(spark, sf_dir), B.STORM_DEPS)


def q_storm_with_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = hazards.storm_history(B.catnat_input(spark, sf_dir), B.STORM_DEPS)
    return flatten_geom(hazards.storm_with_geometry(hist, B.communes_input(spark, sf_dir),
                                                    B.STORM_DEPS))


def q_wind_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_geom(hazards.wind_zones(B.wind_input(spark, sf_dir)))


def q_flood_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(flatten_geom(hazards.flood_zones(B.flood_layers(spark, sf_dir))))


def q_clay_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(flatten_geom(hazards.clay_zones(B.clay_input(spark, sf_dir),
                                                         B.CLAY_DEPS)))


def q_l93_to_wgs84(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    p = B.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    x = F.lit(700000.0) + (k % 40) * 5000.0
    y = F.lit(6500000.0) + (F.floor(k / 40) % 40) * 5000.0
    lon, lat = l93_to_lonlat(x, y)
    return round_doubles(p.select(k.alias("id"), lon.alias("lon"), lat.alias("lat")))


def _section_prices(spark, sf_dir):
    return round_doubles(prices.section_prices(B.dvf_input(spark, sf_dir)))


def q_prices_with_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    secs = lookups.sections_table(B.sections_input(spark, sf_dir))
    return round_doubles(flatten_geom(lookups.prices_with_geometry(
        prices.section_prices(B.dvf_input(spark, sf_dir)), secs)))


def q_sections_of_commune(spark: SparkSession, sf_dir: str) -> DataFrame:
    secs = lookups.sections_table(B.sections_input(spark, sf_dir))
    return flatten_geom(lookups.sections_of_commune(secs, B.LOOKUP_COMMUNE))


def q_prices_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.rows_by_prefix(_section_prices(spark, sf_dir), "section_id", B.PRICE_PREFIX)


def q_price_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.row_count(prices.section_prices(B.dvf_input(spark, sf_dir)))


def q_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.sample_rows(_section_prices(spark, sf_dir), 10, ["section_id"])


def q_crime_with_commune(spark: SparkSession, sf_dir: str) -> DataFrame:
    pv = communes.crime_pivot(B.crime_input(spark, sf_dir), B.CRIME_YEAR, B.CRIME_DEPS)
    return round_doubles(flatten_geom(lookups.attach_commune(pv, B.communes_input(spark, sf_dir))))


def q_wkt_reproject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(flatten_geom(buildings.building_table(B.building_geo_input(spark, sf_dir))))


def q_dpe_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_geom(buildings.dpe_collectif(B.dpe_input(spark, sf_dir), B.DPE_DEPS))


def q_building_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, sats = B.building_star_input(spark, sf_dir)
    return round_doubles(lookups.building_profile(b, sats))


def q_building_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, sats = B.building_star_input(spark, sf_dir)

    def bucketed(df: DataFrame) -> DataFrame:
        return sinks.bucketed_copy(df, "building_star", buildings.KEY, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return round_doubles(lookups.building_profile(bucketed(b), {n: bucketed(s) for n, s in sats.items()}))


def q_icu_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(flatten_geom(hazards.icu_union(B.icu_layers(spark, sf_dir))))


def q_coastal_erosion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(flatten_geom(hazards.coastal_erosion(B.erosion_input(spark, sf_dir))))


def q_replace_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = B.k1_inputs(spark, sf_dir)
    return sinks.replace_departments_query(old, new, B.K1_REQUESTED)


def q_replace_year_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new, year = B.k6_inputs(spark, sf_dir)
    return sinks.replace_departments_query(old, new, B.K1_REQUESTED, within={"year": year})


def q_zone_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    p = B.table(spark, sf_dir, "part")
    tz = B._zone_type(F.col("p_size") % 14)
    return p.select("p_partkey", tz.alias("typezone"),
                    planning.zone_category(tz).alias("zone_category"))


def _plu_status(spark, sf_dir):
    return planning.document_status(B.plu_documents_input(spark, sf_dir),
                                    B.plu_communes_input(spark, sf_dir), B.PLU_DEPS)


def q_document_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plu_status(spark, sf_dir)


def q_document_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.document_type_counts(_plu_status(spark, sf_dir))


def q_covered_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = planning.union_layers(B.plu_zone_layers(spark, sf_dir))
    return round_doubles(flatten_geom(planning.covered_zones(zones, _plu_status(spark, sf_dir))))


def q_covered_prescriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    presc = planning.union_layers(B.plu_prescription_layers(spark, sf_dir))
    return round_doubles(flatten_geom(planning.covered_prescriptions(
        presc, _plu_status(spark, sf_dir))))


def q_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_geom(climate.air_quality(B.air_features_input(spark, sf_dir), B.AIR_DEPS))


def q_pollen_with_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    air = climate.air_quality(B.air_features_input(spark, sf_dir))
    return flatten_geom(climate.pollen_with_coords(B.pollen_features_input(spark, sf_dir), air))


def q_wikidata_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.wikidata_ids(osm.osm_layer(B.osm_input(spark, sf_dir), "wiki_pois"))


def q_poi_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    pois = osm.osm_layer(B.osm_input(spark, sf_dir), "wiki_pois")
    ent = lookups.entity_enrichment(B.entities_input(spark, sf_dir))
    return flatten_geom(osm.attach_wikidata(pois, ent))


def _exposure_classes(spark, sf_dir):
    cells = raster.mosaic(B.dem_cells_input(spark, sf_dir))
    return raster.classify_exposure(cells, B.dem_grid_input(spark, sf_dir))


def q_exposure_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exposure_classes(spark, sf_dir)


def q_exposure_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.exposure_regions(_exposure_classes(spark, sf_dir))


def q_exposure_region_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = raster.region_parts(_exposure_classes(spark, sf_dir), B.dem_grid_input(spark, sf_dir))
    return round_doubles(flatten_geom(parts))


def q_exposure_region_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(raster.region_shapes(_exposure_classes(spark, sf_dir), B.dem_grid_input(spark, sf_dir)))


def q_department_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    from ..operators.departments import assign_departments, point_array
    c = B.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    pts = c.select(k.alias("c_custkey"),
                   (F.lit(41.0) + (k * 37 % 1100) / 100.0).alias("lat"),
                   (F.lit(-5.0) + (k * 53 % 1400) / 100.0).alias("lon"))
    return assign_departments(pts, point_array(F.col("lat"), F.col("lon")))


def q_box_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.departments import assign_departments
    rows, boxes = B.box_assign_input(spark, sf_dir)
    return assign_departments(rows, F.col("places"), boxes=boxes).drop("places")


def _region_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.region_rings(_exposure_classes(spark, sf_dir), B.dem_grid_input(spark, sf_dir))


def q_exposure_region_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    per_ring = _region_rings(spark, sf_dir).groupBy("departement", "region_id", "exposure", "ring_id") \
        .agg(F.first("ring_area").alias("ring_area"))
    return per_ring.groupBy("departement", "region_id", "exposure").agg(
        F.count(F.lit(1)).alias("n_rings"), F.sum("ring_area").alias("n_cells"))


def q_exposure_ring_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every corner of every ring, as grid-independent coordinates."""
    return round_doubles(_region_rings(spark, sf_dir).select("departement", "region_id", "exposure", "lon", "lat"))


def q_exposure_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    polygons = raster.region_polygons(_region_rings(spark, sf_dir))
    return round_doubles(flatten_geom(polygons.withColumn("n_rings", F.size(F.col("geom.parts")[0]).cast("long"))))


def q_department_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, boxes = B.dem_tiles_input(spark, sf_dir)
    side = 1 / B.TILE_SIDE
    on = raster.department_cells(cells, boxes, raster.department_grid(boxes, side, -side))
    return raster.mosaic(on)


def q_tiles_for_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.tiles_for_bbox(B.boxes_input(spark, sf_dir))


def q_reproject_utm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    from ..functions.crs import to_wgs84
    rows = B.projected_points(spark, sf_dir)
    return round_doubles(flatten_geom(rows.withColumn("geom", to_wgs84(F.col("geom"), F.col("src_epsg")))))


def q_reproject_french(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.crs import FRENCH_CODES, to_wgs84
    rows = B.french_points(spark, sf_dir)
    return round_doubles(flatten_geom(rows.withColumn("geom", to_wgs84(F.col("geom"), F.col("src_epsg"), FRENCH_CODES))))


def q_parse_multigeom(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    from ..functions.wkt import parse_wkt
    from ..sources.schemas import GEOJSON_GEOMETRY
    rows = B.multi_geometry_texts(spark, sf_dir)
    json = P.geojson_geometry(F.from_json("geojson", GEOJSON_GEOMETRY))
    both = rows.select("p_partkey", F.lit("wkt").alias("form"), parse_wkt(F.col("wkt")).alias("geom")).unionByName(
        rows.select("p_partkey", F.lit("geojson").alias("form"), json.alias("geom")))
    return flatten_geom(both)


def q_parse_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.types import StringType, StructField, StructType
    props = StructType([StructField(n, StringType()) for n in ("id", "nom", "departement")])
    feats = P.parse_features(B.commune_feature_lines(spark, sf_dir), props)
    return flatten_geom(lookups.commune_geoms(feats))


def q_parse_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.types import StringType, StructField, StructType
    props = StructType([StructField(n, StringType()) for n in ("id", "nom", "departement")])
    feats = R.read_geojson(spark, B.commune_documents(spark, sf_dir), props, line_delimited=False)
    return flatten_geom(lookups.commune_geoms(feats))


def q_parse_quoted_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.read_building_table(spark, B.quoted_files(spark, sf_dir), ",")


def q_parse_osm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_geom(osm.osm_layer(P.parse_osm(B.osm_lines(spark, sf_dir)), "green_spaces"))


def q_parse_decimal_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    from ..functions.text import decimal_comma
    rows = P.parse_delimited(B.ledger_lines(spark, sf_dir),
                             "code string, name string, amount string, segment string")
    return rows.withColumn("amount", decimal_comma(F.col("amount")))


def q_parse_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.entity_enrichment(P.parse_entities(B.entity_batches(spark, sf_dir)))


def q_parse_dpe_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.types import StringType, StructField, StructType
    rec = StructType([StructField(n, StringType()) for n in (
        "numero_dpe", "type_batiment", "etiquette_dpe", "code_departement_ban", "_geopoint")])
    rows = P.explode_results(B.dpe_pages(spark, sf_dir), rec)
    return flatten_geom(buildings.dpe_collectif(rows, B.DPE_DEPS))


def q_parse_atmo(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = B.air_feature_lines(spark, sf_dir)
    schema = B.air_features_input(spark, sf_dir).schema["properties"].dataType
    feats = P.parse_properties(lines, schema)
    return flatten_geom(climate.air_quality(feats, B.AIR_DEPS))


def _osm(layer: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flatten_geom(osm.osm_layer(B.osm_input(spark, sf_dir), layer))
    q.__name__ = f"q_osm_{layer}"
    return q


OSM_QUERIES = {
    "osm_shops": "shops", "osm_nightclubs": "nightclubs", "osm_transport": "transport",
    "osm_stations": "railway_stations", "osm_roads": "roads", "osm_railways": "railways",
    "osm_industry": "industry", "osm_airports": "airports", "osm_parking": "parking",
    "osm_water": "water", "osm_green_spaces": "green_spaces", "osm_wiki_pois": "wiki_pois",
}


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "section_prices": q_section_prices,
        "commune_prices": q_commune_prices,
    }
    out.update({name: _osm(layer) for name, layer in OSM_QUERIES.items()})
    out.update({
        "crime_pivot": q_crime_pivot,
        "rents_long": q_rents_long,
        "rents_replace_present": q_rents_replace_present,
        "climate_stations": q_climate_stations,
        "storm_history": q_storm_history,
        "storm_with_geometry": q_storm_with_geometry,
        "wind_zones": q_wind_zones,
        "flood_zones": q_flood_zones,
        "clay_zones": q_clay_zones,
        "l93_to_wgs84": q_l93_to_wgs84,
        "prices_with_geometry": q_prices_with_geometry,
        "sections_of_commune": q_sections_of_commune,
        "prices_by_prefix": q_prices_by_prefix,
        "price_row_count": q_price_row_count,
        "sample_rows": q_sample_rows,
        "crime_with_commune": q_crime_with_commune,
        "wkt_reproject": q_wkt_reproject,
        "dpe_points": q_dpe_points,
        "building_profile": q_building_profile,
        "building_star": q_building_star,
        "icu_union": q_icu_union,
        "coastal_erosion": q_coastal_erosion,
        "replace_departments": q_replace_departments,
        "zone_category": q_zone_category,
        "document_status": q_document_status,
        "document_type_counts": q_document_type_counts,
        "covered_zones": q_covered_zones,
        "covered_prescriptions": q_covered_prescriptions,
        "air_quality": q_air_quality,
        "pollen_with_coords": q_pollen_with_coords,
        "poi_enriched": q_poi_enriched,
        "wikidata_ids": q_wikidata_ids,
        "exposure_classes": q_exposure_classes,
        "exposure_regions": q_exposure_regions,
        "exposure_region_parts": q_exposure_region_parts,
        "exposure_region_shapes": q_exposure_region_shapes,
        "exposure_region_rings": q_exposure_region_rings,
        "reproject_utm": q_reproject_utm,
        "reproject_french": q_reproject_french,
        "parse_multigeom": q_parse_multigeom,
        "exposure_ring_corners": q_exposure_ring_corners,
        "exposure_polygons": q_exposure_polygons,
        "department_cells": q_department_cells,
        "replace_year_departments": q_replace_year_departments,
        "tiles_for_bbox": q_tiles_for_bbox,
        "department_assign": q_department_assign,
        "box_assign": q_box_assign,
        "parse_geojson": q_parse_geojson,
        "parse_collections": q_parse_collections,
        "parse_quoted_csv": q_parse_quoted_csv,
        "parse_osm": q_parse_osm,
        "parse_decimal_csv": q_parse_decimal_csv,
        "parse_entities": q_parse_entities,
        "parse_dpe_pages": q_parse_dpe_pages,
        "parse_atmo": q_parse_atmo,
    })
    return out
