"""Every dataset job, end to end: landed files to catalog tables."""

import gzip
import json
import os
import shutil

import pytest

from geolake.functions.geometry import GEOM_TYPE
from geolake.plans import jobs as J

DEPS = ["13", "75"]
L93 = (652469.0, 6862035.0)      # Paris in Lambert-93


def pt(x, y):
    return ("Point", [[[(x, y)]]])


def line(*pts):
    return ("LineString", [[list(pts)]])


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landed"))

    def text(path, content, gz=False, encoding="utf-8"):
        path = os.path.join(root, path)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with (gzip.open(path, "wt") if gz else open(path, "w", encoding=encoding)) as f:
            f.write(content)

    def parquet(path, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(os.path.join(root, path))

    def layer(path, rows, schema):
        """One file of a given name, as such layers are landed."""
        parquet("tmp/" + path, rows, schema)
        made = next(f for f in os.listdir(os.path.join(root, "tmp", path)) if f.endswith(".parquet"))
        os.makedirs(os.path.dirname(os.path.join(root, path)), exist_ok=True)
        shutil.copy(os.path.join(root, "tmp", path, made), os.path.join(root, path))

    for year, factor in ((2022, 1), (2023, 2)):
        for dep, base in (("75", 10000), ("13", 5000)):
            text(f"dvf/{year}/{dep}.csv.gz", "id_mutation,nature_mutation,valeur_fonciere,type_local,surface_reelle_bati,id_parcelle\n"
                 + "".join(f"m{i},Vente,{base * i * factor},Appartement,10,{dep}101000AB000{i}\n" for i in range(1, 6)), gz=True)
        for kind in J.RENT_TYPES:
            text(f"rents/{year}/{kind}.csv", "INSEE_C;DEP;LIBGEO;loypredm2;lwr.IPm2;upr.IPm2;TYPPRED;nbobs_com;R2_adj\n"
                 f"75101;75;Paris;{10 * factor},5;8,1;13,2;commune;12;0,61\n", encoding="latin-1")
    square = [[[2.3, 48.8], [2.4, 48.8], [2.4, 48.9], [2.3, 48.8]]]

    def features(*rows):
        return "\n".join(json.dumps({"type": "Feature", "properties": p, "geometry": g}) for p, g in rows) + "\n"
    poly = {"type": "Polygon", "coordinates": square}
    text("geojson/sections/a.geojsonl", features(
        ({"id": "75101000AB", "commune": "75101", "prefixe": "000", "code": "AB", "departement": "75"}, poly),
        ({"id": "69101000AB", "commune": "69101", "prefixe": "000", "code": "AB", "departement": "69"}, poly)))
    text("geojson/communes/a.geojsonl", features(
        ({"id": "75101", "nom": "Paris", "departement": "75"}, poly), ({"id": "13001", "nom": "Aix", "departement": "13"}, poly),
        ({"id": "69001", "nom": "Lyon", "departement": "69"}, poly)))
    text("geojson/wind/a.geojsonl", features(({"V_B0": "24"}, poly), ({"V_B0": "25"}, {"type": "MultiLineString", "coordinates": square})))
    for year, n in ((2023, 1), (2024, 2)):
        text(f"crime/{year}.csv", "CODGEO_2025;annee;indicateur;unite_de_compte;taux_pour_mille;nombre\n"
             f"75101;{year};Vols;infraction;{n},5;4\n")
    for dep in DEPS:
        text(f"meteo/{dep}.csv.gz", "NUM_POSTE;NOM_USUEL;LAT;LON;ALTI;AAAAMM;TX;TN;TXAB;NBJTX25;NBJTX30;NBJTX35\n"
             + "".join(f"{dep}001;S{dep};43.4;5.2;9;2024{m:02d};14.2;4.1;19.0;1;0;0\n" for m in range(1, 13)), gz=True)
    text("catnat/a.csv", "cod_commune;lib_risque_jo;dat_deb;dat_fin\n75101;Tempête;1999-12-26;1999-12-28\n13001;Séisme;2000-01-01;2000-01-02\n")
    parquet("clay", [("75", 2, pt(*L93)), ("69", 2, pt(*L93)), ("13", 9, pt(*L93))], f"DPT string, NIVEAU int, geom {GEOM_TYPE}")
    layer("flood/75/n_inondable_01_s_a.parquet", [("01", "01For", "T1", "Seine", pt(*L93))],
            f"typ_inond string, scenario string, id_tri string, cours_deau string, geom {GEOM_TYPE}")
    layer("flood/13/n_inondable_02_s_b.parquet", [("xx", "04Fai", "T2", pt(2.35, 48.85), 4326)],
            f"typ_inond string, scenario string, id_tri string, geom {GEOM_TYPE}, src_epsg int")
    parquet("erosion", [("a", 1, line(L93, (L93[0] + 1000, L93[1])))], f"name string, n int, geom {GEOM_TYPE}")
    parquet("icu/a", [("x", pt(*L93), 2154)], f"nom string, geom {GEOM_TYPE}, src_epsg int")
    parquet("icu/b", [(5, pt(2.0, 48.0), 4326)], f"score int, geom {GEOM_TYPE}, src_epsg int")
    for dep in DEPS:
        text(f"atmo/air/{dep}.json", json.dumps({"features": [
            {"properties": {"code_zone": f"{dep}001", "lib_zone": "Z", "code_qual": "3", "date_ech": d, "x_wgs84": x, "y_wgs84": 48.0}}
            for d, x in (("2024-01-15", 2.0), ("2024-01-16", 3.0))] + [{"properties": None}]}, indent=1))
    text("atmo/pollen/a.json", json.dumps({"features": [{"properties": {"code_zone": "75001", "code_qual": "2"}},
                                                        {"properties": {"code_zone": "99999"}}, {"properties": None}]}))
    text("dpe/1.json", json.dumps({"results": [
        {"numero_dpe": "D1", "type_batiment": "immeuble", "code_departement_ban": "75", "_geopoint": "48.8,2.3"},
        {"numero_dpe": "D2", "type_batiment": "immeuble", "code_departement_ban": "75", "_geopoint": "x,2"}]}))
    text("buildings/buildings/a.csv", "batiment_groupe_id;code_departement_insee;WKT\n"
         f"B1;75;MULTILINESTRING (({L93[0]} {L93[1]}, {L93[0] + 9} {L93[1]}), ({L93[0]} {L93[1]}, {L93[0]} {L93[1] + 9}))\nB2;75;\n")
    text("buildings/energy_dpe/a.csv", "batiment_groupe_id,code_departement_insee,classe\nB1,75,C\nB3,13,D\n")
    parquet("plu/documents", [("75101", "PLU", "DU_75101", 1), ("13001", None, None, 2)], "grid_name string, du_type string, partition string, gid int")
    parquet("plu/communes", [("75101", "75"), ("13001", "13")], "code_commune string, departement string")
    parquet("plu/zones", [("75101", "75", "U", "l", "L", "i", pt(*L93))],
            f"commune string, departement string, typezone string, libelle string, libelong string, idurba string, geom {GEOM_TYPE}")
    parquet("plu/zones", [("75101", "75", "N", "l", "L", "i", "dest", pt(2.35, 48.85), 4326)],
            f"commune string, departement string, typezone string, libelle string, libelong string, idurba string, destdomi string, geom {GEOM_TYPE}, src_epsg int")
    parquet("plu/prescriptions", [("75101", "75", "01", "l", pt(*L93))], f"commune string, departement string, typepsc string, libelle string, geom {GEOM_TYPE}")
    # One tile over Paris, 20 x 20 pixels: a plane that rises northward.
    parquet("dem/cells.parquet", [(48, 2, r, c, 1000.0 - 400 * r) for r in range(20) for c in range(20)],
            "lat int, lon int, row int, col int, z double")
    text("osm/extract.jsonl", "\n".join(json.dumps(e) for e in (
        {"type": "node", "id": 1, "lat": 48.85, "lon": 2.3, "tags": {"amenity": "nightclub", "name": "x"}},
        {"type": "node", "id": 2, "lat": 43.3, "lon": 5.4, "tags": {"amenity": "bar"}},
        {"type": "node", "id": 3, "lat": 48.86, "lon": 2.33, "tags": {"tourism": "museum", "wikidata": "Q1", "name": "m"}},
        {"type": "way", "id": 4, "tags": {"highway": "primary"}, "geometry": [{"lat": 48.8, "lon": 2.2}, {"lat": 48.9, "lon": 2.5}]},
        {"type": "way", "id": 5, "tags": {"railway": "rail"}, "geometry": [{"lat": 48.8, "lon": 2.2}, {"lat": 48.9, "lon": 2.5}]})) + "\n")
    text("wikidata/a.jsonl", json.dumps({"entities": {"Q1": {"descriptions": {"fr": {"value": "musée"}}}}}) + "\n")
    for db in ("dvf_prices", "geom_utils", "crime_stats", "rents", "climate", "storm_risk", "flood_risk", "clay_risk", "coastal",
               "energy", "bati", "plu", "mnt", "osm"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    return root


def ids(spark, table, *cols):
    return sorted(tuple(r[c] for c in cols) for r in spark.table(table).collect())


def test_prices_of_two_years(spark, root):
    for year in (2022, 2023):
        J.JOBS["dvf"](spark, root, year, DEPS)
    assert ids(spark, "dvf_prices.sections_stats", "year", "departement", "prix_m2_median") == [
        (2022, "13", 1500.0), (2022, "75", 3000.0), (2023, "13", 3000.0), (2023, "75", 6000.0)]
    J.JOBS["dvf"](spark, root, 2023, ["75"])
    assert spark.table("dvf_prices.communes_stats").count() == 4


def test_geometry_tables_keep_to_the_requested_departments(spark, root):
    J.JOBS["dvf-sections"](spark, root, ["75", "69"])
    J.JOBS["dvf-sections"](spark, root, ["75"])
    assert ids(spark, "dvf_prices.sections", "departement") == [("69",), ("75",)]
    J.JOBS["commune-geoms"](spark, root, DEPS)
    assert ids(spark, "geom_utils.communes", "code_commune") == [("13001",), ("75101",)]


def test_indicators_by_year(spark, root):
    for year in (2023, 2024):
        J.JOBS["delinquance"](spark, root, year, DEPS)
    assert ids(spark, "crime_stats.indicators", "year", "taux_vols") == [(2023, 1.5), (2024, 2.5)]
    for year in (2022, 2023):
        J.JOBS["rents"](spark, root, year, DEPS)
    assert {(r.year, r.loyer_m2_median) for r in spark.table("rents.indicators").collect()} == {(2022, 10.5), (2023, 20.5)}
    with pytest.raises(ValueError):
        J.JOBS["rents"](spark, root, 1999)


def test_climate_and_hazards(spark, root):
    J.JOBS["climate"](spark, root, DEPS)
    assert ids(spark, "climate.stations", "departement") == [("13",), ("75",)]
    J.JOBS["commune-geoms"](spark, root, DEPS)
    J.JOBS["storm-risk"](spark, root, DEPS)
    assert sorted(r.geom.type for r in spark.table("storm_risk.wind_zones").collect()) == ["MultiLineString", "Polygon"]
    assert ids(spark, "storm_risk.catnat_storm", "code_commune", "storm_count") == [("75101", 1)]
    J.JOBS["flood-tri"](spark, root, DEPS)
    flood = {r.departement: r for r in spark.table("flood_risk.tri_zones").collect()}
    assert flood["75"].watercourse == "Seine" and flood["13"].watercourse is None and flood["13"].flood_type == "unknown"
    for r in flood.values():   # one layer in Lambert-93, one in WGS84
        p = r.geom.parts[0][0][0]
        assert abs(p.x - 2.35) < 0.02 and abs(p.y - 48.855) < 0.02
    J.JOBS["clay-risk"](spark, root, DEPS)
    levels = dict(ids(spark, "clay_risk.rga_zones", "departement", "exposure_level"))
    assert levels["13"] == "unknown" and levels["75"] != "unknown" and len(levels) == 2


def test_pass_through_layers(spark, root):
    J.JOBS["coastal-erosion"](spark, root)
    p = spark.table("coastal.erosion").first().geom.parts[0][0][0]
    assert abs(p.x - 2.35) < 0.02
    J.JOBS["icu"](spark, root, [f"{root}/icu/a", f"{root}/icu/missing", f"{root}/icu/b"])
    assert sorted((r.nom, r.score) for r in spark.table("climate.icu").collect() if r.nom) == [("x", None)]
    with pytest.raises(ValueError):
        J.JOBS["icu"](spark, root, [f"{root}/icu/missing"])


def test_air_and_pollen(spark, root):
    J.JOBS["air-quality"](spark, root, DEPS)
    assert "ordinal" not in spark.table("climate.air_quality").columns and spark.table("climate.air_quality").count() == 4
    J.JOBS["pollens"](spark, root)
    got = spark.table("climate.pollens").collect()
    assert [(r.commune_code, r.geom.parts[0][0][0].x) for r in got] == [("75001", 3.0)]


def test_buildings_and_diagnostics(spark, root):
    J.JOBS["dpe-collectif"](spark, root, DEPS)
    assert ids(spark, "energy.dpe_collectif", "numero_dpe") == [("D1",)]
    J.JOBS["bdnb"](spark, root, DEPS)
    assert [(r.batiment_groupe_id, r.geom.type) for r in spark.table("bati.buildings").collect()] == [("B1", "MultiLineString")]
    assert spark.table("bati.energy_dpe").count() == 2 and not spark.catalog.tableExists("bati.addresses")


def test_planning(spark, root):
    J.JOBS["plu"](spark, root, DEPS)
    zones = spark.table("plu.zones").collect()
    assert sorted((r.typezone, r.destdomi or "") for r in zones) == [("N", "dest"), ("U", "")]
    assert all(abs(r.geom.parts[0][0][0].x - 2.35) < 0.02 for r in zones)
    assert spark.table("plu.prescriptions").count() == 1


def test_exposure_polygons(spark, root):
    J.JOBS["exposition"](spark, root, ["75"], pixel=1 / 20)
    rows = spark.table("mnt.exposure").collect()
    assert {r.departement for r in rows} == {"75"} and {r.exposition for r in rows} == {"high_exposure"}
    south, west, north, east = J.bbox_table(spark, ["75"]).first()[1:5]
    for r in rows:
        ring = r.geom.parts[0][0]
        assert ring[0] == ring[-1] and all(west - 0.05 <= p.x <= east + 0.05 and south - 0.05 <= p.y <= north + 0.05 for p in ring)


def test_osm_layers(spark, root):
    for name in J.OSM_TABLES:
        J.JOBS[name.replace("_", "-")](spark, root, DEPS)
    assert ids(spark, "osm.nightclubs", "osm_id", "departement") == [(1, "75"), (2, "13")]
    assert ids(spark, "osm.roads", "osm_id", "departement") == [(4, "75")]
    assert ids(spark, "osm.railways", "osm_id", "departement") == [(5, "75")]
    J.JOBS["wiki-pois"](spark, root, DEPS)
    assert ids(spark, "osm.poi_wiki", "osm_id", "description") == [(3, "musée")]
    before = {t: spark.table(f"osm.{t}").count() for t, _ in J.OSM_TABLES.values()}
    J.JOBS["osm-all"](spark, root, DEPS)
    assert {t: spark.table(f"osm.{t}").count() for t, _ in J.OSM_TABLES.values()} == before
