"""Jobs over files shaped as published, absent and broken sources, loads
without rows, and jobs that publish versioned tables."""

import gzip
import json
import os

import pytest

from geolake.functions.geometry import GEOM_TYPE
from geolake.plans import jobs as J
from geolake.sinks import tables as K
from geolake.sources import manifest as M
from geolake.sources import readers as R

SQUARE = {"type": "Polygon", "coordinates": [[[2.3, 48.8], [2.4, 48.8], [2.4, 48.9], [2.3, 48.8]]]}


@pytest.fixture
def root(spark, tmp_path):
    for db in ("dvf_prices", "geom_utils", "climate", "osm", "mnt", "bati"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    return str(tmp_path)


def put(root, path, text, gz=False):
    path = os.path.join(root, path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with (gzip.open(path, "wt") if gz else open(path, "w")) as f:
        f.write(text)


def ids(spark, table, *cols):
    return sorted(tuple(r[c] for c in cols) for r in K.read_table(spark, table).collect())


def sections(*codes):
    """A department's sections as published: one document, no department."""
    return json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": c, "geometry": SQUARE,
         "properties": {"id": c, "commune": c[:5], "prefixe": "000", "code": c[-2:], "created": "2020-01-01"}} for c in codes]})


def test_sections_and_communes_as_published(spark, root):
    put(root, "geojson/sections/cadastre-75-sections.json.gz", sections("75101000AB", "75102000AC"), gz=True)
    put(root, "geojson/sections/2A/sections.json", sections("2A004000AA"))
    put(root, "geojson/sections/69.geojsonl", json.dumps({"type": "Feature", "properties": {"id": "69001000AA", "commune": "69001"}, "geometry": SQUARE}))
    J.JOBS["dvf-sections"](spark, root, ["75", "2A", "69"])
    expected = [("2A004000AA", "2A"), ("69001000AA", "69"), ("75101000AB", "75"), ("75102000AC", "75")]
    assert ids(spark, "dvf_prices.sections", "section_id", "departement") == expected
    J.JOBS["dvf-sections"](spark, root, ["75"])
    J.JOBS["dvf-sections"](spark, root, ["13"])   # nothing landed for it
    assert ids(spark, "dvf_prices.sections", "section_id", "departement") == expected
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": "75101", "nom": "Paris 1"}, "geometry": SQUARE}]}
    put(root, "geojson/communes/75/cadastre-75-communes.json", json.dumps(doc, indent=2))
    J.JOBS["commune-geoms"](spark, root, ["75"])
    assert ids(spark, "geom_utils.communes", "code_commune", "nom_commune", "departement") == [("75101", "Paris 1", "75")]


def test_features_of_no_department_are_refused(spark, root):
    put(root, "geojson/sections/75.json", sections("75101000AB"))
    J.JOBS["dvf-sections"](spark, root, ["75"])
    put(root, "geojson/sections/unnamed.json", sections("75101000AB"))
    with pytest.raises(ValueError, match="no known department"):
        J.JOBS["dvf-sections"](spark, root, ["75"])
    assert ids(spark, "dvf_prices.sections", "section_id") == [("75101000AB",)]


def dvf(dep, price):
    return ("id_mutation,nature_mutation,valeur_fonciere,type_local,surface_reelle_bati,id_parcelle\n"
            + "".join(f"m{i},Vente,{price * i},Appartement,10,{dep}101000AB000{i}\n" for i in range(1, 6)))


def test_a_department_without_a_readable_file_costs_only_itself(spark, root):
    for dep in ("13", "75"):
        put(root, f"dvf/2023/{dep}.csv.gz", dvf(dep, 1000), gz=True)
    J.JOBS["dvf"](spark, root, 2023, ["13", "75", "69"])   # 69 is absent
    assert ids(spark, "dvf_prices.sections_stats", "departement", "prix_m2_median") == [("13", 300.0), ("75", 300.0)]
    put(root, "dvf/2023/75.csv.gz", dvf("75", 2000), gz=True)
    with open(os.path.join(root, "dvf/2023/13.csv.gz"), "rb+") as f:
        f.truncate(60)
    found = R.probe_department_files(spark, f"{root}/dvf/2023", ["13", "75", "69"], ".csv.gz")
    assert {d: s.status for d, s in found.items()} == {"13": "corrupt", "75": "readable", "69": "absent"}
    assert M.manifest(spark, found.values()).where("reason is not null").count() == 2
    J.JOBS["dvf"](spark, root, 2023, ["13", "75", "69"])
    assert ids(spark, "dvf_prices.sections_stats", "departement", "prix_m2_median") == [("13", 300.0), ("75", 600.0)]
    J.JOBS["dvf"](spark, root, 2023, ["69"])   # no file at all: nothing changes
    assert len(ids(spark, "dvf_prices.communes_stats", "departement")) == 2


def test_climate_of_absent_departments(spark, root):
    put(root, "meteo/75.csv.gz", "NUM_POSTE;NOM_USUEL;LAT;LON;ALTI;AAAAMM;TX;TN;TXAB;NBJTX25;NBJTX30;NBJTX35\n"
        + "".join(f'75001;"S ""75""; A";43.4;5.2;9;2024{m:02d};14.2;4.1;19.0;1;0;0\n' for m in range(1, 13)), gz=True)
    J.JOBS["climate"](spark, root, ["13", "75"])
    assert [r.departement for r in K.read_table(spark, "climate.stations").collect()] == ["75"]
    J.JOBS["climate"](spark, root, ["13"])
    assert K.read_table(spark, "climate.stations").count() == 1
    put(root, "meteo/13.csv.gz", gzip.open(os.path.join(root, "meteo/75.csv.gz"), "rt").read().replace("75001", "13001"), gz=True)
    J.JOBS["climate"](spark, root, ["13"], mode="by_department")
    assert ids(spark, "climate.stations", "departement") == [("13",), ("75",)]
    J.JOBS["climate"](spark, root, ["13"])   # the whole table
    assert ids(spark, "climate.stations", "departement") == [("13",)]
    with pytest.raises(ValueError):
        J.JOBS["climate"](spark, root, ["13"], mode="x")


def test_a_corrupt_layer_is_skipped(spark, root):
    for name, schema, row in (("a", f"nom string, geom {GEOM_TYPE}, src_epsg int", ("x", ("Point", [[[(2.0, 48.0)]]]), 4326)),
                              ("b", f"score int, geom {GEOM_TYPE}, src_epsg int", (5, ("Point", [[[(3.0, 48.0)]]]), 4326)),
                              ("c", f"score int, geom {GEOM_TYPE}, src_epsg int", (6, ("Point", [[[(3.0, 48.0)]]]), 4326))):
        spark.createDataFrame([row], schema).coalesce(1).write.parquet(f"{root}/icu/{name}")
    part = next(f for f in os.listdir(f"{root}/icu/b") if f.endswith(".parquet"))
    with open(f"{root}/icu/b/{part}", "rb+") as f:   # the footer stays, the pages are garbage
        f.write(b"PAR1" + b"\xff" * 60)
    part = next(f for f in os.listdir(f"{root}/icu/c") if f.endswith(".parquet"))
    with open(f"{root}/icu/c/{part}", "rb+") as f:
        f.truncate(40)
    paths = [f"{root}/icu/{n}" for n in ("a", "b", "c", "missing")]
    found = M.probe(spark, paths, spark.read.parquet)
    assert [s.status for s in found] == ["readable", "corrupt", "corrupt", "absent"]
    J.JOBS["icu"](spark, root, paths)
    assert ids(spark, "climate.icu", "nom") == [("x",)]
    with pytest.raises(ValueError, match="none of the layers"):
        R.read_layers(spark, paths[1:])


def osm(*elements):
    return "\n".join(json.dumps(e) for e in elements) + "\n"


RAIL = {"type": "way", "id": 5, "tags": {"railway": "rail"}, "geometry": [{"lat": 48.8, "lon": 2.2}, {"lat": 48.9, "lon": 2.5}]}
CLUB = {"type": "node", "id": 1, "lat": 48.85, "lon": 2.3, "tags": {"amenity": "nightclub"}}


def test_a_load_without_rows_keeps_or_clears_as_each_layer_does(spark, root):
    put(root, "osm/a.jsonl", osm(RAIL, CLUB) + "{broken\n")   # a broken line costs only itself
    for layer in ("railways", "nightclubs"):
        J.JOBS[layer](spark, root, ["75"])
    assert ids(spark, "osm.railways", "osm_id") == [(5,)] and ids(spark, "osm.nightclubs", "osm_id") == [(1,)]
    put(root, "osm/a.jsonl", osm({"type": "node", "id": 9, "lat": 48.85, "lon": 2.3, "tags": {}}))
    for layer in ("railways", "nightclubs"):
        J.JOBS[layer](spark, root, ["75"])
    assert ids(spark, "osm.railways", "osm_id") == [(5,)] and ids(spark, "osm.nightclubs", "osm_id") == []


def test_elements_of_several_departments_once(spark, root):
    put(root, "osm/a.jsonl", osm({**CLUB, "lat": 48.9}))
    J.JOBS["nightclubs"](spark, root)
    deps = [d for _, d in ids(spark, "osm.nightclubs", "osm_id", "departement")]
    assert len(deps) > 1
    J.JOBS["nightclubs"](spark, root, dedupe_osm=True)
    assert ids(spark, "osm.nightclubs", "osm_id", "departement") == [(1, min(deps))]


def test_exposure_keeps_departments_without_polygons(spark, root):
    cells = [(48, 2, r, c, 1000.0 - 400 * r) for r in range(20) for c in range(20)]
    spark.createDataFrame(cells, "lat int, lon int, row int, col int, z double").coalesce(1).write.parquet(f"{root}/dem/cells.parquet")
    J.JOBS["exposition"](spark, root, ["75"], pixel=1 / 20)
    before = K.read_table(spark, "mnt.exposure").count()
    assert before
    spark.createDataFrame(cells, "lat int, lon int, row int, col int, z double").where("false").write.mode("overwrite").parquet(f"{root}/dem/cells.parquet")
    J.JOBS["exposition"](spark, root, ["75", "13"], pixel=1 / 20)
    assert K.read_table(spark, "mnt.exposure").count() == before


def test_building_tables_join_without_a_shuffle(spark, root):
    from geolake.operators import lookups
    put(root, "buildings/buildings/a.csv", "batiment_groupe_id;code_departement_insee;etat\n" + "".join(f"B{i};{13 + i % 2:02d};x{i}\n" for i in range(200)))
    put(root, "buildings/energy_dpe/a.csv", "batiment_groupe_id,code_departement_insee,classe\n" + "".join(f'B{i},{13 + i % 2:02d},"C, ""{i}"""\n' for i in range(0, 200, 3)))
    put(root, "buildings/addresses/a.csv", "adresse_id;code_departement_insee\nA1;13\n")
    for deps in (["13"], ["14"], ["13"]):
        J.JOBS["bdnb"](spark, root, ["13", "14"], buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = lookups.building_profile(spark.table("bati.buildings"), {"energy": spark.table("bati.energy_dpe")})
        plan = star._jdf.queryExecution().executedPlan().toString()
        rows = star.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert {r.batiment_groupe_id: r.energy_classe for r in rows} == {f"B{i}": f'C, "{i}"' if i % 3 == 0 else None for i in range(200)}
    assert spark.table("bati.addresses").count() == 1


def test_jobs_publish_versioned_tables(spark, root, tmp_path):
    spark.conf.set("geolake.tables.root", str(tmp_path / "published"))
    try:
        put(root, "osm/a.jsonl", osm(RAIL, CLUB))
        put(root, "geojson/communes/75.geojsonl", json.dumps({"type": "Feature", "properties": {"id": "75101", "nom": "Paris"}, "geometry": SQUARE}))
        put(root, "geojson/wind/a.geojsonl", json.dumps({"type": "Feature", "properties": {"V_B0": "24"}, "geometry": SQUARE}))
        put(root, "catnat/a.csv", "cod_commune;lib_risque_jo;dat_deb;dat_fin\n75101;Tempête;1999-12-26;1999-12-28\n")
        for year in (2022, 2023):
            put(root, f"dvf/{year}/75.csv.gz", dvf("75", year), gz=True)
            J.JOBS["dvf"](spark, root, year, ["75"])
        J.JOBS["commune-geoms"](spark, root, ["75"])
        J.JOBS["storm-risk"](spark, root, ["75"])
        J.JOBS["osm-all"](spark, root, ["75"])
        assert ids(spark, "dvf_prices.communes_stats", "year") == [(2022,), (2023,)]
        assert ids(spark, "storm_risk.catnat_storm", "code_commune", "storm_count") == [("75101", 1)]
        assert ids(spark, "osm.railways", "osm_id") == [(5,)]
        assert K.read_table(spark, "storm_risk.wind_zones").count() == 1
        assert not spark.catalog.tableExists("osm.railways")
    finally:
        spark.conf.unset("geolake.tables.root")
