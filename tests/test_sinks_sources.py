import gzip
import json
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from geolake.sinks import tables as K
from geolake.sources import parse as P, readers as R


def test_replace_departments_query_idempotent(spark):
    old = spark.createDataFrame([("01", 1), ("02", 2), ("03", 3)], "departement string, v int")
    new = spark.createDataFrame([("01", 10)], "departement string, v int")
    once = K.replace_departments_query(old, new, ["01", "02"])
    twice = K.replace_departments_query(once, new, ["01", "02"])
    assert sorted(map(tuple, once.collect())) == [("01", 10), ("03", 3)]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    k2 = K.replace_present_query(old, new)
    assert sorted(map(tuple, k2.collect())) == [("01", 10), ("02", 2), ("03", 3)]


def test_catalog_refresh_actions(spark):
    K.ensure_namespace(spark, "t_geo")
    t = "t_geo.prices"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    a = spark.createDataFrame([("s1", 1.0, "01"), ("s2", 2.0, "02")], "section_id string, v double, departement string")
    K.replace_departments(a, t, ["01", "02"])
    b = spark.createDataFrame([("s3", 3.0, "01")], "section_id string, v double, departement string")
    K.replace_departments(b, t, ["01", "02"])          # 02 requested but absent -> dropped
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [("s3", 3.0, "01")]
    c = spark.createDataFrame([("s4", 4.0, "03")], "section_id string, v double, departement string")
    K.replace_present(c, t)
    assert sorted(r.departement for r in spark.table(t).collect()) == ["01", "03"]
    assert spark.table(t).schema["departement"].dataType == StringType()


def test_readers_on_landed_files(spark):
    d = tempfile.mkdtemp(prefix="geolake-src-")
    with gzip.open(os.path.join(d, "75.csv.gz"), "wt") as f:
        f.write("id_mutation,nature_mutation,valeur_fonciere,type_local,surface_reelle_bati,id_parcelle\n")
        f.write("m1,Vente,100000,Appartement,50,75101000AB0001\n")
        f.write("m2,Vente,abc,Appartement,,75101000AB0002\n")
    dvf = R.read_dvf(spark, os.path.join(d, "75.csv.gz")).collect()
    assert dvf[0].departement == "75" and dvf[0].valeur_fonciere == 100000.0
    assert dvf[1].valeur_fonciere is None and dvf[1].surface_reelle_bati is None

    with open(os.path.join(d, "bat.csv"), "w") as f:
        f.write("batiment_groupe_id;code_departement_insee;WKT\nBG1;75;POINT (700000 6600000)\nBG2;NA;\n")
    bt = R.read_building_table(spark, os.path.join(d, "bat.csv"))
    assert bt.columns == ["batiment_groupe_id", "code_departement_insee", "WKT"]

    feats = [{"type": "Feature", "properties": {"id": "75101000AB", "commune": "75101"},
              "geometry": {"type": "MultiPolygon",
                           "coordinates": [[[[2.3, 48.8], [2.4, 48.8], [2.4, 48.9], [2.3, 48.8]]]]}},
             {"type": "Feature", "properties": {"id": "p", "commune": "75101"},
              "geometry": {"type": "Point", "coordinates": [2.3, 48.8]}}]
    with open(os.path.join(d, "sections.geojsonl"), "w") as f:
        f.write("\n".join(json.dumps(x) for x in feats))
    props = StructType([StructField("id", StringType()), StructField("commune", StringType())])
    g = R.read_geojson(spark, os.path.join(d, "sections.geojsonl"), props).collect()
    assert g[0].geom["type"] == "MultiPolygon" and g[0].geom["parts"][0][0][1]["x"] == 2.4
    assert g[1].geom["type"] == "Point"

    with open(os.path.join(d, "osm.json"), "w") as f:
        json.dump({"elements": [{"type": "node", "id": 1, "lat": 48.85, "lon": 2.3,
                                 "tags": {"shop": "bakery"}}]}, f)
    el = R.read_osm(spark, os.path.join(d, "osm.json"), line_delimited=False).collect()
    assert el[0].tags["shop"] == "bakery"

    with open(os.path.join(d, "ent.jsonl"), "w") as f:
        f.write(json.dumps({"entities": {"Q1": {"descriptions": {"fr": {"value": "musée"}}},
                                         "Q2": {"id": "Q2", "missing": ""}}}))
    ents = {r.qid: r.missing for r in R.read_entities(spark, os.path.join(d, "ent.jsonl")).collect()}
    assert ents == {"Q1": False, "Q2": True}


def test_parse_delimited(spark):
    df = spark.createDataFrame([("a;1,5;x",)], "value string")
    r = P.parse_delimited(df, "a string, b string, c string").first()
    assert tuple(r) == ("a", "1,5", "x")


def test_streaming_department_refresh(spark):
    from pyspark.sql.types import StructField, StructType
    from geolake.operators import prices
    from geolake.streaming.refresh import department_file_stream, run_department_refresh
    d = tempfile.mkdtemp(prefix="geolake-land-")
    for dep, val in (("75", 100000), ("13", 50000)):
        with open(os.path.join(d, f"{dep}.csv"), "w") as f:
            f.write(f"m1,Vente,{val},Appartement,50,{dep}101000AB0001\n")
            f.write(f"m2,Vente,{val * 2},Appartement,50,{dep}101000AB0002\n")
    schema = StructType([StructField(c, StringType()) for c in (
        "id_mutation", "nature_mutation", "valeur_fonciere", "type_local",
        "surface_reelle_bati", "id_parcelle")])
    stream = department_file_stream(spark, d, schema)

    def transform(b):
        b = b.withColumn("valeur_fonciere", F.col("valeur_fonciere").cast("double")) \
             .withColumn("surface_reelle_bati", F.col("surface_reelle_bati").cast("double"))
        return prices.section_prices(b)

    K.ensure_namespace(spark, "t_stream")
    spark.sql("DROP TABLE IF EXISTS t_stream.sections")
    q = run_department_refresh(stream, transform, "t_stream.sections", "dvf_test",
                               checkpoint=tempfile.mkdtemp(prefix="geolake-sck-"))
    q.awaitTermination(120)
    got = {r.departement: r.prix_m2_mean for r in spark.table("t_stream.sections").collect()}
    assert got == {"75": 3000.0, "13": 1500.0}


def test_dataset_jobs_end_to_end(spark):
    """D14/D15 and an OSM layer job from landed files to catalog tables."""
    from geolake.plans import jobs as J
    root = tempfile.mkdtemp(prefix="geolake-root-")
    os.makedirs(os.path.join(root, "dvf", "2023"))
    for dep, base in (("75", 10000), ("13", 5000)):
        with gzip.open(os.path.join(root, "dvf", "2023", f"{dep}.csv.gz"), "wt") as f:
            f.write("id_mutation,nature_mutation,valeur_fonciere,type_local,surface_reelle_bati,id_parcelle\n")
            for i in range(1, 6):
                f.write(f"m{i},Vente,{base * i},Appartement,10,{dep}101000AB000{i}\n")
    spark.sql("DROP TABLE IF EXISTS dvf_prices.sections_stats")
    spark.sql("DROP TABLE IF EXISTS dvf_prices.communes_stats")
    J.job_dvf(spark, root, 2023, ["75", "13"])
    got = {r.departement: r.prix_m2_median for r in spark.table("dvf_prices.sections_stats").collect()}
    assert got == {"75": 3000.0, "13": 1500.0}
    assert spark.table("dvf_prices.communes_stats").count() == 2

    os.makedirs(os.path.join(root, "osm"))
    with open(os.path.join(root, "osm", "extract.jsonl"), "w") as f:
        f.write(json.dumps({"type": "node", "id": 1, "lat": 48.85, "lon": 2.3,
                            "tags": {"amenity": "nightclub", "name": "x"}}) + "\n")
        f.write(json.dumps({"type": "node", "id": 2, "lat": 43.3, "lon": 5.4,
                            "tags": {"amenity": "bar"}}) + "\n")
    spark.sql("DROP TABLE IF EXISTS osm.nightclubs")
    J.JOBS["nightclubs"](spark, root, ["75", "13"])
    rows = sorted((r.osm_id, r.departement) for r in spark.table("osm.nightclubs").collect())
    assert rows == [(1, "75"), (2, "13")]
    J.JOBS["osm-all"](spark, root, ["75", "13"])
    assert sorted(r.osm_id for r in spark.table("osm.shops").collect()) == [2]
    assert spark.table("osm.nightclubs").count() == 2


def test_rent_and_crime_files(spark):
    from geolake.operators import communes
    d = tempfile.mkdtemp(prefix="geolake-rent-")
    with open(os.path.join(d, "house.csv"), "w", encoding="latin-1") as f:
        f.write("INSEE_C;DEP;LIBGEO;loypredm2;lwr.IPm2;upr.IPm2;TYPPRED;nbobs_com;R2_adj\n")
        f.write("01001;01;L'Abergement-Clémenciat;10,5;8,1;13,2;commune;12;0,61\n")
        f.write("2B033;2B;Bastia;12,25;NA;14;maille;3;0,5\n")
    df = R.read_rents(spark, os.path.join(d, "house.csv"))
    got = {r.code_commune: r for r in communes.rents_long({"house": df}, ["01", "2B"]).collect()}
    assert got["01001"].loyer_m2_median == 10.5 and got["01001"].departement == "01"
    assert got["2B033"].loyer_m2_lower is None and got["2B033"].r2_adj == 0.5
    with gzip.open(os.path.join(d, "crime.csv.gz"), "wt") as f:
        f.write("CODGEO_2025;annee;indicateur;unite_de_compte;taux_pour_mille;nombre\n")
        f.write("75101;2024;Vols d'objets;infraction;;4\n")
        f.write("75101;2024;Vols d'objets;infraction;1,5;5\n")
        f.write("75102;2024;Vols d'objets;infraction;ndiff;7\n")
    cr = R.read_crime(spark, os.path.join(d, "crime.csv.gz"))
    out = {r.code_commune: r.taux_vols_dobjets for r in communes.crime_pivot(cr, 2024, ["75"]).collect()}
    assert out == {"75101": 1.5}


def test_layer_discovery_meteo_catnat_and_full_replace(spark):
    d = tempfile.mkdtemp(prefix="geolake-layers-")
    # Only *inondable_*_s_* layers, found recursively
    import pyarrow as pa
    import pyarrow.parquet as pq
    for rel, keep in (("a/n_inondable_01_s_x.parquet", True), ("b/c/n_inondable_02_s_y.parquet", True),
                      ("b/n_inondable_03_l_z.parquet", False)):
        path = os.path.join(d, "flood", rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        pq.write_table(pa.table({"src": [rel], "keep": [keep]}), path)
    found = R.read_flood_layers(spark, os.path.join(d, "flood")).collect()
    assert sorted(r.src for r in found) == ["a/n_inondable_01_s_x.parquet", "b/c/n_inondable_02_s_y.parquet"]
    # Monthly climate file, department from the file name
    with gzip.open(os.path.join(d, "13.csv.gz"), "wt") as f:
        f.write("NUM_POSTE;NOM_USUEL;LAT;LON;ALTI;AAAAMM;TX;TN;TXAB;NBJTX25;NBJTX30;NBJTX35\n")
        f.write("13001;MARIGNANE;43.43;5.21;9;202401;14.2;4.1;19.0;0;0;0\n")
    m = R.read_mens(spark, os.path.join(d, "13.csv.gz")).first()
    assert m.departement == "13" and m.AAAAMM == 202401 and m.TX == 14.2
    # Natural disasters, pandas missing tokens -> NULL
    with open(os.path.join(d, "catnat.csv"), "w") as f:
        f.write("cod_commune;lib_risque_jo;dat_deb;dat_fin\n13001;Tempête;2020-01-02;NA\n")
    c = R.read_catnat(spark, os.path.join(d, "catnat.csv")).first()
    assert c.lib_risque_jo == "Tempête" and c.dat_fin is None
    # K3 full replace and K4 truncate + load keep only the new rows
    K.ensure_namespace(spark, "t_full")
    for fn, t in ((K.replace_table, "t_full.a"), (K.truncate_load, "t_full.b")):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
        fn(spark.createDataFrame([("01", 1)], "departement string, v int"), t)
        fn(spark.createDataFrame([("02", 2)], "departement string, v int"), t)
        assert [tuple(r) for r in spark.table(t).select("departement", "v").collect()] == [("02", 2)]
