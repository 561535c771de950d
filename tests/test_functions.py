import math

from pyspark.sql import functions as F

from geolake.functions import crs, departments as D, text as T, wkt
from geolake.operators.planning import zone_category


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_decimal_comma_and_numeric_guard(spark):
    rows = [("12,5",), ("ndiff",), ("1.5d",), (None,), ("",), (" 3 ",), ("-0,25",), ("1e3",)]
    df = spark.createDataFrame(rows, "v string")
    got = [r[0] for r in df.select(T.decimal_comma(F.col("v"))).collect()]
    assert got == [12.5, None, None, None, None, 3.0, -0.25, 1000.0]


def test_slug_matches_driver_side(spark):
    name = "Vols d'accessoires sur véhicules à moteur ô û è ê"
    assert one(spark, T.slug(F.col("v")), name) == T.slug_py(name)
    assert T.slug_py("Coups et blessures volontaires") == "coups_et_blessures_volontaires"
    # characters outside the fold list stay untouched
    assert T.slug_py("Ça î") == "ça_î"


def test_round_half_even_is_numpy_rint(spark):
    import numpy as np
    vals = [0.25, 0.35, 0.45, 2.5, 1.05, 7 / 1.5, 12.25]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(T.round_half_even(F.col("v"), 1)).collect()]
    assert got == [float(np.round(v, 1)) for v in vals]


def test_parse_date_invalid_is_null(spark):
    df = spark.createDataFrame([("2020-01-31",), ("31/01/2020",), ("junk",), (None,)], "v string")
    got = [r[0] for r in df.select(T.parse_date(F.col("v"))).collect()]
    assert str(got[0]) == "2020-01-31" and got[1:] == [None, None, None]


def test_department_helpers(spark):
    df = spark.createDataFrame([("97101",), ("75056",), ("2A004",), ("1",), ("971",)], "c string")
    got = df.select(D.dep_of(F.col("c")), D.zfill_dep(F.col("c")),
                    D.in_departments_code(F.col("c"), ["971", "2A"]),
                    D.in_departments_any(F.col("c"), ["75"]),
                    D.in_departments_prefix(F.col("c"), ["97", "2A"])).collect()
    assert [r[0] for r in got] == ["971", "75", "2A", "1", "971"]
    assert [r[1] for r in got] == ["97101", "75056", "2A004", "01", "971"]
    assert [r[2] for r in got] == [True, False, True, False, False]
    assert [r[3] for r in got] == [False, True, False, False, False]
    assert [r[4] for r in got] == [True, False, True, False, True]
    # no filter when the list is empty
    assert df.where(D.in_departments_any(F.col("c"), [])).count() == 5


def test_lambert93_origin_and_round_trip(spark):
    df = spark.createDataFrame([(700000.0, 6600000.0), (652469.0, 6862035.0),
                                (1045000.0, 6290000.0), (350000.0, 6700000.0)], "x double, y double")
    lon, lat = crs.l93_to_lonlat(F.col("x"), F.col("y"))
    fx, fy = crs.lonlat_to_l93(lon, lat)
    rows = df.select(lon.alias("lon"), lat.alias("lat"), fx.alias("fx"), fy.alias("fy"), "x", "y").collect()
    assert math.isclose(rows[0]["lon"], 3.0, abs_tol=1e-12)
    assert math.isclose(rows[0]["lat"], 46.5, abs_tol=1e-12)
    for r in rows:
        assert abs(r["fx"] - r["x"]) < 1e-6 and abs(r["fy"] - r["y"]) < 1e-6
    # Paris (Notre-Dame area) lands near 2.35E, 48.85N
    assert abs(rows[1]["lon"] - 2.35) < 0.01 and abs(rows[1]["lat"] - 48.85) < 0.01


def test_parse_wkt_shapes(spark):
    rows = [("POINT (1 2)",), ("POLYGON ((0 0, 1 0, 1 1, 0 0), (0.1 0.1, 0.2 0.1, 0.2 0.2, 0.1 0.1))",),
            ("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))",),
            ("",), (None,), ("CIRCLE (1 2)",), ("POINT (x 2)",), ("LINESTRING (0 0, 3 4)",)]
    df = spark.createDataFrame(rows, "w string").select(wkt.parse_wkt(F.col("w")).alias("g"))
    got = df.collect()
    assert got[0]["g"]["type"] == "Point" and got[0]["g"]["parts"][0][0][0]["y"] == 2.0
    assert got[1]["g"]["type"] == "Polygon" and len(got[1]["g"]["parts"][0]) == 2
    assert got[2]["g"]["type"] == "MultiPolygon" and len(got[2]["g"]["parts"]) == 2
    assert [r["g"] for r in got[3:7]] == [None, None, None, None]
    assert got[7]["g"]["type"] == "LineString"


def test_geom_column_lookup():
    assert wkt.find_geom_col(["id", "s_geom_groupe", "WKT"]) == "WKT"
    assert wkt.find_geom_col(["id", "geom_groupe"]) == "geom_groupe"
    assert wkt.find_geom_col(["id", "name"]) is None


def test_geopoint(spark):
    df = spark.createDataFrame([("48.8,2.3",), ("x,2",), ("1",), ("",)], "g string")
    lat, lon = wkt.parse_geopoint(F.col("g"))
    got = [tuple(r) for r in df.select(lat, lon).collect()]
    assert got == [(48.8, 2.3), (None, 2.0), (1.0, None), (None, None)]


def test_zone_category(spark):
    vals = ["U", "AUc", "AUs", "AU", "A", "N", "Uh", "AUs1", "AUS", "1AU", "ua", "", None, "Nh2"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(zone_category(F.col("t"))).collect()]
    assert got == ["urban", "to_urbanize", "to_urbanize_strict", "to_urbanize", "agricultural",
                   "natural", "urban", "to_urbanize", "to_urbanize", "other", "other", "other",
                   "other", "natural"]
