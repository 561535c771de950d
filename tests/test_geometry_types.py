"""Source CRS and multi-part geometries."""

import json
import math

import pytest
from pyspark.sql import functions as F

from geolake.functions import crs
from geolake.functions.geometry import point
from geolake.functions.wkt import parse_wkt
from geolake.sources.parse import parse_features
from pyspark.sql.types import StringType, StructField, StructType


def _forward_utm(lon, lat, zone, south):
    """Forward transverse Mercator (Krueger series), independent of the inverse."""
    f = crs.GRS80_F
    n = f / (2 - f)
    big_a = crs.GRS80_A / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    alpha = (n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16, 13 * n ** 2 / 48 - 3 * n ** 3 / 5, 61 * n ** 3 / 240)
    phi, lam = math.radians(lat), math.radians(lon - (6 * zone - 183))
    s = 2 * math.sqrt(n) / (1 + n)
    t = math.sinh(math.atanh(math.sin(phi)) - s * math.atanh(s * math.sin(phi)))
    xi, eta = math.atan2(t, math.cos(lam)), math.atanh(math.sin(lam) / math.sqrt(1 + t * t))
    e = eta + sum(a * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, a in enumerate(alpha, 1))
    y = xi + sum(a * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, a in enumerate(alpha, 1))
    return 500000 + 0.9996 * big_a * e, (10000000 if south else 0) + 0.9996 * big_a * y


@pytest.mark.parametrize("code,lon,lat", [(2975, 55.45, -21.1), (4471, 45.2, -12.8), (2972, -52.3, 4.9), (5490, -61.5, 16.2),
                                          (4559, -61.0, 14.6), (32630, -2.9, 48.1), (32756, 151.2, -33.9)])
def test_utm_inverts_the_forward_projection(spark, code, lon, lat):
    x, y = _forward_utm(lon, lat, *crs.utm_zone(code))
    g = spark.createDataFrame([(x, y)], "x double, y double").select(crs.to_wgs84(point(F.col("x"), F.col("y")), code).alias("g")).first().g
    p = g.parts[0][0][0]
    assert abs(p.x - lon) < 1e-8 and abs(p.y - lat) < 1e-8


def test_unknown_codes_are_errors(spark):
    with pytest.raises(ValueError):
        crs.to_wgs84(F.col("g"), 27572)
    df = spark.createDataFrame([(1.0, 2.0, c) for c in (4326, None, 2154)], "x double, y double, c int")
    out = df.select("c", crs.to_wgs84(point(F.col("x"), F.col("y")), F.col("c")).alias("g")).collect()
    assert [r.g.parts[0][0][0].x for r in out[:2]] == [1.0, 1.0] and out[2].g.parts[0][0][0].x != 1.0
    bad = spark.createDataFrame([(1.0, 2.0, 27572)], "x double, y double, c int")
    with pytest.raises(Exception, match="unsupported EPSG:27572"):
        bad.select(crs.to_wgs84(point(F.col("x"), F.col("y")), F.col("c"))).collect()


def test_multi_geometries_keep_their_type(spark):
    wkt = {"MULTIPOINT (1 2, 3 4)": ("MultiPoint", 1, [2]), "MULTIPOINT ((1 2), (3 4), (5 6))": ("MultiPoint", 1, [3]),
           "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3, 4 4))": ("MultiLineString", 1, [2, 3]),
           "LINESTRING (0 0, 1 1)": ("LineString", 1, [2]), "POINT Z (1 2 3)": ("Point", 1, [1])}
    df = spark.createDataFrame([(w,) for w in [*wkt, "GEOMETRYCOLLECTION (POINT (1 2))", "MULTIPOINT (a b)", "", None]], "w string")
    got = {r.w: r.g for r in df.select("w", parse_wkt(F.col("w")).alias("g")).collect()}
    for w, (kind, parts, sizes) in wkt.items():
        assert (got[w].type, len(got[w].parts), [len(r) for r in got[w].parts[0]]) == (kind, parts, sizes)
    assert all(g is None for w, g in got.items() if w not in wkt)
    feats = [("MultiPoint", [[1, 2], [3, 4]]), ("MultiLineString", [[[0, 0], [1, 1]], [[2, 2], [3, 3]]]), ("GeometryCollection", [])]
    lines = spark.createDataFrame([(json.dumps({"type": "Feature", "properties": {"id": t}, "geometry": {"type": t, "coordinates": c}}),)
                                   for t, c in feats], "value string")
    got = {r.id: r.geom for r in parse_features(lines, StructType([StructField("id", StringType())])).collect()}
    assert got["MultiPoint"].type == "MultiPoint" and got["MultiLineString"].type == "MultiLineString"
    assert [len(x) for x in got["MultiLineString"].parts[0]] == [2, 2] and got["GeometryCollection"] is None


def test_wkt_is_parsed_once_in_the_plan(spark):
    import __spark_entry__ as E
    df = E.queries()["wkt_reproject"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("^[^(]*") == 1


def test_feature_collection_documents(spark, tmp_path):
    from geolake.sources.readers import read_geojson
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"id": str(i)}, "geometry": {"type": "Point", "coordinates": [i, 2]}} for i in range(3)]}
    (tmp_path / "a.geojson").write_text(json.dumps(doc, indent=2))
    rows = read_geojson(spark, str(tmp_path), StructType([StructField("id", StringType())]), line_delimited=False).collect()
    assert sorted((r.id, r.geom.parts[0][0][0].x) for r in rows) == [("0", 0.0), ("1", 1.0), ("2", 2.0)]
