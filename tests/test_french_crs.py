"""The French systems against forward formulas of their own."""

import math

import pytest
from pyspark.sql import functions as F

from geolake.functions import crs as C
from geolake.functions.geometry import point

PLACES = [(2.2945, 48.8584), (-1.5536, 47.2184), (7.2619, 43.7102), (5.3698, 43.2965), (3.0573, 50.6292), (8.7386, 41.9192), (2.33722917, 46.8)]


def to_geocentric(lon, lat, a, b):
    e2 = 1 - (b / a) ** 2
    v = a / math.sqrt(1 - e2 * math.sin(lat) ** 2)
    return v * math.cos(lat) * math.cos(lon), v * math.cos(lat) * math.sin(lon), v * (1 - e2) * math.sin(lat)


def to_geodetic(x, y, z, a, b):
    e2, p = 1 - (b / a) ** 2, math.hypot(x, y)
    lat = math.atan2(z, p * (1 - e2))
    for _ in range(30):
        v = a / math.sqrt(1 - e2 * math.sin(lat) ** 2)
        lat = math.atan2(z + e2 * v * math.sin(lat), p)
    return math.atan2(y, x), lat, p / math.cos(lat) - a / math.sqrt(1 - e2 * math.sin(lat) ** 2)


def isometric(lat, e):
    return math.atanh(math.sin(lat)) - e * math.atanh(e * math.sin(lat))


def forward(lon, lat, code):
    """(x, y) of WGS84 degrees by the projection's definition."""
    lon, lat = math.radians(lon), math.radians(lat)
    a, f = 6378137.0, 1 / 298.257222101
    b = a * (1 - f)
    if code == 3857:
        return a * lon, a * math.asinh(math.tan(lat))
    if code < 27000:
        lat0 = code - 3900
        one, two, k0, lon0, x0, y0 = lat0 - 0.75, lat0 + 0.75, 1.0, 3.0, 1.7e6, (code - 3941) * 1e6 + 2e5
    else:
        x, y, z = to_geocentric(lon, lat, a, b)
        a, b = 6378249.2, 6356515.0
        lon, lat, _ = to_geodetic(x + 168, y + 60, z - 320, a, b)
        lat0, k0 = {1: (49.5, 0.999877341), 2: (46.8, 0.99987742), 3: (44.1, 0.999877499), 4: (42.165, 0.99994471)}[code % 10]
        one = two = lat0
        lon0 = 2 + 20 / 60 + 14.025 / 3600
        x0, y0 = (600000.0, {27560: 2e5, 27570: 1e6 * (code % 10) + 2e5}[code // 10 * 10]) if code % 10 < 4 else (
            234.358, {27564: 185861.369, 27574: 4185861.369}[code])
    e = math.sqrt(1 - (b / a) ** 2)
    one, two, lat0, lon0 = map(math.radians, (one, two, lat0, lon0))

    def width(p):
        return math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    n = math.sin(one) if one == two else math.log(width(one) / width(two)) / (isometric(two, e) - isometric(one, e))
    big = k0 * a * width(one) / n * math.exp(n * isometric(one, e))

    def radius(p):
        return big * math.exp(-n * isometric(p, e))
    r, theta = radius(lat), n * (lon - lon0)
    return x0 + r * math.sin(theta), y0 + radius(lat0) - r * math.cos(theta)


def test_inverse_of_the_forward_formulas(spark):
    rows = [(code, lon, lat, *forward(lon, lat, code)) for code in C.FRENCH_CODES for lon, lat in PLACES]
    df = spark.createDataFrame(rows, "code int, lon double, lat double, x double, y double")
    got = df.withColumn("g", C.to_wgs84(point(F.col("x"), F.col("y")), F.col("code"), C.FRENCH_CODES)).collect()
    for r in got:
        p = r.g.parts[0][0][0]
        # The shift back of a point at height 0 leaves its height out: a few millimetres.
        assert abs(p.x - r.lon) < 2e-8 and abs(p.y - r.lat) < 2e-8, (r.code, p.x - r.lon, p.y - r.lat)


def test_origins_and_the_datum(spark):
    assert forward(3.0, 46.0, 3946) == pytest.approx((1.7e6, 5.2e6), abs=1e-6)
    df = spark.createDataFrame([(600000.0, 2200000.0)], "x double, y double")
    p = df.select(C.to_wgs84(point(F.col("x"), F.col("y")), 27572).alias("g")).first().g.parts[0][0][0]
    # The Paris meridian at 52 grades: some 50 m from the same numbers on WGS84.
    assert 20 < math.hypot((p.x - C.PARIS) * 76000, (p.y - 46.8) * 111000) < 120


def test_unknown_codes_are_errors(spark):
    with pytest.raises(ValueError):
        C.to_wgs84(F.col("g"), 3951)
    df = spark.createDataFrame([(1.0, 2.0, 27572)], "x double, y double, code int")
    with pytest.raises(Exception, match="unsupported EPSG"):
        df.select(C.to_wgs84(point(F.col("x"), F.col("y")), F.col("code"))).collect()
