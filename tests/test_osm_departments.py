import random

from pyspark.sql import functions as F

from geolake.functions.departments import DEP_BBOX
from geolake.operators import osm
from geolake.operators.departments import assign_departments, point_array
from geolake.sources.schemas import OSM_ELEMENT


def test_box_assignment_equals_brute_force(spark):
    rnd = random.Random(3)
    pts = [(i, rnd.uniform(-22, 52), rnd.uniform(-62, 56)) for i in range(3000)]
    pts += [(5000, 48.9, 2.3), (5001, 48.85, 2.30)]   # inside overlapping boxes 75/92/93/94
    df = spark.createDataFrame(pts, "id long, lat double, lon double")
    got = {(r.id, r.departement) for r in
           assign_departments(df, point_array(F.col("lat"), F.col("lon"))).collect()}
    exp = {(i, d) for i, la, lo in pts for d, (s, w, n, e) in DEP_BBOX.items()
           if s <= la <= n and w <= lo <= e}
    assert got == exp
    assert len({d for i, d in got if i == 5001}) >= 2


def _el(**kw):
    base = {"type": None, "id": None, "lat": None, "lon": None, "center": None, "tags": {},
            "geometry": None, "members": None}
    base.update(kw)
    return base


def _pts(*xy):
    return [{"lat": la, "lon": lo} for la, lo in xy]


def test_layer_geometry_rules(spark):
    sq = _pts((48.85, 2.30), (48.85, 2.31), (48.86, 2.31), (48.85, 2.30))
    open4 = _pts((48.85, 2.30), (48.85, 2.31), (48.86, 2.31), (48.86, 2.30))
    rows = [
        _el(type="node", id=1, lat=None, lon=2.3, tags={"shop": "bakery"}),        # no lat
        _el(type="node", id=2, lat=48.85, lon=2.3, tags={"shop": "bakery"}),
        _el(type="way", id=3, tags={"leisure": "park"}, geometry=sq),               # closed
        _el(type="way", id=4, tags={"leisure": "park"}, geometry=open4),            # open: dropped
        _el(type="relation", id=5, tags={"landuse": "forest"}, members=[
            {"type": "way", "ref": 1, "role": "outer", "geometry": sq},
            {"type": "way", "ref": 2, "role": "inner", "geometry": sq},
            {"type": "way", "ref": 3, "role": "outer", "geometry": open4}]),
        _el(type="relation", id=6, tags={"landuse": "forest"}, members=[]),
        _el(type="way", id=7, tags={"waterway": "river"}, geometry=open4[:2]),
        _el(type="way", id=8, tags={"waterway": "river"}, geometry=open4[:1]),
        _el(type="way", id=9, tags={"natural": "water", "water": "lake"}, geometry=sq),
    ]
    df = spark.createDataFrame(rows, OSM_ELEMENT)
    shops = osm.osm_layer(df, "shops", ["75"]).collect()
    assert [r.osm_id for r in shops] == [2]
    green = {r.osm_id: r.geom["type"] for r in osm.osm_layer(df, "green_spaces", ["75"]).collect()}
    assert green == {3: "Polygon", 5: "MultiPolygon"}
    water = {r.osm_id: (r.geom["type"], r.water_type)
             for r in osm.osm_layer(df, "water", ["75"]).collect()}
    assert water == {7: ("LineString", "river"), 9: ("Polygon", "lake")}
    # overlapping boxes: one row per matching department
    deps = {r.departement for r in osm.osm_layer(df, "shops").collect()}
    assert {"75", "92", "93", "94"} <= deps


def test_transport_type_precedence(spark):
    rows = [_el(type="node", id=i, lat=48.85, lon=2.3, tags=t) for i, t in enumerate([
        {"railway": "station", "amenity": "bus_station"}, {"station": "subway", "railway": "tram_stop"},
        {"railway": "tram_stop"}, {"amenity": "bus_station"}, {"highway": "bus_stop"}])]
    df = spark.createDataFrame(rows, OSM_ELEMENT)
    got = {r.osm_id: r.transport_type for r in osm.osm_layer(df, "transport", ["75"]).collect()}
    assert got == {0: "train_station", 1: "metro_station", 2: "tram_stop", 3: "bus_station",
                   4: "bus_stop"}


def test_wiki_first_seen_dedupe_and_center(spark):
    rows = [
        _el(type="node", id=1, lat=0.0, lon=2.3, center={"lat": 48.85, "lon": 2.3},
            tags={"wikidata": "Q1", "tourism": "museum", "amenity": "museum"}),
        _el(type="node", id=2, lat=48.85, lon=2.3, tags={"wikidata": "", "tourism": "museum"}),
        _el(type="node", id=3, lat=48.85, lon=2.3, tags={"wikidata": "Q3", "leisure": "park",
                                                         "historic": "ruins"}),
    ]
    df = spark.createDataFrame(rows, OSM_ELEMENT)
    got = {r.osm_id: r.category for r in osm.osm_layer(df, "wiki_pois", ["75"]).collect()}
    assert got == {1: "museum", 3: "ruins"}


def test_way_crossing_a_box_without_vertex_inside(spark):
    from geolake.operators.departments import departments_of_lines
    # box 75 is lat 48.815..48.905, lon 2.22..2.47; the segment crosses it
    # with both vertices outside every box but 75's neighbours.
    line = [{"lat": 48.86, "lon": 2.0}, {"lat": 48.86, "lon": 2.7}]
    miss = [{"lat": 48.95, "lon": 2.0}, {"lat": 49.2, "lon": 2.2}]
    df = spark.createDataFrame([([line],), ([miss],), ([[line[0]]],)],
                               "l array<array<struct<lat:double,lon:double>>>")
    got = [r[0] for r in df.select(departments_of_lines(F.col("l"), ["75", "92", "93", "94"])).collect()]
    assert "75" in got[0] and got[1] == [] and got[2] == []
    rows = [_el(type="way", id=1, tags={"highway": "primary"}, geometry=line)]
    out = {r.departement for r in osm.osm_layer(spark.createDataFrame(rows, OSM_ELEMENT), "roads",
                                                 ["75"]).collect()}
    assert out == {"75"}
