"""OpenStreetMap layers: tag selection, department assignment, geometry and
per-layer tag projection.

Input: one row per OSM element with the Overpass element shape
``type, id, lat, lon, center struct<lat,lon>, tags map<string,string>,
geometry array<struct<lat,lon>>, members array<struct<type,role,geometry>>``
(``sources.read_osm`` / ``sources.parse_osm``).  A layer is a table of
selection rules; each rule is an element type plus tag conditions (a tag
exists, or its value is in a list: the ``~"^(a|b)$"`` form).  The selection
and the box test are what the remote Overpass server evaluated for the
reference; here they are ordinary filters over the whole landed extract.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.text import nonempty
from .departments import departments_of, departments_of_lines, point_array

# --- fixed values -----------------------------------------------------------
# Tag values selected per layer (exact, case-sensitive matches).
SHOP_AMENITIES = ["restaurant", "cafe", "bar", "pub", "fast_food", "bakery",
                  "pharmacy", "bank", "post_office", "fuel",
                  "dentist", "doctors", "veterinary", "hospital", "clinic",
                  "cinema", "theatre", "library",
                  "school", "kindergarten", "college", "university"]
SHOP_LEISURE = ["fitness_centre", "sports_centre", "swimming_pool"]
NIGHT_AMENITIES = ["nightclub", "bar", "pub", "biergarten", "stripclub", "swingerclub",
                   "casino", "gambling", "music_venue"]
NIGHT_LEISURE = ["adult_gaming_centre"]
ROAD_HIGHWAYS = ["motorway", "trunk", "primary", "secondary", "tertiary",
                 "motorway_link", "trunk_link", "primary_link"]
RAIL_LINES = ["rail", "tram", "subway", "light_rail", "narrow_gauge", "monorail"]
RAIL_STATIONS = ["station", "halt", "tram_stop", "subway_entrance"]
AIRPORT_NODES = ["aerodrome", "helipad", "heliport"]
AIRPORT_WAYS = ["aerodrome", "runway", "taxiway", "terminal", "helipad", "heliport", "apron"]
INDUSTRY_MAN_MADE = ["works", "wastewater_plant", "water_works", "gasometer", "chimney",
                     "petroleum_well", "silo", "storage_tank", "pumping_station"]
INDUSTRY_BUILDINGS = ["industrial", "warehouse", "factory"]
GREEN_LEISURE = ["park", "garden", "playground", "dog_park", "nature_reserve"]
GREEN_LANDUSE = ["recreation_ground", "village_green", "forest", "meadow"]
WATERWAYS = ["river", "canal", "stream"]
# Wikidata POI categories, in query order (earlier category wins a duplicate).
WIKI_CATEGORIES = [
    ("tourism", ["museum", "gallery", "hotel", "attraction", "viewpoint"]),
    ("historic", ["monument", "castle", "memorial", "ruins", "archaeological_site", "church"]),
    ("amenity", ["restaurant", "cafe", "bar", "theatre", "cinema", "museum", "place_of_worship"]),
    ("leisure", ["park", "garden", "sports_centre", "stadium"]),
]
# --- end of fixed values ----------------------------------------------------

ADDR = [("addr_street", "addr:street"), ("addr_housenumber", "addr:housenumber"),
        ("addr_postcode", "addr:postcode"), ("addr_city", "addr:city")]


@dataclass(frozen=True)
class Rule:
    """``types``: element types; ``tags``: (key, values or None for 'exists')."""
    types: tuple[str, ...]
    tags: tuple[tuple[str, tuple[str, ...] | None], ...]


def rule(types: str | tuple[str, ...], *tags) -> Rule:
    types = (types,) if isinstance(types, str) else tuple(types)
    norm = tuple((k, None if v is None else (tuple(v) if isinstance(v, (list, tuple)) else (v,)))
                 for k, v in tags)
    return Rule(types, norm)


@dataclass(frozen=True)
class Layer:
    name: str
    rules: tuple[Rule, ...]
    columns: tuple[tuple[str, str], ...]          # (output name, tag key)
    extra: tuple[str, ...] = field(default=())     # derived columns, see build


LAYERS: dict[str, Layer] = {
    "shops": Layer("shops", (
        rule("node", ("shop", None)),
        rule("node", ("amenity", SHOP_AMENITIES)),
        rule("node", ("leisure", SHOP_LEISURE)),
        rule("node", ("healthcare", None))),
        (("name", "name"), ("shop", "shop"), ("amenity", "amenity"), ("leisure", "leisure"),
         ("healthcare", "healthcare"), ("cuisine", "cuisine"), ("brand", "brand"),
         ("opening_hours", "opening_hours"), *ADDR)),
    "nightclubs": Layer("nightclubs", (
        rule("node", ("amenity", NIGHT_AMENITIES)),
        rule("node", ("leisure", NIGHT_LEISURE))),
        (("name", "name"), ("amenity", "amenity"), ("leisure", "leisure"),
         ("opening_hours", "opening_hours"), *ADDR)),
    "transport": Layer("transport", (
        rule("node", ("railway", "station")), rule("node", ("railway", "halt")),
        rule("node", ("station", "subway")), rule("node", ("railway", "tram_stop")),
        rule("node", ("highway", "bus_stop")), rule("node", ("amenity", "bus_station"))),
        (("name", "name"),), ("transport_type", "network", "operator", "line")),
    "railway_stations": Layer("railway_stations", (
        rule("node", ("railway", RAIL_STATIONS)),
        rule("node", ("public_transport", "station"))),
        (("name", "name"), ("railway", "railway"), ("station", "station"),
         ("network", "network"), ("operator", "operator"))),
    "roads": Layer("roads", (rule("way", ("highway", ROAD_HIGHWAYS)),),
        (("name", "name"), ("highway", "highway"), ("lanes", "lanes"),
         ("maxspeed", "maxspeed"), ("surface", "surface"))),
    "railways": Layer("railways", (rule("way", ("railway", RAIL_LINES)),),
        (("name", "name"), ("railway", "railway"), ("operator", "operator"),
         ("service", "service"), ("usage", "usage"), ("electrified", "electrified"),
         ("maxspeed", "maxspeed"), ("tunnel", "tunnel"), ("bridge", "bridge"),
         ("cutting", "cutting"), ("embankment", "embankment"),
         ("noise_barrier", "noise_barrier"))),
    "industry": Layer("industry", (
        rule("way", ("landuse", "industrial")), rule("way", ("landuse", "quarry")),
        rule("way", ("landuse", "port")), rule("way", ("man_made", INDUSTRY_MAN_MADE)),
        rule("way", ("industrial", None)), rule("way", ("building", INDUSTRY_BUILDINGS))),
        (("name", "name"), ("landuse", "landuse"), ("industrial", "industrial"),
         ("man_made", "man_made"), ("building", "building"), ("operator", "operator"))),
    "airports": Layer("airports", (
        rule("node", ("aeroway", AIRPORT_NODES)),
        rule("way", ("aeroway", AIRPORT_WAYS))),
        (("name", "name"), ("aeroway", "aeroway"), ("iata", "iata"), ("icao", "icao"),
         ("operator", "operator")), ("use",)),
    "parking": Layer("parking", (
        rule("node", ("amenity", "parking")), rule("way", ("amenity", "parking")),
        rule("node", ("amenity", "parking_entrance"))),
        (("name", "name"), ("parking_type", "parking"), ("capacity", "capacity"),
         ("fee", "fee"), ("access", "access"))),
    "water": Layer("water", (
        rule("way", ("natural", "water")), rule("relation", ("natural", "water")),
        rule("way", ("waterway", WATERWAYS))),
        (("name", "name"),), ("water_type",)),
    "green_spaces": Layer("green_spaces", (
        rule(("way", "relation"), ("leisure", GREEN_LEISURE)),
        rule(("way", "relation"), ("landuse", GREEN_LANDUSE))),
        (("osm_type", "@type"), ("name", "name"), ("leisure", "leisure"),
         ("landuse", "landuse"), ("access", "access"), ("surface", "surface"))),
    "wiki_pois": Layer("wiki_pois", tuple(
        rule("node", ("wikidata", None), (k, v)) for k, v in WIKI_CATEGORIES),
        (("wikidata_id", "wikidata"), ("name", "name")), ("category",)),
}


def tag(key: str) -> Column:
    """Tag value or NULL when absent (map lookup never raises)."""
    return F.col("tags")[key]


def rule_predicate(r: Rule) -> Column:
    cond = F.col("type").isin(*r.types)
    for key, values in r.tags:
        t = tag(key)
        cond = cond & (t.isNotNull() if values is None else t.isin(*values))
    return F.coalesce(cond, F.lit(False))


def osm_select(df: DataFrame, layer: Layer) -> DataFrame:
    """Keep elements matching any rule of the layer (OR of rules)."""
    cond = None
    for r in layer.rules:
        p = rule_predicate(r)
        cond = p if cond is None else (cond | p)
    return df.where(cond)


def _anchor_lines(zero_is_missing: bool = False) -> Column:
    """Polylines an element is located by: its node position (center
    fallback), its way vertices, or each member's vertices (a relation's
    members are separate lines: no segment joins two members)."""
    lat, lon = F.col("lat"), F.col("lon")
    if zero_is_missing:
        lat, lon = F.when(lat != 0, lat), F.when(lon != 0, lon)
    node_pt = point_array(F.coalesce(lat, F.col("center.lat")),
                          F.coalesce(lon, F.col("center.lon")))
    empty = F.array().cast("array<struct<lat:double,lon:double>>")
    members = F.coalesce(F.transform(F.col("members"), lambda m: F.coalesce(m["geometry"], empty)),
                         F.array().cast("array<array<struct<lat:double,lon:double>>>"))
    return (F.when(F.col("type") == "node", F.array(node_pt))
            .when(F.col("type") == "way", F.array(F.coalesce(F.col("geometry"), empty)))
            .otherwise(members))


def transport_type() -> Column:
    """Station/halt -> train, subway -> metro, tram stop, bus station, else bus stop."""
    return (F.when(tag("railway").isin("station", "halt"), "train_station")
            .when(tag("station") == "subway", "metro_station")
            .when(tag("railway") == "tram_stop", "tram_stop")
            .when(tag("amenity") == "bus_station", "bus_station")
            .otherwise("bus_stop"))


def water_type() -> Column:
    """First non-empty of ``waterway``, ``water``, else ``'water'``."""
    return F.coalesce(nonempty(tag("waterway")), nonempty(tag("water")), F.lit("water"))


def poi_category() -> Column:
    """First non-empty of tourism, amenity, historic, leisure."""
    return F.coalesce(*[nonempty(tag(k)) for k in ("tourism", "amenity", "historic", "leisure")])


def _geometry(layer: str) -> Column:
    lat, lon, pts, t = F.col("lat"), F.col("lon"), F.col("geometry"), F.col("type")
    if layer in ("shops", "nightclubs", "transport", "railway_stations"):
        return F.when(t == "node", G.point(lon, lat))
    if layer in ("roads", "railways"):
        return F.when((t == "way") & pts.isNotNull(), G.line(pts))
    if layer == "industry":
        return F.when((t == "way") & pts.isNotNull(), G.polygon_or_null(pts))
    if layer == "airports":
        return G.feature_geom(t, lat, lon, pts, "polygon_or_line")
    if layer == "parking":
        return G.feature_geom(t, lat, lon, pts, "polygon_or_null")
    if layer == "water":
        return (F.when((t == "way") & pts.isNotNull(), G.polygon_or_line(pts))
                .when((t == "relation") & F.col("members").isNotNull(),
                      G.first_outer_polygon(F.col("members"))))
    if layer == "green_spaces":
        return (F.when((t == "way") & pts.isNotNull(), G.polygon_or_null(pts))
                .when((t == "relation") & F.col("members").isNotNull(),
                      G.multipolygon_from_members(F.col("members"))))
    if layer == "wiki_pois":
        la = F.coalesce(F.when(lat != 0, lat), F.col("center.lat"))
        lo = F.coalesce(F.when(lon != 0, lon), F.col("center.lon"))
        return G.point(lo, la)
    raise KeyError(layer)


def _extra(name: str) -> Column:
    return {
        "transport_type": transport_type(),
        "network": tag("network"),
        "operator": tag("operator"),
        "line": tag("line"),
        "use": F.coalesce(nonempty(tag("aerodrome:type")), nonempty(tag("aerodrome"))),
        "water_type": water_type(),
        "category": poi_category(),
    }[name].alias(name)


def osm_layer(elements: DataFrame, layer_name: str,
              deps: Iterable[str] | None = None, dedupe: bool = False) -> DataFrame:
    """Full layer job: select -> assign departments -> geometry -> projection.

    Rows without a valid geometry are dropped.  An element inside several
    (overlapping) department boxes is emitted once per department; with
    ``dedupe`` once, for the smallest department code.
    """
    layer = LAYERS[layer_name]
    sel = osm_select(elements, layer)
    if layer_name == "wiki_pois":
        sel = sel.where(nonempty(tag("wikidata")).isNotNull())
    anchors = _anchor_lines(zero_is_missing=layer_name == "wiki_pois")
    sel = sel.select("*", _geometry(layer_name).alias("geom"), anchors.alias("_lines")) \
        .where(F.col("geom").isNotNull())
    # Nodes: O(1) grid lookup; ways and relations: vertex or crossing segment.
    node_deps = departments_of(F.get(F.col("_lines"), 0), deps)
    if all(r.types == ("node",) for r in layer.rules):
        found = node_deps
    else:
        found = F.when(F.col("type") == "node", node_deps) \
            .otherwise(departments_of_lines(F.col("_lines"), deps))
    if dedupe:
        found = F.slice(F.array_sort(found), 1, 1)
    rows = sel.select("*", F.explode(found).alias("departement"))
    cols = [F.col("id").alias("osm_id")]
    for out, key in layer.columns:
        cols.append((F.col("type") if key == "@type" else tag(key)).alias(out))
    cols += [_extra(x) for x in layer.extra]
    out = rows.select(*cols, "departement", "geom")
    if layer_name == "wiki_pois":
        out = dedupe_first_seen(rows, layer).select(*cols, "departement", "geom")
    return out


def category_rank() -> Column:
    """Index of the first wiki category query an element matches."""
    expr = None
    for i in reversed(range(len(WIKI_CATEGORIES))):
        k, v = WIKI_CATEGORIES[i]
        p = tag(k).isin(*v)
        expr = F.when(p, F.lit(i)) if expr is None else F.when(p, F.lit(i)).otherwise(expr)
    return expr


def dedupe_first_seen(rows: DataFrame, layer: Layer) -> DataFrame:
    """Per department keep an element only from the first category query that
    returned it.  Rows of that same first category are all kept, as the
    reference updates its seen-set after each whole query.

    One pass: the minimum rank over the few rows of a (department, id), an
    id being one OSM element.
    """
    first = F.min("_rank").over(Window.partitionBy("departement", "id"))
    ranked = rows.withColumn("_rank", category_rank()).withColumn("_first", first)
    return ranked.where(F.col("_rank") == F.col("_first")).drop("_rank", "_first")


def attach_wikidata(pois: DataFrame, entities: DataFrame) -> DataFrame:
    """Left-join POIs to entity enrichment (description, image_url) by QID,
    then keep rows that have a description or an image."""
    ent = entities.select(F.col("qid").alias("wikidata_id"), "description", "image_url")
    return pois.join(ent, "wikidata_id", "left") \
        .where(F.col("description").isNotNull() | F.col("image_url").isNotNull())


__all__ = ["LAYERS", "osm_layer", "osm_select", "attach_wikidata", "dedupe_first_seen",
           "transport_type", "water_type", "poi_category"]
