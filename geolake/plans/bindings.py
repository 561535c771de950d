"""Bindings: the driver's synthetic tables re-read as the datasets the
operators consume.

Each ``*_input`` function derives an operator input from a driver table with
plain integer arithmetic, so the DuckDB oracle (``oracle.py``) can derive the
same rows independently.  The operator then does the real work on every row
of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table  # noqa: F401  (re-exported)


def _lp(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _dep_code(num: Column) -> Column:
    """1..95 -> department code; 20 (absent in France) stands for Corsica 2A."""
    return F.when(num == 20, F.lit("2A")).otherwise(_lp(num, 2))


# ---------------------------------------------------------------- transactions
def dvf_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as property transactions (one row per mutation line)."""
    li = table(spark, sf_dir, "lineitem")
    dep = _dep_code(F.col("l_suppkey") % 95 + 1)
    parcel = F.concat(dep, _lp(F.col("l_partkey") % 20, 3), F.lit("000A"),
                      F.expr("chr(65 + l_partkey % 4)"), _lp(F.col("l_linenumber"), 4))
    return li.select(
        F.col("l_orderkey").cast("string").alias("id_mutation"),
        F.when(F.col("l_returnflag") == "A",
               F.when(F.col("l_linestatus") == "F",
                      F.lit("Vente en l'état futur d'achèvement")).otherwise(F.lit("Vente")))
         .when(F.col("l_returnflag") == "R", F.lit("Adjudication"))
         .otherwise(F.lit("Echange")).alias("nature_mutation"),
        F.when(F.col("l_tax") != 0, F.col("l_extendedprice")).alias("valeur_fonciere"),
        F.lit("Appartement").alias("type_local"),
        F.when(F.col("l_linenumber") == 7, F.lit(0.0))
         .when(F.col("l_linenumber") == 6, F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity")).alias("surface_reelle_bati"),
        F.when(F.col("l_orderkey") % 37 == 0, F.substring(parcel, 1, 8))
         .otherwise(parcel).alias("id_parcelle"),
        dep.alias("departement"),
    )


# ------------------------------------------------------------------------ OSM
# Tag pairs given to elements (primary by order key, secondary by customer key).
OSM_PRIMARY = [
    ("shop", "bakery"), ("amenity", "restaurant"), ("amenity", "bank"),
    ("leisure", "fitness_centre"), ("healthcare", "doctor"), ("amenity", "parking"),
    ("amenity", "nightclub"), ("amenity", "bar"), ("leisure", "adult_gaming_centre"),
    ("amenity", "casino"), ("railway", "station"), ("railway", "halt"),
    ("station", "subway"), ("railway", "tram_stop"), ("highway", "bus_stop"),
    ("amenity", "bus_station"), ("public_transport", "station"),
    ("railway", "subway_entrance"), ("highway", "primary"), ("highway", "motorway_link"),
    ("highway", "residential"), ("railway", "rail"), ("railway", "tram"),
    ("railway", "abandoned"), ("landuse", "industrial"), ("landuse", "quarry"),
    ("man_made", "works"), ("man_made", "tower"), ("industrial", "factory"),
    ("building", "warehouse"), ("aeroway", "aerodrome"), ("aeroway", "runway"),
    ("aeroway", "helipad"), ("aeroway", "gate"), ("amenity", "parking_entrance"),
    ("natural", "water"), ("waterway", "river"), ("waterway", "stream"),
    ("waterway", "ditch"), ("leisure", "park"), ("leisure", "garden"),
    ("landuse", "forest"), ("landuse", "meadow"), ("landuse", "farmland"),
    ("tourism", "museum"), ("historic", "castle"), ("amenity", "place_of_worship"),
    ("leisure", "stadium"), ("tourism", "hotel"), ("historic", "church"),
    ("amenity", "Restaurant"),
]
OSM_SECONDARY = [
    ("amenity", "bus_station"), ("tourism", "museum"), ("leisure", "park"),
    ("historic", "ruins"), ("aerodrome:type", "public"), ("water", "pond"),
    ("waterway", ""), ("aerodrome", "international"), ("parking", "surface"),
    ("cuisine", "french"), ("addr:street", "Rue Haute"), ("operator", "SNCF"),
]


def _pick(pairs, idx: Column, part: int) -> Column:
    return F.element_at(F.array(*[F.lit(p[part]) for p in pairs]),
                        (idx % len(pairs) + 1).cast("int"))


def _vertex(lat_expr: Column, lon_expr: Column) -> Column:
    return F.struct(lat_expr.alias("lat"), lon_expr.alias("lon"))


def osm_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders (+ their lineitems) as Overpass elements.

    type by order key (way / node / relation); node position from keys;
    way vertices = the order's lines by (line number, part, supplier, price),
    closed for even keys;
    relation members = one small ring per line (closed for even part keys).
    """
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    lat = F.lit(41.0) + ((F.col("l_partkey") * 7 + F.col("l_linenumber")) % 1000) / 100.0
    lon = F.lit(-5.0) + ((F.col("l_suppkey") * 13 + F.col("l_linenumber") * 3) % 1300) / 100.0
    # Flat per-line records are gathered per order (bounded: an order's lines);
    # vertices and member rings are then built from them in place.
    lines = li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(
            "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
            lat.alias("lat"), lon.alias("lon")))).alias("ls"))

    def member(x):
        p = _vertex(x["lat"], x["lon"])
        p1 = _vertex(x["lat"], x["lon"] + 0.01)
        p2 = _vertex(x["lat"] + 0.01, x["lon"] + 0.01)
        ring = F.when(x["l_partkey"] % 2 == 0, F.array(p, p1, p2, p)).otherwise(F.array(p, p1, p2))
        return F.struct(
            F.when(x["l_linenumber"] % 3 == 0, "node").otherwise("way").alias("type"),
            F.when(x["l_linenumber"] % 4 == 0, "inner").otherwise("outer").alias("role"),
            ring.alias("geometry"))

    lines = lines.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.transform("ls", lambda x: _vertex(x["lat"], x["lon"])).alias("pts"),
        F.transform("ls", member).alias("mem"))
    # Both sides grow with the data: a shuffle join, whatever the estimate.
    el = o.join(lines.hint("merge"), "o_orderkey", "left")
    kind = F.col("o_orderkey") % 10
    etype = F.when(kind < 5, "way").when(kind < 8, "node").otherwise("relation")
    k1, v1 = _pick(OSM_PRIMARY, F.col("o_orderkey"), 0), _pick(OSM_PRIMARY, F.col("o_orderkey"), 1)
    k2, v2 = _pick(OSM_SECONDARY, F.col("o_custkey"), 0), _pick(OSM_SECONDARY, F.col("o_custkey"), 1)
    entries = F.array(
        F.struct(k1.alias("key"), v1.alias("value")),
        F.struct(F.when(k2 != k1, k2).alias("key"), v2.alias("value")),
        F.struct(F.lit("name").alias("key"),
                 F.concat(F.lit("el"), F.col("o_orderkey").cast("string")).alias("value")),
        F.struct(F.lit("wikidata").alias("key"),
                 F.when(F.col("o_custkey") % 3 != 0,
                        F.concat(F.lit("Q"), F.expr("o_orderkey div 7").cast("string")))
                 .alias("value")))
    tags = F.map_from_entries(F.filter(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull()))
    closed = F.when(F.col("o_orderkey") % 2 == 0,
                    F.concat("pts", F.array(F.get(F.col("pts"), 0)))).otherwise(F.col("pts"))
    node = etype == "node"
    return el.select(
        etype.alias("type"),
        F.col("o_orderkey").alias("id"),
        F.when(node & (F.col("o_orderkey") % 31 != 0),
               F.lit(41.0) + (F.col("o_custkey") % 1000) / 100.0).alias("lat"),
        F.when(node, F.lit(-5.0) + (F.col("o_orderkey") % 1300) / 100.0).alias("lon"),
        F.struct((F.lit(41.5) + (F.col("o_custkey") % 100) / 100.0).alias("lat"),
                 (F.lit(2.0) + (F.col("o_custkey") % 50) / 100.0).alias("lon")).alias("center"),
        tags.alias("tags"),
        F.when(etype == "way", closed).alias("geometry"),
        F.when(etype == "relation", F.col("mem")).alias("members"),
    )


def entities_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as Wikidata entities (QID = 'Q' || partkey)."""
    p = table(spark, sf_dir, "part")
    desc_t = "map<string,struct<value:string>>"
    k = F.col("p_size") % 4
    descriptions = (
        F.when(k == 0, F.create_map(F.lit("fr"), F.struct(F.col("p_name").alias("value"))))
        .when(k == 1, F.create_map(F.lit("en"), F.struct(F.col("p_type").alias("value"))))
        .when(k == 2, F.create_map(F.lit("fr"), F.struct(F.lit(None).cast("string").alias("value")),
                                   F.lit("en"), F.struct(F.col("p_type").alias("value"))))
        .otherwise(F.create_map().cast(desc_t)))
    snak = F.struct(F.struct(F.struct(
        F.concat_ws(" ", "p_name", "p_brand").alias("value")).alias("datavalue")).alias("mainsnak"))
    p18 = F.when(F.col("p_partkey") % 3 == 0, F.array().cast(
        "array<struct<mainsnak:struct<datavalue:struct<value:string>>>>")).otherwise(F.array(snak))
    return p.select(
        F.concat(F.lit("Q"), F.col("p_partkey").cast("string")).alias("qid"),
        (F.col("p_partkey") % 13 == 0).alias("missing"),
        descriptions.cast(desc_t).alias("descriptions"),
        F.struct(p18.alias("P18")).alias("claims"))


# ------------------------------------------------------------ commune codes
def dep_num_code(num: Column) -> Column:
    """1..96 -> department code: 20 stands for 2A, 96 for overseas 971."""
    return (F.when(num == 96, F.lit("971")).when(num == 20, F.lit("2A"))
            .otherwise(_lp(num, 2)))


def commune_code(k: Column) -> Column:
    """Key -> 5-character commune code (department + serial); unique per key
    below 96 000 (9 600 for the overseas department)."""
    num = k % 96 + 1
    dep = dep_num_code(num)
    serial = F.floor(k / 96) % F.when(num == 96, F.lit(100)).otherwise(F.lit(1000))
    return F.concat(dep, F.lpad(serial.cast("string"), 5, "0").substr(F.length(dep) + 1, F.lit(5)))


# ------------------------------------------------------------- crime / rents
CRIME_INDICATORS = {
    "1-URGENT": "Coups et blessures volontaires",
    "2-HIGH": "Vols d'accessoires sur véhicules",
    "3-MEDIUM": "Destructions et dégradations volontaires",
    "4-NOT SPECIFIED": "Cambriolages de logement",
    "5-LOW": "Usage de stupéfiants",
}
CRIME_YEAR = 1997
CRIME_DEPS = [f"{i:02d}" for i in range(1, 61) if i != 20] + ["2A", "971"]


def _case_map(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def crime_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as the crime-statistics file (text fields, decimal comma)."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rate = (F.when(k % 11 == 0, F.lit("ndiff"))
            .when(k % 13 == 0, F.lit(None).cast("string"))
            .when(k % 17 == 0, F.lit("1.5d"))
            .otherwise(F.concat((k % 1000).cast("string"), F.lit(","), _lp(c % 100, 2))))
    return o.select(
        commune_code(c).alias("CODGEO_2025"),
        F.year("o_orderdate").alias("annee"),
        _case_map(F.col("o_orderpriority"), CRIME_INDICATORS).alias("indicateur"),
        rate.alias("taux_pour_mille"),
        F.when(k % 7 != 0, (c % 50).cast("string")).alias("nombre"),
        k.alias("ordinal"))


RENT_TYPES = ["apartment_all", "apartment_t1_t2", "apartment_t3_plus", "house"]
RENT_DEPS = [f"{i:02d}" for i in range(1, 51) if i != 20] + ["2A", "971"]


def rents_inputs(spark: SparkSession, sf_dir: str, vintage: int = 0) -> dict[str, DataFrame]:
    """part as the four rent-indicator files (one per property type)."""
    p = table(spark, sf_dir, "part")
    k, s = F.col("p_partkey"), F.col("p_size")
    code = commune_code(k)
    out = {}
    for i, t in enumerate(RENT_TYPES):
        j = i + vintage
        out[t] = p.select(
            code.alias("INSEE_C"),
            code.substr(1, 3).alias("_c3"),
            F.when(k % 41 == 0, F.lit("NA"))
             .otherwise(F.concat((s + j * 3).cast("string"), F.lit(","), (k % 10).cast("string")))
             .alias("loypredm2"),
            F.concat(s.cast("string"), F.lit(","), ((k + j) % 10).cast("string")).alias("lwr.IPm2"),
            F.concat((s + 5 + j).cast("string"), F.lit(",5")).alias("upr.IPm2"),
            F.when(s % 3 == 0, "commune").otherwise("maille").alias("TYPPRED"),
            (s * 7 + j).cast("string").alias("nbobs_com"),
            F.concat(F.lit("0,"), _lp((k + j) % 100, 2)).alias("R2_adj"),
        ).withColumn("DEP", F.when(F.col("_c3") == "971", "971")
                     .otherwise(F.col("_c3").substr(1, 2))).drop("_c3")
    return out


# ------------------------------------------------------------------ climate
CLIMATE_START_YEAR = 1998


def meteo_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as monthly station records (one station per supplier)."""
    li = table(spark, sf_dir, "lineitem")
    s, n = F.col("l_suppkey"), F.col("l_linenumber")
    return li.select(
        dep_num_code(s % 96 + 1).alias("departement"),
        s.alias("NUM_POSTE"),
        F.concat(F.lit("STATION_"), s.cast("string")).alias("NOM_USUEL"),
        F.when(s % 23 != 0, F.lit(42.0) + (s % 9)).alias("LAT"),
        F.when(s % 29 == 0, F.lit(0.0)).otherwise(F.lit(-4.0) + (s % 11)).alias("LON"),
        F.when(s % 31 != 0, s * 10.0).alias("ALTI"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("AAAAMM"),
        F.col("l_quantity").alias("TX"),
        (F.col("l_tax") * 100).alias("TN"),
        F.when(n != 3, F.col("l_extendedprice") / 100).alias("TXAB"),
        F.when(n != 1, n.cast("double")).alias("NBJTX25"),
        F.when(s % 5 != 0, (n % 3).cast("double")).alias("NBJTX30"),
        F.when(s % 3 != 0, (n % 2).cast("double")).alias("NBJTX35"))


# ------------------------------------------------------------------- storms
STORM_DEPS = [f"{i:02d}" for i in range(1, 41) if i != 20] + ["2A", "971"]
STORM_LABEL_OF = {"1-URGENT": "Tempête", "2-HIGH": "Vents Cycloniques",
                  "3-MEDIUM": "Inondations et coulées de boue"}


def catnat_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as natural-disaster declarations (all text)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.when(k % 19 != 0, commune_code(F.col("o_custkey"))).alias("cod_commune"),
        _case_map(F.col("o_orderpriority"), STORM_LABEL_OF, "Mouvements de terrain")
        .alias("lib_risque_jo"),
        F.when(k % 23 == 0, F.lit("not a date"))
         .when(k % 29 == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("dat_deb"))


def communes_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as commune geometries (one point per commune code)."""
    from ..functions.geometry import point
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    code = commune_code(k)
    return c.select(
        code.alias("code_commune"),
        F.concat(F.lit("Commune "), k.cast("string")).alias("nom_commune"),
        dep_num_code(k % 96 + 1).alias("departement"),
        point(F.lit(-5.0) + (k % 1300) / 100.0, F.lit(41.0) + (k % 1000) / 100.0).alias("geom"))


# ------------------------------------------------------------------ hazards
def _square(lon: Column, lat: Column, d: float = 0.01) -> Column:
    from ..functions.geometry import xy
    ring = F.array(xy(lon, lat), xy(lon + d, lat), xy(lon + d, lat + d), xy(lon, lat + d),
                   xy(lon, lat))
    return F.struct(F.lit("Polygon").alias("type"), F.array(F.array(ring)).alias("parts"))


def wind_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    v = _case_map(F.col("p_size") % 6, {0: 22, 1: 24, 2: 26, 3: 28, 4: 25})
    return p.select(v.alias("V_B0"),
                    _square(F.lit(-5.0) + (k % 1300) / 100.0, F.lit(41.0) + (k % 1000) / 100.0)
                    .alias("geom"))


def l93_point_geom(k: Column) -> Column:
    """A Lambert-93 point per key on a 5 km grid around the projection origin."""
    from ..functions.geometry import xy
    x = F.lit(700000.0) + (k % 40) * 5000.0
    y = F.lit(6500000.0) + (F.floor(k / 40) % 40) * 5000.0
    return F.struct(F.lit("Point").alias("type"), F.array(F.array(F.array(xy(x, y)))).alias("parts"))


def flood_layers(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """part as two flood-zone layers in Lambert-93; only the first has
    ``cours_deau``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    base = p.select(
        k,
        _case_map(F.col("p_size") % 5, {0: "01", 1: "02", 2: "03", 3: "04"}).alias("typ_inond"),
        _case_map(k % 6, {0: "01For", 1: "02Moy", 2: "03Mcc", 3: "04Fai", 4: "05Xxx"}).alias("scenario"),
        F.concat(F.lit("TRI_"), F.col("p_brand")).alias("id_tri"),
        dep_num_code(k % 96 + 1).alias("departement"),
        l93_point_geom(k).alias("geom"),
        F.concat(F.lit("river "), F.col("p_brand")).alias("cours_deau"))
    a = base.where(k % 2 == 0).drop("p_partkey")
    b = base.where(k % 2 == 1).drop("p_partkey", "cours_deau")
    return [a, b]


CLAY_DEPS = [f"{i:02d}" for i in range(1, 51) if i != 20] + ["2A", "971"]


def clay_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    dpt = (F.when(k % 7 == 0, F.lit("2A")).when(k % 7 == 1, F.lit("971"))
           .otherwise((k % 95 + 1).cast("string")))
    return p.select(dpt.alias("DPT"), (F.col("p_size") % 5).alias("NIVEAU"),
                    l93_point_geom(k).alias("geom"))


# ---------------------------------------------------------------- sections
def sections_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as cadastral-section features (GeoJSON properties + geometry)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    dep = _dep_code(k % 95 + 1)
    commune = F.concat(dep, _lp(F.floor(k / 95) % 20, 3))
    letter = F.expr("chr(65 + floor(p_partkey / 1900) % 4)")
    return p.select(
        F.concat(commune, F.lit("000A"), letter).alias("id"),
        commune.alias("commune"), F.lit("000").alias("prefixe"),
        F.concat(F.lit("A"), letter).alias("code"), dep.alias("departement"),
        _square(F.lit(-5.0) + (k % 1300) / 100.0, F.lit(41.0) + (k % 1000) / 100.0).alias("geom"))


LOOKUP_COMMUNE = "01005"
PRICE_PREFIX = "01005"


# --------------------------------------------------------------------- DPE
DPE_DEPS = [f"{i:02d}" for i in range(1, 71) if i != 20] + ["2A", "971"]


def dpe_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as energy-diagnostic records with a text geopoint."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    lat = F.concat((F.lit(43) + k % 5).cast("string"), F.lit("."), _lp(k % 100, 2))
    lon = F.concat((k % 7).cast("string"), F.lit("."), (k % 10).cast("string"))
    gp = (F.when(k % 6 == 0, F.lit("x,2")).when(k % 6 == 1, F.lit("1"))
          .when(k % 6 == 2, F.lit("")).when(k % 6 == 3, F.lit(None).cast("string"))
          .otherwise(F.concat(lat, F.lit(","), lon)))
    return c.select(
        F.concat(F.lit("DPE"), k.cast("string")).alias("numero_dpe"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "immeuble")
         .otherwise("maison").alias("type_batiment"),
        F.expr("chr(65 + c_custkey % 7)").alias("etiquette_dpe"),
        dep_num_code(k % 96 + 1).alias("code_departement_ban"),
        gp.alias("_geopoint"))


# --------------------------------------------------------------- buildings
def _l93_xy(k: Column) -> tuple[Column, Column]:
    return (F.lit(650000) + (k % 50) * 2000, F.lit(6550000) + (F.floor(k / 50) % 50) * 2000)


def building_geo_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as a building table with WKT geometry in Lambert-93 (points,
    polygons, polygons with a hole, multipolygons, empty and NA text)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    x0, y0 = _l93_xy(k)

    def v(x, y):
        return F.concat_ws(" ", x.cast("string"), y.cast("string"))

    x1, y1 = x0 + 1000, y0 + 1000
    sq = F.concat_ws(", ", v(x0, y0), v(x1, y0), v(x1, y1), v(x0, y0))
    sq2 = F.concat_ws(", ", v(x0 + 3000, y0), v(x1 + 3000, y0), v(x1 + 3000, y1), v(x0 + 3000, y0))
    outer = F.concat_ws(", ", v(x0, y0), v(x1, y0), v(x1, y1), v(x0, y1), v(x0, y0))
    hole = F.concat_ws(", ", v(x0 + 100, y0 + 100), v(x0 + 200, y0 + 100),
                       v(x0 + 200, y0 + 200), v(x0 + 100, y0 + 100))
    kind = F.col("p_size") % 5
    wkt = (F.when(kind == 0, F.concat(F.lit("POINT ("), v(x0, y0), F.lit(")")))
           .when(kind == 1, F.concat(F.lit("POLYGON (("), sq, F.lit("))")))
           .when(kind == 2, F.concat(F.lit("POLYGON (("), outer, F.lit("), ("), hole, F.lit("))")))
           .when(kind == 3, F.concat(F.lit("MULTIPOLYGON ((("), sq, F.lit(")), (("), sq2, F.lit(")))")))
           .when(k % 2 == 0, F.lit("")).otherwise(F.lit("NA")))
    return p.select(
        F.concat(F.lit("BG"), k.cast("string")).alias("batiment_groupe_id"),
        F.when(k % 29 == 0, F.lit("NA")).otherwise(dep_num_code(k % 96 + 1))
        .alias("code_departement_insee"),
        F.lit("x").alias("s_geom_groupe"),
        wkt.alias("WKT"))


def building_star_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """orders as buildings; their lines 1 to 7 as the seven satellite tables."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    bid = F.concat(F.lit("BG"), F.col("o_orderkey").cast("string"))
    buildings = o.select(bid.alias("batiment_groupe_id"),
                         dep_num_code(F.col("o_custkey") % 96 + 1).alias("code_departement_insee"),
                         F.col("o_orderstatus").alias("etat"))
    lid = F.concat(F.lit("BG"), F.col("l_orderkey").cast("string")).alias("batiment_groupe_id")
    sats = {
        "construction": li.where(F.col("l_linenumber") == 1).select(
            lid, F.year("l_shipdate").alias("annee"), F.col("l_returnflag").alias("materiau")),
        "energy_dpe": li.where(F.col("l_linenumber") == 2).select(
            lid, F.col("l_linestatus").alias("classe"), (F.col("l_quantity") * 10).alias("conso")),
        "natural_risks": li.where(F.col("l_linenumber") == 3).select(
            lid, (F.col("l_discount") > 0.05).alias("alea_fort")),
        "property_values": li.where(F.col("l_linenumber") == 4).select(
            lid, F.col("l_extendedprice").alias("valeur")),
        "coproperty": li.where(F.col("l_linenumber") == 5).select(
            lid, F.col("l_partkey").alias("nb_lots")),
        "social_housing": li.where(F.col("l_linenumber") == 6).select(
            lid, F.col("l_suppkey").alias("bailleur"), F.col("l_tax").alias("part_sociale")),
        "addresses": li.where(F.col("l_linenumber") == 7).select(
            lid, F.concat(F.lit("Rue "), F.col("l_suppkey").cast("string")).alias("libelle")),
    }
    return buildings, sats


# -------------------------------------------------------- layers and K1
def icu_layers(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """supplier (Lambert-93) and customer (WGS84) as heat-island layers with
    different attribute columns."""
    from ..functions.geometry import point
    s = table(spark, sf_dir, "supplier")
    c = table(spark, sf_dir, "customer")
    a = s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nom"),
                 F.col("s_acctbal").alias("score"), l93_point_geom(F.col("s_suppkey")).alias("geom"),
                 F.lit(2154).alias("src_epsg"))
    k = F.col("c_custkey")
    b = c.select(k.alias("id"), F.col("c_mktsegment").alias("categorie"),
                 point(F.lit(-5.0) + (k % 1300) / 100.0, F.lit(41.0) + (k % 1000) / 100.0).alias("geom"),
                 F.lit(4326).alias("src_epsg"))
    return [a, b]


def erosion_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as coastline segments (Lambert-93 two-point lines)."""
    from ..functions.geometry import xy
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    x = F.lit(700000.0) + (k % 40) * 5000.0
    y = F.lit(6500000.0) + (F.floor(k / 40) % 40) * 5000.0
    g = F.struct(F.lit("LineString").alias("type"),
                 F.array(F.array(F.array(xy(x, y), xy(x + 500.0, y + 500.0)))).alias("parts"))
    return s.select(k.alias("id_trait"), "s_name", F.col("s_acctbal").alias("taux"), g.alias("geom"))


#: No supplier or order has a department overseas: requested, but absent.
K1_REQUESTED = [f"{i:02d}" for i in range(1, 31) if i != 20] + ["971"]


def k1_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """supplier as an existing department table and as a new load of the
    requested departments."""
    s = table(spark, sf_dir, "supplier")
    dep = dep_num_code(F.col("s_suppkey") % 96 + 1)
    old = s.select(dep.alias("departement"), "s_suppkey", "s_name", F.lit("old").alias("vintage"))
    new = s.select(
        dep.alias("departement"), "s_suppkey", "s_name", F.lit("new").alias("vintage")) \
        .where(F.col("departement").isin(K1_REQUESTED))
    return old, new


def k6_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, int]:
    """orders as a table of several years, and a load of one year whose rows
    also hold departments that were not requested."""
    year = 1996
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", dep_num_code(F.col("o_custkey") % 96 + 1).alias("departement"),
        F.year("o_orderdate").alias("year"))
    old = o.select("*", F.lit("old").alias("vintage"))
    new = o.select(
        "o_orderkey", "departement", F.lit(year).alias("year"), F.lit("new").alias("vintage"))
    return old, new, year


# ---------------------------------------------------------------- planning
PLU_DEPS = [f"{i:02d}" for i in range(1, 96) if i != 20] + ["2A", "971"]
ZONE_TYPES = ["U", "AUc", "AUs", "AU", "A", "N", "Uh", "AUs1", "AUS", "1AU", "ua", "", None, "Nh2"]


def plu_communes_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as the commune list of each department."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(commune_code(k).alias("code_commune"),
                    dep_num_code(k % 96 + 1).alias("departement"))


def plu_documents_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as planning documents (even commune keys only are covered)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    grid = commune_code((F.floor(k / 7) % 150) * 2)
    return o.select(
        grid.alias("grid_name"),
        _case_map(k % 4, {0: "PLU", 1: "PLUi", 2: "CC"}).alias("du_type"),
        F.when(k % 11 == 0, F.concat(F.lit("DU_99"), grid))
         .otherwise(F.concat(F.lit("DU_"), grid)).alias("partition"),
        k.alias("gid"))


def _zone_type(idx: Column) -> Column:
    expr = None
    for i, v in enumerate(ZONE_TYPES):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(idx == i, lit) if expr is None else expr.when(idx == i, lit)
    return expr


def plu_zone_layers(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """part as zoning features downloaded per commune; only the first layer
    has ``destdomi``; ``datappro``/``urlfic`` are absent everywhere."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    ck = k % 200
    base = p.select(
        k, commune_code(ck).alias("commune"), dep_num_code(ck % 96 + 1).alias("departement"),
        _zone_type(F.col("p_size") % 14).alias("typezone"),
        F.col("p_name").alias("libelle"), F.col("p_type").alias("libelong"),
        F.concat(F.lit("DOC_"), (k % 50).cast("string")).alias("idurba"),
        F.col("p_brand").alias("destdomi"), l93_point_geom(k).alias("geom"))
    return [base.where(k % 2 == 0).drop("p_partkey"),
            base.where(k % 2 == 1).drop("p_partkey", "destdomi")]


def plu_prescription_layers(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """part as prescription features; ``stypepsc`` only in the first layer."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    ck = (k * 3) % 200
    base = p.select(
        k, commune_code(ck).alias("commune"), dep_num_code(ck % 96 + 1).alias("departement"),
        _lp(F.col("p_size") % 30, 2).alias("typepsc"), F.col("p_name").alias("libelle"),
        F.col("p_type").alias("stypepsc"), l93_point_geom(k).alias("geom"))
    return [base.where(k % 3 == 0).drop("p_partkey"),
            base.where(k % 3 != 0).drop("p_partkey", "stypepsc")]


# ------------------------------------------------------------- atmo feeds
AIR_DEPS = [f"{i:02d}" for i in range(1, 61) if i != 20] + ["971"]
QUAL_LABELS = {0: "Bon", 1: "Moyen", 2: "Dégradé", 3: "Mauvais", 4: "Très mauvais",
               5: "Extrêmement mauvais"}


def air_features_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as air-quality features (properties struct + file order)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    zk = k % 700
    q = F.col("c_nationkey") % 6
    props = F.struct(
        commune_code(zk).alias("code_zone"),
        F.concat(F.lit("Zone "), zk.cast("string")).alias("lib_zone"),
        q.alias("code_qual"), _case_map(q, QUAL_LABELS).alias("lib_qual"),
        (k % 5).alias("code_no2"), (k % 4).alias("code_o3"), (k % 6).alias("code_pm10"),
        (k % 3).alias("code_pm25"), (k % 2).alias("code_so2"),
        F.lit("atmo").alias("source"), F.lit("2024-01-15").alias("date_ech"),
        F.when(k % 17 != 0, F.lit(-5.0) + (k % 1300) / 100.0).alias("x_wgs84"),
        (F.lit(41.0) + (k % 1000) / 100.0).alias("y_wgs84"))
    return c.select(props.alias("properties"), k.alias("ordinal"))


def pollen_features_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as pollen features (NULL properties for some)."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    zk = (F.col("user_id") * 7 + i % 3) % 800
    props = F.struct(
        commune_code(zk).alias("code_zone"),
        F.concat(F.lit("Zone "), zk.cast("string")).alias("lib_zone"),
        (i % 6).alias("code_qual"), _case_map(i % 6, QUAL_LABELS).alias("lib_qual"),
        (F.col("value") > 100).alias("alerte"), F.col("event_type").alias("pollen_resp"),
        (i % 5).alias("code_boul"), (i % 4).alias("code_gram"), (i % 3).alias("code_oliv"),
        (i % 6).alias("code_ambr"), (i % 2).alias("code_arm"), (i % 7).alias("code_aul"),
        (F.col("value") * 2).alias("conc_boul"), (F.col("value") * 3).alias("conc_gram"),
        (F.col("value") * 4).alias("conc_oliv"), (F.col("value") * 5).alias("conc_ambr"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_ech"), F.lit("atmo").alias("source"))
    return e.select(F.when(i % 50 != 0, props).alias("properties"))


# ------------------------------------------------------- geometry and CRS
PROJECTED = [2975, 5490, 2972, 4471, 4559, 2154, 4326, None]


def projected_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as points of several source CRS (one undeclared)."""
    from ..functions.geometry import point
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    code = F.get(F.array(*[F.lit(c).cast("int") for c in PROJECTED]), (k % len(PROJECTED)).cast("int"))
    geographic = code.isNull() | (code == 4326)
    x = F.when(geographic, (k % 300) / 10.0 - 15).otherwise(F.lit(300000.0) + (k % 400) * 1000.0)
    y = (F.when(geographic, (k % 170) / 2.0 - 40)
         .when(code.isin(2975, 4471), F.lit(7600000.0) + (k % 900) * 700.0)
         .when(code == 2154, F.lit(6300000.0) + (k % 700) * 1000.0)
         .otherwise(F.lit(300000.0) + (k % 1500) * 1000.0))
    return p.select("p_partkey", code.alias("src_epsg"), point(x, y).alias("geom"))


def multi_geometry_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as WKT and GeoJSON texts of multi-points and multi-lines."""
    p = table(spark, sf_dir, "part")
    k, n = F.col("p_partkey"), F.col("p_size")
    a = [F.concat_ws(" ", (k + i).cast("string"), (n * i).cast("string")) for i in range(5)]
    j = [F.concat(F.lit("["), (k + i).cast("string"), F.lit(","), (n * i).cast("string"), F.lit("]")) for i in range(5)]
    kind = k % 4
    wkt = (F.when(kind == 0, F.concat(F.lit("MULTIPOINT ("), F.concat_ws(", ", *a[:3]), F.lit(")")))
           .when(kind == 1, F.concat(F.lit("MULTIPOINT (("), F.concat_ws("), (", *a[:4]), F.lit("))")))
           .when(kind == 2, F.concat(F.lit("MULTILINESTRING (("), F.concat_ws(", ", *a[:2]), F.lit("), ("),
                                     F.concat_ws(", ", *a[2:]), F.lit("))")))
           .otherwise(F.lit("GEOMETRYCOLLECTION (POINT (1 2))")))

    def feature(t: str, coords: Column) -> Column:
        return F.concat(F.lit('{"type":"' + t + '","coordinates":'), coords, F.lit("}"))

    def array(*items: Column) -> Column:
        return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))
    geojson = (F.when(kind == 0, feature("MultiPoint", array(*j[:3]))).when(kind == 1, feature("MultiPoint", array(*j[:4])))
               .when(kind == 2, feature("MultiLineString", array(array(*j[:2]), array(*j[2:]))))
               .otherwise(F.lit('{"type":"GeometryCollection","geometries":[]}')))
    return p.select("p_partkey", wkt.alias("wkt"), geojson.alias("geojson"))


# ------------------------------------------------------------------ raster
# Grids of differing size and resolution: department, columns, a, e, c, f.
DEM_GRIDS = [("75", 40, 1 / 1200, -1 / 1200, 2.2, 48.9), ("2A", 23, 1 / 800, -1 / 800, 8.5, 43.1),
             ("971", 31, 1 / 1000, -1 / 1000, -61.8, 16.5)]


def dem_cells_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as elevation cells of three departments' grids: every tenth cell
    is also covered by a second tile, some cells by the second tile only and
    some by none, and some hold nodata."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    i = (k % len(DEM_GRIDS)).cast("int")
    j = F.expr(f"p_partkey div {len(DEM_GRIDS)}")
    dep = F.get(F.array(*[F.lit(g[0]) for g in DEM_GRIDS]), i)
    width = F.get(F.array(*[F.lit(g[1]) for g in DEM_GRIDS]), i)
    row, col = F.floor(j / width), j % width
    z = (F.when(k % 97 == 0, F.lit(-9999.0))
         .when(row < 25, (F.floor(F.col("p_size") / 17) * 20).cast("double"))
         .otherwise((F.abs(row - 37) * 3 + F.abs(col - 20) * 2).cast("double")))
    cells = p.select(dep.alias("departement"), j.alias("j"), row.cast("int").alias("row"), col.cast("int").alias("col"),
                     z.alias("z"), (k % 10 == 0).alias("twice"))
    absent = F.col("j") % 53 == 7
    base = cells.where(~absent).select("departement", F.lit(0).alias("tile_rank"), "row", "col", "z")
    over = cells.where(F.col("twice") | (absent & (F.col("j") % 2 == 0))).select(
        "departement", F.lit(1).alias("tile_rank"), "row", "col", (F.col("z") + 500.0).alias("z"))
    return base.unionByName(over)


def dem_grid_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grids, as high as the part keys reach (absent cells included)."""
    top = table(spark, sf_dir, "part").agg(F.max("p_partkey").alias("k"))
    rows = spark.createDataFrame([(i, *g) for i, g in enumerate(DEM_GRIDS)],
                                 "i int, departement string, ncols int, a double, e double, c double, f double")
    n = len(DEM_GRIDS)
    last = F.expr(f"(k - pmod(k - i, {n}) - i) div {n}")   # the department's last cell
    return rows.join(F.broadcast(top)).select(
        "departement", "a", "e", "c", "f", (F.floor(last / F.col("ncols")) + 1).cast("int").alias("nrows"), "ncols")


TILE_SIDE = 20


def dem_tiles_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """part as cells of 1-degree tiles of 20 x 20 pixels (some tiles absent),
    and boxes over all of them that cut through some."""
    p = table(spark, sf_dir, "part")
    tile = F.expr(f"p_partkey div {TILE_SIDE * TILE_SIDE}")
    at = F.col("p_partkey") % (TILE_SIDE * TILE_SIDE)
    cells = p.select((F.lit(43) + tile % 3).cast("int").alias("lat"), (F.lit(1) + F.expr(f"(p_partkey div {TILE_SIDE * TILE_SIDE}) div 3")).cast("int").alias("lon"),
                     F.floor(at / TILE_SIDE).cast("int").alias("row"), (at % TILE_SIDE).cast("int").alias("col"),
                     F.col("p_retailprice").alias("z"))
    # A box for every two tile columns, as far as the part keys reach, whose
    # edges cut through tiles and overlap the next box's.
    last = p.agg(F.max(F.expr(f"(p_partkey div {TILE_SIDE * TILE_SIDE}) div 6")).alias("n"))
    i = F.col("i").cast("double")
    boxes = last.select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("n"))).alias("i")).select(
        F.concat(F.lit("B"), F.col("i").cast("string")).alias("departement"), F.lit(42.81).alias("south"),
        (F.lit(0.77) + i * 2.0).alias("west"), F.lit(46.12).alias("north"), (F.lit(3.31) + i * 2.0).alias("east"))
    return cells, boxes


def boxes_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as bounding boxes (south, west, north, east)."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    south = F.lit(-20.0) + (k % 700) / 10.0
    west = F.lit(-60.0) + (k % 1200) / 10.0
    return s.select(F.concat(F.lit("B"), k.cast("string")).alias("departement"),
                    south.alias("south"), west.alias("west"),
                    (south + (k % 3) * 0.7).alias("north"), (west + (k % 4) * 0.6).alias("east"))


def french_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as points in the French systems, a code each in turn."""
    from ..functions import crs as C
    from ..functions.geometry import xy
    k, codes = F.col("p_partkey"), C.FRENCH_CODES
    place = {c: (C.conic(c).x0, C.conic(c).y0) if C.conic(c) else (250000.0, 5900000.0) for c in codes}
    code, x0, y0 = (F.array(*map(F.lit, v)) for v in (codes, *zip(*(place[c] for c in codes))))
    at = (k % len(codes)).cast("int")
    step = F.expr(f"p_partkey div {len(codes)}")
    x = F.get(x0, at) + ((step % 41) - 20) * 10000.0
    y = F.get(y0, at) + ((F.expr(f"p_partkey div {41 * len(codes)}") % 31) - 15) * 10000.0
    point = F.struct(F.lit("Point").alias("type"), F.array(F.array(F.array(xy(x, y)))).alias("parts"))
    return table(spark, sf_dir, "part").select("p_partkey", F.get(code, at).alias("src_epsg"), point.alias("geom"))


def box_assign_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """customer as elements of one or two places, a third of them at one spot;
    supplier as boxes from a street to the world, overlapping."""
    k = F.col("c_custkey")
    lat = F.when(k % 3 == 0, F.lit(45.5)).otherwise(F.lit(41.0) + (k * 37 % 11000) / 1000.0)
    lon = F.when(k % 3 == 0, F.lit(2.25)).otherwise(F.lit(-5.0) + (k * 53 % 14000) / 1000.0)
    one, two = F.struct(lat.alias("lat"), lon.alias("lon")), F.struct((lat + 1.5).alias("lat"), (lon + 0.5).alias("lon"))
    places = F.when(k % 7 == 0, F.array(one, two)).when(k % 11 == 0, F.array(two, one, two)).otherwise(F.array(one))
    rows = table(spark, sf_dir, "customer").select(k.alias("c_custkey"), places.alias("places"))
    s = F.col("s_suppkey")
    south, west = F.lit(41.0) + (s * 7 % 110) / 10.0, F.lit(-5.0) + (s * 13 % 140) / 10.0
    side = F.when(s % 5 == 0, F.lit(0.0)).when(s % 5 == 1, F.lit(0.0009)).when(s % 5 == 2, F.lit(0.3)).otherwise(F.lit(0.05))
    world = s % 997 == 1
    boxes = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("B"), s.cast("string")).alias("departement"),
        F.when(world, F.lit(-90.0)).otherwise(south).alias("south"), F.when(world, F.lit(-180.0)).otherwise(west).alias("west"),
        F.when(world, F.lit(90.0)).otherwise(south + side).alias("north"),
        F.when(world, F.lit(180.0)).otherwise(west + side * 2.0).alias("east"))
    return rows, boxes


# --------------------------------------------------------------- text forms
def commune_feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as line-delimited GeoJSON commune features (text)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    lon, lat = (k % 800) / 100.0, F.lit(41.0) + (k % 1000) / 100.0

    def p(x, y):
        return F.array(x, y)
    ring = F.array(p(lon, lat), p(lon + 0.01, lat), p(lon + 0.01, lat + 0.01), p(lon, lat))
    feat = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(commune_code(k).alias("id"),
                 F.concat(F.lit("Commune "), k.cast("string")).alias("nom"),
                 dep_num_code(k % 96 + 1).alias("departement")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    return c.select(F.to_json(feat).alias("value"))


def osm_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The OSM elements serialised one JSON object per line."""
    el = osm_input(spark, sf_dir)
    return el.select(F.to_json(F.struct(*el.columns)).alias("value"))


def ledger_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as ';'-separated records with decimal-comma amounts."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    amount = F.when(k % 9 == 0, F.lit("n/a")).otherwise(
        F.concat((k * 37 % 100000).cast("string"), F.lit(","), _lp(k % 100, 2)))
    return c.select(F.concat_ws(";", commune_code(k), F.col("c_name"), amount,
                                F.col("c_mktsegment")).alias("value"))


def entity_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities serialised as API batch documents of 20 entities each."""
    ent = entities_input(spark, sf_dir)
    doc = F.struct(F.when(F.col("missing"), F.lit("")).alias("missing"),
                   "descriptions", "claims")
    batch = F.floor(F.substring("qid", 2, 20).cast("long") / 20)
    return (ent.groupBy(batch.alias("b"))
            .agg(F.map_from_entries(F.collect_list(F.struct("qid", doc))).alias("entities"))
            .select(F.to_json(F.struct("entities")).alias("value")))


def dpe_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DPE records serialised as result pages of 50 records."""
    d = dpe_input(spark, sf_dir).withColumn("_p", F.floor(
        F.substring("numero_dpe", 4, 20).cast("long") / 50))
    return (d.groupBy("_p").agg(F.collect_list(F.struct(
        "numero_dpe", "type_batiment", "etiquette_dpe", "code_departement_ban", "_geopoint"))
        .alias("results"))
        .select(F.to_json(F.struct("results")).alias("value")))


def air_feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air-quality features serialised one per line, with the file order."""
    a = air_features_input(spark, sf_dir)
    return a.select(F.to_json(F.struct("properties")).alias("value"), "ordinal")


# ------------------------------------------------------------ landed files
def quoted_files(spark: SparkSession, sf_dir: str) -> str:
    """customer as landed CSV files whose fields hold quotes, separators and
    line ends; the folder."""
    from ..session import scratch_path
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    shop = F.concat(F.lit('Shop "'), F.col("c_name"), F.lit('", '), F.col("c_mktsegment"))
    note = F.when(k % 7 == 0, F.lit(None)).when(k % 3 == 0, F.concat(F.lit('first\n"second"; line,\n'), k.cast("string"))) \
        .when(k % 3 == 1, F.lit('"')).otherwise(F.concat(F.lit("plain "), k.cast("string")))
    path = scratch_path(spark, "quoted")
    c.select(commune_code(k).alias("code"), shop.alias("shop"), note.alias("note"), k.cast("string").alias("key")).write.option(
        "header", True).option("escape", '"').csv(path)
    return path


DOCUMENT_FEATURES = 1000


def commune_documents(spark: SparkSession, sf_dir: str) -> str:
    """The commune features as FeatureCollection documents, a file each, with
    other objects before and after the features; the folder."""
    from ..session import scratch_path
    lines = commune_feature_lines(spark, sf_dir)
    code = F.get_json_object("value", "$.properties.nom")
    number = F.expr(f"cast(substring(nom, 9) as bigint) div {DOCUMENT_FEATURES}")
    docs = lines.withColumn("nom", code).groupBy(number.alias("doc")).agg(F.sort_array(F.collect_list("value")).alias("features"))
    text = F.concat(F.lit('{"type": "FeatureCollection", "note": "a { and a }", "crs": {"properties": {"name": "x"}}, "features": [\n'),
                    F.array_join("features", ",\n"), F.lit('\n], "about": {"n": {"type": "Feature"}}}'))
    path = scratch_path(spark, "collections")
    docs.select("doc", text.alias("value")).write.partitionBy("doc").option("lineSep", "\n").text(path)
    return path
