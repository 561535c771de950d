"""DuckDB oracle SQL for every registered query.

Each statement re-derives the operator input from the driver tables with the
same integer arithmetic as ``bindings.py`` and then states the operator's
semantics directly in SQL.  Floating outputs are normalised to float32
precision on both sides (see ``tables.round_doubles``).
"""

from __future__ import annotations

def expand_f32(sql: str) -> str:
    """Rewrite the shorthand ``F32(expr)`` to ``CAST(CAST(expr AS FLOAT) AS DOUBLE)``,
    the float32 normalisation matching ``tables.round_doubles``."""
    out, i = [], 0
    while True:
        j = sql.find("F32(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + 4
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(f"CAST(CAST({expand_f32(sql[j + 4:k - 1])} AS FLOAT) AS DOUBLE)")
        i = k


DEP = ("CASE WHEN {n} = 20 THEN '2A' ELSE lpad(CAST({n} AS VARCHAR), 2, '0') END")

DVF = f"""
dvf AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id_mutation,
         CASE WHEN l_returnflag = 'A' THEN
                CASE WHEN l_linestatus = 'F' THEN 'Vente en l''état futur d''achèvement'
                     ELSE 'Vente' END
              WHEN l_returnflag = 'R' THEN 'Adjudication' ELSE 'Echange' END AS nature_mutation,
         CASE WHEN l_tax <> 0 THEN l_extendedprice END AS valeur_fonciere,
         CASE WHEN l_linenumber = 7 THEN 0.0 WHEN l_linenumber = 6 THEN NULL
              ELSE l_quantity END AS surface_reelle_bati,
         CASE WHEN l_orderkey % 37 = 0 THEN substr(parcel, 1, 8) ELSE parcel END AS id_parcelle,
         dep AS departement
  FROM (SELECT *, {DEP.format(n='(l_suppkey % 95 + 1)')} AS dep,
               {DEP.format(n='(l_suppkey % 95 + 1)')}
               || lpad(CAST(l_partkey % 20 AS VARCHAR), 3, '0') || '000A'
               || chr(CAST(65 + l_partkey % 4 AS INTEGER))
               || lpad(CAST(l_linenumber AS VARCHAR), 4, '0') AS parcel
        FROM lineitem) t
),
bati AS (
  SELECT departement, id_mutation, substr(id_parcelle, 1, 10) AS section_id,
         substr(id_parcelle, 1, 5) AS code_commune,
         valeur_fonciere / surface_reelle_bati AS prix_m2, surface_reelle_bati
  FROM dvf
  WHERE nature_mutation IN ('Vente', 'Vente en l''état futur d''achèvement', 'Adjudication')
    AND valeur_fonciere IS NOT NULL AND length(id_parcelle) >= 10
    AND surface_reelle_bati > 0
)"""

SECTION_PRICES = f"""
WITH {DVF}
SELECT section_id,
       F32(quantile_cont(prix_m2, 0.25)) AS prix_m2_q1,
       F32(quantile_cont(prix_m2, 0.5)) AS prix_m2_median,
       F32(quantile_cont(prix_m2, 0.75)) AS prix_m2_q3,
       F32(avg(prix_m2)) AS prix_m2_mean,
       count(DISTINCT id_mutation) AS nb_ventes,
       F32(quantile_cont(surface_reelle_bati, 0.5)) AS surface_mediane,
       departement
FROM bati GROUP BY departement, section_id
"""

COMMUNE_PRICES = f"""
WITH {DVF}
SELECT code_commune,
       F32(quantile_cont(prix_m2, 0.5)) AS commune_median_price_sqm,
       F32(avg(prix_m2)) AS commune_mean_price_sqm,
       count(DISTINCT id_mutation) AS commune_sales_count,
       count(DISTINCT section_id) AS commune_sections_count,
       departement
FROM bati GROUP BY departement, code_commune
"""


def oracle_sql() -> dict[str, str]:
    out = dict(_ORACLES)
    out.update(osm_oracles())
    out.update(geometry_oracles())
    for fn in (crime_oracles, rents_oracles, climate_oracles, storm_oracles, hazard_oracles,
               lookup_oracles, building_oracles, planning_oracles, atmo_oracles,
               raster_oracles, parse_oracles, assign_oracles):
        out.update(fn())
    return {k: expand_f32(v) for k, v in out.items()}


_ORACLES = {
    "section_prices": SECTION_PRICES,
    "commune_prices": COMMUNE_PRICES,
}


# ------------------------------------------------------------------------ OSM
def D(x) -> str:
    """A double literal.  DuckDB reads ``41.0`` as DECIMAL, and a long decimal
    literal cast to DOUBLE may round twice; parsing the text is exact."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _boxes_sql() -> str:
    from ..functions.departments import DEP_BBOX
    rows = ", ".join(f"('{d}', {D(s)}, {D(w)}, {D(n)}, {D(e)})"
                     for d, (s, w, n, e) in DEP_BBOX.items())
    return f"(VALUES {rows}) AS b(dep, s, w, n, e)"


def _osm_el_sql() -> str:
    from .bindings import OSM_PRIMARY, OSM_SECONDARY

    def lst(pairs, i):
        return "[" + ", ".join("'" + p[i] + "'" for p in pairs) + "]"
    lat = f"{D(41.0)} + ((l_partkey * 7 + l_linenumber) % 1000) / {D(100.0)}"
    lon = f"{D(-5.0)} + ((l_suppkey * 13 + l_linenumber * 3) % 1300) / {D(100.0)}"
    return f"""
lv AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         struct_pack(lat := {lat}, lon := {lon}) AS p,
         struct_pack(lat := {lat}, lon := {lon} + {D(0.01)}) AS p1,
         struct_pack(lat := {lat} + {D(0.01)}, lon := {lon} + {D(0.01)}) AS p2
  FROM lineitem
),
lines AS (
  SELECT l_orderkey,
         list(p ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pts,
         list(struct_pack(
                type := CASE WHEN l_linenumber % 3 = 0 THEN 'node' ELSE 'way' END,
                role := CASE WHEN l_linenumber % 4 = 0 THEN 'inner' ELSE 'outer' END,
                geometry := CASE WHEN l_partkey % 2 = 0 THEN [p, p1, p2, p] ELSE [p, p1, p2] END)
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS mem
  FROM lv GROUP BY l_orderkey
),
el0 AS (
  SELECT o.o_orderkey AS id,
         CASE WHEN o.o_orderkey % 10 < 5 THEN 'way' WHEN o.o_orderkey % 10 < 8 THEN 'node'
              ELSE 'relation' END AS type,
         o.o_custkey, lines.pts, lines.mem,
         {lst(OSM_PRIMARY, 0)}[o.o_orderkey % {len(OSM_PRIMARY)} + 1] AS k1,
         {lst(OSM_PRIMARY, 1)}[o.o_orderkey % {len(OSM_PRIMARY)} + 1] AS v1,
         {lst(OSM_SECONDARY, 0)}[o.o_custkey % {len(OSM_SECONDARY)} + 1] AS k2_,
         {lst(OSM_SECONDARY, 1)}[o.o_custkey % {len(OSM_SECONDARY)} + 1] AS v2
  FROM orders o LEFT JOIN lines ON lines.l_orderkey = o.o_orderkey
),
el AS (
  SELECT id, type,
         CASE WHEN type = 'node' AND id % 31 <> 0
              THEN {D(41.0)} + (o_custkey % 1000) / {D(100.0)} END AS lat,
         CASE WHEN type = 'node' THEN {D(-5.0)} + (id % 1300) / {D(100.0)} END AS lon,
         {D(41.5)} + (o_custkey % 100) / {D(100.0)} AS center_lat,
         {D(2.0)} + (o_custkey % 50) / {D(100.0)} AS center_lon,
         k1, v1, CASE WHEN k2_ <> k1 THEN k2_ END AS k2, v2,
         'el' || CAST(id AS VARCHAR) AS tag_name,
         CASE WHEN o_custkey % 3 <> 0 THEN 'Q' || CAST(id // 7 AS VARCHAR) END AS tag_wikidata,
         CASE WHEN type = 'way' THEN
              CASE WHEN id % 2 = 0 THEN list_concat(pts, [pts[1]]) ELSE pts END END AS geometry,
         CASE WHEN type = 'relation' THEN mem END AS members
  FROM el0
)"""


def _tag(k: str) -> str:
    if k == "name":
        return "tag_name"
    if k == "wikidata":
        return "tag_wikidata"
    return f"(CASE WHEN k1 = '{k}' THEN v1 WHEN k2 = '{k}' THEN v2 END)"


def _in(k: str, values) -> str:
    vals = [values] if isinstance(values, str) else list(values)
    return f"{_tag(k)} IN (" + ", ".join("'" + v + "'" for v in vals) + ")"


def _closed(g: str) -> str:
    return f"(len({g}) >= 4 AND {g}[1].lat = {g}[-1].lat AND {g}[1].lon = {g}[-1].lon)"


def _pts_in_box(g: str) -> str:
    return (f"len(list_filter({g}, lambda p: p.lat BETWEEN b.s AND b.n "
            f"AND p.lon BETWEEN b.w AND b.e)) > 0")


def _seg_in_box(p0: str, p1: str) -> str:
    """Closed segment meets the closed box: overlapping ranges and the box
    corners not all strictly on one side of the segment's line."""
    def side(cx, cy):
        return (f"(({p1}.lon - {p0}.lon) * ({cy} - {p0}.lat) - ({p1}.lat - {p0}.lat) * ({cx} - {p0}.lon))")
    sides = [side("b.w", "b.s"), side("b.w", "b.n"), side("b.e", "b.s"), side("b.e", "b.n")]
    return (f"(greatest({p0}.lon, {p1}.lon) >= b.w AND least({p0}.lon, {p1}.lon) <= b.e "
            f"AND greatest({p0}.lat, {p1}.lat) >= b.s AND least({p0}.lat, {p1}.lat) <= b.n "
            f"AND NOT ({' AND '.join(x + ' > 0' for x in sides)}) "
            f"AND NOT ({' AND '.join(x + ' < 0' for x in sides)}))")


def _line_in_box(g: str, var: str = "k") -> str:
    return (f"(CASE WHEN len({g}) = 1 THEN {g}[1].lat BETWEEN b.s AND b.n AND {g}[1].lon BETWEEN b.w AND b.e "
            f"ELSE len(list_filter(range(1, len({g})), lambda {var}: "
            f"{_seg_in_box(f'{g}[{var}]', f'{g}[{var} + 1]')})) > 0 END)")


def _osm_layer_sql(where: str, geom_cases: list[tuple[str, str, str, str]],
                   cols: list[tuple[str, str]], wiki: bool = False) -> str:
    """``geom_cases``: (condition, type name, parts-count expr, points-list expr)."""
    gt = "CASE " + " ".join(f"WHEN {c} THEN '{t}'" for c, t, _, _ in geom_cases) + " END"
    gp = "CASE " + " ".join(f"WHEN {c} THEN {n}" for c, _, n, _ in geom_cases) + " END"
    gl = "CASE " + " ".join(f"WHEN {c} THEN {l}" for c, _, _, l in geom_cases) + " END"
    anchor = f"""CASE WHEN s.type = 'node' THEN
                   coalesce(s.lat, s.center_lat) BETWEEN b.s AND b.n
                   AND coalesce(s.lon, s.center_lon) BETWEEN b.w AND b.e
                 WHEN s.type = 'way' THEN coalesce({_line_in_box('s.geometry')}, false)
                 ELSE coalesce(len(list_filter(s.members, lambda m: m.geometry IS NOT NULL
                        AND len(m.geometry) > 0 AND {_line_in_box('m.geometry', 'k2')})) > 0, false) END"""
    proj = ", ".join(f"{expr} AS {name}" for name, expr in cols)
    body = f"""
WITH {_osm_el_sql()},
sel AS (
  SELECT *, {gt} AS gtype, {gp} AS gparts, {gl} AS gpts FROM el WHERE {where}
),
asg AS (
  SELECT s.*, b.dep AS departement FROM (SELECT * FROM sel WHERE gtype IS NOT NULL) s
  JOIN {_boxes_sql()} ON {anchor}
)"""
    if wiki:
        body += f""",
rk AS (SELECT *, {_wiki_rank()} AS rnk FROM asg),
mn AS (SELECT *, min(rnk) OVER (PARTITION BY departement, id) AS first_rnk FROM rk),
asg2 AS (SELECT * FROM mn WHERE rnk = first_rnk)"""
    src = "asg2" if wiki else "asg"
    return body + f"""
SELECT id AS osm_id, {proj}, departement,
       gtype AS geom_type, CAST(gparts AS BIGINT) AS geom_parts,
       CAST(len(gpts) AS BIGINT) AS geom_points,
       list_min(list_transform(gpts, lambda p: p.lon)) AS geom_xmin,
       list_min(list_transform(gpts, lambda p: p.lat)) AS geom_ymin,
       list_max(list_transform(gpts, lambda p: p.lon)) AS geom_xmax,
       list_max(list_transform(gpts, lambda p: p.lat)) AS geom_ymax
FROM {src}
"""


def _wiki_rank() -> str:
    from ..operators.osm import WIKI_CATEGORIES
    return "CASE " + " ".join(f"WHEN {_in(k, v)} THEN {i}"
                              for i, (k, v) in enumerate(WIKI_CATEGORIES)) + " END"


def _node_point() -> tuple[str, str, str, str]:
    return ("type = 'node' AND lat IS NOT NULL AND lon IS NOT NULL", "Point", "1",
            "[struct_pack(lat := lat, lon := lon)]")


def _way_line() -> tuple[str, str, str, str]:
    return ("type = 'way' AND len(geometry) >= 2", "LineString", "1", "geometry")


def _way_polygon() -> tuple[str, str, str, str]:
    return (f"type = 'way' AND {_closed('geometry')}", "Polygon", "1", "geometry")


def _cols(*names) -> list[tuple[str, str]]:
    out = []
    for n in names:
        if isinstance(n, tuple):
            out.append(n)
        else:
            out.append((n, _tag(n)))
    return out


ADDR_COLS = [("addr_street", _tag("addr:street")), ("addr_housenumber", _tag("addr:housenumber")),
             ("addr_postcode", _tag("addr:postcode")), ("addr_city", _tag("addr:city"))]


def osm_oracles() -> dict[str, str]:
    from ..operators import osm as O
    node = "type = 'node'"
    way = "type = 'way'"
    rel = "type = 'relation'"
    water_rel = ("type = 'relation' AND len(list_filter(members, lambda m: m.role = 'outer' "
                 "AND m.geometry IS NOT NULL AND " + _closed("m.geometry") + ")) > 0")
    water_first = ("list_filter(members, lambda m: m.role = 'outer' AND m.geometry IS NOT NULL AND "
                   + _closed("m.geometry") + ")[1].geometry")
    green_rings = ("list_filter(members, lambda m: m.role = 'outer' AND m.type = 'way' "
                   "AND m.geometry IS NOT NULL AND " + _closed("m.geometry") + ")")
    nonempty = "(CASE WHEN {x} <> '' THEN {x} END)"
    q = {}
    q["osm_shops"] = _osm_layer_sql(
        f"{node} AND ({_tag('shop')} IS NOT NULL OR {_in('amenity', O.SHOP_AMENITIES)} "
        f"OR {_in('leisure', O.SHOP_LEISURE)} OR {_tag('healthcare')} IS NOT NULL)",
        [_node_point()],
        _cols("name", "shop", "amenity", "leisure", "healthcare", "cuisine", "brand",
              "opening_hours") + ADDR_COLS)
    q["osm_nightclubs"] = _osm_layer_sql(
        f"{node} AND ({_in('amenity', O.NIGHT_AMENITIES)} OR {_in('leisure', O.NIGHT_LEISURE)})",
        [_node_point()], _cols("name", "amenity", "leisure", "opening_hours") + ADDR_COLS)
    ttype = ("CASE WHEN " + _in("railway", ["station", "halt"]) + " THEN 'train_station' "
             "WHEN " + _tag("station") + " = 'subway' THEN 'metro_station' "
             "WHEN " + _tag("railway") + " = 'tram_stop' THEN 'tram_stop' "
             "WHEN " + _tag("amenity") + " = 'bus_station' THEN 'bus_station' ELSE 'bus_stop' END")
    q["osm_transport"] = _osm_layer_sql(
        f"{node} AND ({_in('railway', ['station', 'halt', 'tram_stop'])} "
        f"OR {_tag('station')} = 'subway' OR {_tag('highway')} = 'bus_stop' "
        f"OR {_tag('amenity')} = 'bus_station')",
        [_node_point()],
        _cols("name", ("transport_type", ttype), "network", "operator", "line"))
    q["osm_stations"] = _osm_layer_sql(
        f"{node} AND ({_in('railway', O.RAIL_STATIONS)} OR {_tag('public_transport')} = 'station')",
        [_node_point()], _cols("name", "railway", "station", "network", "operator"))
    q["osm_roads"] = _osm_layer_sql(
        f"{way} AND {_in('highway', O.ROAD_HIGHWAYS)}", [_way_line()],
        _cols("name", "highway", "lanes", "maxspeed", "surface"))
    q["osm_railways"] = _osm_layer_sql(
        f"{way} AND {_in('railway', O.RAIL_LINES)}", [_way_line()],
        _cols("name", "railway", "operator", "service", "usage", "electrified", "maxspeed",
              "tunnel", "bridge", "cutting", "embankment", "noise_barrier"))
    q["osm_industry"] = _osm_layer_sql(
        f"{way} AND ({_in('landuse', ['industrial', 'quarry', 'port'])} "
        f"OR {_in('man_made', O.INDUSTRY_MAN_MADE)} OR {_tag('industrial')} IS NOT NULL "
        f"OR {_in('building', O.INDUSTRY_BUILDINGS)})",
        [_way_polygon()],
        _cols("name", "landuse", "industrial", "man_made", "building", "operator"))
    use = ("coalesce(" + nonempty.format(x=_tag("aerodrome:type")) + ", "
           + nonempty.format(x=_tag("aerodrome")) + ")")
    q["osm_airports"] = _osm_layer_sql(
        f"(({node} AND {_in('aeroway', O.AIRPORT_NODES)}) OR ({way} AND {_in('aeroway', O.AIRPORT_WAYS)}))",
        [_node_point(), _way_polygon(), _way_line()],
        _cols("name", "aeroway", "iata", "icao", "operator", ("use", use)))
    q["osm_parking"] = _osm_layer_sql(
        f"((({node} OR {way}) AND {_tag('amenity')} = 'parking') "
        f"OR ({node} AND {_tag('amenity')} = 'parking_entrance'))",
        [_node_point(), _way_polygon()],
        _cols("name", ("parking_type", _tag("parking")), "capacity", "fee", "access"))
    wtype = ("coalesce(" + nonempty.format(x=_tag("waterway")) + ", "
             + nonempty.format(x=_tag("water")) + ", 'water')")
    q["osm_water"] = _osm_layer_sql(
        f"((({way} OR {rel}) AND {_tag('natural')} = 'water') "
        f"OR ({way} AND {_in('waterway', O.WATERWAYS)}))",
        [_way_polygon(), _way_line(), (water_rel, "Polygon", "1", water_first)],
        _cols("name", ("water_type", wtype)))
    q["osm_green_spaces"] = _osm_layer_sql(
        f"({way} OR {rel}) AND ({_in('leisure', O.GREEN_LEISURE)} OR {_in('landuse', O.GREEN_LANDUSE)})",
        [_way_polygon(),
         (f"{rel} AND len({green_rings}) > 0", "MultiPolygon", f"len({green_rings})",
          f"flatten(list_transform({green_rings}, lambda m: m.geometry))")],
        _cols(("osm_type", "type"), "name", "leisure", "landuse", "access", "surface"))
    wlat = "coalesce(CASE WHEN lat <> 0 THEN lat END, center_lat)"
    wlon = "coalesce(CASE WHEN lon <> 0 THEN lon END, center_lon)"
    wiki_where = " OR ".join(f"({_in(k, v)})" for k, v in O.WIKI_CATEGORIES)
    cat = "coalesce(" + ", ".join(nonempty.format(x=_tag(k))
                                  for k in ("tourism", "amenity", "historic", "leisure")) + ")"
    q["osm_wiki_pois"] = _osm_layer_sql(
        f"{node} AND {_tag('wikidata')} <> '' AND ({wiki_where})",
        [(f"{wlat} IS NOT NULL AND {wlon} IS NOT NULL", "Point", "1",
          f"[struct_pack(lat := {wlat}, lon := {wlon})]")],
        _cols(("wikidata_id", _tag("wikidata")), "name", ("category", cat)), wiki=True)
    return q


# ------------------------------------------------------- commune-code helpers
def sql_dep_num(num: str) -> str:
    return (f"(CASE WHEN {num} = 96 THEN '971' WHEN {num} = 20 THEN '2A' "
            f"ELSE lpad(CAST({num} AS VARCHAR), 2, '0') END)")


def sql_commune(k: str) -> str:
    num = f"({k} % 96 + 1)"
    dep = sql_dep_num(num)
    serial = f"(({k} // 96) % (CASE WHEN {num} = 96 THEN 100 ELSE 1000 END))"
    return f"({dep} || substr(lpad(CAST({serial} AS VARCHAR), 5, '0'), length({dep}) + 1, 5))"


def sql_decimal_comma(x: str) -> str:
    s = f"trim(replace({x}, ',', '.'))"
    return (f"(CASE WHEN regexp_full_match({s}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
            f"THEN TRY_CAST({s} AS DOUBLE) END)")


def sql_dep_of(code: str) -> str:
    return f"(CASE WHEN {code} LIKE '97%' THEN substr({code}, 1, 3) ELSE substr({code}, 1, 2) END)"


def sql_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def sql_case(col: str, mapping: dict, default: str | None = None) -> str:
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    body = " ".join(f"WHEN {col} = {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"(CASE {body}" + (f" ELSE {lit(default)}" if default is not None else "") + " END)"


def sql_l93(x: str, y: str) -> tuple[str, str]:
    """Inverse Lambert-93 in SQL (same formula and iteration count)."""
    from ..functions import crs as C
    import math
    dx = f"({x} - {D(C.L93_X0)})"
    dy = f"({D(C.RHO0)} - ({y} - {D(C.L93_Y0)}))"
    t = f"pow(sqrt({dx} * {dx} + {dy} * {dy}) / {D(C.AF)}, {D(1.0 / C.N)})"
    lon = f"degrees(atan2({dx}, {dy}) / {D(C.N)} + {D(C.LON0)})"
    phi = f"({D(math.pi / 2)} - {D(2.0)} * atan({t}))"
    for _ in range(C._ITER):
        ratio = f"({D(2.0)} / ({D(1.0)} + {D(C._E)} * sin({phi})) - {D(1.0)})"
        phi = f"({D(math.pi / 2)} - {D(2.0)} * atan({t} * pow({ratio}, {D(C._E / 2)})))"
    return lon, f"degrees({phi})"


def sql_utm(x: str, y: str, zone: int, south: bool) -> tuple[str, str]:
    """Inverse UTM in SQL (same series)."""
    import math
    from ..functions import crs as C
    scale = C.UTM_K0 * C.TM_RADIUS
    xi = f"(({y} - {D(C.UTM_N0_SOUTH if south else 0.0)}) / {D(scale)})"
    eta = f"(({x} - {D(C.UTM_E0)}) / {D(scale)})"
    xi1 = f"({xi}" + "".join(f" - {D(b)} * sin({xi} * {D(2.0 * j)}) * cosh({eta} * {D(2.0 * j)})" for j, b in enumerate(C.TM_BETA, 1)) + ")"
    eta1 = f"({eta}" + "".join(f" - {D(b)} * cos({xi} * {D(2.0 * j)}) * sinh({eta} * {D(2.0 * j)})" for j, b in enumerate(C.TM_BETA, 1)) + ")"
    chi = f"asin(sin({xi1}) / cosh({eta1}))"
    lat = f"({chi}" + "".join(f" + {D(d)} * sin({chi} * {D(2.0 * j)})" for j, d in enumerate(C.TM_DELTA, 1)) + ")"
    return f"degrees({D(math.radians(6 * zone - 183))} + atan2(sinh({eta1}), cos({xi1})))", f"degrees({lat})"


def _french_sql() -> str:
    """The French systems in SQL: a table of constants, the inverse conic, the
    datum shift and the inverse Mercator, column by column."""
    import math
    from ..functions import crs as C
    rows = []
    for i, code in enumerate(C.FRENCH_CODES):
        c = C.conic(code)
        v = (c.n, c.af, c.rho0, c.lon0, c.x0, c.y0, c.e, c.a) if c else (1.0, 1.0, 1.0, 0.0, 250000.0, 5900000.0, 0.0, C.GRS80_A)
        shift = c.shift if c and c.shift else (0.0, 0.0, 0.0)
        rows.append(f"({i}, {code}, {str(bool(c and c.shift)).lower()}, {', '.join(D(x) for x in (*v, *shift))})")
    phi = f"({D(math.pi / 2)} - {D(2.0)} * atan(t))"
    for _ in range(C._ITER):
        phi = f"({D(math.pi / 2)} - {D(2.0)} * atan(t * pow({D(2.0)} / ({D(1.0)} + e * sin({phi})) - {D(1.0)}, e / {D(2.0)})))"
    a, b = C.GRS80_A, C.GRS80_A * (1 - C.GRS80_F)
    f2, g2 = 1 - (b / a) ** 2, (a / b) ** 2 - 1
    n = len(C.FRENCH_CODES)
    return f"""
WITH k AS (SELECT * FROM (VALUES {', '.join(rows)}) v(i, code, shifted, n, af, rho0, lon0, x0, y0, e, a, dx, dy, dz)),
p AS (SELECT p_partkey, code, k.* EXCLUDE (code), x0 + ((p_partkey // {n}) % 41 - 20) * {D(10000.0)} AS x,
             y0 + ((p_partkey // {41 * n}) % 31 - 15) * {D(10000.0)} AS y FROM part JOIN k ON p_partkey % {n} = i),
c AS (SELECT *, x - x0 AS px, rho0 - (y - y0) AS py FROM p),
t AS (SELECT *, pow(sqrt(px * px + py * py) / af, {D(1.0)} / n) AS t, atan2(px, py) / n + lon0 AS lam FROM c WHERE code <> {C.MERCATOR_CODE}),
g AS (SELECT *, {phi} AS phi, e * e AS e2 FROM t),
v AS (SELECT *, a / sqrt({D(1.0)} - e2 * sin(phi) * sin(phi)) AS v FROM g),
q AS (SELECT *, v * cos(phi) * cos(lam) + dx AS gx, v * cos(phi) * sin(lam) + dy AS gy, v * ({D(1.0)} - e2) * sin(phi) + dz AS gz FROM v),
u AS (SELECT *, sqrt(gx * gx + gy * gy) AS r, atan2(gz * {D(a)}, sqrt(gx * gx + gy * gy) * {D(b)}) AS u FROM q),
o AS (SELECT p_partkey, code, CASE WHEN shifted THEN degrees(atan2(gy, gx)) ELSE degrees(lam) END AS lon,
             CASE WHEN shifted THEN degrees(atan2(gz + {D(g2 * b)} * pow(sin(u), 3), r - {D(f2 * a)} * pow(cos(u), 3))) ELSE degrees(phi) END AS lat FROM u
      UNION ALL
      SELECT p_partkey, code, degrees(x / {D(a)}), degrees(atan(sinh(y / {D(a)}))) FROM p WHERE code = {C.MERCATOR_CODE})
SELECT p_partkey, CAST(code AS INTEGER) AS src_epsg, {point_stats('lon', 'lat')} FROM o
"""


def geometry_oracles() -> dict[str, str]:
    from . import bindings as B
    from ..functions import crs as C
    codes = ", ".join("NULL" if c is None else str(c) for c in B.PROJECTED)
    cases = {2154: sql_l93("x", "y"), **{c: sql_utm("x", "y", *C.utm_zone(c)) for c in B.PROJECTED if c and C.utm_zone(c)}}
    lon = "CASE src_epsg " + " ".join(f"WHEN {c} THEN {v[0]}" for c, v in cases.items()) + " ELSE x END"
    lat = "CASE src_epsg " + " ".join(f"WHEN {c} THEN {v[1]}" for c, v in cases.items()) + " ELSE y END"
    q = {"reproject_utm": f"""
WITH c AS (SELECT p_partkey, CAST([{codes}][p_partkey % {len(B.PROJECTED)} + 1] AS INTEGER) AS src_epsg FROM part),
p AS (SELECT p_partkey, src_epsg,
        CASE WHEN src_epsg IS NULL OR src_epsg = 4326 THEN (p_partkey % 300) / {D(10.0)} - 15 ELSE {D(300000.0)} + (p_partkey % 400) * {D(1000.0)} END AS x,
        CASE WHEN src_epsg IS NULL OR src_epsg = 4326 THEN (p_partkey % 170) / {D(2.0)} - 40
             WHEN src_epsg IN (2975, 4471) THEN {D(7600000.0)} + (p_partkey % 900) * {D(700.0)}
             WHEN src_epsg = 2154 THEN {D(6300000.0)} + (p_partkey % 700) * {D(1000.0)}
             ELSE {D(300000.0)} + (p_partkey % 1500) * {D(1000.0)} END AS y FROM c),
g AS (SELECT p_partkey, src_epsg, {lon} AS lon, {lat} AS lat FROM p)
SELECT p_partkey, src_epsg, {point_stats('lon', 'lat')} FROM g
"""}
    q["reproject_french"] = _french_sql()
    q["parse_multigeom"] = """
WITH k AS (SELECT p_partkey, p_partkey % 4 AS kind, CASE p_partkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 4 WHEN 2 THEN 5 END AS n, p_size FROM part),
f AS (SELECT *, unnest(['wkt', 'geojson']) AS form FROM k)
SELECT p_partkey, form, CASE WHEN kind < 2 THEN 'MultiPoint' WHEN kind = 2 THEN 'MultiLineString' END AS geom_type,
       CASE WHEN n IS NOT NULL THEN 1::BIGINT END AS geom_parts, n::BIGINT AS geom_points,
       CASE WHEN n IS NOT NULL THEN p_partkey::DOUBLE END AS geom_xmin, CASE WHEN n IS NOT NULL THEN 0::DOUBLE END AS geom_ymin,
       (p_partkey + n - 1)::DOUBLE AS geom_xmax, (p_size * (n - 1))::DOUBLE AS geom_ymax FROM f
"""
    return q


def point_stats(lon: str, lat: str, f32: bool = True) -> str:
    w = (lambda e: f"F32({e})") if f32 else (lambda e: e)
    return (f"'Point' AS geom_type, CAST(1 AS BIGINT) AS geom_parts, CAST(1 AS BIGINT) AS geom_points, "
            f"{w(lon)} AS geom_xmin, {w(lat)} AS geom_ymin, {w(lon)} AS geom_xmax, {w(lat)} AS geom_ymax")


CRIME_SQL_INPUT = """
cr AS (
  SELECT {code} AS CODGEO_2025, CAST(year(o_orderdate) AS INTEGER) AS annee,
         {ind} AS indicateur,
         CASE WHEN o_orderkey % 11 = 0 THEN 'ndiff' WHEN o_orderkey % 13 = 0 THEN NULL
              WHEN o_orderkey % 17 = 0 THEN '1.5d'
              ELSE CAST(o_orderkey % 1000 AS VARCHAR) || ',' || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0')
         END AS taux_pour_mille,
         CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey % 50 AS VARCHAR) END AS nombre,
         o_orderkey AS ordinal
  FROM orders
)"""


def crime_oracles() -> dict[str, str]:
    from ..functions.text import slug_py
    from . import bindings as B
    cr = CRIME_SQL_INPUT.format(code=sql_commune("o_custkey"),
                                ind=sql_case("o_orderpriority", B.CRIME_INDICATORS))
    prefix = " OR ".join(f"CODGEO_2025 LIKE '{d}%'" for d in B.CRIME_DEPS)
    inds = sorted(B.CRIME_INDICATORS.values())
    cols = ", ".join(f"F32(max(CASE WHEN indicator = '{i.replace(chr(39), chr(39) * 2)}' THEN rate END)) "
                     f"AS taux_{slug_py(i)}" for i in inds)
    cols += ", " + ", ".join(f"F32(max(CASE WHEN indicator = '{i.replace(chr(39), chr(39) * 2)}' "
                             f"THEN cnt END)) AS nb_{slug_py(i)}" for i in inds)
    pivot = f"""
WITH {cr},
f AS (
  SELECT CODGEO_2025 AS code_commune, indicateur AS indicator,
         {sql_decimal_comma('taux_pour_mille')} AS rate, {sql_decimal_comma('nombre')} AS cnt, ordinal
  FROM cr WHERE annee = {B.CRIME_YEAR} AND ({prefix})
    AND CODGEO_2025 IS NOT NULL AND indicateur IS NOT NULL
),
pairs AS (
  SELECT code_commune, indicator,
         arg_min(rate, ordinal) FILTER (WHERE rate IS NOT NULL) AS rate,
         arg_min(cnt, ordinal) FILTER (WHERE cnt IS NOT NULL) AS cnt
  FROM f GROUP BY code_commune, indicator
)"""
    q = {}
    q["crime_pivot"] = pivot + f"""
SELECT code_commune, {cols}, {sql_dep_of('code_commune')} AS departement
FROM pairs GROUP BY code_commune HAVING count(rate) > 0
"""
    q["crime_with_commune"] = pivot + f""",
pv AS (SELECT code_commune, {cols}, {sql_dep_of('code_commune')} AS departement
       FROM pairs GROUP BY code_commune HAVING count(rate) > 0),
com AS (SELECT {sql_commune('c_custkey')} AS code_commune,
               'Commune ' || CAST(c_custkey AS VARCHAR) AS nom_commune,
               {D(-5.0)} + (c_custkey % 1300) / {D(100.0)} AS lon, {D(41.0)} + (c_custkey % 1000) / {D(100.0)} AS lat FROM customer)
SELECT pv.*, com.nom_commune, {point_stats('lon', 'lat')} FROM pv JOIN com USING (code_commune)
"""
    return q


def rents_sql(vintage: int = 0, deps=None) -> str:
    from . import bindings as B
    parts = []
    for i, t in enumerate(B.RENT_TYPES):
        j = i + vintage
        code = sql_commune("p_partkey")
        parts.append(f"""
  SELECT {code} AS code_commune, '{t}' AS type_local,
         CASE WHEN substr({code}, 1, 3) = '971' THEN '971' ELSE substr({code}, 1, 2) END AS departement,
         {sql_decimal_comma(f"CASE WHEN p_partkey % 41 = 0 THEN 'NA' ELSE CAST(p_size + {j * 3} AS VARCHAR) || ',' || CAST(p_partkey % 10 AS VARCHAR) END")} AS loyer_m2_median,
         {sql_decimal_comma(f"CAST(p_size AS VARCHAR) || ',' || CAST((p_partkey + {j}) % 10 AS VARCHAR)")} AS loyer_m2_lower,
         {sql_decimal_comma(f"CAST(p_size + {5 + j} AS VARCHAR) || ',5'")} AS loyer_m2_upper,
         CASE WHEN p_size % 3 = 0 THEN 'commune' ELSE 'maille' END AS prediction_type,
         {sql_decimal_comma(f"CAST(p_size * 7 + {j} AS VARCHAR)")} AS nb_obs,
         {sql_decimal_comma(f"'0,' || lpad(CAST((p_partkey + {j}) % 100 AS VARCHAR), 2, '0')")} AS r2_adj
  FROM part""")
    body = " UNION ALL ".join(parts)
    where = f"WHERE departement IN {sql_list(deps)}" if deps else ""
    return f"(SELECT * FROM ({body}) u {where})"


def f32_cols(cols) -> str:
    return ", ".join(f"F32({c}) AS {c}" for c in cols)


RENT_NUM = ["loyer_m2_median", "loyer_m2_lower", "loyer_m2_upper", "nb_obs", "r2_adj"]
RENT_TXT = ["code_commune", "type_local", "departement", "prediction_type"]


def rents_oracles() -> dict[str, str]:
    from . import bindings as B
    q = {}
    q["rents_long"] = f"""
SELECT {', '.join(RENT_TXT)}, {f32_cols(RENT_NUM)} FROM {rents_sql(0, B.RENT_DEPS)} r
"""
    q["rents_replace_present"] = f"""
WITH old AS {rents_sql(10)}, new AS {rents_sql(0, B.RENT_DEPS)},
merged AS (
  SELECT * FROM old WHERE departement NOT IN (SELECT DISTINCT departement FROM new
                                               WHERE departement IS NOT NULL)
  UNION ALL SELECT * FROM new
)
SELECT {', '.join(RENT_TXT)}, {f32_cols(RENT_NUM)} FROM merged
"""
    return q


def climate_oracles() -> dict[str, str]:
    from . import bindings as B
    return {"climate_stations": f"""
WITH m AS (
  SELECT {sql_dep_num('(l_suppkey % 96 + 1)')} AS departement,
         l_suppkey AS NUM_POSTE, 'STATION_' || CAST(l_suppkey AS VARCHAR) AS NOM_USUEL,
         CASE WHEN l_suppkey % 23 <> 0 THEN {D(42.0)} + (l_suppkey % 9) END AS LAT,
         CASE WHEN l_suppkey % 29 = 0 THEN {D(0.0)} ELSE {D(-4.0)} + (l_suppkey % 11) END AS LON,
         CASE WHEN l_suppkey % 31 <> 0 THEN l_suppkey * {D(10.0)} END AS ALTI,
         year(l_shipdate) * 100 + month(l_shipdate) AS AAAAMM,
         l_quantity AS TX, l_tax * {D(100)} AS TN,
         CASE WHEN l_linenumber <> 3 THEN l_extendedprice / {D(100)} END AS TXAB,
         CASE WHEN l_linenumber <> 1 THEN CAST(l_linenumber AS DOUBLE) END AS NBJTX25,
         CASE WHEN l_suppkey % 5 <> 0 THEN CAST(l_linenumber % 3 AS DOUBLE) END AS NBJTX30,
         CASE WHEN l_suppkey % 3 <> 0 THEN CAST(l_linenumber % 2 AS DOUBLE) END AS NBJTX35
  FROM lineitem
),
a AS (
  SELECT departement, NUM_POSTE, NOM_USUEL, LAT, LON, ALTI,
         avg(TX) AS avg_temp_max, avg(TN) AS avg_temp_min, max(TXAB) AS max_temp_recorded,
         coalesce(sum(NBJTX25), 0) AS t25, coalesce(sum(NBJTX30), 0) AS t30,
         coalesce(sum(NBJTX35), 0) AS t35, count(AAAAMM) AS months
  FROM m
  WHERE AAAAMM // 100 >= {B.CLIMATE_START_YEAR}
    AND NUM_POSTE IS NOT NULL AND NOM_USUEL IS NOT NULL AND LAT IS NOT NULL
    AND LON IS NOT NULL AND ALTI IS NOT NULL
  GROUP BY departement, NUM_POSTE, NOM_USUEL, LAT, LON, ALTI
)
SELECT NUM_POSTE AS station_id, NOM_USUEL AS station_name, F32(ALTI) AS altitude, departement,
       F32(avg_temp_max) AS avg_temp_max, F32(avg_temp_min) AS avg_temp_min,
       F32(max_temp_recorded) AS max_temp_recorded,
       F32(round_even(t25 / (months / {D(12)}) * {D(10)}, 0) / {D(10)}) AS avg_days_above_25,
       F32(round_even(t30 / (months / {D(12)}) * {D(10)}, 0) / {D(10)}) AS avg_days_above_30,
       F32(round_even(t35 / (months / {D(12)}) * {D(10)}, 0) / {D(10)}) AS avg_days_above_35,
       {point_stats('LON', 'LAT')}
FROM a WHERE LAT <> 0 AND LON <> 0
"""}


def storm_oracles() -> dict[str, str]:
    from . import bindings as B
    deps = B.STORM_DEPS
    cat = f"""
cat AS (
  SELECT CASE WHEN o_orderkey % 19 <> 0 THEN {sql_commune('o_custkey')} END AS cod_commune,
         {sql_case('o_orderpriority', B.STORM_LABEL_OF, 'Mouvements de terrain')} AS lib_risque_jo,
         CASE WHEN o_orderkey % 23 = 0 THEN 'not a date'
              WHEN o_orderkey % 29 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dat_deb
  FROM orders
),
h AS (
  SELECT cod_commune AS code_commune, count(*) AS storm_count,
         strftime(min(CAST(try_strptime(dat_deb, '%Y-%m-%d') AS DATE)), '%Y-%m-%d') AS first_event,
         strftime(max(CAST(try_strptime(dat_deb, '%Y-%m-%d') AS DATE)), '%Y-%m-%d') AS last_event
  FROM cat WHERE lib_risque_jo IN ('Tempête', 'Vents Cycloniques') AND cod_commune IS NOT NULL
  GROUP BY cod_commune
),
hist AS (
  SELECT * FROM h
  WHERE (length(code_commune) = 5 AND regexp_full_match(substr(code_commune, 1, 3), '[0-9]{{3}}')
         AND substr(code_commune, 1, 3) IN {sql_list(deps)})
     OR substr(code_commune, 1, 2) IN {sql_list(deps)}
)"""
    lon = f"({D(-5.0)} + (c_custkey % 1300) / {D(100.0)})"
    lat = f"({D(41.0)} + (c_custkey % 1000) / {D(100.0)})"
    return {
        "storm_history": f"WITH {cat} SELECT * FROM hist",
        "storm_with_geometry": f"""
WITH {cat},
com AS (SELECT {sql_commune('c_custkey')} AS code_commune,
               {sql_dep_num('(c_custkey % 96 + 1)')} AS departement, {lon} AS lon, {lat} AS lat
        FROM customer)
SELECT hist.code_commune, storm_count, first_event, last_event, com.departement,
       {point_stats('lon', 'lat', f32=False)}
FROM hist JOIN com ON com.code_commune = hist.code_commune
WHERE com.departement IN {sql_list(deps)} AND starts_with(hist.code_commune, com.departement)
"""}


def hazard_oracles() -> dict[str, str]:
    from . import bindings as B
    lon = f"({D(-5.0)} + (p_partkey % 1300) / {D(100.0)})"
    lat = f"({D(41.0)} + (p_partkey % 1000) / {D(100.0)})"
    d = D(0.01)
    x = f"({D(700000.0)} + (p_partkey % 40) * {D(5000.0)})"
    y = f"({D(6500000.0)} + ((p_partkey // 40) % 40) * {D(5000.0)})"
    wlon, wlat = sql_l93(x, y)
    v = sql_case("p_size % 6", {0: 22, 1: 24, 2: 26, 3: 28, 4: 25})
    q = {}
    q["wind_zones"] = f"""
SELECT {sql_case(v, {22: 1, 24: 2, 26: 3, 28: 4})} AS wind_zone, {v} AS wind_speed_ms,
       'Polygon' AS geom_type, CAST(1 AS BIGINT) AS geom_parts, CAST(5 AS BIGINT) AS geom_points,
       {lon} AS geom_xmin, {lat} AS geom_ymin, {lon} + {d} AS geom_xmax, {lat} + {d} AS geom_ymax
FROM part
"""
    typ = sql_case("p_size % 5", {0: "01", 1: "02", 2: "03", 3: "04"})
    scen = sql_case("p_partkey % 6", {0: "01For", 1: "02Moy", 2: "03Mcc", 3: "04Fai", 4: "05Xxx"})
    q["flood_zones"] = f"""
SELECT coalesce({sql_case(typ, {"01": "river_overflow", "02": "runoff", "03": "marine_submersion"})},
                'unknown') AS flood_type,
       coalesce({sql_case(scen, {"01For": "high_probability", "02Moy": "medium_probability",
                                  "03Mcc": "medium_probability_climate_change",
                                  "04Fai": "low_probability"})}, 'unknown') AS scenario,
       CASE WHEN p_partkey % 2 = 0 THEN 'river ' || p_brand END AS watercourse,
       'TRI_' || p_brand AS tri_id, {sql_dep_num('(p_partkey % 96 + 1)')} AS departement,
       {point_stats(wlon, wlat)}
FROM part
"""
    dpt = ("(CASE WHEN p_partkey % 7 = 0 THEN '2A' WHEN p_partkey % 7 = 1 THEN '971' "
           "ELSE CAST(p_partkey % 95 + 1 AS VARCHAR) END)")
    zf = f"(CASE WHEN length({dpt}) < 2 THEN lpad({dpt}, 2, '0') ELSE {dpt} END)"
    q["clay_zones"] = f"""
SELECT coalesce({sql_case('p_size % 5', {1: 'low', 2: 'medium', 3: 'high'})}, 'unknown') AS exposure_level,
       {zf} AS departement, {point_stats(wlon, wlat)}
FROM part WHERE {zf} IN {sql_list(B.CLAY_DEPS)}
"""
    q["l93_to_wgs84"] = f"""
SELECT p_partkey AS id, F32({wlon}) AS lon, F32({wlat}) AS lat FROM part
"""
    return q


# ----------------------------------------------------------- lookups (J, L)
def sections_sql() -> str:
    dep = DEP.format(n="(p_partkey % 95 + 1)")
    commune = f"({dep} || lpad(CAST((p_partkey // 95) % 20 AS VARCHAR), 3, '0'))"
    letter = "chr(CAST(65 + (p_partkey // 1900) % 4 AS INTEGER))"
    lon = f"({D(-5.0)} + (p_partkey % 1300) / {D(100.0)})"
    lat = f"({D(41.0)} + (p_partkey % 1000) / {D(100.0)})"
    return f"""
sections AS (
  SELECT {commune} || '000A' || {letter} AS section_id, {commune} AS commune,
         '000' AS prefixe, 'A' || {letter} AS code, {dep} AS departement,
         'Polygon' AS geom_type, CAST(1 AS BIGINT) AS geom_parts, CAST(5 AS BIGINT) AS geom_points,
         {lon} AS geom_xmin, {lat} AS geom_ymin, {lon} + {D(0.01)} AS geom_xmax,
         {lat} + {D(0.01)} AS geom_ymax
  FROM part
)"""


SECTION_PRICES_CTE = f"""
sp AS (
  SELECT section_id,
         F32(quantile_cont(prix_m2, 0.25)) AS prix_m2_q1,
         F32(quantile_cont(prix_m2, 0.5)) AS prix_m2_median,
         F32(quantile_cont(prix_m2, 0.75)) AS prix_m2_q3,
         F32(avg(prix_m2)) AS prix_m2_mean,
         count(DISTINCT id_mutation) AS nb_ventes,
         F32(quantile_cont(surface_reelle_bati, 0.5)) AS surface_mediane,
         departement
  FROM bati GROUP BY departement, section_id
)"""


def lookup_oracles() -> dict[str, str]:
    from . import bindings as B
    q = {}
    q["prices_with_geometry"] = f"""
WITH {DVF}, {SECTION_PRICES_CTE}, {sections_sql()}
SELECT sp.*, s.commune, s.prefixe, s.code, s.geom_type, s.geom_parts, s.geom_points,
       F32(s.geom_xmin) AS geom_xmin, F32(s.geom_ymin) AS geom_ymin,
       F32(s.geom_xmax) AS geom_xmax, F32(s.geom_ymax) AS geom_ymax
FROM sp JOIN (SELECT * FROM sections) s USING (section_id)
"""
    q["sections_of_commune"] = f"""
WITH {sections_sql()}
SELECT * FROM sections WHERE commune = '{B.LOOKUP_COMMUNE}'
"""
    q["prices_by_prefix"] = f"""
WITH {DVF}, {SECTION_PRICES_CTE}
SELECT * FROM sp WHERE starts_with(section_id, '{B.PRICE_PREFIX}')
"""
    q["price_row_count"] = f"""
WITH {DVF}, {SECTION_PRICES_CTE}
SELECT count(*) AS n FROM sp
"""
    q["sample_rows"] = f"""
WITH {DVF}, {SECTION_PRICES_CTE}
SELECT * FROM sp ORDER BY section_id LIMIT 10
"""
    return q


def building_oracles() -> dict[str, str]:
    from . import bindings as B
    x0 = "(650000 + (p_partkey % 50) * 2000)"
    y0 = "(6550000 + ((p_partkey // 50) % 50) * 2000)"

    def v(dx, dy):
        return f"struct_pack(x := CAST({x0} + {dx} AS DOUBLE), y := CAST({y0} + {dy} AS DOUBLE))"
    sq = f"[{v(0, 0)}, {v(1000, 0)}, {v(1000, 1000)}, {v(0, 0)}]"
    sq2 = f"[{v(3000, 0)}, {v(4000, 0)}, {v(4000, 1000)}, {v(3000, 0)}]"
    outer = f"[{v(0, 0)}, {v(1000, 0)}, {v(1000, 1000)}, {v(0, 1000)}, {v(0, 0)}]"
    hole = f"[{v(100, 100)}, {v(200, 100)}, {v(200, 200)}, {v(100, 100)}]"
    lon, lat = sql_l93("p.x", "p.y")
    q = {}
    q["wkt_reproject"] = f"""
WITH g AS (
  SELECT 'BG' || CAST(p_partkey AS VARCHAR) AS batiment_groupe_id,
         CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE {sql_dep_num('(p_partkey % 96 + 1)')} END
           AS code_departement_insee,
         'x' AS s_geom_groupe,
         CASE p_size % 5 WHEN 0 THEN 'Point' WHEN 1 THEN 'Polygon' WHEN 2 THEN 'Polygon'
              WHEN 3 THEN 'MultiPolygon' END AS geom_type,
         CAST(CASE WHEN p_size % 5 = 3 THEN 2 ELSE 1 END AS BIGINT) AS geom_parts,
         CASE p_size % 5 WHEN 0 THEN [{v(0, 0)}] WHEN 1 THEN {sq}
              WHEN 2 THEN list_concat({outer}, {hole}) WHEN 3 THEN list_concat({sq}, {sq2}) END AS pts
  FROM part
),
r AS (SELECT *, list_transform(pts, lambda p: struct_pack(lon := {lon}, lat := {lat})) AS w
      FROM g WHERE geom_type IS NOT NULL)
SELECT batiment_groupe_id, code_departement_insee, s_geom_groupe, geom_type, geom_parts,
       CAST(len(w) AS BIGINT) AS geom_points,
       F32(list_min(list_transform(w, lambda p: p.lon))) AS geom_xmin,
       F32(list_min(list_transform(w, lambda p: p.lat))) AS geom_ymin,
       F32(list_max(list_transform(w, lambda p: p.lon))) AS geom_xmax,
       F32(list_max(list_transform(w, lambda p: p.lat))) AS geom_ymax
FROM r
"""
    lat_t = "CAST(43 + c_custkey % 5 AS VARCHAR) || '.' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0')"
    lon_t = "CAST(c_custkey % 7 AS VARCHAR) || '.' || CAST(c_custkey % 10 AS VARCHAR)"
    q["dpe_points"] = f"""
WITH d AS (
  SELECT 'DPE' || CAST(c_custkey AS VARCHAR) AS numero_dpe,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'immeuble' ELSE 'maison' END
           AS type_batiment,
         chr(CAST(65 + c_custkey % 7 AS INTEGER)) AS etiquette_dpe,
         {sql_dep_num('(c_custkey % 96 + 1)')} AS code_departement_ban,
         CASE c_custkey % 6 WHEN 0 THEN 'x,2' WHEN 1 THEN '1' WHEN 2 THEN '' WHEN 3 THEN NULL
              ELSE {lat_t} || ',' || {lon_t} END AS gp
  FROM customer
),
p AS (
  SELECT *, TRY_CAST(split_part(gp, ',', 1) AS DOUBLE) AS lat,
         CASE WHEN len(string_split(gp, ',')) >= 2 THEN TRY_CAST(split_part(gp, ',', 2) AS DOUBLE) END AS lon
  FROM d WHERE type_batiment = 'immeuble' AND code_departement_ban IN {sql_list(B.DPE_DEPS)}
    AND gp IS NOT NULL AND gp <> ''
)
SELECT numero_dpe, type_batiment, etiquette_dpe, code_departement_ban,
       code_departement_ban AS departement, {point_stats('lon', 'lat', f32=False)}
FROM p WHERE lat IS NOT NULL AND lon IS NOT NULL
"""
    q["building_profile"] = """
WITH b AS (SELECT 'BG' || CAST(o_orderkey AS VARCHAR) AS batiment_groupe_id,
                  {dep} AS code_departement_insee, o_orderstatus AS etat FROM orders),
c AS (SELECT 'BG' || CAST(l_orderkey AS VARCHAR) AS batiment_groupe_id,
             CAST(year(l_shipdate) AS INTEGER) AS construction_annee,
             l_returnflag AS construction_materiau FROM lineitem WHERE l_linenumber = 1),
e AS (SELECT 'BG' || CAST(l_orderkey AS VARCHAR) AS batiment_groupe_id,
             l_linestatus AS energy_dpe_classe, F32(l_quantity * 10) AS energy_dpe_conso
      FROM lineitem WHERE l_linenumber = 2),
r AS (SELECT 'BG' || CAST(l_orderkey AS VARCHAR) AS batiment_groupe_id,
             l_discount > 0.05 AS natural_risks_alea_fort FROM lineitem WHERE l_linenumber = 3),
p AS (SELECT 'BG' || CAST(l_orderkey AS VARCHAR) AS batiment_groupe_id,
             F32(l_extendedprice) AS property_values_valeur FROM lineitem WHERE l_linenumber = 4),
o AS (SELECT 'BG' || CAST(l_orderkey AS VARCHAR) AS batiment_groupe_id,
             l_partkey AS coproperty_nb_lots FROM lineitem WHERE l_linenumber = 5),
s AS (SELECT 'BG' || CAST(l_orderkey AS VARCHAR) AS batiment_groupe_id, l_suppkey AS social_housing_bailleur,
             F32(l_tax) AS social_housing_part_sociale FROM lineitem WHERE l_linenumber = 6),
a AS (SELECT 'BG' || CAST(l_orderkey AS VARCHAR) AS batiment_groupe_id,
             'Rue ' || CAST(l_suppkey AS VARCHAR) AS addresses_libelle FROM lineitem WHERE l_linenumber = 7)
SELECT * FROM b LEFT JOIN c USING (batiment_groupe_id) LEFT JOIN e USING (batiment_groupe_id)
LEFT JOIN r USING (batiment_groupe_id) LEFT JOIN p USING (batiment_groupe_id) LEFT JOIN o USING (batiment_groupe_id)
LEFT JOIN s USING (batiment_groupe_id) LEFT JOIN a USING (batiment_groupe_id)
""".replace("{dep}", sql_dep_num("(o_custkey % 96 + 1)"))
    q["building_star"] = q["building_profile"]
    x = f"({D(700000.0)} + (s_suppkey % 40) * {D(5000.0)})"
    y = f"({D(6500000.0)} + ((s_suppkey // 40) % 40) * {D(5000.0)})"
    slon, slat = sql_l93(x, y)
    clon = f"({D(-5.0)} + (c_custkey % 1300) / {D(100.0)})"
    clat = f"({D(41.0)} + (c_custkey % 1000) / {D(100.0)})"
    q["icu_union"] = f"""
SELECT s_suppkey AS id, s_name AS nom, F32(s_acctbal) AS score, NULL::VARCHAR AS categorie,
       {point_stats(slon, slat)} FROM supplier
UNION ALL
SELECT c_custkey AS id, NULL::VARCHAR AS nom, NULL::DOUBLE AS score, c_mktsegment AS categorie,
       {point_stats(clon, clat)} FROM customer
"""
    elon0, elat0 = sql_l93(x, y)
    elon1, elat1 = sql_l93(f"({x} + {D(500.0)})", f"({y} + {D(500.0)})")
    q["coastal_erosion"] = f"""
SELECT s_suppkey AS id_trait, s_name, F32(s_acctbal) AS taux, 'LineString' AS geom_type,
       CAST(1 AS BIGINT) AS geom_parts, CAST(2 AS BIGINT) AS geom_points,
       F32(least({elon0}, {elon1})) AS geom_xmin, F32(least({elat0}, {elat1})) AS geom_ymin,
       F32(greatest({elon0}, {elon1})) AS geom_xmax, F32(greatest({elat0}, {elat1})) AS geom_ymax
FROM supplier
"""
    dep = sql_dep_num("(s_suppkey % 96 + 1)")
    q["replace_departments"] = f"""
SELECT {dep} AS departement, s_suppkey, s_name, 'old' AS vintage FROM supplier
WHERE {dep} NOT IN {sql_list(B.K1_REQUESTED)}
UNION ALL
SELECT {dep} AS departement, s_suppkey, s_name, 'new' AS vintage FROM supplier
WHERE {dep} IN {sql_list(B.K1_REQUESTED)}
"""
    odep = sql_dep_num("(o_custkey % 96 + 1)")
    q["replace_year_departments"] = f"""
WITH o AS (SELECT o_orderkey, {odep} AS departement, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
SELECT *, 'old' AS vintage FROM o WHERE NOT (year = 1996 AND departement IN {sql_list(B.K1_REQUESTED)})
UNION ALL
SELECT o_orderkey, departement, CAST(1996 AS INTEGER) AS year, 'new' AS vintage FROM o
"""
    return q


# ---------------------------------------------------------------- planning
def planning_oracles() -> dict[str, str]:
    from . import bindings as B
    from ..operators.planning import ZONE_CATEGORIES
    ztype = "CASE " + " ".join(
        f"WHEN p_size % 14 = {i} THEN " + ("NULL" if v is None else f"'{v}'")
        for i, v in enumerate(B.ZONE_TYPES)) + " END"
    base = "upper(regexp_replace(tz, '[0-9csCShH]+$', ''))"
    cat = ("coalesce(" + sql_case("tz", ZONE_CATEGORIES) + ", "
           + sql_case(base, {b: ZONE_CATEGORIES[b] for b in ("U", "AU", "A", "N")}) + ", 'other')")
    com = f"""
com AS (SELECT {sql_commune('s_suppkey')} AS code_commune,
               {sql_dep_num('(s_suppkey % 96 + 1)')} AS departement FROM supplier
        WHERE {sql_dep_num('(s_suppkey % 96 + 1)')} IN {sql_list(B.PLU_DEPS)})"""
    grid = sql_commune("(((o_orderkey // 7) % 150) * 2)")
    docs = f"""
docs AS (SELECT {grid} AS grid_name,
                {sql_case('o_orderkey % 4', {0: 'PLU', 1: 'PLUi', 2: 'CC'})} AS du_type,
                CASE WHEN o_orderkey % 11 = 0 THEN 'DU_99' || {grid} ELSE 'DU_' || {grid} END AS partition,
                o_orderkey AS gid FROM orders)"""
    status = f"""
{com}, {docs},
last AS (SELECT com.departement, com.code_commune, arg_max_null(docs.du_type, docs.gid) AS du_type
         FROM docs JOIN com ON docs.grid_name = com.code_commune
              AND starts_with(docs.partition, 'DU_' || com.departement)
         WHERE docs.grid_name IS NOT NULL AND docs.grid_name <> ''
         GROUP BY com.departement, com.code_commune),
status AS (SELECT com.code_commune, last.du_type, com.departement
           FROM com LEFT JOIN last USING (departement, code_commune))"""
    x = f"({D(700000.0)} + (p_partkey % 40) * {D(5000.0)})"
    y = f"({D(6500000.0)} + ((p_partkey // 40) % 40) * {D(5000.0)})"
    lon, lat = sql_l93(x, y)
    zones = f"""
zones AS (SELECT {sql_commune('(p_partkey % 200)')} AS commune,
                 {sql_dep_num('((p_partkey % 200) % 96 + 1)')} AS departement,
                 {ztype} AS tz, p_name AS libelle, p_type AS libelong,
                 CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS destdomi,
                 'DOC_' || CAST(p_partkey % 50 AS VARCHAR) AS idurba, p_partkey FROM part)"""
    presc = f"""
presc AS (SELECT {sql_commune('((p_partkey * 3) % 200)')} AS commune,
                 {sql_dep_num('(((p_partkey * 3) % 200) % 96 + 1)')} AS departement,
                 lpad(CAST(p_size % 30 AS VARCHAR), 2, '0') AS typepsc, p_name AS libelle,
                 CASE WHEN p_partkey % 3 = 0 THEN p_type END AS stypepsc, p_partkey FROM part)"""
    covered = "SELECT code_commune AS commune, departement FROM status WHERE du_type IS NOT NULL"
    return {
        "zone_category": f"""
SELECT p_partkey, tz AS typezone, {cat} AS zone_category
FROM (SELECT p_partkey, {ztype} AS tz FROM part)
""",
        "document_status": f"WITH {status} SELECT * FROM status",
        "document_type_counts": f"""
WITH {status}
SELECT departement, coalesce(du_type, 'RNU') AS du_type, count(*) AS n FROM status
GROUP BY departement, coalesce(du_type, 'RNU')
""",
        "covered_zones": f"""
WITH {status}, {zones}
SELECT tz AS typezone, {cat} AS zone_category, libelle, libelong, destdomi, idurba,
       NULL::VARCHAR AS datappro, NULL::VARCHAR AS urlfic, departement, {point_stats(lon, lat)}
FROM zones WHERE (commune, departement) IN ({covered})
""",
        "covered_prescriptions": f"""
WITH {status}, {presc}
SELECT typepsc, stypepsc, libelle, NULL::VARCHAR AS txt, departement, {point_stats(lon, lat)}
FROM presc WHERE (commune, departement) IN ({covered})
""",
    }


# ------------------------------------------------------------- atmo feeds
def atmo_oracles() -> dict[str, str]:
    from . import bindings as B
    air = f"""
air AS (
  SELECT {sql_commune('(c_custkey % 700)')} AS commune_code,
         'Zone ' || CAST(c_custkey % 700 AS VARCHAR) AS commune_name,
         c_nationkey % 6 AS quality_index, {sql_case('c_nationkey % 6', B.QUAL_LABELS)} AS quality_label,
         c_custkey % 5 AS no2_index, c_custkey % 4 AS o3_index, c_custkey % 6 AS pm10_index,
         c_custkey % 3 AS pm25_index, c_custkey % 2 AS so2_index, 'atmo' AS source,
         '2024-01-15' AS date,
         CASE WHEN c_custkey % 17 <> 0 THEN {D(-5.0)} + (c_custkey % 1300) / {D(100.0)} END AS lon,
         {D(41.0)} + (c_custkey % 1000) / {D(100.0)} AS lat, c_custkey AS ordinal
  FROM customer
)"""
    air_cols = ("commune_code, commune_name, quality_index, quality_label, no2_index, o3_index, "
                "pm10_index, pm25_index, so2_index, source, date")
    q = {}
    q["air_quality"] = f"""
WITH {air}
SELECT {air_cols}, {point_stats('lon', 'lat', f32=False)}, ordinal FROM air
WHERE lon IS NOT NULL AND lat IS NOT NULL
  AND (substr(commune_code, 1, 2) IN {sql_list(B.AIR_DEPS)}
       OR substr(commune_code, 1, 3) IN {sql_list(B.AIR_DEPS)})
"""
    zk = "((user_id * 7 + event_id % 3) % 800)"
    q["pollen_with_coords"] = f"""
WITH {air},
coords AS (SELECT commune_code, arg_max(struct_pack(lat := lat, lon := lon), ordinal) AS c
           FROM air WHERE lon IS NOT NULL AND lat IS NOT NULL AND commune_code IS NOT NULL
           GROUP BY commune_code),
pol AS (
  SELECT {sql_commune(zk)} AS commune_code, 'Zone ' || CAST({zk} AS VARCHAR) AS commune_name,
         event_id % 6 AS quality_index, {sql_case('event_id % 6', B.QUAL_LABELS)} AS quality_label,
         value > 100 AS alert, event_type AS responsible_pollen,
         event_id % 5 AS birch_index, event_id % 4 AS grass_index, event_id % 3 AS olive_index,
         event_id % 6 AS ragweed_index, event_id % 2 AS mugwort_index, event_id % 7 AS alder_index,
         value * 2 AS birch_conc, value * 3 AS grass_conc, value * 4 AS olive_conc,
         value * 5 AS ragweed_conc, strftime(ts, '%Y-%m-%d') AS date, 'atmo' AS source
  FROM events WHERE event_id % 50 <> 0
)
SELECT pol.*, {point_stats('c.lon', 'c.lat', f32=False)} FROM pol JOIN coords USING (commune_code)
"""
    from ..operators.lookups import IMAGE_URL_PREFIX, IMAGE_URL_SUFFIX
    wiki = osm_oracles()["osm_wiki_pois"]
    q["wikidata_ids"] = f"SELECT DISTINCT wikidata_id FROM ({wiki}) w WHERE wikidata_id IS NOT NULL"
    q["poi_enriched"] = f"""
WITH ent AS (
  SELECT 'Q' || CAST(p_partkey AS VARCHAR) AS qid,
         CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN p_type END AS description,
         CASE WHEN p_partkey % 3 <> 0 THEN '{IMAGE_URL_PREFIX}' || replace(p_name || ' ' || p_brand, ' ', '_')
              || '{IMAGE_URL_SUFFIX}' END AS image_url
  FROM part WHERE p_partkey % 13 <> 0
)
SELECT w.*, ent.description, ent.image_url
FROM ({wiki}) w LEFT JOIN ent ON w.wikidata_id = ent.qid
WHERE ent.description IS NOT NULL OR ent.image_url IS NOT NULL
"""
    return q


# ------------------------------------------------------------------ raster
def assign_oracles() -> dict[str, str]:
    lat = f"({D(41.0)} + (c_custkey * 37 % 1100) / {D(100.0)})"
    lon = f"({D(-5.0)} + (c_custkey * 53 % 1400) / {D(100.0)})"
    first = (f"CASE WHEN c_custkey % 3 = 0 THEN {D(45.5)} ELSE {D(41.0)} + (c_custkey * 37 % 11000) / {D(1000.0)} END",
             f"CASE WHEN c_custkey % 3 = 0 THEN {D(2.25)} ELSE {D(-5.0)} + (c_custkey * 53 % 14000) / {D(1000.0)} END")
    side = (f"CASE s_suppkey % 5 WHEN 0 THEN {D(0.0)} WHEN 1 THEN {D(0.0009)} WHEN 2 THEN {D(0.3)} ELSE {D(0.05)} END")
    return {"department_assign": f"""
SELECT c_custkey, {lat} AS lat, {lon} AS lon, b.dep AS departement
FROM customer JOIN {_boxes_sql()} ON {lat} BETWEEN b.s AND b.n AND {lon} BETWEEN b.w AND b.e
""", "box_assign": f"""
WITH p AS (SELECT c_custkey, {first[0]} AS lat, {first[1]} AS lon FROM customer),
q AS (SELECT * FROM p UNION ALL
      SELECT c_custkey, lat + {D(1.5)}, lon + {D(0.5)} FROM p WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0),
o AS (SELECT s_suppkey, {D(41.0)} + (s_suppkey * 7 % 110) / {D(10.0)} AS s, {D(-5.0)} + (s_suppkey * 13 % 140) / {D(10.0)} AS w,
             {side} AS d FROM supplier),
b AS (SELECT 'B' || CAST(s_suppkey AS VARCHAR) AS departement,
             CASE WHEN s_suppkey % 997 = 1 THEN {D(-90.0)} ELSE s END AS s, CASE WHEN s_suppkey % 997 = 1 THEN {D(-180.0)} ELSE w END AS w,
             CASE WHEN s_suppkey % 997 = 1 THEN {D(90.0)} ELSE s + d END AS n,
             CASE WHEN s_suppkey % 997 = 1 THEN {D(180.0)} ELSE w + d * {D(2.0)} END AS e FROM o)
SELECT DISTINCT c_custkey, departement FROM q JOIN b ON lat BETWEEN s AND n AND lon BETWEEN w AND e
"""}


def raster_oracles() -> dict[str, str]:
    from . import bindings as B
    from ..operators.raster import CELL_ID_STRIDE
    grids = ", ".join(f"({i}, '{dep}', {n}, {D(a)}, {D(e)}, {D(c)}, {D(f)})"
                      for i, (dep, n, a, e, c, f) in enumerate(B.DEM_GRIDS))
    n = len(B.DEM_GRIDS)
    cls = f"""
gr AS (SELECT * FROM (VALUES {grids}) t(i, departement, ncols, a, e, c, f)),
c1 AS (SELECT gr.departement, p_partkey, p_size, (p_partkey - i) // {n} AS j,
              ((p_partkey - i) // {n}) // ncols AS r, ((p_partkey - i) // {n}) % ncols AS q
       FROM part JOIN gr ON p_partkey % {n} = gr.i),
c0 AS (
  SELECT departement, r AS row, q AS col, p_partkey, j,
         CASE WHEN p_partkey % 97 = 0 THEN {D(-9999.0)}
              WHEN r < 25 THEN CAST((p_size // 17) * 20 AS DOUBLE)
              ELSE CAST(abs(r - 37) * 3 + abs(q - 20) * 2 AS DOUBLE) END AS z0
  FROM c1
),
g AS (SELECT gr.*, max(row) + 1 AS nrows FROM gr JOIN c0 USING (departement) GROUP BY ALL),
m AS (SELECT departement, row, col, CASE WHEN j % 53 <> 7 THEN z0 WHEN j % 2 = 0 OR p_partkey % 10 = 0 THEN z0 + 500 END AS z0 FROM c0),
v AS (SELECT departement, row, col, z0 AS z FROM m WHERE z0 >= {D(-1000.0)} AND z0 <= {D(9000.0)}),
dense AS (SELECT departement, row, unnest(range(0, ncols)) AS col, nrows, ncols, dx, dy FROM (
            SELECT departement, unnest(range(0, nrows)) AS row, nrows, ncols,
                   a * {D(111320.0)} * cos(radians(f + (nrows // 2) * e)) AS dx, abs(e) * {D(111320.0)} AS dy FROM g)),
k AS (SELECT dense.*, o.z AS z, w.z AS wz, x.z AS ez, u.z AS nz, d.z AS sz
      FROM dense
      LEFT JOIN v o ON o.departement = dense.departement AND o.row = dense.row AND o.col = dense.col
      LEFT JOIN v w ON w.departement = dense.departement AND w.row = dense.row AND w.col = dense.col - 1
      LEFT JOIN v x ON x.departement = dense.departement AND x.row = dense.row AND x.col = dense.col + 1
      LEFT JOIN v u ON u.departement = dense.departement AND u.row = dense.row - 1 AND u.col = dense.col
      LEFT JOIN v d ON d.departement = dense.departement AND d.row = dense.row + 1 AND d.col = dense.col),
d AS (SELECT departement, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col,
        CASE WHEN ncols < 2 THEN NULL WHEN col = 0 THEN (ez - z) / dx WHEN col = ncols - 1 THEN (z - wz) / dx
             ELSE (ez - wz) / ({D(2.0)} * dx) END AS gx,
        CASE WHEN nrows < 2 THEN NULL WHEN row = 0 THEN (sz - z) / dy WHEN row = nrows - 1 THEN (z - nz) / dy
             ELSE (sz - nz) / ({D(2.0)} * dy) END AS gy
      FROM k),
s AS (SELECT departement, row, col, degrees(atan(sqrt(gx * gx + gy * gy))) AS slope,
             (degrees(atan2(-gx, gy)) + 360) % 360 AS aspect FROM d),
cls AS (
  SELECT departement, row, col,
         CASE WHEN slope >= 2 AND aspect >= 135 AND aspect <= 225 THEN 'high_exposure'
              WHEN slope >= 2 AND (aspect >= 315 OR aspect <= 45) THEN 'low_exposure'
              WHEN slope >= 2 THEN 'moderate' ELSE 'flat' END AS exposure
  FROM s WHERE slope IS NOT NULL
)"""
    q = {}
    q["exposure_classes"] = f"WITH {cls} SELECT * FROM cls"
    q["exposure_regions"] = f"""
WITH RECURSIVE {cls},
nodes AS (SELECT departement, CAST(row AS BIGINT) * {CELL_ID_STRIDE} + col AS id, exposure, row, col FROM cls),
e1 AS (SELECT a.departement, a.id AS s, b.id AS d FROM nodes a JOIN nodes b
         ON a.departement = b.departement AND a.exposure = b.exposure AND b.row = a.row AND b.col = a.col + 1
       UNION ALL
       SELECT a.departement, a.id AS s, b.id AS d FROM nodes a JOIN nodes b
         ON a.departement = b.departement AND a.exposure = b.exposure AND b.row = a.row + 1 AND b.col = a.col),
edges AS (SELECT departement, s, d FROM e1 UNION ALL SELECT departement, d AS s, s AS d FROM e1),
cc(departement, id, label) AS (
  SELECT departement, id, id FROM nodes
  UNION
  SELECT cc.departement, edges.d, cc.label FROM cc JOIN edges ON cc.departement = edges.departement AND cc.id = edges.s
),
lab AS (SELECT departement, id, min(label) AS region_id FROM cc GROUP BY departement, id)
SELECT departement, region_id, exposure, count(*) AS n_cells,
       min(row) AS row_min, max(row) AS row_max, min(col) AS col_min, max(col) AS col_max
FROM nodes JOIN lab USING (departement, id) GROUP BY departement, region_id, exposure
"""
    q["exposure_region_parts"] = q["exposure_regions"].split("SELECT departement, region_id, exposure, count(*)")[0].rstrip() + f""",
rc AS (SELECT departement, region_id, exposure, row, col,
              col - row_number() OVER (PARTITION BY departement, region_id, row ORDER BY col) AS k
       FROM nodes JOIN lab USING (departement, id)),
runs AS (SELECT departement, region_id, exposure, row, min(col) AS col_start, max(col) AS col_end
         FROM rc GROUP BY departement, region_id, exposure, row, k)
SELECT departement, region_id, exposure, row, col_start, col_end,
       CAST(col_end - col_start + 1 AS BIGINT) AS n_cells,
       'Polygon' AS geom_type, CAST(1 AS BIGINT) AS geom_parts, CAST(5 AS BIGINT) AS geom_points,
       F32(c + col_start * a) AS geom_xmin, F32(f + (row + 1) * e) AS geom_ymin,
       F32(c + (col_end + 1) * a) AS geom_xmax, F32(f + row * e) AS geom_ymax
FROM runs JOIN gr USING (departement)
"""
    q["exposure_region_shapes"] = q["exposure_regions"].split("SELECT departement, region_id, exposure, count(*)")[0].rstrip() + f""",
lc AS (SELECT departement, region_id, exposure, row, col FROM nodes JOIN lab USING (departement, id)),
quads AS (
  SELECT departement, region_id, exposure, vr, vc, sum(b) AS mask, count(*) AS bits FROM (
    SELECT departement, region_id, exposure, row + 1 AS vr, col + 1 AS vc, 1 AS b FROM lc
    UNION ALL SELECT departement, region_id, exposure, row + 1, col, 2 FROM lc
    UNION ALL SELECT departement, region_id, exposure, row, col + 1, 4 FROM lc
    UNION ALL SELECT departement, region_id, exposure, row, col, 8 FROM lc) t
  GROUP BY departement, region_id, exposure, vr, vc),
per AS (
  SELECT departement, region_id, exposure,
         sum(CASE WHEN bits = 1 THEN 1 ELSE 0 END) AS q1,
         sum(CASE WHEN bits = 3 THEN 1 ELSE 0 END) AS q3,
         sum(CASE WHEN mask IN (6, 9) THEN 1 ELSE 0 END) AS qd,
         (SELECT count(*) FROM lc WHERE lc.region_id = quads.region_id
            AND lc.departement = quads.departement) AS n
  FROM quads GROUP BY departement, region_id, exposure)
SELECT departement, region_id, exposure, CAST(n AS BIGINT) AS n_cells,
       F32(n * abs(a * e)) AS area, CAST(2 - (q1 - q3 + 2 * qd) / 4 AS BIGINT) AS n_rings
FROM per JOIN gr USING (departement)
"""
    # Ring corners: grid vertices where the region's boundary turns, i.e. one
    # or three of the four cells around belong to it (one corner), or two
    # diagonal ones (two corners).
    q["exposure_ring_corners"] = q["exposure_region_shapes"].split("per AS (")[0].rstrip() + """
turns AS (SELECT departement, region_id, exposure, vr, vc, 1 AS k FROM quads WHERE bits IN (1, 3)
          UNION ALL SELECT departement, region_id, exposure, vr, vc, unnest([1, 2]) FROM quads WHERE bits = 2 AND mask IN (6, 9))
SELECT departement, region_id, exposure, F32(c + vc * a) AS lon, F32(f + vr * e) AS lat
FROM turns JOIN gr USING (departement)
"""
    q["exposure_polygons"] = q["exposure_region_shapes"].split("per AS (")[0].rstrip() + """
cor AS (SELECT departement, region_id, exposure, sum(CASE WHEN bits IN (1, 3) THEN 1 WHEN mask IN (6, 9) THEN 2 ELSE 0 END) AS n,
               sum(CASE WHEN bits = 1 THEN 1 ELSE 0 END) AS q1, sum(CASE WHEN bits = 3 THEN 1 ELSE 0 END) AS q3,
               sum(CASE WHEN mask IN (6, 9) THEN 1 ELSE 0 END) AS qd FROM quads GROUP BY departement, region_id, exposure),
ext AS (SELECT departement, region_id, min(row) AS r0, max(row) + 1 AS r1, min(col) AS c0, max(col) + 1 AS c1
        FROM lc GROUP BY departement, region_id)
SELECT departement, region_id, exposure AS exposition, CAST(2 - (q1 - q3 + 2 * qd) / 4 AS BIGINT) AS n_rings,
       'Polygon' AS geom_type, CAST(1 AS BIGINT) AS geom_parts,
       CAST(n + 2 - (q1 - q3 + 2 * qd) / 4 AS BIGINT) AS geom_points,
       F32(c + c0 * a) AS geom_xmin, F32(f + r1 * e) AS geom_ymin, F32(c + c1 * a) AS geom_xmax, F32(f + r0 * e) AS geom_ymax
FROM cor JOIN ext USING (departement, region_id) JOIN gr USING (departement)
"""
    side = 1 / B.TILE_SIDE
    q["department_cells"] = f"""
WITH t AS (SELECT CAST(43 + (p_partkey // {B.TILE_SIDE ** 2}) % 3 AS INTEGER) AS lat,
                  CAST(1 + (p_partkey // {B.TILE_SIDE ** 2}) // 3 AS INTEGER) AS lon,
                  (p_partkey % {B.TILE_SIDE ** 2}) // {B.TILE_SIDE} AS r, (p_partkey % {B.TILE_SIDE ** 2}) % {B.TILE_SIDE} AS q,
                  p_retailprice AS z FROM part),
b AS (SELECT 'B' || CAST(i AS VARCHAR) AS departement, {D(42.81)} AS s, {D(0.77)} + CAST(i AS DOUBLE) * {D(2.0)} AS w,
             {D(46.12)} AS n, {D(3.31)} + CAST(i AS DOUBLE) * {D(2.0)} AS e
      FROM (SELECT unnest(range(0, max((p_partkey // {B.TILE_SIDE ** 2}) // 6) + 1)) AS i FROM part)),
x AS (SELECT departement, lat, lon, z,
             CAST(floor(((lat + 1 + (r + {D(0.5)}) * {D(-side)}) - n) / {D(-side)}) AS INTEGER) AS row,
             CAST(floor(((lon + (q + {D(0.5)}) * {D(side)}) - w) / {D(side)}) AS INTEGER) AS col,
             CAST(round((n - s) / {D(side)}) AS INTEGER) AS nrows, CAST(round((e - w) / {D(side)}) AS INTEGER) AS ncols
      FROM t JOIN b ON lat BETWEEN floor(s) AND floor(n) AND lon BETWEEN floor(w) AND floor(e)),
k AS (SELECT *, row_number() OVER (PARTITION BY departement, row, col ORDER BY lat, lon, z) AS rn FROM x
      WHERE row >= 0 AND row < nrows AND col >= 0 AND col < ncols)
SELECT departement, row, col, z FROM k WHERE rn = 1
"""
    q["exposure_region_rings"] = q["exposure_region_shapes"].split("SELECT departement, region_id, exposure, CAST(n AS BIGINT)")[0] + """
SELECT departement, region_id, exposure, CAST(2 - (q1 - q3 + 2 * qd) / 4 AS BIGINT) AS n_rings,
       CAST(n AS BIGINT) AS n_cells
FROM per
"""
    south = f"({D(-20.0)} + (s_suppkey % 700) / {D(10.0)})"
    west = f"({D(-60.0)} + (s_suppkey % 1200) / {D(10.0)})"
    north = f"({south} + (s_suppkey % 3) * {D(0.7)})"
    east = f"({west} + (s_suppkey % 4) * {D(0.6)})"
    q["tiles_for_bbox"] = f"""
WITH b AS (SELECT 'B' || CAST(s_suppkey AS VARCHAR) AS departement,
                  CAST(floor({south}) AS INTEGER) AS s0, CAST(floor({north}) AS INTEGER) AS n0,
                  CAST(floor({west}) AS INTEGER) AS w0, CAST(floor({east}) AS INTEGER) AS e0
           FROM supplier),
t AS (SELECT departement, unnest(range(s0, n0 + 1)) AS lat, w0, e0 FROM b),
u AS (SELECT departement, lat, unnest(range(w0, e0 + 1)) AS lon FROM t)
SELECT departement, CAST(lat AS INTEGER) AS lat, CAST(lon AS INTEGER) AS lon,
       'Copernicus_DSM_COG_30_' || CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END
       || lpad(CAST(abs(lat) AS VARCHAR), 2, '0') || '_00_' || CASE WHEN lon >= 0 THEN 'E' ELSE 'W' END
       || lpad(CAST(abs(lon) AS VARCHAR), 3, '0') || '_00_DEM' AS tile
FROM u
"""
    return q


# --------------------------------------------------------------- text forms
def parse_oracles() -> dict[str, str]:
    q = {}
    lon = f"((c_custkey % 800) / {D(100.0)})"
    lat = f"({D(41.0)} + (c_custkey % 1000) / {D(100.0)})"
    q["parse_geojson"] = f"""
SELECT {sql_commune('c_custkey')} AS code_commune, 'Commune ' || CAST(c_custkey AS VARCHAR) AS nom_commune,
       {sql_dep_num('(c_custkey % 96 + 1)')} AS departement,
       'Polygon' AS geom_type, CAST(1 AS BIGINT) AS geom_parts, CAST(4 AS BIGINT) AS geom_points,
       {lon} AS geom_xmin, {lat} AS geom_ymin, {lon} + {D(0.01)} AS geom_xmax, {lat} + {D(0.01)} AS geom_ymax
FROM customer
"""
    amount = ("CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(CAST(c_custkey * 37 % 100000 AS VARCHAR) "
              "|| '.' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS DOUBLE) END")
    q["parse_decimal_csv"] = f"""
SELECT {sql_commune('c_custkey')} AS code, c_name AS name, {amount} AS amount, c_mktsegment AS segment
FROM customer
"""
    note = ("CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'first' || chr(10) || '\"second\"; line,' || chr(10) "
            "|| CAST(c_custkey AS VARCHAR) WHEN c_custkey % 3 = 1 THEN '\"' ELSE 'plain ' || CAST(c_custkey AS VARCHAR) END")
    q["parse_quoted_csv"] = f"""
SELECT {sql_commune('c_custkey')} AS code, 'Shop \"' || c_name || '\", ' || c_mktsegment AS shop, {note} AS note,
       CAST(c_custkey AS VARCHAR) AS key
FROM customer
"""
    q["parse_collections"] = q["parse_geojson"]
    osm = osm_oracles()
    q["parse_osm"] = osm["osm_green_spaces"]
    other = atmo_oracles()
    ent = other["poi_enriched"].split("SELECT w.*")[0]
    q["parse_entities"] = ent + "SELECT qid, description, image_url FROM ent\n"
    q["parse_dpe_pages"] = building_oracles()["dpe_points"]
    q["parse_atmo"] = other["air_quality"]
    return q
