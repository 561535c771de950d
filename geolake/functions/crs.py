"""Projected coordinates -> WGS84 as pure Column math: Lambert-93 (EPSG:2154),
the nine conic zones (3942-3950), the NTF Lambert zones (27561-27564,
27571-27574, with their datum), Web Mercator (3857) and the UTM zones of the
overseas departments (any WGS84 UTM zone works).

Lambert Conformal Conic, two standard parallels, on the GRS80 ellipsoid.
RGF93 is treated as identical to WGS84 (no datum shift, as for the usual
EPSG:2154 -> EPSG:4326 transformation).  The inverse latitude is solved by
a fixed number of fixed-point iterations, unrolled into the expression tree,
so the whole transform stays inside whole-stage codegen (no UDF).
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import bind, map_points, xy

# --- fixed values -----------------------------------------------------------
# GRS80 ellipsoid and the Lambert-93 projection parameters (EPSG:2154).
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
L93_LAT1 = 44.0
L93_LAT2 = 49.0
L93_LAT0 = 46.5
L93_LON0 = 3.0
L93_X0 = 700000.0
L93_Y0 = 6600000.0
# UTM: scale on the central meridian, false easting, false northing (south).
UTM_K0, UTM_E0, UTM_N0_SOUTH = 0.9996, 500000.0, 10000000.0
# National realisations of UTM: EPSG code -> (zone, southern).
UTM_NATIONAL = {4559: (20, False), 5490: (20, False), 2972: (22, False), 4471: (38, True), 2975: (40, True)}
WGS84_CODES = (4326, 4171, 4258)   # geographic, same as WGS84 within a metre
# Clarke 1880 (IGN), the NTF's ellipsoid; its shift to WGS84 in metres; Paris.
CLARKE_A, CLARKE_B = 6378249.2, 6356515.0
NTF_SHIFT = (-168.0, -60.0, 320.0)
PARIS = 2.33722917
# NTF Lambert zones: latitude of origin and scale of zones I to IV, then EPSG
# code -> (zone, false easting, false northing).
NTF_ZONES = ((49.5, 0.999877341), (46.8, 0.99987742), (44.1, 0.999877499), (42.165, 0.99994471))
NTF_CODES = {27561: (0, 600000.0, 200000.0), 27562: (1, 600000.0, 200000.0), 27563: (2, 600000.0, 200000.0),
             27564: (3, 234.358, 185861.369), 27571: (0, 600000.0, 1200000.0), 27572: (1, 600000.0, 2200000.0),
             27573: (2, 600000.0, 3200000.0), 27574: (3, 234.358, 4185861.369)}
# Conic zones CC42 to CC50: code 3900 + latitude of origin; parallels 0.75
# degrees to either side of it.
CC_CODES, CC_HALF, CC_X0 = range(3942, 3951), 0.75, 1700000.0
MERCATOR_CODE = 3857
# --- end of fixed values ----------------------------------------------------

_E = math.sqrt(2 * GRS80_F - GRS80_F ** 2)
_ITER = 6


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - (_E * math.sin(phi)) ** 2)


def _t(phi: float) -> float:
    es = _E * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (_E / 2)


_P1, _P2, _P0 = (math.radians(v) for v in (L93_LAT1, L93_LAT2, L93_LAT0))
N = (math.log(_m(_P1)) - math.log(_m(_P2))) / (math.log(_t(_P1)) - math.log(_t(_P2)))
AF = GRS80_A * _m(_P1) / (N * _t(_P1) ** N)   # a * F
RHO0 = AF * _t(_P0) ** N
LON0 = math.radians(L93_LON0)


def l93_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """(easting, northing) metres -> (lon, lat) degrees."""
    dx = x - F.lit(L93_X0)
    dy = F.lit(RHO0) - (y - F.lit(L93_Y0))
    rho = F.sqrt(dx * dx + dy * dy)
    lon = F.atan2(dx, dy) / F.lit(N) + F.lit(LON0)

    def latitude(t):
        phi = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t)
        for _ in range(_ITER):
            # (1 - es) / (1 + es) written with es once, keeping the tree linear.
            ratio = F.lit(2.0) / (F.lit(1.0) + F.lit(_E) * F.sin(phi)) - F.lit(1.0)
            phi = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t * F.pow(ratio, F.lit(_E / 2)))
        return phi
    phi = bind(F.pow(rho / F.lit(AF), F.lit(1.0 / N)), latitude)
    return F.degrees(lon), F.degrees(phi)


# Third flattening and the inverse transverse Mercator series (Krueger).
_N3 = GRS80_F / (2 - GRS80_F)
TM_RADIUS = GRS80_A / (1 + _N3) * (1 + _N3 ** 2 / 4 + _N3 ** 4 / 64)
TM_BETA = (_N3 / 2 - 2 * _N3 ** 2 / 3 + 37 * _N3 ** 3 / 96, _N3 ** 2 / 48 + _N3 ** 3 / 15, 17 * _N3 ** 3 / 480)
TM_DELTA = (2 * _N3 - 2 * _N3 ** 2 / 3 - 2 * _N3 ** 3, 7 * _N3 ** 2 / 3 - 8 * _N3 ** 3 / 5, 56 * _N3 ** 3 / 15)


def utm_to_lonlat(x: Column, y: Column, zone: int, south: bool) -> tuple[Column, Column]:
    """UTM (easting, northing) metres -> (lon, lat) degrees."""
    scale = UTM_K0 * TM_RADIUS
    xi = (y - F.lit(UTM_N0_SOUTH if south else 0.0)) / F.lit(scale)
    eta = (x - F.lit(UTM_E0)) / F.lit(scale)
    xi1, eta1 = xi, eta
    for j, b in enumerate(TM_BETA, 1):
        xi1 = xi1 - F.lit(b) * F.sin(xi * (2.0 * j)) * F.cosh(eta * (2.0 * j))
        eta1 = eta1 - F.lit(b) * F.cos(xi * (2.0 * j)) * F.sinh(eta * (2.0 * j))
    lon = F.lit(math.radians(6 * zone - 183)) + F.atan2(F.sinh(eta1), F.cos(xi1))

    def latitude(chi):
        phi = chi
        for j, d in enumerate(TM_DELTA, 1):
            phi = phi + F.lit(d) * F.sin(chi * (2.0 * j))
        return phi
    lat = bind(F.asin(F.sin(xi1) / F.cosh(eta1)), latitude)
    return F.degrees(lon), F.degrees(lat)


def utm_zone(epsg: int) -> tuple[int, bool] | None:
    """(zone, southern) of an EPSG code, None if it is no UTM code known here."""
    if epsg in UTM_NATIONAL:
        return UTM_NATIONAL[epsg]
    if 32601 <= epsg <= 32660:
        return epsg - 32600, False
    if 32701 <= epsg <= 32760:
        return epsg - 32700, True
    return None


def lonlat_to_l93(lon: Column, lat: Column) -> tuple[Column, Column]:
    """(lon, lat) degrees -> (easting, northing) metres (forward LCC)."""
    phi = F.radians(lat)
    es = F.lit(_E) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(_E / 2))
    rho = F.lit(AF) * F.pow(t, F.lit(N))
    theta = F.lit(N) * (F.radians(lon) - F.lit(LON0))
    return F.lit(L93_X0) + rho * F.sin(theta), F.lit(L93_Y0) + F.lit(RHO0) - rho * F.cos(theta)


def l93_to_wgs84(geom: Column) -> Column:
    """Reproject every vertex of a Lambert-93 geometry to WGS84."""
    return map_points(geom, lambda x, y: xy(*l93_to_lonlat(x, y)))


def utm_to_wgs84(geom: Column, zone: int, south: bool) -> Column:
    return map_points(geom, lambda x, y: xy(*utm_to_lonlat(x, y, zone, south)))


class Conic:
    """A Lambert conformal conic projection: with two standard parallels, or
    with one and a scale; ``shift`` is its datum's to WGS84."""

    def __init__(self, a: float, b: float, lat0: float, lon0: float, x0: float, y0: float,
                 parallels: tuple[float, float] | None = None, scale: float = 1.0, shift: tuple[float, float, float] | None = None):
        self.a, self.b, self.x0, self.y0, self.shift, self.lon0 = a, b, x0, y0, shift, math.radians(lon0)
        self.e = e = math.sqrt(1 - (b / a) ** 2)

        def m(phi):
            return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

        def t(phi):
            return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)
        phi0 = math.radians(lat0)
        one, two = (math.radians(v) for v in parallels or (lat0, lat0))
        self.n = math.sin(phi0) if parallels is None else (math.log(m(one)) - math.log(m(two))) / (math.log(t(one)) - math.log(t(two)))
        self.af = scale * a * m(one) / (self.n * t(one) ** self.n)
        self.rho0 = self.af * t(phi0) ** self.n


def conic(code: int) -> Conic | None:
    """The conic projection of an EPSG code, None if it is none known here."""
    grs80_b = GRS80_A * (1 - GRS80_F)
    if code in CC_CODES:
        lat0 = float(code - 3900)
        return Conic(GRS80_A, grs80_b, lat0, L93_LON0, CC_X0, 1e6 * (lat0 - 41) + 2e5, (lat0 - CC_HALF, lat0 + CC_HALF))
    if code in NTF_CODES:
        zone, x0, y0 = NTF_CODES[code]
        lat0, scale = NTF_ZONES[zone]
        return Conic(CLARKE_A, CLARKE_B, lat0, PARIS, x0, y0, scale=scale, shift=NTF_SHIFT)
    return None


def _conic_radians(x: Column, y: Column, c: Conic) -> tuple[Column, Column]:
    dx, dy = x - F.lit(c.x0), F.lit(c.rho0) - (y - F.lit(c.y0))

    def latitude(t):
        phi = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t)
        for _ in range(_ITER):
            ratio = F.lit(2.0) / (F.lit(1.0) + F.lit(c.e) * F.sin(phi)) - F.lit(1.0)
            phi = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t * F.pow(ratio, F.lit(c.e / 2)))
        return phi
    phi = bind(F.pow(F.sqrt(dx * dx + dy * dy) / F.lit(c.af), F.lit(1.0 / c.n)), latitude)
    return F.atan2(dx, dy) / F.lit(c.n) + F.lit(c.lon0), phi


def _shifted(point: Column, c: Conic) -> Column:
    """(lon, lat) radians on ``c``'s ellipsoid -> degrees on WGS84, through
    geocentric coordinates of a point at height 0."""
    e2 = 1 - (c.b / c.a) ** 2
    a, b = GRS80_A, GRS80_A * (1 - GRS80_F)
    f2, g2 = 1 - (b / a) ** 2, (a / b) ** 2 - 1
    lon, lat = point["x"], point["y"]

    def geocentric(v):
        flat = v * F.cos(lat)
        return F.struct((flat * F.cos(lon) + c.shift[0]).alias("x"), (flat * F.sin(lon) + c.shift[1]).alias("y"),
                        (v * (1 - e2) * F.sin(lat) + c.shift[2]).alias("z"))

    def geodetic(q):
        p = F.sqrt(q["x"] * q["x"] + q["y"] * q["y"])
        u = F.atan2(q["z"] * a, p * b)
        north = q["z"] + g2 * b * F.pow(F.sin(u), F.lit(3.0))
        return xy(F.degrees(F.atan2(q["y"], q["x"])), F.degrees(F.atan2(north, p - f2 * a * F.pow(F.cos(u), F.lit(3.0)))))
    return bind(bind(F.lit(c.a) / F.sqrt(1 - e2 * F.sin(lat) * F.sin(lat)), geocentric), geodetic)


def conic_to_wgs84(geom: Column, c: Conic) -> Column:
    """Reproject every vertex of a conic projection, and shift its datum."""
    def point(x: Column, y: Column) -> Column:
        lon, lat = _conic_radians(x, y, c)
        if c.shift is None:
            return xy(F.degrees(lon), F.degrees(lat))
        return bind(xy(lon, lat), lambda p: _shifted(p, c))
    return map_points(geom, point)


def mercator_to_wgs84(geom: Column) -> Column:
    """Web Mercator (on the sphere of the ellipsoid's radius)."""
    return map_points(geom, lambda x, y: xy(F.degrees(x / GRS80_A), F.degrees(F.atan(F.sinh(y / GRS80_A)))))


# Codes a column of codes may hold unless told otherwise: the national grids.
COLUMN_CODES = (2154, *UTM_NATIONAL)
#: The other systems of metropolitan France.
FRENCH_CODES = (*CC_CODES, *NTF_CODES, MERCATOR_CODE)


def to_wgs84(geom: Column, src_epsg: Column | int | None, codes: Iterable[int] = COLUMN_CODES) -> Column:
    """Reproject from the source CRS.  WGS84 and an undeclared CRS (None /
    NULL) pass as is; an unknown code is an error, never a silent pass.
    ``codes`` are those that a column may hold."""
    if src_epsg is None:
        return geom
    if isinstance(src_epsg, int):
        if src_epsg in WGS84_CODES:
            return geom
        if src_epsg == 2154:
            return l93_to_wgs84(geom)
        if src_epsg == MERCATOR_CODE:
            return mercator_to_wgs84(geom)
        if (c := conic(src_epsg)) is not None:
            return conic_to_wgs84(geom, c)
        zone = utm_zone(src_epsg)
        if zone is None:
            raise ValueError(f"EPSG:{src_epsg} is not supported")
        return utm_to_wgs84(geom, *zone)
    code = src_epsg.cast("int")
    out = F.when(code.isNull() | code.isin(*WGS84_CODES), geom)
    for c in codes:
        out = out.when(code == c, to_wgs84(geom, c))
    return out.otherwise(F.raise_error(F.concat(F.lit("unsupported EPSG:"), code.cast("string"))))


def source_crs(df, default: int | None) -> Column | int | None:
    """The CRS of a layer's rows: their ``src_epsg`` column (``default`` where
    it is NULL) if they carry one, else ``default``."""
    if "src_epsg" not in df.columns:
        return default
    return F.coalesce(F.col("src_epsg").cast("int"), F.lit(default).cast("int"))
