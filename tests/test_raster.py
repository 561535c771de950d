import random

import pytest
from pyspark.sql import functions as F

from geolake.operators import raster as R

A, E, FN = 1 / 1200, -1 / 1200, 48.9


def _grid(spark, nrows, ncols, a=A, e=E, c=2.2, f=FN, deps=("75",)):
    return spark.createDataFrame([(d, a, e, c, f, nrows, ncols) for d in deps],
                                 "departement string, a double, e double, c double, f double, nrows int, ncols int")


def _plane(spark, fz, n=12):
    rows = [("75", 0, r, c, float(fz(r, c))) for r in range(n) for c in range(n)]
    return spark.createDataFrame(rows, "departement string, tile_rank int, row int, col int, z double")


@pytest.mark.parametrize("fz,expected", [
    (lambda r, c: 100 - 10 * r, "high_exposure"),   # falls southward: faces south
    (lambda r, c: 100 + 10 * r, "low_exposure"),    # rises southward: faces north
    (lambda r, c: 100 + 10 * c, "moderate"),        # faces west
    (lambda r, c: 100.0, "flat"),
])
def test_planes(spark, fz, expected):
    cls = R.classify_exposure(R.mosaic(_plane(spark, fz)), _grid(spark, 12, 12))
    assert cls.count() == 144
    assert {r.exposure for r in cls.collect()} == {expected}


def test_isolated_nodata_cell_classified_neighbours_excluded(spark):
    cells = _plane(spark, lambda r, c: -9999 if (r, c) == (5, 5) else 100 + 10 * r)
    got = {(r.row, r.col) for r in R.classify_exposure(cells, _grid(spark, 12, 12)).collect()}
    assert (5, 5) in got
    assert not ({(4, 5), (6, 5), (5, 4), (5, 6)} & got)


def _unit(spark):
    return _grid(spark, 100, 100, 1.0, 1.0, 0.0, 0.0)


def test_gap_of_absent_cells_is_nodata_not_an_edge(spark):
    """Absent rows and columns give what the same cells with nodata give."""
    def fz(r, c):
        return 100 + 10 * r + 3 * c
    gone = {(r, c) for r in range(12) for c in range(12) if c in (5, 6) or r == 8 or (r, c) == (2, 2)}
    absent = _plane(spark, fz).where(~F.struct("row", "col").isin([F.struct(F.lit(r), F.lit(c)) for r, c in sorted(gone)]))
    nodata = _plane(spark, lambda r, c: -9999 if (r, c) in gone else fz(r, c))
    a, b = (sorted(map(tuple, R.slope_aspect(x, _grid(spark, 12, 12)).where("slope is not null").collect())) for x in (absent, nodata))
    assert a == b and 0 < len(a) < 144
    assert not {(r, 4) for r in range(12)} & {(x[1], x[2]) for x in a}


def test_each_department_uses_its_own_grid(spark):
    plane = _plane(spark, lambda r, c: 100 + 2 * c)
    both = plane.unionByName(plane.withColumn("departement", F.lit("971")))
    grid = _grid(spark, 12, 12).unionByName(_grid(spark, 12, 12, f=16.5, a=1 / 300, deps=("971",)))
    got = {r.departement: r.s for r in R.slope_aspect(both, grid).groupBy("departement").agg(F.max("slope").alias("s")).collect()}
    import math
    for dep, a, f in (("75", A, FN), ("971", 1 / 300, 16.5)):
        dx = a * 111320.0 * math.cos(math.radians(f + 6 * E))
        assert abs(got[dep] - math.degrees(math.atan(2 / dx))) < 1e-9


def test_tiles_are_clipped_to_department_grids(spark):
    boxes = spark.createDataFrame([("A", 44.5, 1.5, 46.0, 2.5)], "departement string, south double, west double, north double, east double")
    grid = R.department_grid(boxes, 0.1, -0.1)
    assert (grid.first().nrows, grid.first().ncols) == (15, 10)
    rows = [(la, lo, r, c, la * 1000 + lo * 100 + r * 10 + c * 1.0) for la, lo in ((44, 1), (45, 1), (45, 2), (50, 5)) for r in range(10) for c in range(10)]
    got = {(r.row, r.col): r.z for r in R.mosaic(R.department_cells(spark.createDataFrame(
        rows, "lat int, lon int, row int, col int, z double"), boxes, grid)).collect()}
    # North-west corner: the middle of tile (45, 1); below row 10 tile (44, 1); (44, 2) is absent.
    assert got[(0, 0)] == 45000 + 100 + 0 + 5 and got[(9, 4)] == 45000 + 100 + 90 + 9 and got[(0, 5)] == 45000 + 200
    assert got[(10, 0)] == 44000 + 100 + 5 and got[(14, 4)] == 44000 + 100 + 40 + 9 and (10, 5) not in got
    assert len(got) == 150 - 25


def _flood_fill(grid):
    lab, comps = {}, []
    for (r, c), k in grid.items():
        if (r, c) in lab:
            continue
        stack, members = [(r, c)], []
        lab[(r, c)] = len(comps)
        while stack:
            cr, cc = stack.pop()
            members.append((cr, cc))
            for nr, nc in ((cr + 1, cc), (cr - 1, cc), (cr, cc + 1), (cr, cc - 1)):
                if grid.get((nr, nc)) == k and (nr, nc) not in lab:
                    lab[(nr, nc)] = lab[(r, c)]
                    stack.append((nr, nc))
        comps.append((min(a * R.CELL_ID_STRIDE + b for a, b in members), k, len(members)))
    return sorted(comps)


@pytest.mark.parametrize("tile", [(256, 1024), (5, 4), (1, 1000), (1000, 3)])
def test_regions_match_flood_fill(spark, tile):
    rnd = random.Random(11)
    names = ["flat", "high_exposure", "low_exposure", "moderate"]
    grid = {(r, c): rnd.choice(names[:2]) for r in range(30) for c in range(17)
            if rnd.random() > 0.05}
    df = spark.createDataFrame([("75", r, c, k) for (r, c), k in grid.items()],
                               "departement string, row int, col int, exposure string")
    got = sorted((r.region_id, r.exposure, r.n_cells)
                 for r in R.exposure_regions(df, *tile).collect())
    assert got == _flood_fill(grid)


def test_tiles_for_bbox(spark):
    df = spark.createDataFrame([("x", -0.5, -1.2, 1.1, 0.2)],
                               "departement string, south double, west double, north double, east double")
    tiles = {r.tile for r in R.tiles_for_bbox(df).collect()}
    assert len(tiles) == 3 * 3
    assert "Copernicus_DSM_COG_30_S01_00_W002_00_DEM" in tiles
    assert "Copernicus_DSM_COG_30_N01_00_E000_00_DEM" in tiles


def _holes(cells):
    """Enclosed 8-connected components of the complement (pure Python)."""
    rows = [r for r, _ in cells]
    cols = [c for _, c in cells]
    r0, r1, c0, c1 = min(rows) - 1, max(rows) + 1, min(cols) - 1, max(cols) + 1
    seen, holes = set(), 0
    for r in range(r0, r1 + 1):
        for c in range(c0, c1 + 1):
            if (r, c) in cells or (r, c) in seen:
                continue
            stack, border = [(r, c)], False
            seen.add((r, c))
            while stack:
                cr, cc = stack.pop()
                if cr in (r0, r1) or cc in (c0, c1):
                    border = True
                for dr in (-1, 0, 1):
                    for dc in (-1, 0, 1):
                        nr, nc = cr + dr, cc + dc
                        if r0 <= nr <= r1 and c0 <= nc <= c1 and (nr, nc) not in cells \
                                and (nr, nc) not in seen:
                            seen.add((nr, nc))
                            stack.append((nr, nc))
            holes += 0 if border else 1
    return holes


def test_region_ring_counts_match_flood_fill(spark):
    rnd = random.Random(5)
    names = ["flat", "high_exposure"]
    grid = {(r, c): rnd.choice(names) for r in range(25) for c in range(20) if rnd.random() > 0.1}
    # a ring with a hole and a ring with a diagonal leak (no hole under 4/8 connectivity)
    for r in range(30, 35):
        for c in range(0, 5):
            grid[(r, c)] = "moderate" if (r in (30, 34) or c in (0, 4)) else "low_exposure"
    df = spark.createDataFrame([("75", r, c, k) for (r, c), k in grid.items()],
                               "departement string, row int, col int, exposure string")
    shapes = {r.region_id: (r.n_cells, r.n_rings) for r in R.region_shapes(df, _unit(spark), 7, 6).collect()}
    seen = set()
    expected = {}
    for (r, c), k in sorted(grid.items()):
        if (r, c) in seen:
            continue
        stack, members = [(r, c)], {(r, c)}
        seen.add((r, c))
        while stack:
            cr, cc = stack.pop()
            for nr, nc in ((cr + 1, cc), (cr - 1, cc), (cr, cc + 1), (cr, cc - 1)):
                if grid.get((nr, nc)) == k and (nr, nc) not in seen:
                    seen.add((nr, nc))
                    members.add((nr, nc))
                    stack.append((nr, nc))
        rid = min(a * R.CELL_ID_STRIDE + b for a, b in members)
        expected[rid] = (len(members), 1 + _holes(members))
    assert shapes == expected
    assert any(v[1] > 1 for v in expected.values())


def test_region_rings_close_and_match_shapes(spark):
    rnd = random.Random(9)
    names = ["flat", "high_exposure"]
    grid = {(r, c): rnd.choice(names) for r in range(14) for c in range(12) if rnd.random() > 0.08}
    for r in range(20, 25):                     # ring with a hole, plus a diagonal pinch
        for c in range(0, 5):
            grid[(r, c)] = "moderate" if (r in (20, 24) or c in (0, 4)) else "low_exposure"
    grid[(25, 5)] = "moderate"                  # touches the ring only at a corner
    df = spark.createDataFrame([("75", r, c, k) for (r, c), k in grid.items()],
                               "departement string, row int, col int, exposure string")
    shapes = {r.region_id: (r.n_rings, r.n_cells) for r in R.region_shapes(df, _unit(spark)).collect()}
    rings = R.region_rings(df, _unit(spark), 6, 5).collect()
    per = {}
    for r in rings:
        per.setdefault(r.region_id, {}).setdefault(r.ring_id, []).append(r)
    got = {}
    for rid, rs in per.items():
        areas = [v[0].ring_area for v in rs.values()]
        assert sum(1 for x in areas if x > 0) == 1           # one exterior ring per region
        got[rid] = (len(rs), sum(areas))
        for pts in rs.values():                               # axis-parallel closed rings
            pts = sorted(pts, key=lambda p: p.seq)
            for p, q in zip(pts, pts[1:] + pts[:1]):
                assert p.lon == q.lon or p.lat == q.lat
    assert got == shapes


def test_region_polygons_have_their_holes(spark):
    cells = [(r, c, "moderate" if r in (0, 4) or c in (0, 4) else "flat") for r in range(5) for c in range(5)]
    df = spark.createDataFrame([("75", *x) for x in cells], "departement string, row int, col int, exposure string")
    got = {r.exposition: r.geom for r in R.region_polygons(R.region_rings(df, _unit(spark))).collect()}
    outer, hole = got["moderate"].parts[0]
    assert len(got["flat"].parts[0]) == 1 and len(outer) == len(hole) == 5
    assert outer[0] == outer[-1] and {(p.x, p.y) for p in outer} == {(0, 0), (5, 0), (5, 5), (0, 5)}
    assert {(p.x, p.y) for p in hole} == {(1, 1), (4, 1), (4, 4), (1, 4)}
