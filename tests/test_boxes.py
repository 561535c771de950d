"""Range join of points and boxes by a grid of many levels."""

import math
import random

import pytest
from pyspark.sql import functions as F

from geolake.operators import boxes as X
from geolake.operators.departments import assign_departments

ROW = "id int, own string, p array<struct<lat double, lon double>>"
BOX = "departement string, south double, west double, north double, east double, salt int"


def brute(rows, boxes):
    out = []
    for i, own, points in rows:
        for code, s, w, n, e, _ in boxes:
            if None in (s, w, n, e) or any(map(math.isnan, (s, w, n, e))):
                continue
            if any(p and None not in p and s <= p[0] <= n and w <= p[1] <= e and not math.isinf(p[0]) and not math.isinf(p[1]) for p in points or []):
                out.append((i, own, code))
    return sorted(out, key=str)


def got(spark, rows, boxes, **more):
    r, b = spark.createDataFrame(rows, ROW), spark.createDataFrame(boxes, BOX)
    return sorted(map(tuple, assign_departments(r, F.col("p"), boxes=b, **more).drop("p").collect()), key=str)


def some_box(rnd, k):
    side = rnd.choice([0.0, 1e-5, 2.0 ** -10, 0.01, 0.3, 5.0, 40.0])
    s, w = round(rnd.uniform(-60, 60), 2), round(rnd.uniform(-120, 120), 2)
    return (f"B{k}", s, w, s + side, w + side * rnd.choice([0.1, 1, 3]), k)


@pytest.mark.parametrize("seed", [0, 1])
def test_equal_to_the_brute_force_range_join(spark, monkeypatch, seed):
    monkeypatch.setattr(X, "HOT_SHARE", 20)   # salts in a small test
    rnd = random.Random(seed)
    boxes = [some_box(rnd, k) for k in range(60)]
    boxes += [("world", -90.0, -180.0, 90.0, 180.0, 1), ("all", -math.inf, -math.inf, math.inf, math.inf, 1), ("none", 1.0, 1.0, 0.0, 2.0, 1),
              ("null", None, 0.0, 1.0, 1.0, 1), ("nan", math.nan, 0.0, 1.0, 1.0, 1), ("nan2", 0.0, 0.0, math.nan, 1.0, 1)]
    boxes += [("twin", -1.0, -1.0, 1.0, 1.0, 1), ("twin", -2.0, -2.0, 2.0, 2.0, 1)] + [(f"o{k}", -0.5, -0.5, 0.5, 0.5 + k, 1) for k in range(15)]
    rows = []
    for i in range(150):
        points = [(round(rnd.uniform(-62, 62), 2), round(rnd.uniform(-125, 125), 2)) for _ in range(rnd.choice([0, 1, 1, 2, 5]))]
        if rnd.random() < 0.5:   # on a box's edge or corner
            b = rnd.choice(boxes[:60])
            points.append((rnd.choice([b[1], b[3]]), rnd.choice([b[2], b[4]])))
        rows.append((i, f"r{i}", points))
    rows += [(1000 + k, "hot", [(0.0, 0.0)]) for k in range(120)] + [(2000, "hot", [(0.0, 0.0)])] * 3
    rows += [(3000, None, None), (3001, None, []), (3002, None, [None, (None, 1.0), (math.nan, 1.0), (math.inf, 0.0)]), (3003, "x", [(0.0, 0.0), (None, None)])]
    assert got(spark, rows, boxes) == brute(rows, boxes)
    assert {c for _, _, c in got(spark, rows, boxes, deps=["world", "twin"])} == {"world", "twin"}


def test_projected_coordinates_and_empty_tables(spark):
    rnd = random.Random(5)
    boxes = [(f"B{k}", y, x, y + d, x + d, 0) for k in range(30) for y, x, d in [(rnd.uniform(6e6, 7e6), rnd.uniform(1e5, 1.2e6), rnd.choice([1.0, 1e3, 1e5, 1e6]))]]
    rows = [(i, "a", [(rnd.uniform(6e6, 7e6), rnd.uniform(1e5, 1.2e6))]) for i in range(200)]
    assert got(spark, rows, boxes) == brute(rows, boxes)
    assert got(spark, rows, []) == [] and got(spark, [], boxes) == []
    with pytest.raises(ValueError):
        X.assign_to_boxes(spark.createDataFrame(rows, ROW.replace("own", "departement")), F.col("p"), spark.createDataFrame(boxes, BOX))


def test_boxes_take_four_cells_at_most(spark):
    rnd = random.Random(2)
    b = spark.createDataFrame([some_box(rnd, k) for k in range(300)] + [("world", -90.0, -180.0, 90.0, 180.0, 1)], BOX)
    assert X.box_cells(b).groupBy("code").count().agg(F.max("count")).first()[0] <= 4


def test_the_plan_has_no_nested_loop(spark):
    r, b = spark.createDataFrame([(1, "a", [(0.0, 0.0)])], ROW), spark.createDataFrame([("a", 0.0, 0.0, 1.0, 1.0, 0)], BOX)
    plan = X.assign_to_boxes(r, F.col("p"), b)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_box_of_one_point_is_on_the_finest_level(spark):
    b = spark.createDataFrame([("dot", 1.5, 2.5, 1.5, 2.5, 0), ("line", 1.5, 2.5, 1.5, 3.0, 0)], BOX)
    levels = {r.code: r.level for r in X.box_cells(b).collect()}
    assert levels["dot"] == 0 and 2.0 ** levels["line"] * X.CELL == 0.5


def test_rows_of_one_file_are_dealt_out_before_their_lookups(spark):
    r, b = spark.createDataFrame([(1, "a", [(0.0, 0.0)])], ROW), spark.createDataFrame([("a", 0.0, 0.0, 1.0, 1.0, 0)], BOX)
    plan = X.assign_to_boxes(r.coalesce(1), F.col("p"), b)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 4, true" in plan   # the session's number of shuffle partitions
