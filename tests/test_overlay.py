"""Union and difference of polygons against counts of fine cells."""

import random

import pytest
from pyspark.sql import functions as F

from rangemap.operators import overlay, vector
from rangemap.operators.grid import GridSpec, model_grid

SCHEMA = "g string, geom_id long, rings array<array<array<double>>>"


def box(x, y, w, h):
    return [[float(a), float(b)] for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))]


def diamond(x, y, r):
    return [[x - r, y], [x, y + r], [x + r, y], [x, y - r], [x - r, y]]


def area(rows, g):
    return sum(r.area for r in rows if r.g == g)


def check_rings(rows):
    for r in rows:
        assert r.points[0] == r.points[-1] and len(r.points) >= 4
        a = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(r.points, r.points[1:], strict=False)) / 2
        assert a == pytest.approx(r.area, abs=1e-6) and r.hole == (a < 0)


def test_union_of_boxes(spark):
    rows = [
        ("lap", 1, [box(0, 0, 4, 4)]), ("lap", 2, [box(2, 2, 4, 4)]), ("lap", 3, [box(0, 0, 4, 4)]),
        ("frame", 4, [box(0, 0, 9, 1)]), ("frame", 5, [box(0, 8, 9, 1)]), ("frame", 6, [box(0, 0, 1, 9)]), ("frame", 7, [box(8, 0, 1, 9)]),
        ("side", 8, [box(0, 0, 1, 1)]), ("side", 9, [box(1, 0, 1, 1)]),
        ("corner", 10, [box(0, 0, 1, 1)]), ("corner", 11, [box(1, 1, 1, 1)]),
        ("inner", 12, [box(0, 0, 9, 9), box(1, 1, 7, 7)]), ("inner", 13, [box(3, 3, 2, 2)]),
        ("apart", 14, [box(50, 50, 2, 3)]), (None, 15, [box(0, 0, 1, 2)]),
    ]
    found = overlay.union(spark.createDataFrame(rows, SCHEMA), "g")
    rows = found.collect()
    check_rings(rows)
    assert {g: area(rows, g) for g in ("lap", "frame", "side", "corner", "inner", "apart")} == pytest.approx({"lap": 28, "frame": 32, "side": 2, "corner": 2, "inner": 36, "apart": 6})
    count = lambda g, hole: sum(r.g == g and r.hole == hole for r in rows)
    assert [(count(g, False), count(g, True)) for g in ("lap", "frame", "side", "corner", "inner")] == [(1, 0), (1, 1), (1, 0), (2, 0), (2, 1)]
    whole = overlay.polygons(found, "g").withColumn("a", overlay.shapes_area()).groupBy("g").agg(F.sum("a").alias("a"), F.count("*").alias("n")).collect()
    assert {r.g: (round(r.a, 6), r.n) for r in whole if r.g} == {"lap": (28, 1), "frame": (32, 1), "side": (2, 1), "corner": (2, 2), "inner": (36, 2), "apart": (6, 1)}


def test_difference_of_boxes(spark):
    near = spark.createDataFrame([("a", 1, [box(0, 0, 6, 6)]), ("b", 2, [box(0, 0, 3, 3)]), ("c", 3, [box(0, 0, 2, 2)])], SCHEMA)
    land = spark.createDataFrame([("a", 1, [box(1, 1, 2, 2)]), ("a", 2, [box(5, 5, 4, 4)]), ("b", 3, [box(-1, -1, 9, 9)]), ("d", 4, [box(0, 0, 2, 2)])], SCHEMA)
    rows = overlay.difference(near, land, "g").collect()
    check_rings(rows)
    assert area(rows, "a") == pytest.approx(36 - 4 - 1) and area(rows, "c") == pytest.approx(4)
    assert {r.g for r in rows} == {"a", "c"} and sum(r.hole for r in rows) == 1


def test_union_of_diamonds_covers_what_cells_do(spark):
    rng = random.Random(4)
    layer = spark.createDataFrame([("g", i, [diamond(rng.uniform(20, 80), rng.uniform(20, 80), rng.uniform(3, 12))]) for i in range(60)], SCHEMA)
    rows = overlay.union(layer, "g").collect()
    check_rings(rows)
    spec = GridSpec(0.0, 100.0, 0.25, 400, 400)
    cells = vector.polygon_cells(layer.select("geom_id", "rings"), spec).select("row", "col").distinct().count()
    length = sum(((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) ** 0.5 for r in rows for p, q in zip(r.points, r.points[1:], strict=False))
    assert abs(area(rows, "g") - cells * 0.0625) < length * 0.25 * 0.1
    again = overlay.polygons(spark.createDataFrame([(r.g, r.ring, r.hole, r.area, r.points) for r in rows], "g string, ring long, hole boolean, area double, points array<array<double>>"), "g")
    assert abs(vector.polygon_cells(again.select("geom_id", "rings"), spec).count() - cells) <= 2


def test_no_polygons(spark):
    assert overlay.union(spark.createDataFrame([], SCHEMA), "g").count() == 0
    assert model_grid(spark, GridSpec(0.0, 1.0, 1.0, 1, 1)).count() == 1


def test_overlay_broadcasts_nothing(spark, monkeypatch):
    """Rows of edges may be many at any size of their files; no step may collect them on the driver."""
    plans = []
    keep = overlay.written

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name)

    monkeypatch.setattr(overlay, "written", noted)
    ring = lambda a, b, c, d: [[[a, b], [c, b], [c, d], [a, d], [a, b]]]
    layer = spark.createDataFrame([("g", 1, ring(0.0, 0.0, 10.0, 10.0)), ("g", 2, ring(5.0, 5.0, 15.0, 15.0))], "brand string, geom_id int, rings array<array<array<double>>>")
    whole = overlay.polygons(overlay.union(layer, "brand"), "brand")
    plans.append(whole._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5 and not [p for p in plans if "BroadcastHashJoin" in p]
    assert [r[0] for r in whole.select(overlay.shapes_area()).collect()] == [175.0]


def test_places_meet_their_own_group_only(spark):
    """Rows that a side's search makes must not grow with the number of groups at one place; equal edges are cut once."""
    ring = lambda i: [box(i, 0, 4, 4)]
    layer = spark.createDataFrame([(f"g{i % 20}", str(i), ring(i // 20)) for i in range(60)], SCHEMA.replace("geom_id long", "geom_id string"))
    spec = GridSpec(-1.0, 9.0, 4.0, 3, 3)
    spots = spark.createDataFrame([("g3", 1, 1, 2.5, 2.5), ("g4", 2, -1, 0.5, 2.5), ("g5", 3, 1, -0.5, 2.5)], "g string, piece long, side int, x double, y double")
    assert sorted(tuple(r) for r in overlay._holding(spots, layer, "g", spec).collect()) == [(1, 1, "23"), (1, 1, "3"), (1, 1, "43"), (2, -1, "4")]
    edges = overlay._plain(vector.segments(layer, "g").select("g", "x1", "y1", "x2", "y2").unionByName(vector.segments(layer, "g").select("g", F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))), "g")
    assert edges.count() == 20 * 12
    named = edges.withColumn("edge", F.monotonically_increasing_id()).localCheckpoint()
    pieces = overlay._cut(named, "g", spec).filter("g = 'g7'").collect()
    assert len(pieces) == len(set(pieces)) == 6 + 10  # six uprights, two lines of five pieces each
    assert overlay.union(layer, "g").filter("NOT hole AND area = 24").count() == 20
