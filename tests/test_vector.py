import math
import random

import pytest
from pyspark.sql import functions as F

from rangemap.operators import distance, grid, vector

RINGS = "geom_id string, rings array<array<array<double>>>"


def square(a, b, c, d):
    return [[[a, b], [c, b], [c, d], [a, d], [a, b]]]


def test_rasterise_and_touch(spark):
    spec = grid.GridSpec(0, 100, 10, 10, 10)
    layer = spark.createDataFrame([("a", square(12.0, 12.0, 38.0, 28.0)), ("b", square(60.0, 60.0, 70.0, 70.0))], RINGS)
    inside = {(r["geom_id"], r["row"], r["col"]) for r in vector.polygon_cells(layer, spec).collect()}
    assert inside == {("a", r, c) for r in (7, 8) for c in (1, 2, 3)} | {("b", 3, 6)}
    touched = {(r["row"], r["col"]) for r in vector.touched_cells(layer.filter("geom_id = 'a'"), spec).collect()}
    assert touched == {(r, c) for r in (7, 8) for c in (1, 2, 3)}


def test_lines_pass_through_every_cell(spark):
    rng = random.Random(1)
    spec = grid.GridSpec(0, 20, 1, 20, 20)
    lines = [(str(i), [[[rng.uniform(-3, 23), rng.uniform(-3, 23)], [rng.uniform(-3, 23), rng.uniform(-3, 23)]]]) for i in range(25)]
    lines.append(("flat", [[[1.5, 5.5], [8.5, 5.5]]]))
    found = {(r["geom_id"], r["row"], r["col"]) for r in vector.line_cells(spark.createDataFrame(lines, RINGS), spec).collect()}
    want = set()
    for name, ((p, q),) in lines:
        for k in range(20001):
            t = k / 20000
            x, y = p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])
            r, c = math.floor(20 - y), math.floor(x)
            if 0 <= r < 20 and 0 <= c < 20:
                want.add((name, r, c))
    assert want <= found and len(found - want) <= 6  # corners that the walk steps over


def test_cover_of_known_boxes(spark):
    spec = grid.GridSpec(0, 200, 100, 2, 2)
    layers = {"buildings": (spark.createDataFrame([("a", square(10.0, 10.0, 20.0, 20.0)), ("b", square(60.0, 60.0, 70.0, 70.0)), ("c", square(10.0, 10.0, 20.0, 20.0))], RINGS), False)}
    out = {(r["row"], r["col"]): r["buildings"] for r in vector.feature_cover(layers, spec, grid.model_grid(spark, spec)).collect()}
    assert out == {(0, 0): 0, (0, 1): 0, (1, 0): 2, (1, 1): 0}
    with pytest.raises(ValueError):
        vector.feature_cover(layers, spec, grid.model_grid(spark, spec), 30.0)


def test_split_roads(spark):
    roads = spark.createDataFrame([("A Road",), ("Local Street",), ("Minor Road",), ("Motorway",), (None,)], "c string")
    major, minor = vector.split_roads(roads, "c")
    assert sorted(r["c"] for r in major.collect()) == ["A Road", "Motorway"] and minor.count() == 3


@pytest.mark.parametrize("start", [1.0, 7.0, 100.0])
def test_nearest_equals_brute_force(spark, start):
    rng = random.Random(7)
    spots = [(rng.uniform(0, 30), rng.uniform(0, 100)) for _ in range(9)]
    cells = grid.model_grid(spark, grid.GridSpec(0, 100, 10, 10, 10))
    out = distance.to_points(cells, spark.createDataFrame(spots, "x double, y double"), ["row", "col"], start).collect()
    for r in out:
        x, y = (r["col"] + 0.5) * 10, 100 - (r["row"] + 0.5) * 10
        assert r["distance"] == pytest.approx(min(math.dist((x, y), s) for s in spots))
    assert len(out) == 100


def test_no_features_give_null(spark):
    cells = grid.model_grid(spark, grid.GridSpec(0, 20, 10, 2, 2))
    out = distance.to_points(cells, spark.createDataFrame([], "x double, y double"), ["row", "col"]).collect()
    assert [r["distance"] for r in out] == [None] * 4


def test_distance_to_polygon_is_zero_inside(spark):
    spec = grid.GridSpec(0, 100, 10, 10, 10)
    layer = spark.createDataFrame([("a", square(30.0, 30.0, 60.0, 60.0))], RINGS)
    out = distance.to_segments(grid.model_grid(spark, spec), vector.segments(layer), ["row", "col"], 5.0, vector.polygon_cells(layer, spec))
    for r in out.collect():
        x, y = (r["col"] + 0.5) * 10, 100 - (r["row"] + 0.5) * 10
        assert r["distance"] == pytest.approx(math.hypot(max(30 - x, x - 60, 0), max(30 - y, y - 60, 0)))


def test_knn_weights_equal_brute_force(spark):
    rng = random.Random(3)
    data = [("a", str(i), rng.gauss(0, 50), rng.gauss(0, 50)) for i in range(40)] + [("b", str(i), float(i), 0.0) for i in range(3)] + [("c", "only", 1.0, 1.0)]
    out = distance.knn_weights(spark.createDataFrame(data, "g string, id string, x double, y double"), "g", "id", 5, 3.0).collect()
    assert len(out) == len(data)
    for r in out:
        me = next(d for d in data if d[:2] == (r["g"], r["id"]))
        others = sorted(math.dist(me[2:], d[2:]) for d in data if d[0] == me[0] and d[1] != me[1])[:5]
        if others:
            assert r["mean_distance"] == pytest.approx(sum(others) / len(others))
        else:
            assert r["weight"] == 1
    weights = sorted(r["weight"] for r in out if r["g"] == "a")
    assert (weights[19] + weights[20]) / 2 == pytest.approx(1)


def test_dissolve_cancels_shared_edges(spark):
    layer = spark.createDataFrame([("1", square(0.0, 0.0, 1.0, 1.0), "r"), ("2", square(1.0, 0.0, 2.0, 1.0), "r"), ("3", square(2.0, 0.0, 3.0, 1.0), "s")], RINGS + ", region string")
    edges = vector.dissolved_edges(layer, "region").groupBy("region").count().collect()
    assert {r["region"]: r["count"] for r in edges} == {"r": 6, "s": 4}
    parts = vector.dissolve(layer, "region")
    assert parts.columns == ["region", "part", "rings"] and parts.count() == 3


def test_simplify_validity_and_parts(spark):
    layer = spark.createDataFrame([("1", [[[0.0, 0.0], [0.4, 0.1], [9.8, 0.0], [10.0, 10.0], [0.0, 0.0]]]), ("bad", [[[0.0, 0.0], [1.0, 1.0], [0.0, 0.0]]])], RINGS)
    assert [r["geom_id"] for r in vector.valid(layer).collect()] == ["1"]
    assert vector.simplify(layer.limit(1), 1.0).first()["rings"] == [[[0, 0], [10, 0], [10, 10], [0, 0]]]
    assert vector.large_parts(layer, 1e-5).count() == 1


def test_missing_counties_raise(spark):
    counties, regions = spark.createDataFrame([("York",)], "name string"), spark.createDataFrame([("York", "N"), ("Hull", "E")], "name string, region string")
    with pytest.raises(ValueError, match="Hull"):
        vector.join_regions(counties, regions, "name")
    assert vector.join_regions(counties, regions.limit(1), "name").collect()[0]["region"] == "N"


def test_point_in_layer_with_hole(spark):
    ring = square(0.0, 0.0, 10.0, 10.0)[0]
    hole = square(4.0, 4.0, 6.0, 6.0)[0]
    layer = spark.createDataFrame([("a", [ring, hole])], RINGS)
    points = spark.range(121).select(F.col("id").alias("point_id"), (F.expr("id % 11") + F.lit(0.1)).alias("x"), (F.expr("id DIV 11") + F.lit(0.1)).alias("y"))
    out = vector.point_in_layer(points, layer, grid.GridSpec(-5, 20, 5, 5, 5))
    assert out.count() == 100 - 4


def test_neighbours_and_distances_where_nearly_all_points_are_in_one_spot(spark, rng_points=400):
    import numpy as np

    rng = np.random.default_rng(5)
    dense = rng.normal([700.0, 900.0], 0.01, (rng_points * 9 // 10, 2))
    wide = rng.uniform(-60_000, 60_000, (rng_points // 10 - 2, 2))
    xy = np.concatenate([dense, wide, [[-1e6, -1e6], [1e6, -1e6]]])
    data = [("g", str(i), float(x), float(y)) for i, (x, y) in enumerate(xy)] + [("pair", "a", -1.0, 0.0), ("pair", "b", 3.0, -3.0), ("pair", "none", None, 1.0)]
    found = {(r["g"], r["id"]): r["mean_distance"] for r in distance.knn_weights(spark.createDataFrame(data, "g string, id string, x double, y double"), "g", "id", 5, 100.0).collect()}
    all_pairs = np.sort(np.hypot(*(xy[:, None] - xy[None]).transpose(2, 0, 1)), axis=1)
    assert np.allclose([found["g", str(i)] for i in range(len(xy))], all_pairs[:, 1:6].mean(axis=1), rtol=1e-9)
    assert found["pair", "a"] == found["pair", "b"] == 5.0 and found["pair", "none"] is None
    spots = np.concatenate([rng.uniform(-2e6, 2e6, (30, 2)), xy[:5] + 0.003, wide[:5] + 40])
    cells = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(spots)] + [(99, None, 0.0)], "id int, x double, y double")
    points = spark.createDataFrame([(float(x), float(y)) for x, y in xy] + [(None, 1.0)], "x double, y double")
    near = {r["id"]: r["distance"] for r in distance.to_points(cells, points, ["id"], 100.0).collect()}
    assert len(near) == 41 and near[99] is None
    assert np.allclose([near[i] for i in range(40)], np.hypot(*(spots[:, None] - xy[None]).transpose(2, 0, 1)).min(axis=1), rtol=1e-9)


def test_point_in_layer_broadcasts_nothing(spark, tmp_path):
    """Cells and edges of exploded polygons look as small as the polygons' file; Spark must not collect them on the driver."""
    spec = grid.GridSpec(0, 100, 10, 10, 10)
    spark.createDataFrame([("a", square(12.0, 12.0, 38.0, 28.0))], RINGS).write.parquet(str(tmp_path / "layer"))
    layer = spark.read.parquet(str(tmp_path / "layer"))
    points = spark.createDataFrame([(1, 20.0, 20.0), (2, 50.0, 50.0)], "point_id int, x double, y double")
    found = vector.point_in_layer(points, layer, spec)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [(1, "a")]


def test_distances_broadcast_no_places(spark, tmp_path, monkeypatch):
    """Places on several levels are more rows than their file's size says; Spark must not collect them on the driver."""
    spark.range(60).selectExpr("CAST(id * 37 % 101 AS DOUBLE) AS x", "CAST(id * 53 % 97 AS DOUBLE) AS y").write.parquet(str(tmp_path / "points"))
    points, plans, keep = spark.read.parquet(str(tmp_path / "points")), [], distance.written

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name)

    monkeypatch.setattr(distance, "written", noted)
    cells = grid.model_grid(spark, grid.GridSpec(0, 100, 20, 5, 5))
    found = distance.to_points(cells, points, ["row", "col"], 10.0).collect()
    assert plans and not [p for p in plans if "BroadcastHashJoin" in p]
    at = [(i * 37 % 101, i * 53 % 97) for i in range(60)]
    for r in found:
        x, y = r["col"] * 20 + 10, 100 - r["row"] * 20 - 10
        assert r["distance"] == pytest.approx(min(math.hypot(x - a, y - b) for a, b in at))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dissolved_edges_are_dealt_before_they_are_counted(spark):
    layer = spark.createDataFrame([("1", square(0.0, 0.0, 1.0, 1.0), "r")], RINGS + ", region string")
    plan = _plan(vector.dissolved_edges(layer, "region"))
    assert plan.count("Exchange") == 1 and "HashAggregate" not in plan[plan.index("Exchange") :]


def test_short_region_map_goes_to_the_counties(spark, monkeypatch, tmp_path):
    spark.createDataFrame([(str(i), square(0.0, 0.0, 1.0, 1.0), "r") for i in range(3)], RINGS + ", name string").write.parquet(f"{tmp_path}/c")
    counties = spark.read.parquet(f"{tmp_path}/c")
    regions = spark.createDataFrame([("r", "N")], "name string, region string")
    # By the size of their files the counties would be sent instead.
    assert "BuildRight" in _plan(vector.join_regions(counties, regions, "name"))
    monkeypatch.setattr(vector, "MAPPED", 0)
    joined = vector.join_regions(counties, regions, "name")
    assert "BroadcastHashJoin" not in _plan(joined) and joined.count() == 3
