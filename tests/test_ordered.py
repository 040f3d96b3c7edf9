"""Running totals, quantiles and first rows against plain loops; scoring, names, transformers, metrics, reprojection."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rangemap.functions import geometry
from rangemap.functions import scalars as S
from rangemap.operators import distance, evaluate, focal, maxent, ordered, predict, raster, transformers, vector
from rangemap.operators.grid import GridSpec
from rangemap.sources import tables


def rows_of(rng, n=400):
    return [(rng.choice(["a", "b", None]), i, rng.randint(0, 9)) for i in range(n)]


@pytest.mark.parametrize("descending", [False, True])
def test_running(spark, descending):
    data = rows_of(random.Random(1))
    out = ordered.running(spark.createDataFrame(data, "g string, o int, v int").repartition(5), ["g"], "o", {"before": "v"}, descending).collect()
    so_far, want = {}, {}
    for g, o, v in sorted(data, key=lambda r: r[1], reverse=descending):
        want[o] = so_far.get(g, 0)
        so_far[g] = so_far.get(g, 0) + v
    assert {r["o"]: r["before"] for r in out} == want


def test_quantiles(spark):
    data = [(g, None if o % 17 == 0 else v * 0.5) for g, o, v in rows_of(random.Random(2))]
    df = spark.createDataFrame(data, "g string, v double")
    shares = {"low": 0.05, "half": 0.5, "top": 1.0}
    want = {g: [float(np.quantile([v for h, v in data if h == g and v is not None], q)) for q in shares.values()] for g in ("a", "b", None)}
    out = {r["g"]: [r[n] for n in shares] for r in ordered.quantiles(df, ["g"], "v", shares).collect()}
    assert all(out[g] == pytest.approx(want[g]) for g in want) and len(out) == 3
    assert ordered.quantiles(df, [], "v", {"q": 0.3}).first()["q"] == pytest.approx(float(np.quantile([v for _, v in data if v is not None], 0.3)))
    assert ordered.quantiles(df.limit(0), [], "v", {"q": 0.3}).first()["q"] is None


def test_first_rows(spark):
    data = [(g or "z", o, v) for g, o, v in rows_of(random.Random(3))]
    df = spark.createDataFrame(data, "g string, o int, v int")
    out = ordered.first_rows(df, ["g"], [F.desc("v"), F.asc("o")], 7, "o").collect()
    want = {g: sorted(((-v, o) for h, o, v in data if h == g))[:7] for g in "abz"}
    assert {g: sorted((-r["v"], r["o"]) for r in out if r["g"] == g) for g in "abz"} == want
    assert sorted(r["_rank"] for r in out if r["g"] == "a") == list(range(1, 8))


def test_names():
    assert S.tidy_name("a:b(c),d[e]") == "a_b_c_d_e" and S.tidy_name(r" A\\b/c.{d};-e! ") == "a_b_c_d_e"


def test_names_as_columns(spark):
    names = ["a:b(c),d[e]", r"X\y/z.{w};-v!", "__a__", "é b"]
    out = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(S.tidy(F.col("n"))).collect()]
    assert out == [S.tidy_name(n) for n in names]


def models(spark):
    rows = [("a_X", -1, "linear", "f", None, 0.0, True, 0.0, 10.0, None, None, 2.0), ("a_X", -1, "product", "f", "g", 0.0, True, 0.0, 10.0, 0.0, 1.0, 1.0), ("a_X", -1, "alpha", None, None, None, None, None, None, None, None, -1.0), ("b_Y", -1, "threshold", "g", None, 0.5, True, 0.0, 1.0, None, None, 3.0)]
    return spark.createDataFrame(rows, maxent.COEFFICIENTS)


def test_scores_equal_a_plain_sum(spark):
    df = spark.createDataFrame([(1, "a_X", 5.0, 0.5), (2, "b_Y", 20.0, 1.0), (3, "a_X", None, 0.1), (4, "none", 1.0, 1.0)], "i int, identifier string, f double, g double")
    def plain(name, f, g):
        f, g = min(max(f / 10, 0), 1), min(max(g, 0), 1)
        return 1 - np.exp(-np.exp(2 * f + f * g - 1)) if name == "a_X" else 1 - np.exp(-np.exp(3.0 * (g >= 0.5)))
    data = {r["i"]: (r["f"], r["g"]) for r in df.collect()}
    out = {(r["i"], r["identifier"]): r["p"] for r in predict.score(df.drop("identifier"), models(spark), ["f", "g"], ["i"]).collect()}
    assert len(out) == 8 and out[3, "a_X"] is None and out[3, "b_Y"] is None
    for (i, name), p in out.items():
        if p is not None:
            assert p == pytest.approx(plain(name, *data[i]))
    own = {r["i"]: r["p"] for r in predict.score_own(df, models(spark), ["f", "g"], ["i"]).collect()}
    assert set(own) == {1, 2, 3} and own[1] == out[1, "a_X"] and own[2] == out[2, "b_Y"]
    assert transformers.ModelScores(models(spark), ["f", "g"], ["i"]).transform(df.drop("identifier")).count() == 8


def test_many_models_and_features_score_in_one_map(spark):
    """22 models of 23 features each, of all kinds of terms: no code grows with them."""
    features = [f"f{i}" for i in range(23)]
    made = maxent.terms(features, maxent.Config())
    rng = np.random.default_rng(0)
    rows = [(f"s{m}_X", -1, k, a, b or None, float(t), up, 0.0, 1.0, 0.0 if b else None, 1.0 if b else None, float(rng.normal() / 20)) for m in range(22) for k, a, b, t, up in made]
    df = spark.range(500).select("id", *(F.rand(i).alias(f) for i, f in enumerate(features)))
    out = predict.score(df, spark.createDataFrame(rows, maxent.COEFFICIENTS), features, ["id"])
    assert out.filter("p BETWEEN 0 AND 1").count() == 22 * 500


def test_feature_subset(spark, tmp_path):
    step = transformers.FeatureSubset(names=["b"], keys=["i"])
    df = spark.createDataFrame([(1, 2, 3)], "i int, a int, b int")
    assert step.transform(df).columns == ["i", "b"]
    step.save(str(tmp_path / "step"))
    assert transformers.FeatureSubset.load(str(tmp_path / "step")).transform(df).columns == ["i", "b"]
    with pytest.raises(ValueError):
        transformers.FeatureSubset(names=["x"]).transform(df)


def test_metric_of_folds(spark):
    rows = [("s_X", i, float(i % 50), int(i % 50 > 30), 1.0, i % 3) for i in range(150)]
    df = spark.createDataFrame(rows, "identifier string, point_id int, f double, class int, sample_weight double, fold int")
    found = maxent.fit_all(df, ["f"], maxent.Config(kinds=("linear",)), metric=lambda y, s: float(len(y)))
    assert {r["coef"] for r in found.filter("kind = 'auc' AND fold >= 0").collect()} == {50.0}


def test_many_points_at_one_place(spark):
    rng = random.Random(4)
    data = [("g", f"p{i}", 1.0, 1.0) for i in range(300)] + [("g", f"q{i}", rng.random() * 1000, rng.random() * 1000) for i in range(60)] + [("g", "r1", 1.0, 2.0), ("g", "n", None, 1.0), ("h", "alone", 0.0, 0.0)]
    out = {r["id"]: r for r in distance.knn_weights(spark.createDataFrame(data, "g string, id string, x double, y double"), "g", "id", 5, 500.0).collect()}
    known = [d for d in data if d[2] is not None and d[0] == "g"]
    for g, i, x, y in known:
        want = np.mean(sorted(np.hypot(x - a, y - b) for _, j, a, b in known if j != i)[:5])
        assert out[i]["mean_distance"] == pytest.approx(want)
    assert out["alone"]["weight"] == 1.0 and out["n"]["weight"] == 1.0 and len(out) == len(data)


def test_long_segments_and_points_in_their_cells(spark):
    rng = random.Random(5)
    segs = [(rng.random() * 900, rng.random() * 900, rng.random() * 900, rng.random() * 900) for _ in range(25)] + [(10.0, 5.0, 800.0, 5.0), (7.0, 3.0, 7.0, 900.0)]
    cells = [(i, rng.random() * 1000, rng.random() * 1000) for i in range(80)]
    def far(x, y, x1, y1, x2, y2):
        d = (x2 - x1) ** 2 + (y2 - y1) ** 2
        t = 0 if d == 0 else min(max(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / d, 0), 1)
        return np.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1))
    out = distance.to_segments(spark.createDataFrame(cells, "i int, x double, y double"), spark.createDataFrame(segs, "x1 double, y1 double, x2 double, y2 double"), ["i"], 30.0).collect()
    want = {i: min(far(x, y, *s) for s in segs) for i, x, y in cells}
    assert all(r["distance"] == pytest.approx(want[r["i"]]) for r in out) and len(out) == 80


def test_point_in_layer_with_holes(spark):
    star = [[[0.0, 0.0], [50.0, 20.0], [100.0, 0.0], [80.0, 50.0], [100.0, 100.0], [50.0, 80.0], [0.0, 100.0], [20.0, 50.0], [0.0, 0.0]], [[40.0, 40.0], [60.0, 40.0], [60.0, 60.0], [40.0, 60.0], [40.0, 40.0]]]
    layer = spark.createDataFrame([(1, star), (2, [[[30.0, 30.0], [70.0, 30.0], [70.0, 70.0], [30.0, 70.0], [30.0, 30.0]]])], "geom_id int, rings array<array<array<double>>>")
    rng = random.Random(6)
    points = spark.createDataFrame([(i, rng.random() * 110 - 5, rng.random() * 110 - 5) for i in range(600)], "point_id int, x double, y double")
    want = points.crossJoin(layer).filter(geometry.inside(F.col("x"), F.col("y"), F.col("rings"))).select("point_id", "geom_id")
    for res in (7.0, 40.0):
        out = vector.point_in_layer(points, layer, GridSpec(-10.0, 120.0, res, 22, 22))
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("size", [(3, 2), (9, 14)])
def test_gaussian_equals_a_mirrored_sum(spark, size):
    rng = np.random.default_rng(1)
    grid = rng.random(size)
    cells = spark.createDataFrame([(r, c, None if (r, c) == (1, 1) else float(grid[r, c])) for r in range(size[0]) for c in range(size[1])], "row int, col int, v double")
    w = np.exp(-0.5 * (np.arange(-6, 7) / 1.5) ** 2)
    w /= w.sum()
    grid[1, 1] = 0
    for axis in (0, 1):
        n = size[axis]
        at = np.array([[(i + d) % (2 * n) for d in range(-6, 7)] for i in range(n)])
        at = np.where(at < n, at, 2 * n - 1 - at)
        grid = np.moveaxis((np.moveaxis(grid, axis, 0)[at] * w[:, None]).sum(axis=1), 0, axis)
    out = {(r["row"], r["col"]): r["v"] for r in focal.gaussian(cells, *size, "v", 1.5).collect()}
    assert all(out[r, c] == pytest.approx(grid[r, c]) for r in range(size[0]) for c in range(size[1]))


def test_ruggedness_far_from_zero(spark):
    cells = spark.createDataFrame([(r, c, 1e9 + (r * 7 + c * 3) % 5) for r in range(4) for c in range(4)], "row int, col int, v double")
    v = {(r["row"], r["col"]): r["v"] for r in cells.collect()}
    out = {(r["row"], r["col"]): r["tri"] for r in focal.ruggedness_index(cells, "v").collect()}
    want = np.sqrt(sum((v[i, j] - v[1, 1]) ** 2 for i in range(3) for j in range(3)))
    assert out[1, 1] == pytest.approx(want) and out[0, 0] is None


def test_shapes_are_moved(spark):
    ring = [[400000.0, 400000.0], [400100.0, 400000.0], [400100.0, 400100.0], [400000.0, 400000.0]]
    shapes = spark.createDataFrame([("a", 0, "n", [ring, ring[::-1]]), ("a", 1, "m", [ring])], "geom_id string, part int, name string, rings array<array<array<double>>>")
    there = geometry.reproject_shapes(shapes, 27700, 4326)
    assert there.columns == shapes.columns and all(-3 < x < 0 and 52 < y < 55 for r in there.collect() for q in r["rings"] for x, y in q)
    for r in geometry.reproject_shapes(there, 4326, 27700).collect():
        want = [ring, ring[::-1]] if r["part"] == 0 else [ring]
        assert len(r["rings"]) == len(want) and np.allclose(np.array(r["rings"][0]), np.array(want[0]), atol=0.5)


def test_known_place_is_projected(spark):
    """The published example: 52 39 27.2531 N, 1 43 4.5177 E on the old datum is 651409.903, 313177.270; on the new one the
    tower of Caister lies within some metres."""
    lat, lon = 52.65797861, 1.71605194
    p = geometry.reproject(spark.createDataFrame([(lon, lat)], "x double, y double"), 4326, 27700).first()
    assert p["x"] == pytest.approx(651409.9, abs=6) and p["y"] == pytest.approx(313177.3, abs=6)


def test_layers_by_path_and_top(spark, tmp_path):
    assert raster.layer_paths(["a=/x/y.parquet", "/z/b.c.parquet"]) == {"a": "/x/y.parquet", "b": "/z/b.c.parquet"}
    with pytest.raises(ValueError):
        raster.layer_paths(["a=x", "/q/a.parquet"])
    scores = spark.createDataFrame([("f", 1.0), ("g", -1.0), ("h", 2.0)], "feature string, importance double")
    assert [r["feature"] for r in evaluate.importance_summary(scores, ["feature"], 2).collect()] == ["h", "f"]
    df = spark.createDataFrame([("a_X", i, 1.0) for i in range(40)], "identifier string, point_id int, v double")
    tables.write_training(df, str(tmp_path / "t"), files=4)
    assert 1 <= len(list((tmp_path / "t" / "identifier=a_X").glob("*.parquet"))) <= 4 and spark.read.parquet(str(tmp_path / "t")).count() == 40
