import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rangemap.operators import evaluate, explain, features, grid, imagery, maxent, occurrence, predict, sampling


def test_weighted_sample_follows_weights(spark):
    df = spark.range(2000).withColumn("p", F.when(F.col("id") < 200, 10.0).otherwise(1.0))
    out = [r["id"] for r in sampling.weighted_sample(df, 300, "id").collect()]
    assert len(set(out)) == 300 and sum(i < 200 for i in out) > 100
    again = [r["id"] for r in sampling.weighted_sample(df.repartition(7), 300, "id").collect()]
    assert sorted(again) == sorted(out)
    other = [r["id"] for r in sampling.weighted_sample(df, 300, "id", seed=1).collect()]
    assert sorted(other) != sorted(out)


def test_weighted_sample_with_replacement(spark):
    df = spark.range(50).withColumn("p", F.when(F.col("id") == 7, 50.0).otherwise(1.0))
    out = [r["id"] for r in sampling.weighted_sample_replace(df, 400, "id").collect()]
    assert len(out) == 400 and 120 < out.count(7) < 280


def test_uniform_hash_is_uniform(spark):
    from rangemap.functions.scalars import unit_hash

    s = spark.range(20000).select(unit_hash(F.col("id")).alias("u")).agg(F.avg("u"), F.stddev("u"), F.min("u"), F.max("u")).first()
    assert abs(s[0] - 0.5) < 0.02 and abs(s[1] - 12**-0.5) < 0.02 and 0 < s[2] and s[3] < 1


def test_points_in_polygon(spark):
    ring = [[0.0, 0.0], [10.0, 0.0], [0.0, 10.0], [0.0, 0.0]]
    out = sampling.points_in_polygon(spark, [ring], 200).collect()
    assert len(out) == 200 and all(r["x"] + r["y"] < 10 and r["x"] >= 0 and r["y"] >= 0 for r in out)


def test_background_points_stay_near_the_density(spark):
    rng = random.Random(1)
    spec = grid.GridSpec(0, 2000, 100, 20, 20)
    points = spark.createDataFrame([(rng.gauss(500, 80), rng.gauss(500, 80)) for _ in range(300)], "x double, y double")
    out = sampling.background_points(points, spec, 60, background="contrast", value=0.0).collect()
    assert len(out) == 60 and len({(r["row"], r["col"]) for r in out}) == 60
    assert all(math.dist((r["x"], r["y"]), (500, 500)) < 1000 for r in out)
    assert len(sampling.background_points(points, spec, 450, background="binary").collect()) == 450


@pytest.mark.parametrize("method, value", [("contrast", 2.0), ("percentile", 50), ("scale", 0.5), ("fixed", 0.3), ("binary", 0)])
def test_probabilities_sum_to_one(spark, method, value):
    df = spark.range(30).select(F.col("id").cast("double").alias("value"))
    assert sampling.probabilities(df, method, value).agg(F.sum("p")).first()[0] == pytest.approx(1)
    nothing = spark.range(4).select(F.lit(0.0).alias("value"))
    assert {r["p"] for r in sampling.probabilities(nothing, "contrast", 0.1).collect()} == {0.25}
    with pytest.raises(ValueError):
        sampling.probabilities(df, "other", 1)


def test_rank_and_raw_transforms(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.0), (2, 4.0)], "id int, value double")
    ranks = {r["id"]: r["value"] for r in sampling.transform_counts(df, "rank").collect()}
    assert ranks == {0: 0.5, 1: 0.5, 2: 1.0}
    assert sampling.transform_counts(df, "unknown").collect() == df.collect()
    assert [r[0] for r in spark.createDataFrame([(50,), (500,), (2000,)], "n int").select(occurrence.background_size(F.col("n"))).collect()] == [1000, 5000, 10000]


def test_auc_equals_pairwise_definition(spark):
    rng = random.Random(2)
    data = [("a", rng.randrange(2), rng.randrange(6) / 5) for _ in range(200)] + [("b", 1, 0.5)]
    out = {r["g"]: r["auc"] for r in evaluate.auc(spark.createDataFrame(data, "g string, class int, p double"), ["g"]).collect()}
    pos, neg = ([p for g, c, p in data if g == "a" and c == k] for k in (1, 0))
    want = sum((x > y) + (x == y) / 2 for x in pos for y in neg) / (len(pos) * len(neg))
    assert out["a"] == pytest.approx(want) and out["b"] is None
    assert maxent.rank_auc(np.array([c for g, c, _ in data if g == "a"]), np.array([p for g, _, p in data if g == "a"])) == pytest.approx(want)


def test_metrics_without_denominators(spark):
    r = evaluate.confusion(spark.createDataFrame([("a", 0, 0.1)], "g string, class int, p double"), ["g"]).first()
    assert (r["sensitivity"], r["precision"], r["f1"], r["specificity"], r["accuracy"]) == (0, 0, 0, 1, 1)


def test_anti_join_leaves_no_shared_cell(spark):
    rng = random.Random(3)
    spec = grid.GridSpec(0, 100, 10, 10, 10)
    make = lambda n: spark.createDataFrame([(i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(n)], "point_id int, x double, y double")
    pres, back = grid.with_cell(make(40), spec), grid.with_cell(make(200), spec)
    left = occurrence.drop_in_presence_cells(back, pres)
    assert left.join(pres, ["row", "col"], "left_semi").count() == 0 and 0 < left.count() < 200


def test_thinning_circle_in_square(spark):
    spec = grid.GridSpec(0, 200, 100, 2, 2)
    p = spark.createDataFrame([(1, "s", 50.0, 50.0), (2, "s", 60.0, 50.0), (3, "s", 95.0, 95.0), (4, "t", 55.0, 50.0), (5, "s", -10.0, 50.0)], "point_id int, k string, x double, y double")
    assert sorted(r["point_id"] for r in occurrence.thin_to_cells(p, spec, ["k"], "point_id").collect()) == [1, 4]
    assert sorted(r["point_id"] for r in occurrence.thin_to_cells(p, spec, ["k"], "point_id", 80.0).collect()) == [1, 4]


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        x, y = rng.uniform(0, 1000), rng.uniform(0, 1000)
        f, g = rng.uniform(0, 1), rng.uniform(0, 1)
        here = i % 3 == 0
        if here:
            f = min(1.0, rng.uniform(0.6, 1.2))
        rows.append((f"Myotis brandtii_{'Roost' if i % 2 else 'In flight'}", i, x, y, f, g, int(here), 1.0))
    rows += [("Rare one_Roost", 2000 + i, float(i), 1.0, 0.5, 0.5, 1, 1.0) for i in range(3)]
    return spark.createDataFrame(rows, "identifier string, point_id int, x double, y double, f double, g double, class int, sample_weight double").cache()


@pytest.fixture(scope="module")
def coefficients(training):
    folds = maxent.with_random_folds(training)
    return maxent.fit_all(folds, ["f", "g"], maxent.Config(n_hinge=5)).cache()


def test_models_find_the_signal(training, coefficients):
    out = {r["identifier"]: r for r in maxent.results(coefficients).collect()}
    for name in ("Myotis brandtii_Roost", "Myotis brandtii_In flight"):
        assert out[name]["mean_cv_score"] > 0.8 and out[name]["status"] == "Success" and out[name]["n_presence"] == 150
    assert out["Myotis brandtii_Roost"]["latin_name"] == "Myotis brandtii" and out["Myotis brandtii_Roost"]["activity_type"] == "Roost"
    assert out["Rare one_Roost"]["status"] == "No background data" and out["Rare one_Roost"]["mean_cv_score"] is None


def test_scores_agree_with_the_fit(training, coefficients):
    rows = training.withColumnRenamed("identifier", "own")
    scored = predict.score(rows, coefficients, ["f", "g"], ["own", "point_id", "class"]).filter("own = identifier")
    assert scored.filter("p < 0 OR p > 1 OR p IS NULL").count() == 0
    auc = {r["identifier"]: r["auc"] for r in evaluate.auc(scored, ["identifier"]).collect()}
    final = {r["identifier"]: r["coef"] for r in coefficients.filter("kind = 'auc' AND fold = -1").collect()}
    for k, v in final.items():
        assert auc[k] == pytest.approx(v, abs=1e-6)
    some = rows.limit(3).withColumn("f", F.lit(None).cast("double"))
    assert predict.score(some, coefficients, ["f", "g"], ["point_id"]).filter("p IS NOT NULL").count() == 0


def test_over_regularised_model_is_flat(training):
    flat = maxent.fit_all(maxent.with_random_folds(training), ["f", "g"], maxent.Config(beta=1e6))
    out = {r["identifier"]: r["mean_cv_score"] for r in maxent.results(flat).collect()}
    assert out["Myotis brandtii_Roost"] == pytest.approx(0.5)


def test_distributed_fit_agrees_in_sign(training):
    found = maxent.fit_large(training.filter("identifier LIKE 'Myotis%'"), ["f", "g"], maxent.Config(kinds=("linear",)))
    assert {r["a"]: r["coef"] > 0 for r in found.filter("kind = 'linear'").collect()}["f"]


def test_geographic_folds(training):
    folds = maxent.with_geographic_folds(training).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2]


def test_importance_and_dependence(training, coefficients):
    rows = training.filter("identifier LIKE 'Myotis%'")
    imp = {(r["identifier"], r["feature"]): r["mean"] for r in explain.permutation_importance(rows, coefficients, ["f", "g"], repeats=3).collect()}
    assert imp["Myotis brandtii_Roost", "f"] > imp["Myotis brandtii_Roost", "g"] + 0.1
    cells = training.withColumn("cell_id", F.col("point_id").cast("long"))
    pdp = explain.partial_dependence(cells, coefficients, ["f", "g"], vary=["f"], points=5).filter("identifier = 'Myotis brandtii_Roost'").orderBy("step").collect()
    assert len(pdp) == 5 and pdp[0]["centred"] == 0 and pdp[-1]["p"] > pdp[0]["p"]


def test_importance_is_of_all_rows(spark, training, coefficients):
    """However many rows an identifier has, here over 2,000, all of them are scored in each repeat."""
    rows = training.filter("identifier = 'Myotis brandtii_Roost'")
    times = -(-2500 // rows.count())
    many = rows.crossJoin(spark.range(times)).withColumn("point_id", F.col("point_id") * times + F.col("id")).drop("id")
    seen = []
    keep = explain.auc

    def noted(df, by):
        seen.append((by, df.count()))
        return keep(df, by)

    explain.auc = noted
    try:
        found = {r["feature"]: r["mean"] for r in explain.permutation_importance(many, coefficients, ["f", "g"], repeats=2).collect()}
    finally:
        explain.auc = keep
    n = many.count()
    assert n >= 2500 and [c for _, c in seen] == [n, n * 2 * 2] and found["f"] > found["g"] + 0.1


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000])
def test_dealing_is_a_permutation(n):
    i = np.arange(n)
    for seed in range(5):
        assert sorted(explain.shuffled(i, np.full(n, n), seed)) == i.tolist()
    both = explain.shuffled(np.concatenate([i, np.arange(7)]), np.concatenate([np.full(n, n), np.full(7, 7)]), 3)
    assert both[:n].tolist() == explain.shuffled(i, np.full(n, n), 3).tolist() and sorted(both[n:]) == list(range(7))
    if n == 1000:
        assert explain.shuffled(i, np.full(n, n), 1).tolist() != explain.shuffled(i, np.full(n, n), 2).tolist()
        assert abs(np.corrcoef(i, explain.shuffled(i, np.full(n, n), 1))[0, 1]) < 0.1


def test_feature_tables(spark, training):
    mi = {r["feature"]: r["score"] for r in features.mutual_information(training, ["f", "g"], "class").collect()}
    assert mi["f"] > 5 * mi["g"]
    wide = training.withColumn("f2", F.col("f") * 3 - 1)
    assert {r["variable"]: r["group"] for r in features.correlated_groups(wide, ["f", "g", "f2"]).collect()} == {"f": "f", "g": "g", "f2": "f"}
    pcs, share = features.principal_components(wide, ["f", "g", "f2"], ["point_id"], 2)
    assert pcs.columns == ["point_id", "pc_1", "pc_2"] and sum(share) == pytest.approx(1, abs=1e-6)
    assert features.with_prefix(["a_x", "b_x"], ["a"]) == ["a_x"]
    assert features.included(spark.createDataFrame([("v", 1), ("w", 0)], "variable string, include int")) == ["v"]


def test_user_model(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "id int, v double")
    out = {r["id"]: r["p"] for r in predict.score_with(df, lambda x: x["v"] / 4, ["v"], ["id"]).collect()}
    assert out[1] == 0.5 and (out[2] is None or math.isnan(out[2]))


def test_cloud_mask(spark):
    px = [("s", r, c, 90.0 if (r, c) == (5, 5) else 0.0, 1000.0 if (r, c) == (5, 6) else 3000.0, 4) for r in range(11) for c in range(11)]
    pixels = imagery.flags(spark.createDataFrame(px, "scene string, row int, col int, probability double, nir double, scl int"))
    assert [tuple(r) for r in imagery.shadows(pixels, 90.0, 2).collect()] == [("s", 5, 6)]
    kept = {(r["row"], r["col"]) for r in imagery.masked(pixels, 90.0, 2, 1, 3).collect()}
    assert len(kept) == 121 - 12 and (5, 5) not in kept and (4, 4) not in kept and (5, 7) not in kept and (5, 8) in kept


def test_draws_with_replacement_follow_the_weights_without_a_nested_loop(spark):
    rows = [(i, [0.0, 1.0, 2.0, 1e-9, 97.0][i % 5] if i < 5 else 0.05) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, p double")
    found = sampling.weighted_sample_replace(df, 20_000, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan.replace("BroadcastNestedLoopJoin BuildRight, Cross", "").replace("BroadcastNestedLoopJoin BuildLeft, Cross", "")
    out = [r["id"] for r in found.collect()]
    total = sum(p for _, p in rows)
    assert len(out) == 20_000 and 0 not in out
    for i in (1, 2, 4):
        share = rows[i][1] / total
        assert abs(out.count(i) / 20_000 - share) < 5 * (share * (1 - share) / 20_000) ** 0.5 + 1e-9
    assert sampling.weighted_sample_replace(df.filter("p = 0"), 10, "id").count() == 0
    assert sampling.weighted_sample_replace(df, 0, "id").count() == 0


def test_random_folds_of_groups_smaller_than_k_and_of_repeated_rows(spark):
    rows = [("a", i, i % 2) for i in range(11)] + [("b", 1, 1), ("b", 2, 0)] + [("c", 5, 1)] * 4 + [(None, 3, 1)]
    df = spark.createDataFrame(rows, "identifier string, point_id long, class int")
    found = maxent.with_random_folds(df).groupBy("identifier", "fold").count().collect()
    sizes = {}
    for r in found:
        sizes.setdefault(r["identifier"], {})[r["fold"]] = r["count"]
    assert sizes == {"a": {0: 4, 1: 4, 2: 3}, "b": {0: 1, 1: 1}, "c": {0: 2, 1: 1, 2: 1}, None: {0: 1}}
