"""The fit of the models: objectives against a long plain solve, one table for all sizes, null models only where asked for."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rangemap.operators import maxent, predict, solver


def objective(x, y, w, lam, beta):
    eta = x @ beta[:-1] + beta[-1]
    return float(w @ (np.logaddexp(0, eta) - y * eta) + lam @ np.abs(beta[:-1]))


def plain(x, y, w, lam, rounds=60_000):
    """Accelerated proximal steps, as many as it takes."""
    a = np.c_[x, np.ones(len(x))]
    lam = np.r_[lam, 0.0]
    size = np.linalg.eigvalsh(a.T @ (a * w[:, None]))[-1] / 4
    beta = ahead = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        g = a.T @ (w * (1 / (1 + np.exp(-(a @ ahead))) - y))
        new = ahead - g / size
        new = np.sign(new) * np.maximum(np.abs(new) - lam / size, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if (ahead - new) @ (new - beta) > 0:
            t_new = 1.0
        ahead, beta, t = new + (t - 1) / t_new * (new - beta), new, t_new
    return beta


def made(rng, n0, n1, p):
    f = np.r_[rng.normal(0, 1, (n0, p)), rng.normal(np.linspace(1, 0, p), 0.8, (n1, p))]
    return f, np.r_[np.zeros(n0), np.ones(n1)]


def rows_of(spark, f, y, identifier="Sp_A", folds=3):
    n, p = f.shape
    rows = [(identifier, i, int(y[i]), 1.0, i % folds, *map(float, f[i])) for i in range(n)]
    return spark.createDataFrame(rows, "identifier string, point_id int, class int, sample_weight double, fold int, " + ", ".join(f"f{j} double" for j in range(p)))


@pytest.mark.parametrize(("n0", "n1", "p", "kinds", "weight"), [(1000, 60, 3, ("linear", "hinge", "product"), 100.0), (400, 100, 2, ("linear", "quadratic", "threshold"), 1.0), (300, 30, 3, ("linear", "hinge"), "balanced")])
def test_objective_is_the_least(spark, n0, n1, p, kinds, weight):
    f, y = made(np.random.default_rng(1), n0, n1, p)
    names = [f"f{j}" for j in range(p)]
    config = maxent.Config(kinds=kinds, n_hinge=5, background_weight=weight)
    found = maxent.fit_all(rows_of(spark, f, y).repartition(4), names, config, k=0).collect()
    terms = maxent.terms(names, config)
    x = maxent.matrix({c: (f[:, j] - f[:, j].min()) / np.ptp(f[:, j]) for j, c in enumerate(names)}, terms)
    heavy = n1 / n0 if weight == "balanced" else weight
    w = np.where(y == 1, 1.0, heavy)
    lam = maxent.penalties(x[y == 1].std(axis=0), n1, terms, config)
    kept = {(r.kind, r.a, r.b or "", r.knot, r.up): r.coef for r in found if r.up is not None}
    fixed = {r.kind: r.coef for r in found if r.up is None}
    beta = np.array([*(kept.get(t, 0.0) for t in terms), fixed["intercept"]])
    mine, best = objective(x, y, w, lam, beta), objective(x, y, w, lam, plain(x, y, w, lam))
    assert mine <= best * (1 + 1e-6)
    assert fixed["gap"] < 1e-6
    assert np.abs(beta[:-1]).max() > 0.5
    eta = x[y == 0] @ beta[:-1]
    raw = np.exp(eta - np.log(np.exp(eta).sum()))
    assert fixed["alpha"] == pytest.approx(-np.log(np.exp(eta).sum()), abs=1e-9)
    assert fixed["entropy"] == pytest.approx(-(raw * np.log(raw)).sum(), abs=1e-9)
    assert fixed["auc"] == pytest.approx(maxent.rank_auc(y, x @ beta[:-1]), abs=1e-9)


def test_usual_size_finds_what_there_is(spark):
    """10,000 background and 200 presence rows, default terms and weight: more terms than are at work at once."""
    f, y = made(np.random.default_rng(2), 10_000, 200, 8)
    names = [f"f{j}" for j in range(8)]
    df = rows_of(spark, f, y)
    found = maxent.fit_all(df, names, k=0)
    fixed = {r.kind: r.coef for r in found.filter("up IS NULL").collect()}
    assert len(maxent.terms(names, maxent.Config())) > solver.AT_ONCE
    assert fixed["gap"] < 1e-6 and fixed["auc"] > 0.85
    p = [r.p for r in predict.score(df, found, names, ["point_id"]).collect()]
    assert np.ptp(p) > 0.5


@pytest.mark.parametrize("weight", [1.0, 100.0, "balanced"])
def test_one_table_for_few_and_many_rows(spark, weight):
    f, y = made(np.random.default_rng(3), 300, 60, 2)
    df = rows_of(spark, f, y)
    config = maxent.Config(kinds=("linear", "hinge"), n_hinge=4, background_weight=weight)
    key = lambda r: (r.kind, r.a, r.b, r.knot, r.up)
    few = {key(r): r.coef for r in maxent.fit_all(df, ["f0", "f1"], config, k=0).collect()}
    large = {key(r): r.coef for r in maxent.fit_large(df.repartition(7), ["f0", "f1"], config).collect()}
    assert few.keys() == large.keys()
    assert all(v == pytest.approx(large[k], abs=1e-4) for k, v in few.items() if v is not None and k[0] != "gap")


def test_models_keep_their_own_rows(spark):
    """Several identifiers with features of their own, nulls, and one without background."""
    rng = random.Random(1)
    rows = [(f"S{s}_{a}", i, int(i % 5 == 0), 1.0, i % 3, rng.random() + (i % 5 == 0) * 0.4, rng.random(), None if i % 7 == 0 and a == "Roost" else rng.random()) for s in range(2) for a in ("Roost", "Fly") for i in range(200)]
    rows += [("Lone_Fly", i, 1, 1.0, i % 3, 0.5, 0.5, 0.5) for i in range(4)]
    df = spark.createDataFrame(rows, "identifier string, point_id int, class int, sample_weight double, fold int, a double, b double, c double")
    config = maxent.Config(kinds=("linear",))
    both = maxent.fit_all(df, {"Roost": ["a", "b", "c"], "Fly": ["a", "b"]}, config)
    res = {r.identifier: r for r in maxent.results(both).collect()}
    assert res["Lone_Fly"].status == "No background data" and res["S0_Roost"].n_presence + res["S0_Roost"].n_background == 171
    one = maxent.fit_all(df.filter("identifier = 'S1_Fly'"), ["a", "b"], config)
    pick = lambda t: {(r.fold, r.kind, r.a): r.coef for r in t.filter("identifier = 'S1_Fly'").collect() if r.coef is not None and r.kind != "gap"}
    mine, alone = pick(both), pick(one)
    assert mine.keys() == alone.keys() and all(v == pytest.approx(alone[k], abs=1e-6) for k, v in mine.items())
    assert not both.filter((F.col("identifier") == "S1_Fly") & (F.col("a") == "c")).count()


def test_quadratic_step():
    rng = np.random.default_rng(5)
    for n in (1, 4, 20):
        a = rng.standard_normal((n + 3, n))
        gram, g, beta, lam = a.T @ a, rng.standard_normal(n) * 3, rng.standard_normal(n), np.abs(rng.standard_normal(n))
        d = solver.quadratic(g, gram, beta, lam)
        r, z = g + gram @ d, beta + d
        assert np.where(z != 0, np.abs(r + lam * np.sign(z)), np.maximum(np.abs(r) - lam, 0)).max() < 1e-7
