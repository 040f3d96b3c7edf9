"""Whitening against a library's eigenvectors and plain integers."""

import math

import numpy as np
import pytest

from rangemap.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def spectra(d):
    return {
        "spread": np.linspace(3, 0.01, d),
        "equal": np.ones(d),
        "steep": 10.0 ** -np.minimum(np.arange(d), 14),
        "low rank": np.r_[np.ones(min(d, 2)), np.zeros(d - min(d, 2))],
        "one above all": np.r_[1e6, np.linspace(2, 1, d)[1:]],
        "near ties": np.r_[2 + 1e-9 * np.arange(min(d, 6)), np.linspace(1, 0.9, d)[min(d, 6) :]],
    }


@pytest.mark.parametrize("d", [1, 2, 3, 4, 9, 64])
@pytest.mark.parametrize("kind", list(spectra(1)))
def test_eigenpairs(d, kind):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    v = (q * spectra(d)[kind]) @ q.T
    v = (v + v.T) / 2
    e, vectors = whitening.leading(v, 4)
    true = np.linalg.eigvalsh(v)[::-1][:4]
    assert len(e) == (min(d, 2) if kind == "low rank" else min(d, 4))
    size = true[0]
    assert np.abs(e - true[: len(e)]).max() < 1e-13 * size
    assert np.abs(v @ vectors - vectors * e).max() < 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(e))).max() < 1e-13


def test_inertia_counts():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    e = np.linalg.eigvalsh(a)
    diagonal, off = whitening.tridiagonal(a)
    for s in np.linspace(e[0] - 1, e[-1] + 1, 97):
        assert whitening.count_above(diagonal, off, s) == (e > s).sum()


def brute(rows, d):
    kept = [(i, v) for i, v, _ in rows if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in kept])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:4], q[:, ::-1][:, :4]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    return [i for i, _ in kept], n, deviation, (x - s / n) @ q / np.sqrt(e), e / np.trace(c.T @ c / n)


def make(rng, d=12, n=200):
    rows = [(i, [float(c) for c in rng.standard_normal(d) * np.linspace(2, 0.2, d)], 0) for i in range(n)]
    rows += [(1000 + i, rows[3][1], None) for i in range(150)]
    rows += [(5, rows[5][1], 1), (None, rows[9][1], 1), (None, None, None), (2000, None, 1), (2001, [], 1)]
    rows += [(2002, [None, *rows[0][1][1:]], 1), (2003, [math.nan, *rows[0][1][1:]], 1), (2004, [math.inf, *rows[0][1][1:]], 1), (2005, [-math.inf, *rows[0][1][1:]], 1)]
    return rows + [(2006, [1.0, 2.0], 1), (2007, [-0.0] * d, 1)]


def test_equals_plain_numbers(spark):
    rows = make(np.random.default_rng(4))
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS n", "1.5 AS component", "label AS x").repartition(5)
    got = whitening.whiten(df).collect()
    ids, n, deviation, white, explained = brute(rows, 12)
    assert len(got) == 4 * len(ids)
    assert {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    assert sorted((r.vec_id or -1, r.deviation) for r in got) == sorted(((i or -1), v) for i, v in zip(ids, deviation, strict=True) for _ in range(4))
    want = {}
    for i, w in zip(ids, white, strict=True):
        want[i] = w
    signs = {}
    for r in got:
        w = want[r.vec_id][r.component - 1]
        assert abs(abs(r.whitened) - abs(w)) < 1e-9
        if abs(w) > 1e-6:
            assert signs.setdefault(r.component, np.sign(w * r.whitened)) == np.sign(w * r.whitened)
        assert abs(r.explained - explained[r.component - 1]) < 1e-9


def test_lacking_components_are_null(spark):
    rows = [(1, [1.0, 2.0, 0.0, 0.0, 0.0]), (2, [3.0, 6.0, 0.0, 0.0, 0.0]), (3, [2.0, 4.5, 0.0, 0.0, 0.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((r.vec_id, r.component) for r in got) == [(i, k) for i in (1, 2, 3) for k in (1, 2, 3, 4)]
    assert all((r.whitened is None) == (r.component > 2) == (r.explained is None) for r in got)
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], "vec_id long, embedding array<float>")).collect()
    assert len(same) == 18
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, None, None, None)}


def test_no_rows(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(nothing).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 1), (2, [], 1), (3, [math.nan], 1)], SCHEMA)).collect() == []


def test_large_entries(spark):
    rows = [(1, [3e9, 1.0]), (2, [-2e9, 5.0]), (3, [2e14, 0.5]), (4, [7.0, 1e38])]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert sorted({i for i, _ in got}) == [1, 2]  # the others pass 2^53 quanta
    assert got[1, 1].deviation is None  # passes 64 bits
