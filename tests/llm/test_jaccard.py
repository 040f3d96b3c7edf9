import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rangemap.llm import jaccard
from rangemap.llm.components import connected_components

DATA = os.environ.get("RANGEMAP_TESTDATA", "/root/testdata")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent):
    """Per row (id, size, component), by comparing all pairs."""
    sets = [(r[0], shingles(r[1], k)) for r in rows]
    place = {i: i for i, _ in sets if i is not None}

    def root(x):
        while place[x] != x:
            x = place[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if None not in (i, j) and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                place[y] = x
    return sorted((str(i), len(s), None if i is None else root(i)) for i, s in sets)


@pytest.mark.parametrize("tile", [1000, 4])
@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_components_equal_brute_force(hard, hard_rows, k, percent, tile, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", tile)
    found = jaccard.jaccard_components(hard, k, percent).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in found) == brute(hard_rows, k, percent)


def test_empty_table(nothing):
    assert jaccard.jaccard_components(nothing, 4, 85).count() == 0
    assert jaccard.keep_first(nothing).count() == 0


def test_keep_first_keeps_columns_and_first_copies(hard, hard_rows):
    found = jaccard.keep_first(hard)
    assert found.columns == hard.columns
    want = sorted(str(i) for i, _, c in brute(hard_rows, 5, 80) if i == "None" or str(c) == i)
    assert sorted(str(r["doc_id"]) for r in found.collect()) == want


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)), st.integers(50, 100))
def test_linked_and_bitmap_bound(a, b, percent):
    x, y = (np.array(sorted(v), np.uint64) * np.uint64(0x9E3779B97F4A7C15) for v in (a, b))
    x.sort(), y.sort()
    if a and b:
        assert jaccard.linked(x, y, percent) == (100 * len(a & b) >= percent * len(a | b))
    marks = jaccard.bitmaps(np.r_[x, y], np.array([0, len(x), len(x) + len(y)]))
    most = (len(a) + len(b) - int(np.bitwise_count(marks[0] ^ marks[1]).sum())) // 2
    assert most >= len(a & b)


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5), (200, 100), (None, 3)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100, 200: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40), max_size=30), min_size=1, max_size=12), st.sampled_from([80, 85, 95]))
def test_prefix_ranges_hold_the_prefix(values, percent):
    """The ranges that a set tells of hold its prefix, and no fewer ranges would."""
    values = [sorted(int(jaccard.mix64(np.array([x], np.uint64))[0]) for x in v) for v in values]
    first = np.cumsum([0, *map(len, values)])
    send, last, before, at = jaccard.prefix_ranges(np.array([x for v in values for x in v], np.uint64), first, percent)
    for i, v in enumerate(values):
        need = len(v) - -(-len(v) * percent // 100) + 1 if v else 0
        assert before[i] == sum(x >> 62 < last[i] for x in v) and at[i] == sum(x >> 62 == last[i] for x in v)
        assert before[i] + at[i] >= need and (before[i] < need or not v)
        assert send[first[i] : first[i + 1]].tolist() == [x >> 62 <= last[i] for x in v]


def near(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.integers(len(words))] = f"w{rng.integers(1 << 30)}"
    return " ".join(words)


@pytest.mark.parametrize("tile, common", [(1000, 1000), (5, 3)])
def test_many_sizes_at_the_threshold(spark, tile, common, monkeypatch):
    """Texts of all sizes with as many changes as a link may have, about the threshold on both sides; shared passages."""
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "COMMON", common)
    rng = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for size in (4, 5, 9, 15, 30, 60, 120, 400):
        for _ in range(6):
            base = [f"w{x}" for x in rng.integers(0, 1 << 30, size)] + (passage if rng.random() < 0.5 else [])
            rows += [near(rng, base, c) for c in (0, 0, max(1, len(base) // 50), max(1, len(base) // 40), max(1, len(base) // 30))]
            rows.append(" ".join(base[: len(base) * 9 // 10]))
    rows = [(i, t) for i, t in enumerate(rng.permutation(rows).tolist())]
    for k, percent in ((4, 85), (5, 80)):
        found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()
        assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in found) == brute(rows, k, percent)


def test_all_pairs_of_a_whole_table(spark):
    """All links of a thousand documents, against all pairs."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    sets = {i: shingles(t, 4) for i, t in rows}
    index = {}
    for i, s in sets.items():
        for g in s:
            index.setdefault(g, []).append(i)
    common = Counter((a, b) for ids in index.values() for x, a in enumerate(ids) for b in ids[x + 1 :])
    place = {i: i for i in sets}
    for (a, b), n in common.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((place[a], place[b]))
            place = {k: x if v == y else v for k, v in place.items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs, 4, 85).collect()}
    assert found == place and any(i != c for i, c in place.items())


def test_links_outside_a_smallest_star(spark):
    """A text whose smallest star holds no partner links in another star."""
    rng = np.random.default_rng(9)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 30, n)]
    rows = []
    for g in range(12):
        x, p, q, z, r = words(50), words(10), words(10), words(50), words(90)
        rows += [(g * 10 + i, " ".join(t)) for i, t in enumerate((p + r, r + words(60), x + q + z, x + p + z, p + words(80)))]
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 75).collect()
    want = brute(rows, 4, 75)
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in found) == want and any(str(c) != i for i, _, c in want)


def test_stars_over_batches():
    rows = [(1, 5), (1, 5), (1, 7), (1, 7), (2, 3), (3, 1), (3, 2), (3, 9), (4, 4), (4, 4)]
    table = pa.table({"tile": [r[0] for r in rows], "node": [r[1] for r in rows]})
    for cut in (1, 2, 3, 20):
        out = pa.Table.from_batches(list(jaccard._stars(table.to_batches(max_chunksize=cut))))
        assert [tuple(r.values()) for r in out.to_pylist()] == [(5, 7), (1, 2), (1, 9)]


def test_counts_over_batches(monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON", 3)
    rows = [(1, 5), (1, 5), (1, 7), (1, 7), (2, 3), (3, 1), (3, 2), (3, 9), (3, 9), (3, 10), (3, 12), (4, 4), (4, 4), (5, 1), (5, 2)]
    table = pa.table({"shingle": [r[0] for r in rows], "one": [r[1] for r in rows]})
    for cut in (1, 2, 3, 20):
        out = pa.Table.from_batches(list(jaccard._counted(table.to_batches(max_chunksize=cut)))).to_pylist()
        assert sorted((r["shingle"], r["one"], r["c"]) for r in out) == [(1, 5, 2), (1, 7, 2), (3, 1, 3), (3, 2, 3), (3, 9, 3), (3, 10, 3), (3, 12, 3), (5, 1, 2), (5, 2, 2)]
