import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rangemap.llm import substrings


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, window):
    first = {}
    for i, text in sorted(((r[0], r[1]) for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = split(text)
        for j in range(len(w) - window + 1):
            first.setdefault(tuple(w[j : j + window]), i)
    out = []
    for r in rows:
        i, w = r[0], split(r[1])
        keep = [True] * len(w)
        for j in range(len(w) - window + 1):
            if i is not None and first[tuple(w[j : j + window])] < i:
                keep[j : j + window] = [False] * window
        kept = [x for x, k in zip(w, keep, strict=True) if k]
        out.append((str(i), len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("hot", "known"), [(500, 50_000), (2, 0), (2, 50_000)])
def test_report_equals_brute_force(hard, hard_rows, hot, known, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "KNOWN", known)
    found = substrings.dedup_report(hard).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found) == brute(hard_rows, 13)


def test_remove_repeats_keeps_rows_columns_and_other_texts(hard, hard_rows):
    found = substrings.remove_repeats(hard)
    assert found.columns == hard.columns and found.count() == len(hard_rows)
    kept = {(i, d) for i, _, _, d in brute(hard_rows, 13)}
    texts = dict((r[0], r[1]) for r in hard_rows)
    for r in found.collect():
        assert (str(r["doc_id"]), hashlib.sha256(" ".join(split(r["text"])).encode()).hexdigest()) in kept
        if r["doc_id"] in (1, 8, 9, 10, 12, 14, 16) or r["text"] is None:
            assert r["text"] == texts[r["doc_id"]]


def test_empty_table(nothing):
    assert substrings.dedup_report(nothing).count() == 0
    assert substrings.remove_repeats(nothing).columns == nothing.columns


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=12), min_size=1, max_size=6), st.lists(st.integers(0, 3), max_size=14), st.integers(1, 5))
def test_automaton_finds_the_maximal_matches(texts, probe, window):
    automaton = substrings.SuffixAutomaton()
    for t in texts:
        automaton.add(t)
    known = lambda part: any(t[a : a + len(part)] == part for t in texts for a in range(len(t) - len(part) + 1))
    covered = [any(known(probe[j : j + window]) for j in range(max(0, i - window + 1), min(i, len(probe) - window) + 1)) for i in range(len(probe))]
    spans, whole = automaton.matched(probe, window)
    found = [any(a <= i < b for a, b in spans) for i in range(len(probe))]
    assert found == covered and whole == (not probe or known(probe))


def test_ranges_are_merged():
    doc, begin, finish = (np.array(x) for x in ([1, 0, 0, 0, 1], [5, 0, 10, 3, 9], [9, 4, 12, 8, 20]))
    assert [x.tolist() for x in substrings._merged(doc, begin, finish)] == [[0, 0, 1], [0, 10, 5], [8, 12, 20]]


@pytest.mark.parametrize("cut", [1, 2, 3, 7])
def test_shared_anchors_over_batches(cut):
    """Rows of an anchor that goes on over batches are treated as if they came at once."""
    rows = sorted([(a, d, w) for a, ds in ((1, [5]), (2, [3, 3, 4]), (3, [1, 1]), (4, [2, 3, 4, 5, 6, 7]), (5, [8, 9])) for w, d in enumerate(ds)])
    table = pa.table({"anchor": [r[0] for r in rows], "doc_id": [r[1] for r in rows], "word": pa.array([100 + r[2] for r in rows], pa.int32())})
    out = pa.Table.from_batches(list(substrings._shared(64, 4)(table.to_batches(max_chunksize=cut)))).to_pylist()
    want = [(3, 100, 3, 1), (3, 101, 3, 1), (4, 102, 3, 1), *((d, 98 + d, 2, -1) for d in range(2, 8)), (8, 100, 8, 1), (9, 101, 8, 1)]
    assert sorted(tuple(r.values()) for r in out) == sorted(want)


def test_common_anchors_leave_their_shard():
    """Of an anchor in many texts a task sends a bounded number of rows under its own name."""
    text = " ".join(f"w{i}" for i in range(13))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": [text] * 40})
    out = pa.Table.from_batches(list(substrings._anchors(13, 5, 3)([batch, batch]))).to_pylist()
    assert len(out) == 80 and sum(r["word"] == 0 for r in out) == 4 and sum(r["word"] == -1 for r in out) == 76
    assert len({r["anchor"] for r in out if r["word"] == 0}) == 1 and len({r["anchor"] for r in out}) > 30
    hits = pa.Table.from_batches(list(substrings._shared(64, 3)(pa.Table.from_pylist(sorted(out, key=lambda r: (r["anchor"], r["doc_id"]))).to_batches())))
    assert len(hits) == 80 and set(hits["part"].to_pylist()) == {-1} and set(hits["word"].to_pylist()) == {0}


def test_very_long_texts(spark):
    """A text of a megabyte, its copy, and one that begins in its middle."""
    rng = np.random.default_rng(3)
    words = [f"w{x}" for x in rng.integers(0, 50_000, 160_000)]
    rows = [(1, " ".join(words)), (2, "\n".join(words)), (3, " ".join(words[80_000:] + ["end"] * 30)), (4, "end " * 20)]
    found = substrings.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found) == brute(rows, 13)
