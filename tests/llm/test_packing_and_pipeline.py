import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from rangemap.llm import packing

PIECES = st.lists(st.tuples(st.integers(0, 20), st.sampled_from(["a", "b", "c", None]), st.integers(0, 4)), max_size=30)


@settings(max_examples=150, deadline=None)
@given(PIECES)
def test_every_piece_takes_the_tightest_compatible_bin(pieces):
    sizes, sources, clusters = (list(x) for x in zip(*pieces, strict=True)) if pieces else ([], [], [])
    bins, offsets = packing.pack(sizes, sources, clusters, 20)
    held = []  # (free, sources, clusters) of each bin
    for n, s, c, b, at in zip(sizes, sources, clusters, bins, offsets, strict=True):
        fit = [(x[0], i) for i, x in enumerate(held) if x[0] >= n and c not in x[2] and (s is None or s not in x[1])]
        assert b == (min(fit)[1] if fit else len(held))
        if b == len(held):
            held.append([20, set(), set()])
        assert at == 20 - held[b][0]
        held[b][0] -= n
        held[b][1].add(s)
        held[b][2].add(c)


def check_packing(rows, texts, capacity):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    words, bins = defaultdict(int), defaultdict(list)
    for r in rows:
        words[r["doc_id"]] += r["n_words"]
        bins[r["shard"], r["bin"]].append(r)
    assert {k: v for k, v in words.items()} == {i: sum(size(t) for j, t in texts if j == i) for i, _ in texts}
    for held in bins.values():
        held.sort(key=lambda r: (r["bin_offset"], r["n_words"]))
        at = 0
        for r in held:
            assert r["bin_offset"] == at
            at += r["n_words"]
        assert at <= capacity


def test_packing_of_hard_rows(hard, hard_rows, nothing):
    for shard in (1000, 5):
        rows = packing.best_fit(hard, capacity=100, shard=shard).collect()
        check_packing(rows, [(r[0], r[1]) for r in hard_rows], 100)
        source = {r[0]: r[3] for r in hard_rows if r[0] is not None}
        seen = set()
        for r in rows:
            if r["doc_id"] is not None and source[r["doc_id"]] is not None and r["doc_id"] != 13:
                key = r["shard"], r["bin"], source[r["doc_id"]]
                assert key not in seen
                seen.add(key)
        texts = {r[0]: r[1] or "" for r in hard_rows}
        alike = [(r["shard"], r["bin"], texts[r["doc_id"]]) for r in rows if r["doc_id"] is not None and r["piece"] == 0 and r["doc_id"] != 13]
        assert len(set(alike)) == len(alike)
    assert packing.best_fit(nothing).count() == 0


def test_near_copies_share_no_bin(hard, hard_rows):
    from rangemap.llm import jaccard
    from pyspark.sql import functions as F

    ids = jaccard.jaccard_components(hard, 5, 80).select("doc_id", "component_id").distinct()
    group = {r["doc_id"]: r["component_id"] for r in ids.collect()}
    assert len(set(group.values())) < len(group) - 5
    rows = packing.best_fit(hard.drop("component").join(ids, "doc_id"), capacity=5000, cluster=F.col("component_id")).collect()
    held = [(r["shard"], r["bin"], group[r["doc_id"]]) for r in rows if r["doc_id"] != 13]
    assert len(set(held)) == len(held)


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "substring dedup", "secret scans", "best-fit packing"]
    before, kept = docs.count(), docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf)
        kept = spark.createDataFrame(kept.collect(), kept.schema)
        assert kept.columns == docs.columns, name
        now = kept.count()
        assert 0 < now <= before
        if name in ("substring dedup", "secret scans"):
            assert now == before and kept.filter("n_chars <> length(text)").count() == 0
        before = now
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()
    check_packing(packed, [(r["doc_id"], r["text"]) for r in kept.collect()], packing.CAPACITY)
    same = corpus_pipeline.run(spark, sf).collect()
    assert sorted(map(tuple, same)) == sorted(map(tuple, packed))


def test_stages_take_hard_rows(spark, hard, nothing, sf):
    from rangemap.llm import jaccard, secrets, substrings

    for rows in (hard, nothing):
        out = secrets.redact_secrets(substrings.remove_repeats(jaccard.keep_first(rows)))
        assert out.columns == rows.columns
        assert packing.best_fit(out).count() >= out.count()
