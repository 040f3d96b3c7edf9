"""Phrase mining against plain counting."""

import glob
import random
import re
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rangemap import session
from rangemap.llm import common, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        totals[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    found = []
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    for (lang, p), a in candidates.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(other == lang and len(q) > len(p) and 100 * b >= 100 * a and inside(q) for (other, q), b in candidates.items()):
            continue
        n = totals[lang]
        score, _, left, right = min((1000 * a * n // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
        found.append((lang, " ".join(p), a, left, right, n, score))
    found.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranks = Counter()
    out = []
    for r in found:
        ranks[r[0]] += 1
        if ranks[r[0]] <= top:
            out.append((r[0], ranks[r[0]], *r[1:]))
    return out


def rows_of(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize(("least", "top"), [(2, 2000), (3, 7), (12, 2000)])
def test_equals_plain_counting(spark, hard, hard_rows, least, top):
    assert rows_of(phrases.collocations(hard, least, top)) == brute(hard_rows, least, top)


def test_overlaps_pieces_and_ties(spark):
    rng = random.Random(3)
    texts = ["a a a a a, a a", "A\ta a;a", "b c d e f g\nb c d e f", "b  c d e f.b c", "ß É é ß É", "\x1cx y\x85 x y", "", None]
    texts += [" ".join(rng.choice("abcd") + rng.choice(["", ",", "\v"]) for _ in range(200)) for _ in range(6)]
    rows = [(i, t, rng.choice(["en", None, "de"]), None, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string").repartition(3)
    assert rows_of(phrases.collocations(df, 2)) == brute(rows, 2, 2000)


def test_no_rows_and_nothing_frequent(spark, nothing, hard):
    assert phrases.collocations(nothing).collect() == []
    assert phrases.collocations(hard, 10**6).collect() == []


def test_one_text_of_a_megabyte(spark):
    text = "to be or not to be " * 60_000
    df = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    assert rows_of(phrases.collocations(df)) == brute([(1, text, "en")], 100, 2000)


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    frequent = spark.createDataFrame([("en", "x", 1, big), ("en", "y", 1, big - 7), ("en", "x y", 2, big - 9)], "lang string, phrase string, words int, f long")
    totals = spark.createDataFrame([("en", 3 * big)], "lang string, n long")
    found = phrases.scored(phrases.maximal(frequent), frequent, totals).collect()
    assert [r.score for r in found] == [1000 * (big - 9) * 3 * big // (big * (big - 7))]


def test_a_full_bitmap_drops_nothing(spark, hard, hard_rows, monkeypatch):
    monkeypatch.setattr(common, "MOST_BITS", 6)
    assert rows_of(phrases.collocations(hard, 2)) == brute(hard_rows, 2, 2000)


@pytest.mark.parametrize("held", [1, 5, 1_000_000])
def test_counts_of_a_task_add_up_however_many_it_holds(held, monkeypatch):
    monkeypatch.setattr(phrases, "HELD", held)
    texts = [["a b a", "b; b c"], ["c a"], ["a a d", ""]]
    rows = [phrases.Block.of_texts("en", t).row("en", 1) for t in texts]
    found = Counter()
    for batch in phrases._phrase_counts(rows):
        for lang, phrase, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            found[lang, phrase] += n
    assert found == Counter(("en", w) for t in texts for w in re.findall("[a-d]", " ".join(t)))


@pytest.mark.parametrize("held", [1, 1_000_000])
def test_words_are_counted_once_by_their_text(held, monkeypatch):
    monkeypatch.setattr(phrases, "HELD", held)
    texts, langs = ["a b A", "b; c b", None, "d\ta"], ["en", "de", "en", "en"]
    batches = [pa.RecordBatch.from_pydict({"lang": langs[i : i + 2], "text": [t or "" for t in texts[i : i + 2]]}) for i in (0, 2)]
    found = Counter()
    for batch in phrases._word_counts(batches):
        for lang, phrase, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            found[lang, phrase] += n
    assert found == {("en", "a"): 3, ("en", "b"): 1, ("en", "d"): 1, ("de", "b"): 2, ("de", "c"): 1}
    words = pa.RecordBatch.from_pydict({"lang": ["en", "en", "de"], "phrase": ["a", "b", "b"]})
    hashes = next(phrases._word_hashes([words])).column(0).to_numpy().view("uint64").tolist()
    block = phrases.Block.of_texts("en", ["a b"])
    assert hashes[:2] == block.hash.tolist() and hashes[2] not in hashes[:2]


def test_blocks_are_in_row_groups_of_few(spark, hard, monkeypatch):
    """A task that writes or reads a relation holds one row group, so that must not grow with the task's share of the texts."""
    kept, paths = phrases.written, []

    def noted(df, name, options=None):
        if name == "relation":
            paths.append(options)
        return kept(df, name, options)

    monkeypatch.setattr(phrases, "written", noted)
    phrases.collocations(hard, 2).count()
    assert len(paths) == 5 and all(o == session.FEW_ROWS for o in paths)
    table = session.written(spark.range(0, 20, 1, 1).select(F.transform(F.sequence(F.lit(1), F.lit(500_000)), lambda i: F.xxhash64("id", i)).alias("hash")), "blocks", session.FEW_ROWS)
    files = [pq.ParquetFile(f) for f in glob.glob(table.written_to.removeprefix("file:") + "/*.parquet")]
    groups = [f.metadata.row_group(i).num_rows for f in files for i in range(f.metadata.num_row_groups)]
    assert sum(groups) == 20 == table.count() and max(groups) <= 6  # of 4 MB each
