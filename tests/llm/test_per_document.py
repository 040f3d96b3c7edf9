"""Operators that judge each document by itself."""

import hashlib
import random
import re
import struct
import unicodedata
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rangemap.llm import bpe, fingerprint, media, pseudo_likelihood, quality, secrets, url_filter
from rangemap.llm.common import Words


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# words

@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t\x1c\xa0語", max_size=30), max_size=6))
def test_words(texts):
    import pyarrow as pa

    w = Words(pa.array(texts, pa.string()))
    want = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    assert w.count.tolist() == [len(x) for x in want]
    flat = [x for t in want for x in t]
    assert [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.stop, strict=True)] == flat
    seen = {}
    for x, h in zip(flat, w.hash.tolist(), strict=True):
        assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)
    runs, at = w.runs(3)
    assert len(at) == sum(max(0, len(x) - 2) for x in want)


# secrets

def brute_spans(text):
    found = []
    rules = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12), ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 16)]
    for k, (kind, pattern, good) in enumerate(rules):
        flags = re.I | re.A if kind == "assign" else 0
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text, flags) if good(m)]
    return [x for _, _, x in sorted(found)]


PARTS = ["token", "Password", "api_key", "APIKEY", "secret", "passwd", "=", ":", " ", '"', "'", "abcdef012345", "AKIA", "ABCDEF12345678", "0123456789abcdef", "é", "ſ", "K", "-", "\n", "x"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_base_spans_equal_plain_expressions(text):
    assert [f"{k}:{a}:{b}" for k, a, b in secrets.find_spans(text) if k in secrets.BASE_KINDS] == brute_spans(text)


def test_checked_kind_needs_its_checksum():
    body = "0123456789abcdefghijABCDEFGHIJ"
    good = f"é ghp_{body}{secrets.checksum62(body.encode())} end"
    assert [s[0] for s in secrets.find_spans(good) if s[0] == "checked"] == ["checked"]
    assert "checked" not in [s[0] for s in secrets.find_spans(good[:-5] + "0 end")]


def test_scan_and_redact(hard, hard_rows, nothing):
    found = secrets.scan_secrets(hard).collect()
    assert len(found) == len(hard_rows)
    want = sorted((str(r[0]), sha(",".join(brute_spans(r[1] or "")))) for r in hard_rows)
    assert sorted((str(r["doc_id"]), r["base_sha256"]) for r in found) == want
    masked = secrets.redact_secrets(hard)
    assert masked.columns == hard.columns
    texts = dict((r[0], r[1]) for r in hard_rows if r[0] is not None)
    for r in masked.collect():
        if r["doc_id"] == 12:
            assert "04dbebab" not in r["text"] and "AKIA" not in r["text"] and "é" in r["text"]
        elif r["doc_id"] is not None:
            assert r["text"] == texts[r["doc_id"]]
    assert secrets.scan_secrets(nothing).count() == 0 and secrets.redact_secrets(nothing).count() == 0


# tokens

@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN


@pytest.fixture(scope="module")
def known(vocabulary):
    import tiktoken

    path, pattern = vocabulary
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})


def test_bpe_equals_the_library(vocabulary, known):
    coder, tokens = bpe.encoder(*vocabulary), bpe.token_table(vocabulary[0])
    rng = random.Random(2)
    parts = ["a", "b", "th", "é", "ß", "1", "!!", " ", "  ", "\n", "語", "the", "ing", "🙂", "'s", "x", "\x1c", "\xa0", "²", "​"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(1500)] + ["a" * 5000, " " * 3000, "ab" * 3000, "éa" * 900]
    for t in texts:
        ids = coder.encode(t)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == known.encode_ordinary(t)
        assert bpe.decoded(tokens, ids) == t.encode()


def test_bpe_query_rows(hard, hard_rows, nothing, vocabulary, known):
    found = bpe.digests(bpe.decode(bpe.encode(hard, *vocabulary), vocabulary[0])).collect()
    want = []
    for r in hard_rows:
        ids = known.encode_ordinary(r[1] or "")
        want.append((str(r[0]), len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(r[1] or "")))
    assert sorted((str(r["doc_id"]), *r[1:]) for r in found) == sorted(want)
    assert bpe.encode(nothing, *vocabulary).count() == 0


# media

def test_media_rows(hard, hard_rows, nothing):
    found = media.media_features(media.with_media(hard)).collect()
    want = []
    for r in hard_rows:
        data = (r[1] or "").encode()
        pad = media.padded(data)
        assert len(pad) % 64 == 0 and pad and pad.rstrip(b"\0") == data.rstrip(b"\0")
        want.append((str(r[0]), len(data), len(pad), sha(pad), zlib.crc32(pad[-64:])))
    assert sorted((str(r["doc_id"]), *r[1:5]) for r in found) == sorted(want)
    by_text = {}
    for r in found:
        assert by_text.setdefault(r["payload_sha256"], (r["media_sha256"], r["feature"])) == (r["media_sha256"], r["feature"])
    assert media.media_features(media.with_media(nothing)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 9), st.integers(1, 70), st.randoms(use_true_random=False))
def test_png_round_trip_and_all_filters(rows, width, rng):
    image = np.array([[rng.randrange(256) for _ in range(width)] for _ in range(rows)], np.uint8)
    assert (media.decode_png(media.encode_png(image)) == image).all()
    kinds = np.array([rng.randrange(5) for _ in range(rows)], np.uint8)
    lines = np.zeros_like(image)
    for r in range(rows):
        for c in range(width):
            a = int(image[r, c - 1]) if c else 0
            b = int(image[r - 1, c]) if r else 0
            d = int(image[r - 1, c - 1]) if r and c else 0
            p = a + b - d
            paeth = a if abs(p - a) <= min(abs(p - b), abs(p - d)) else b if abs(p - b) <= abs(p - d) else d
            lines[r, c] = (int(image[r, c]) - [0, a, b, (a + b) // 2, paeth][kinds[r]]) % 256
    assert (media.unfilter(kinds, lines) == image).all()


def test_damage_is_found():
    good = media.encode_png(np.arange(128, dtype=np.uint8).reshape(2, 64))
    for at in range(8, len(good)):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            media.decode_png(bytes(bad))
    with pytest.raises(ValueError):
        media.decode_png(good[:-4])


# fingerprints

def plain(text):
    x = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(x.split())


@given(st.text(max_size=40))
def test_canonical(text):
    assert fingerprint.canonical(text) == plain(text).encode()
    assert fingerprint.canonical(plain(text)) == plain(plain(text)).encode()


def test_an_id_with_two_texts_keeps_both_fingerprints(spark):
    texts = [(1, "alpha"), (1, "beta"), (2, "beta"), (None, "beta"), (3, "ALPHA"), (1, "beta"), (None, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = fingerprint.fingerprint_report(docs).collect()
    marks = {fingerprint.digest(fingerprint.canonical(t or "")): t for _, t in texts}
    got = sorted((r["doc_id"] or 0, marks[r["fingerprint"]].lower() if marks[r["fingerprint"]] else "", r["group_id"] or 0) for r in found)
    assert got == [(0, "", 0), (0, "beta", 0), (1, "alpha", 1), (1, "beta", 1), (1, "beta", 1), (2, "beta", 1), (3, "alpha", 1)]


def test_fingerprint_report(hard, hard_rows, nothing):
    found = fingerprint.fingerprint_report(hard).collect()
    rows = sorted(((r[0], r[1] or "") for r in hard_rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for (i, t), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
        k = len(t) // 4
        changed = t[: len(t) - k] + after[:k]
        want.append((str(i), len(t), sha(changed), float(plain(t) == plain(changed)), float(plain(t) == plain(after))))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in found) == sorted(want)
    mark = {r["doc_id"]: (r["fingerprint"], r["group_id"]) for r in found if r["doc_id"] is not None}
    assert mark[1][0] == mark[3][0] and mark[3][1] == 1 and mark[16] == (mark[17][0], 16) and mark[8] == mark[9]
    assert mark[6] == mark[7] == mark[14] and mark[2][0] != mark[1][0]
    assert fingerprint.fingerprint_report(nothing).count() == 0


def test_one_row_follows_itself(spark):
    found = fingerprint.compare_with_next(spark.createDataFrame([(4, "abcdefgh")], "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["near_next"], r["edited_sha256"]) for r in found] == [(4, 1.0, sha("abcdefab"))]


# quality

def test_quality_learns_and_holds_out(spark, sf):
    import pandas as pd

    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = quality.classify(docs, labels).toPandas()
    assert len(found) == docs.count() and found["score"].between(0, 1).all()
    assert ((found["score"] >= 0.7) == (found["predicted"] == 1)).all()
    assert (found["held_out"] == found["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    joined = found.merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    held = joined[joined["held_out"]]
    good, bad = (held[held["quality"] == y]["score"].to_numpy() for y in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() > 0.9
    assert ((held["predicted"] == held["quality"])).mean() > 0.9


def test_quality_hard_cases(spark, hard, hard_rows, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (8, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.classify(hard, labels).count() == len(hard_rows)
    none = labels.limit(0)
    assert {r["score"] for r in quality.classify(hard, none).collect()} == {0.5}
    assert quality.classify(nothing, none).count() == 0
    kept = quality.keep_good(hard, none, cut=0.5)
    assert kept.columns == hard.columns and kept.count() == len(hard_rows)


# masked scores

def test_conditionals_sum_to_one():
    model = pseudo_likelihood.fresh(3)
    near = np.random.default_rng(0).integers(0, pseudo_likelihood.IDS + 1, (1, 2 * pseudo_likelihood.SIDE))
    every = np.arange(pseudo_likelihood.IDS)
    p = np.exp(pseudo_likelihood.log_probs(model, np.repeat(near, len(every), 0), every))
    assert abs(p.sum() - 1) < 1e-4


def test_contexts_stop_at_text_ends():
    ids, first = np.array([5, 6, 7, 8]), np.array([0, 3, 3, 4])
    e = pseudo_likelihood.EDGE
    assert pseudo_likelihood.contexts(ids, first, np.arange(4), pseudo_likelihood.texts_of(first)).tolist() == [[e, e, 6, 7], [e, 5, 7, e], [5, 6, e, e], [e, e, e, e]]


def test_training_step_lowers_the_loss():
    rng = np.random.default_rng(1)
    model, near = pseudo_likelihood.fresh(), rng.integers(0, 20, (512, 4))
    target = near[:, 1] * 7
    sums = {k: np.full(s, 1e-3, np.float32) for k, s in pseudo_likelihood.SHAPES.items()}
    before = pseudo_likelihood.log_probs(model, near, target).mean()
    for _ in range(60):
        pseudo_likelihood.train_step(model, sums, near, target)
    assert pseudo_likelihood.log_probs(model, near, target).mean() > before + 3


def test_scores_of_all_rows(hard, hard_rows, nothing):
    found = pseudo_likelihood.score(hard).collect()
    assert sorted((str(r["doc_id"]), r["n_words"]) for r in found) == sorted((str(r[0]), len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in hard_rows)
    assert all(r["log_likelihood"] < 0 if r["n_words"] else r["log_likelihood"] == 0 for r in found)
    assert pseudo_likelihood.score(nothing).count() == 0


def test_every_word_is_a_target_once(hard, hard_rows):
    p = pseudo_likelihood
    row, first = np.array([7, 8, 1 << 33, 9]), np.array([0, 500, 500, 501, 900])
    turns = [p.targets(row, first, t) for t in range(p.MASK)]
    assert sorted(np.concatenate(turns).tolist()) == list(range(900)) and all(len(x) for x in turns)
    alone = [p.targets(row[:1], first[:2], t) for t in range(p.MASK)]
    assert all((a == b[b < 500]).all() for a, b in zip(alone, turns, strict=True))
    ids = p.tokens(hard).select("row", "tokens")
    seen = [ids.mapInArrow(p._train(p.flat(p.fresh()), t), p.COPIES).filter("block = 0").groupBy().sum("seen").first()[0] or 0 for t in range(p.MASK)]
    assert sum(seen) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in hard_rows)


def test_train_runs_every_turn(spark, monkeypatch):
    turns, run = [], pseudo_likelihood._train
    monkeypatch.setattr(pseudo_likelihood, "_train", lambda values, turn: turns.append(turn) or run(values, turn))
    pseudo_likelihood.train(pseudo_likelihood.tokens(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")))
    assert turns == list(range(pseudo_likelihood.MASK))


@pytest.mark.parametrize("most", [1_000_000, 3])
def test_words_of_one_bucket_have_their_own_probabilities(spark, most):
    import pyarrow as pa

    names = [f"w{i}" for i in range(60_000)]
    bucket = (Words(pa.array(names)).hash >> np.uint64(52)).tolist()
    a, b, c = [x for x, k in zip(names, bucket, strict=True) if k == bucket[0]][:3]
    rows = [(1, f"x {a} y"), (2, f"x {b} y"), (3, f"x {c} y"), (None, a)] + [(9, f"{a} {b}"), (9, a)] * 5
    found = {r["doc_id"]: r for r in pseudo_likelihood.score(spark.createDataFrame(rows, "doc_id long, text string"), most=most).collect() if r["doc_id"] != 9}
    mark = {k: found[k]["log_likelihood"] for k in (1, 2, 3)}
    assert mark[1] - mark[2] == pytest.approx(np.log(12 / 6), abs=1e-4) and mark[2] - mark[3] == pytest.approx(np.log(6), abs=1e-4)
    assert len(found) == 4 and found[None]["n_words"] == 1
    ids = pseudo_likelihood.tokens(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["n"] for r in pseudo_likelihood.vocabulary(ids).collect()) == [1, 3, 3, 6, 12]


def test_order_matters_to_the_score(spark):
    text = " ".join(["one two three four five six seven eight"] * 60)
    docs = [(i, text) for i in range(40)] + [(90, text)]
    mixed = text.split()
    random.Random(4).shuffle(mixed)
    docs.append((91, " ".join(mixed)))
    found = {r["doc_id"]: r["mean_log_prob"] for r in pseudo_likelihood.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found[90] > found[91] + 0.5


# urls

def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host) :])[0]


def brute_rule(host, path):
    fit = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda x: len(x[0]), default=(None, None))


def test_urls(spark, sf):
    urls = ["http://A.Example.ORG/es/1", "https://x.com/fr/a?b#c", "com/fr/", None, "", "no scheme", "x://", "a://b://c/d", "http://org/", "http://borg/", "http://example.org/en/12", "http://example.org/EN/1", "http://é.com/de/\nx", "http://www.com?x/fr/", "http://n.net#/", "http://spam-farm.example.net/en/7"]
    rows = [(i, u, "h", i, 1.0) for i, u in enumerate(urls)] + [(None, "http://a.net/", None, 0, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host long, probability double")
    found = {r["page_id"]: r for r in url_filter.filter_urls(pages).collect()}
    for i, u in enumerate(urls):
        host, path = brute_url(u)
        rule, verdict = brute_rule(host, path)
        r = found[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["block_score"] >= 0.5 else "allow"))
    assert found[len(urls) - 1]["verdict"] == "block"
    assert url_filter.filter_urls(pages.limit(0)).count() == 0
    every = url_filter.filter_urls(spark.read.parquet(f"{sf}/pages.parquet"))
    assert every.count() == spark.read.parquet(f"{sf}/pages.parquet").count()


def test_url_model_learns_its_table(spark):
    table = url_filter.labelled(spark)
    model = url_filter.train(table)
    out = model.transform(url_filter.with_features(table))
    assert out.filter("label = prediction").count() >= 0.95 * table.count()


def test_url_table_teaches_what_it_holds_back(spark):
    """Held out by hash of the row; the score is the fitted line through the hashed n-grams of host and path."""
    from pyspark.ml.feature import HashingTF
    from pyspark.sql import functions as F

    table = url_filter.labelled(spark).cache()
    assert table.count() > 5000 and 0.3 < table.agg(F.avg("label")).first()[0] < 0.5
    back = F.pmod(F.xxhash64("host", "path"), F.lit(5)) == 0
    known, held = table.filter(~back), table.filter(back).withColumn("url", F.concat(F.lit("http://"), "host", "path"))
    pages = held.select(F.monotonically_increasing_id().alias("page_id"), "url", "label")
    model, hashing = url_filter.train(known), HashingTF(numFeatures=url_filter.FEATURES)
    found = url_filter.filter_urls(pages, [], model=model).join(pages, "page_id").collect()
    right = [(r["verdict"] == "block") == (r["label"] == 1) for r in found]
    print("held out:", len(right), sum(right) / len(right))
    assert len(right) > 1000 and sum(right) / len(right) > 0.99
    for r in found[:20]:
        grams = set()
        for text, mark in ((r["host"], "h:"), (re.sub("[0-9]+", "0", r["path"]), "p:")):
            whole = f"^{text}$"
            grams |= {hashing.indexOf(mark + whole[i : i + n]) for n in url_filter.GRAMS for i in range(max(1, len(whole) - n + 1))}
        eta = model.intercept + sum(model.coefficients[i] for i in grams)
        assert r["block_score"] == pytest.approx(1 / (1 + np.exp(-eta)), abs=1e-6)


def test_quality_equals_plain_sizes_and_curve(spark, sf):
    """Scores from whole sizes by the plain library, and the curve against gradient descent."""
    import zstandard

    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)
    sizes = [zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False) for d in (model.good, model.bad)]
    found = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    for r in docs.orderBy("doc_id").limit(60).collect():
        data = r["text"].encode()
        parts = [data[i : i + quality.CHUNK] for i in range(0, len(data), quality.CHUNK)]
        by_good, by_bad = (sum(len(c.compress(x)) for x in parts) for c in sizes)
        eta = (model.slope * (by_bad - by_good) + model.whole * len(data)) / (len(data) + quality.SHORT) + model.offset
        assert found[r["doc_id"]] == pytest.approx(1 / (1 + np.exp(-eta)), abs=1e-9)
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(300, 2)), (rng.random(300) < 0.4).astype(float)
    x[:, 0] += y
    w, b = np.where(y == 1, 0.3 / y.sum(), 0.7 / (1 - y).sum()), np.zeros(2)
    for _ in range(20_000):
        b -= 2.0 * (x.T @ (w * (1 / (1 + np.exp(-(x @ b - 0.8))) - y)) + 1e-4 * b)
    assert quality._curve(x, y, 0.3, -0.8) == pytest.approx(b, abs=1e-5)


def test_quality_sample_is_bounded_and_repeatable(spark):
    rows = [(i % 40, f"text {i} " * (i % 7 + 1)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(3, 0, 0)], "doc_id long, quality int, toxic int")
    seen = []
    for df in (docs, docs.repartition(5)):
        model = quality.train(df, labels, per_class=10, class_bytes=300)
        seen.append((model.good, model.bad, model.slope, model.offset))
    assert seen[0] == seen[1]


def test_score_equals_a_plain_loop(spark):
    """log P of every word: softmax of class, softmax of member, and the word's share of its bucket, word by word."""
    import pyarrow as pa

    p = pseudo_likelihood
    rows = [(1, "the cat sat on the mat"), (2, "a cat"), (3, ""), (4, "the dog sat on the mat by the cat " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = p.tokens(docs)
    model = p.train(ids)
    counts = {r["word"]: r["n"] for r in p.vocabulary(ids).collect()}
    total = {}
    for word, n in counts.items():
        total[(word % (1 << 64)) >> 52] = total.get((word % (1 << 64)) >> 52, 0) + n
    found = {r["doc_id"]: r["log_likelihood"] for r in p.score(docs).collect()}
    for i, text in rows:
        hashes = Words(pa.array([text])).hash
        buckets = [int(h >> np.uint64(52)) for h in hashes]
        want = 0.0
        for at, (h, bucket) in enumerate(zip(hashes, buckets, strict=True)):
            near = [buckets[j] if 0 <= j < len(buckets) else p.EDGE for j in (at - 2, at - 1, at + 1, at + 2)]
            x = np.concatenate([model["embed"][j] for j in near]).astype(float)
            hidden = np.tanh(x @ model["into"] + model["into_0"])
            for logits, k in ((hidden @ model["group"] + model["group_0"], bucket // p.MEMBERS), (hidden @ model["member"][bucket // p.MEMBERS] + model["member_0"][bucket // p.MEMBERS], bucket % p.MEMBERS)):
                want += logits[k] - np.log(np.exp(logits).sum())
            want += np.log(counts[int(h.view(np.int64))] / total[bucket])
        assert found[i] == pytest.approx(want, rel=1e-3, abs=1e-3)


def test_colliding_digests_are_told_apart(spark):
    rows = [(5, "Same text"), (2, "same  TEXT"), (9, "other"), (7, "OTHER "), (1, "third"), (None, "other"), (4, None)]
    found = fingerprint.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), mark=lambda canon: "one").collect()
    assert {r["doc_id"]: r["group_id"] for r in found if r["doc_id"] is not None} == {5: 2, 2: 2, 9: 7, 7: 7, 1: 1, 4: 4}
    marks = {r["doc_id"]: r["fingerprint"] for r in found}
    assert marks[5] == marks[2] and marks[9] == marks[7] and len({marks[i] for i in (2, 7, 1, 4)}) == 4


def test_cosine_hash_equals_a_plain_transform():
    """Block means over 32 x 32, then the sums of the transform's definition."""
    rng = np.random.default_rng(1)
    for rows in (1, 5, 32, 70):
        image = rng.integers(0, 256, (rows, 64), np.uint8)
        n = media.GRID

        def blocks(size):
            return [range(i * size // n, (i + 1) * size // n) if size >= n else [i * size // n] for i in range(n)]

        grid = np.array([[np.mean([[float(image[r, c]) for c in cs] for r in rs]) for cs in blocks(64)] for rs in blocks(rows)])
        low = np.array([[sum(grid[i, j] * np.cos(np.pi * (2 * i + 1) * u / (2 * n)) * np.cos(np.pi * (2 * j + 1) * v / (2 * n)) for i in range(n) for j in range(n)) for v in range(media.LOW)] for u in range(media.LOW)]).round(6).ravel()
        want = [u > 0 and low[u] > np.median(low[1:]) for u in range(64)]
        found = np.unpackbits(np.frombuffer(bytes.fromhex(media.cosine_hash(image)), np.uint8)).astype(bool)
        assert (found == want).mean() > 0.98  # rounding may turn a bit that lies at the median


def test_very_long_texts(spark, vocabulary, known):
    """A text of a megabyte, beside its copy and a short one, through every operator on single documents."""
    rng = random.Random(3)
    long = " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(170_000)) + " token = 0123456789abcdef0123"
    docs = spark.createDataFrame([(1, long), (2, long), (3, "short")], "doc_id long, text string")
    assert len(long) > 900_000
    scans = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs).collect()}
    assert scans[1] == scans[2] == ",".join(brute_spans(long)) and scans[3] == ""
    rows = {r["doc_id"]: r for r in media.media_features(media.with_media(docs)).collect()}
    assert rows[1]["payload_sha256"] == sha(media.padded(long.encode())) and rows[1]["feature"] == rows[2]["feature"]
    ids = known.encode_ordinary(long)
    coded = {r["doc_id"]: r for r in bpe.digests(bpe.decode(bpe.encode(docs, *vocabulary), vocabulary[0])).collect()}
    assert coded[2]["ids_sha256"] == sha(struct.pack(f"<{len(ids)}I", *ids)) and coded[2]["decoded_sha256"] == sha(long)
    marks = {r["doc_id"]: r["group_id"] for r in fingerprint.fingerprint_report(docs).collect()}
    assert marks == {1: 1, 2: 1, 3: 3}


def test_a_text_beyond_the_bound_does_not_shut_out_others(spark):
    front = spark.range(40, 2000, 2).filter(~quality.held_out(F.col("id"))).orderBy(F.xxhash64("id")).first()[0]
    rows = [(i, f"text {i} " * (i % 7 + 1)) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in [*range(40), front]], "doc_id long, quality int")
    plain = quality.train(spark.createDataFrame(rows, "doc_id long, text string"), labels, class_bytes=300)
    behind = quality.train(spark.createDataFrame([*rows, (front, "long " * 100)], "doc_id long, text string"), labels, class_bytes=300)
    assert plain.bad and plain.good and (behind.bad, behind.good) == (plain.bad, plain.good)


def test_a_training_step_reuses_its_memory():
    import tracemalloc

    p, rng = pseudo_likelihood, np.random.default_rng(4)
    batches = [(rng.integers(0, 300, (n, 4)), rng.integers(0, 300, n)) for n in (2048, 300, 2048)]

    def trained(fresh_memory: bool):
        model, sums = p.fresh(), {k: np.full(s, 1e-3, np.float32) for k, s in p.SHAPES.items()}
        for near, target in batches:
            if fresh_memory:
                p._ROOM.clear()
            tracemalloc.start()
            p.train_step(model, sums, near, target)
            peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
        return p.flat(model), peak

    kept, peak = trained(False)
    assert peak < 800_000
    # Nothing of one step is left in the next.
    assert np.array_equal(kept, trained(True)[0])


def test_contexts_and_gradients_equal_plain_ones():
    p, rng = pseudo_likelihood, np.random.default_rng(5)
    ids, first = rng.integers(0, 300, 400), np.array([0, 0, 1, 3, 3, 6, 390, 397, 400, 400])
    doc, where = p.texts_of(first), rng.permutation(400)
    near = p.contexts(ids, first, where, doc)
    plain = [[ids[j] if 0 <= j < 400 and doc[j] == doc[i] else p.EDGE for j in (i - 2, i - 1, i + 1, i + 2)] for i in where]
    assert near.tolist() == plain
    x = np.array([-1e5, -50, -1e-3, 0, 1e-3, 3, 1e5], np.float32)
    assert np.allclose(p._tanh(x.copy()), np.tanh(x), rtol=0, atol=2e-7)
    # A step's first move is RATE times the gradient's sign nearly; its gradient is that of the mean loss, by differences.
    model = {k: v.astype(np.float32) * 3 for k, v in p.fresh(2).items()}
    moved, sums = {k: v.copy() for k, v in model.items()}, {k: np.zeros(s, np.float32) for k, s in p.SHAPES.items()}
    p.train_step(moved, sums, near, ids[where])
    top = ids[where][0] // p.MEMBERS
    for k, at in (("member_0", (top, 3)), ("group_0", (top,)), ("into_0", (5,)), ("member", (top, 4, 2)), ("embed", (p.EDGE, 1))):
        loss = []
        for by in (-0.02, 0.02):
            other = {name: v.copy() for name, v in model.items()}
            other[k][at] += by
            loss.append(-p.log_probs(other, near, ids[where]).mean())
        assert np.sqrt(sums[k][at]) == pytest.approx(abs(loss[1] - loss[0]) / 0.04, rel=0.05, abs=2e-5)
