"""Personal data: base spans against plain expressions, EM and the classifier against known truth."""

import random
import re
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rangemap.llm import personal


def plain_luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (1 + i % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and plain_luhn(digits(s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
]


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, good in RULES for m in re.finditer(p, text) if good(m[0])]


PARTS = ["a", "Bob", ".", "..", "@", "-", "+", "%", "_", "é", "١", " ", "  ", "(", ")", "\n", "4", "12", "255", "256", "0", "4111111111111111", "4111 1111 1111 1111", "378282246310005", "+1 (555) 010-9999", "x@y.com", "1.2.3.4", "at", " at ", "[at]", "dot", "::1", "DE89370400440532013000", "123-45-6789", "0049"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join))
def test_base_spans_equal_plain_expressions(text):
    found = personal.candidates(text)
    assert [f"{c.kind}:{c.start}:{c.end}" for c in found if c.base] == brute(text)
    assert all(0 <= c.start < c.end <= len(text) for c in found)


@pytest.mark.parametrize("text", ["0" * 9000 + "1.2.3.4", "a" * 300_000, "1" * 200_000, "1." * 100_000, "1 " * 100_000, "+1" + "(" * 200_000, "a@" * 50_000, "a@b" * 50_000, "f:" * 50_000, " at x" * 50_000, "1-" * 100_000])
def test_long_runs_end_soon(text):
    import time

    began = time.time()
    personal.candidates(text)
    assert time.time() - began < 20


def test_whole_table(spark, hard, hard_rows):
    got = personal.personal_data(hard).collect()
    assert len(got) == len(hard_rows)
    want = sorted((r[0] or -1, sha256(",".join(brute(r[1] or "")).encode()).hexdigest()) for r in hard_rows)
    assert sorted((r.doc_id or -1, r.base_sha256) for r in got) == want


def test_no_rows(spark, nothing):
    assert personal.personal_data(nothing).collect() == []


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(1)
    n, share = 40_000, 0.3
    truth = rng.random(n) < share
    right = [0.9, 0.8, 0.7, 0.85, 0.6]
    speaks = [1.0, 0.8, 0.6, 0.9, 0.5]
    votes = np.stack([np.where(rng.random(n) < s, np.where(rng.random(n) < r, 1, -1) * np.where(truth, 1, -1), 0) for r, s in zip(right, speaks, strict=True)], axis=1)
    votes[:, 2] *= votes[:, 2] > 0  # one that only says yes
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    likely, reliability, found = personal.weigh_labelers(patterns, counts, trust=0)
    assert abs(found - share) < 0.02
    for i in (0, 1, 3, 4):
        assert abs(reliability[i, 2, 1] - right[i] * speaks[i]) < 0.03
    majority = np.mean((votes.sum(1) > 0) == truth)
    assert np.mean((likely[inverse.ravel()] > 0.5) == truth) > majority


TRUE = ["phone {p}", "call me on {p} today", "tel {p}, please", "mobile: {p}", "write to {e} now", "contact {e}", "my card {c} was taken", "visa {c}", "iban {i} of my bank", "ssn {s}"]
FALSE = ["order {p} was sent", "invoice {p}", "version {p} is out", "part {c} of the model", "serial {c}", "ref {s} of the ticket", "page {s}", "case {p}"]


def sentences(rng, n):
    """(text, what should be found) with looser forms only, so that the base expressions find nothing."""
    made = []
    for _ in range(n):
        true = rng.random() < 0.5
        while True:
            c = "37" + "".join(rng.choice("0123456789") for _ in range(13))
            if plain_luhn(c):
                break
        three = lambda: str(rng.randint(2, 9)) + str(rng.randint(10, 99))
        account = "".join(rng.choice("0123456789") for _ in range(18))
        iban = f"DE{98 - int(account + '131400') % 97:02d}{account}"
        parts = {"p": f"{three()}-{three()}-{rng.randint(1000, 9999)}", "e": f"{rng.choice(['ann', 'jo.b', 'k9'])} [at] host{rng.randint(1, 99)} [dot] org", "c": c, "i": iban, "s": f"{rng.randint(100, 600)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"}
        form = rng.choice(TRUE if true else FALSE)
        text = f"{rng.choice(['So', 'Then', 'And'])} {form.format(**parts)} {rng.choice(['it said', 'they say', 'thanks'])}"
        made.append((text, parts[re.search(r"\{(.)\}", form)[1]] if true else None))
    return made


def test_held_out_sentences(spark):
    rng = random.Random(8)
    rows = sentences(rng, 1500)
    base = [f"mail ann{i}@host.org or +49 30 {rng.randint(1000000, 9999999)} from 8.8.{i % 200}.1" for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*(t for t, _ in rows[:1000]), *base])], "doc_id long, text string")
    model = personal.train(personal.find(docs).cache())
    right = false = 0
    for text, span in rows[1000:]:
        got = personal.accepted(personal.candidates(text), model, 0.8)
        right += (span is None and not got) or (span is not None and span in [text[c.start : c.end] for c in got])
        false += span is None and bool(got)
    assert right / 500 > 0.95
    assert false / 500 < 0.02


def test_decoys_are_not_added(spark):
    rng = random.Random(9)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = [f"the {number(16)} and {rng.randint(256, 999)}.1.1.{i} of {number(3)}-{number(3)}" for i in range(300)]
    texts += [f"this ann{i}@host.org here {8}.{i % 255}.3.4 there" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in personal.personal_data(docs).collect():
        assert r.spans == ",".join(brute(texts[r.doc_id]))


def test_redaction():
    text = "a x@y.org b 1.2.3.4"
    assert personal.redact(text, [c for c in personal.candidates(text) if c.base]) == "a [EMAIL] b [IP]"
