"""Secret scans: keyword prefilter, anchored expressions near its hits, embedded checksums.

An Aho-Corasick automaton reads each text once and gives the places where a secret can begin; the expressions are
matched only there. Long hex runs have no keyword: the text is mapped to two symbols and searched for sixteen in a row.
Kinds whose last characters are a checksum of the others are kept only if it holds.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, pieces

# The expressions of the base kinds, and the issuers' token formats.
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
CHECKED = rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "checked")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
SLICE = 1 << 20
_HEX = bytes(104 if c in b"0123456789abcdef" else 46 for c in range(256))
_PATTERNS = {"assign": re.compile(ASSIGN, re.I), "access": re.compile(ACCESS), "checked": re.compile(CHECKED)}

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


@lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in (("assign", KEYWORDS), ("access", ("akia",)), ("checked", CHECKED_PREFIXES)):
        for w in words:
            found.add_word(w, (kind, len(w)))
    found.make_automaton()
    return found


def checksum62(body: bytes) -> str:
    """CRC-32 of body in base 62, six digits."""
    left, digits = zlib.crc32(body), ""
    for _ in range(6):
        left, d = divmod(left, 62)
        digits = BASE62[d] + digits
    return digits


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind in KINDS' order."""
    data = text.encode()
    starts: dict[str, list[int]] = {}
    for end, (kind, n) in _automaton().iter(data.lower().decode("latin-1")):
        starts.setdefault(kind, []).append(end - n + 1)
    found = []
    for kind, places in starts.items():
        match, over = _PATTERNS[kind].match, 0
        for at in sorted(places):
            if at < over or not (m := match(data, at)):
                continue
            over = m.end()
            if kind == "assign":
                good = len(m[2]) >= MIN_ASSIGN
            elif kind == "access":
                good = len(m[0]) >= MIN_ACCESS
            else:
                good = checksum62(m[1]) == m[2].decode()
            if good:
                found.append((kind, at, over))
    marks = data.translate(_HEX)
    at = marks.find(b"h" * MIN_HEX)
    while at >= 0:
        over = marks.find(b".", at)
        over = len(data) if over < 0 else over
        found.append(("hex", at, over))
        at = marks.find(b"h" * MIN_HEX, over)
    if len(data) != len(text):
        # Code points before each byte: all but continuation bytes count.
        before = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        before = np.r_[0, before]
        found = [(k, int(before[a]), int(before[b])) for k, a, b in found]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """text with each stretch covered by spans replaced by mark; overlapping spans make one stretch."""
    out, over = [], 0
    for _, a, b in sorted(spans, key=lambda x: x[1:]):
        if a >= over:
            out += [text[over:a], mark]
        over = max(over, b)
    return "".join(out) + text[over:]


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(batches):
    from hashlib import sha256

    for batch in (p for whole in batches for p in pieces(whole, SLICE)):
        ids, rows = batch.column(0), []
        for text in batch.column(1).to_pylist():
            spans = find_spans(text)
            base = [s for s in spans if s[0] in BASE_KINDS]
            rows.append([*(sum(s[0] == k for s in base) for k in BASE_KINDS), sha256(_joined(base).encode()).hexdigest(), _joined(spans)])
        n1, n2, n3, digest, joined = zip(*rows, strict=True) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays([ids, pa.array(n1, pa.int64()), pa.array(n2, pa.int64()), pa.array(n3, pa.int64()), pa.array(digest, pa.string()), pa.array(joined, pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the counts and spans of the secrets in its whole text.

    A narrow map: no shuffle, nothing gathered. Null and empty texts have no spans; equal rows give equal rows; a null
    id stays null; other columns of docs are left out.
    """
    return id_text(docs, id_col, text_col).mapInArrow(_scan, SCHEMA)


def _redact(batches):
    for batch in (p for whole in batches for p in pieces(whole, SLICE)):
        texts = [redacted(t, find_spans(t)) for t in batch.column("_text").to_pylist()]
        yield batch.set_column(batch.schema.get_field_index("_text"), "_text", pa.array(texts, pa.string()))


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the secrets of text_col masked; a null text stays null, all other columns stay as they are."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    names = docs.columns
    inner = docs.toDF(*(f"c{i}" if c != text_col else "_text" for i, c in enumerate(names)))
    null = "n" + str(len(names))
    inner = inner.withColumn(null, F.col("_text").isNull()).withColumn("_text", F.coalesce("_text", F.lit("")))
    out = inner.mapInArrow(_redact, T.StructType([T.StructField(f.name, f.dataType) for f in inner.schema]))
    return out.withColumn("_text", F.when(~F.col(null), F.col("_text"))).drop(null).toDF(*names)
