"""Quality classifier by compression: which of two zstandard dictionaries makes a text smaller?

One dictionary is trained on labelled good texts, one on labelled bad ones. A text's chunks are compressed with either;
the difference of the two totals, normalised by the text's length, enters a logistic curve, fitted on labelled texts that
trained no dictionary and weighted by how often each label occurs, which makes it the chance of a good text. A text too
short to tell anything gets the share of good ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import id_text, pieces

SCORE_SCHEMA = "doc_id long, score double"
#: Bytes compressed at once: in a longer stretch the text's own past would outweigh the dictionary.
CHUNK = 1024
#: Bytes at which a text tells half of what a long one does.
SHORT = 200
LEVEL = 3
CUT = 0.7


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    whole: float
    offset: float

    def score(self, features: np.ndarray) -> np.ndarray:
        """Of rows of features()."""
        return 1 / (1 + np.exp(-np.clip(features @ np.array([self.slope, self.whole]) + self.offset, -30, 30)))

    def of(self, texts: list[str | None]) -> np.ndarray:
        return self.score(features(texts, self.good, self.bad))


@lru_cache(2)
def _compressors(good: bytes, bad: bytes):
    out = []
    for data in (good, bad):
        if data:
            known = zstandard.ZstdCompressionDict(data)
            known.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False))
        else:
            out.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))
    return out


def difference(data: bytes, good: bytes, bad: bytes) -> int:
    """Size with the bad dictionary minus size with the good one, over all chunks."""
    by_good, by_bad = _compressors(good, bad)
    total = 0
    for at in range(0, len(data), CHUNK):
        part = data[at : at + CHUNK]
        total += len(by_bad.compress(part)) - len(by_good.compress(part))
    return total


def features(texts: list[str | None], good: bytes, bad: bytes) -> np.ndarray:
    """For each text its difference and its length, both over length + SHORT."""
    rows = [((data := (t or "").encode()) and difference(data, good, bad), len(data)) for t in texts]
    found = np.array([(d or 0, n) for d, n in rows], float).reshape(-1, 2)
    return found / (found[:, 1:] + SHORT)


def _dictionary(texts: list[str], size: int) -> bytes:
    parts = [d[i : i + CHUNK] for d in (t.encode() for t in texts) for i in range(0, len(d), CHUNK)]
    if len(parts) < 8:
        return b"".join(parts)[:size]  # too few to train: their own bytes
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, parts)) // 4)), parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[:size]


def fit(texts: list[str], labels: list[int], dict_bytes: int = 1 << 16, share: float = 0.5) -> Model:
    """From few labelled texts: even places train the dictionaries, odd ones the curve. share: of good ones among all
    labelled rows. Without both labels the score is the same for every text, their smoothed share."""
    share = min(max(share, 1 / (len(texts) + 2)), 1 - 1 / (len(texts) + 2))
    offset = float(np.log(share / (1 - share)))
    sides = {y: [t for t, v in zip(texts, labels, strict=True) if v == y] for y in (0, 1)}
    if min(map(len, sides.values())) < 2:
        return Model(b"", b"", 0.0, 0.0, offset)
    good, bad = (_dictionary(sides[y][::2], dict_bytes) for y in (1, 0))
    x = np.concatenate([features(sides[y][1::2], good, bad) for y in (0, 1)])
    y = np.repeat([0.0, 1.0], [len(sides[0][1::2]), len(sides[1][1::2])])
    scale = np.abs(x).max(axis=0)
    scale[scale == 0] = 1.0
    slope, whole = _curve(x / scale, y, share, offset) / scale
    return Model(good, bad, float(slope), float(whole), offset)


def _curve(x: np.ndarray, y: np.ndarray, share: float, offset: float, ridge: float = 1e-4, rounds: int = 60) -> np.ndarray:
    """Logistic regression of y on x with a fixed offset by Newton's method; the label 1 weighs share in all."""
    w = np.where(y == 1, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1))
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b + offset, -30, 30)))
        slope = x.T @ (w * (p - y)) + ridge * b
        curve = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        b -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return b


def held_out(id_col: F.Column) -> F.Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1000, dict_bytes: int = 1 << 16, class_bytes: int = 32 << 20) -> Model:
    """Fit on at most per_class labelled documents of each class, whole texts, of class_bytes in all (documented bounds of
    the sample): those with the smallest hash of the id among labelled rows that are not held out, as long as they fit; a text of more than class_bytes is passed over.
    Null labels, ids and texts are left out; of several texts of one id the first in order counts; a document with both
    labels is in both classes."""
    spark = docs.sparkSession
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("doc_id"), "quality").distinct()
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    chosen = [known.filter(F.col("quality") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    rows = chosen[0].unionByName(chosen[1]).collect()  # at most 2 * per_class pairs
    few = spark.createDataFrame(rows, "doc_id long, quality int")
    texts = id_text(docs).filter("text <> ''").join(F.broadcast(few), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    # Of per_class rows: a text that alone is beyond the bound is passed over, so that it doesn't shut out all after it.
    size = F.octet_length("text")
    so_far = F.sum(F.when(size <= class_bytes, size)).over(Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id"))
    found = sorted(texts.withColumn("so_far", so_far).filter((size <= class_bytes) & (F.col("so_far") <= class_bytes)).collect(), key=lambda r: (r["doc_id"], r["quality"]))
    return fit([r["text"] for r in found], [r["quality"] for r in found], dict_bytes, share)


def _scores(model: Model):
    def run(batches):
        for whole in batches:
            for batch in pieces(whole, 1 << 20):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.of(batch.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row from its whole text, whose length is an input of the score too; empty and null texts get the share of good ones.
    A narrow map; the model is two dictionaries of fixed size."""
    return id_text(docs, id_col, text_col).mapInArrow(_scores(model), SCORE_SCHEMA)


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """Score and decision per document, with held_out telling which rows no label was learnt from. Null and empty texts get
    the share of good ones; repeated rows get equal results; a null id stays null and isn't held out; other columns are
    left out."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def _keep(model: Model, cut: float, at: int):
    def run(batches):
        for whole in batches:
            for batch in pieces(whole, 1 << 20):
                yield batch.filter(pa.array(model.of(batch.column(at).to_pylist()) >= cut))

    return run


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT, text_col: str = "text") -> DataFrame:
    """docs' rows, all columns, whose score reaches cut. Null and empty texts are judged by the share of good labels;
    repeated rows stay or go together."""
    return docs.mapInArrow(_keep(train(docs, labels), cut, docs.columns.index(text_col)), docs.schema)
