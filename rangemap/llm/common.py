"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, release, shared_dir, written

__all__ = ["discard", "release", "shared_dir", "written"]

#: White space that separates words: space, and tab to carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on; further columns, whatever their names, stay out. A null text is empty."""
    return df.select(df[id_col].cast("long").alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text"))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000, size: str = "4m"):
    """Inside, Arrow batches have a few MB at most, so that no task's memory follows the length of rows; afterwards the
    session's settings are as before."""
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def pieces(batch: pa.RecordBatch, most: int = 2 << 20):
    """Slices of a batch of about most bytes of text, in order."""
    step = max(1, int(len(batch) * most / max(batch.nbytes, most)))
    for at in range(0, len(batch), step):
        yield batch.slice(at, step)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64's), for uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bits of the largest bitmap of hashes, as a power of two.
MOST_BITS = 29


def bitmap(hashes: DataFrame) -> Broadcast:
    """The bitmap of the 64-bit hashes h: sixteen bits each, in all between 2^16 and 2^MOST_BITS of them, so between 8 KB and
    64 MB whatever the input. Spark makes it; the driver only puts its words in order. With more hashes than fit, more of
    what isn't there passes; what is there always does."""
    spark = hashes.sparkSession
    size = min(max((16 * hashes.count()).bit_length(), 16), MOST_BITS)
    h, mask = F.col("h"), F.lit((1 << size) - 1)
    at = hashes.select(F.explode(F.array(h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask))).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("word"))
    found = words.toArrow()
    bits = np.zeros(1 << max(size - 6, 0), np.uint64)
    bits[found.column("slot").to_numpy()] = found.column("word").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(bits)


def in_bitmap(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which hashes have both their places in the bitmap."""
    mask = np.uint64(64 * len(bits) - 1)
    good = np.ones(len(hashes), bool)
    for at in (hashes & mask, (hashes >> np.uint64(32)) & mask):
        good &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return good


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a column of texts, without a Python object for each.

    data: all texts' UTF-8 bytes; start, stop: each word's byte range in data; count: words per text; first: index of
    each text's first word, with a last entry for the end; hash: 64 bits for each word.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_string()).fill_null("")
        ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        size = int(ends[-1] - ends[0]) if len(ends) else 0
        self.data = data = np.frombuffer(raw, dtype=np.uint8)[ends[0] : ends[-1]] if size else np.zeros(0, np.uint8)
        ends = ends - ends[0] if len(ends) else np.zeros(1, np.int64)
        gap = (data == 32) | ((data >= 9) & (data <= 13))
        inside = ~gap
        begins = inside.copy()
        begins[1:] &= gap[:-1]
        finish = inside.copy()
        finish[:-1] &= gap[1:]
        cuts = ends[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < size)]
        begins[cuts] |= inside[cuts]
        finish[cuts - 1] |= inside[cuts - 1]
        self.start = np.flatnonzero(begins)
        self.stop = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.start, ends)
        self.first[-1] = len(self.start)
        self.count = np.diff(self.first)
        self.text_start = ends
        if lower and size:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        self.hash = self._hashes(data)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """Eight bytes at a time: each word's little-endian chunks, mixed in order."""
        n = len(self.start)
        if not n:
            return np.zeros(0, np.uint64)
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        at8 = np.lib.stride_tricks.as_strided(padded, (len(padded) - 8, 8), (1, 1))
        length = self.stop - self.start
        out = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        left, at, todo = length, self.start, None
        while True:
            take = np.minimum(left, 8)
            chunk = np.ascontiguousarray(at8[at]).view("<u8").ravel()
            chunk = chunk & (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - take) * 8).astype(np.uint64))
            if todo is None:
                out = mix64(out ^ chunk)
                todo = np.arange(n)
            else:
                out[todo] = mix64((out[todo] * np.uint64(0xD6E8FEB86659FD93)) ^ chunk)
            more = left > 8
            if not more.any():
                return out
            todo, left, at = todo[more], left[more] - 8, at[more] + 8

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words, each followed by one space, and each word's byte range there."""
        size = self.stop - self.start
        starts = np.cumsum(size + 1) - (size + 1)
        if not len(size):
            return b"", starts, starts
        at = np.repeat(self.start - starts, size + 1) + np.arange(int(starts[-1] + size[-1] + 1))
        out = self.data[np.minimum(at, len(self.data) - 1)]
        out[starts + size] = 32
        return out.tobytes(), starts, starts + size

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hashes of every k consecutive words of one text, and the index of each one's first word."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + self.hash[j : j + n]
            h ^= h >> np.uint64(32)
        whole = np.ones(n, bool)
        for j in range(1, k):  # a run may not pass the end of its text
            cut = self.first[1:-1] - j
            whole[cut[(cut >= 0) & (cut < n)]] = False
        at = np.flatnonzero(whole)
        return mix64(h[at]), at
