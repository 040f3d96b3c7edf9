"""Best-fit packing of documents into training sequences, with conflicts.

Documents are dealt to shards of about SHARD pieces by a hash of their id, so every hot source or group of copies is
spread evenly, and each shard packs on its own. A text longer than a bin is cut into full bins and a rest. In a shard
pieces go from the largest to the smallest; open bins stand in the order of their free space and carry two bitmaps, of
the sources and of the duplicate clusters inside. The first bin that is large enough is tried, then its successors,
until one has neither the piece's source nor its cluster: the tightest compatible bin. If there is none, a bin is opened.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP

CAPACITY, SHARD = 2048, 1000
SCHEMA = "doc_id long, piece int, n_words int, shard long, bin int, bin_offset int"


def pack(sizes: list[int], sources: list, clusters: list, capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of every piece, given in the order in which they are placed. A null source or cluster conflicts
    with none. Pieces of no words take no space but keep to the rules."""
    source_bit, cluster_bit = ({v: 1 << i for i, v in enumerate(dict.fromkeys(x for x in values if x is not None))} for values in (sources, clusters))
    open_bins: list[tuple[int, int]] = []  # (free, bin), ascending
    held: list[tuple[int, int]] = []
    bins, offsets = [], []
    for n, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = source_bit.get(source, 0), cluster_bit.get(cluster, 0)
        at = bisect_left(open_bins, (n, -1))
        while at < len(open_bins):
            has_source, has_cluster = held[open_bins[at][1]]
            if not (has_source & s or has_cluster & c):
                break
            at += 1
        if at < len(open_bins):
            free, b = open_bins.pop(at)
        else:
            free, b = capacity, len(held)
            held.append((0, 0))
        bins.append(b)
        offsets.append(capacity - free)
        held[b] = held[b][0] | s, held[b][1] | c
        insort(open_bins, (free - n, b))
    return bins, offsets


def _shard(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pandas(types_mapper=None)
        rows = rows.astype({"doc_id": "Int64"}) if rows["doc_id"].isna().any() else rows
        order = np.lexsort((rows["piece"], rows["doc_id"].fillna(-1).astype(np.int64), -rows["n_words"].to_numpy()))
        rows = rows.iloc[order]
        none = lambda col: [None if x is None or x != x else x for x in rows[col].tolist()]
        bins, offsets = pack(rows["n_words"].tolist(), none("source"), rows["cluster"].tolist(), capacity)
        ids = pa.array([None if x is None or x != x else int(x) for x in table.column("doc_id").to_pylist()], pa.int64()).take(pa.array(order))
        return pa.table({"doc_id": ids, "piece": pa.array(rows["piece"].to_numpy(), pa.int32()), "n_words": pa.array(rows["n_words"].to_numpy(), pa.int32()), "shard": pa.array(rows["shard"].to_numpy(), pa.int64()), "bin": pa.array(bins, pa.int32()), "bin_offset": pa.array(offsets, pa.int32())})

    return run


def best_fit(docs: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster: F.Column | None = None) -> DataFrame:
    """(doc_id, piece, n_words, shard, bin, bin_offset): where each piece of each document goes.

    Sizes are words of the whole text. No bin holds more than capacity words, two pieces of one source, or two pieces of
    one cluster (by default: equal texts, by a 64-bit hash; a chance collision only keeps two apart). Only ids, sizes and
    hashes are shuffled. Every row is placed: null and empty texts as a piece of no words, a null source conflicts with
    none, null ids are packed as rows of their own. Bins are numbered within a shard.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    words = F.size(F.filter(F.split(text, WORD_GAP), lambda w: w != ""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), words.alias("words"), docs[source_col].cast("string").alias("source"), (F.xxhash64(text) if cluster is None else cluster.cast("long")).alias("cluster"))
    shards = max(1, -(-docs.count() // shard))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("words") / capacity)).cast("int")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(shards)))
    rows = rows.select("doc_id", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"), "words", "source", "cluster", "shard")
    rows = rows.withColumn("n_words", F.least(F.lit(capacity), F.col("words") - F.col("piece") * capacity).cast("int")).drop("words")
    return rows.groupBy("shard").applyInArrow(_shard(capacity), SCHEMA)
