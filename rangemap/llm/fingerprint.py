"""Document fingerprints: a canonical exact digest.

Canonical form: Unicode NFKC, case folding, NFKC again, every run of white space one space, ends stripped. The
fingerprint is the 128-bit xxhash of its UTF-8 bytes. exact_groups compares the bytes inside each bucket of equal
digests, so that two documents share a group only if their canonical bytes are equal.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bitmap, id_text, in_bitmap, pieces, release, written

SLICE = 1 << 20
PAIR_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, part int, place string, text string"


def canonical(text: str) -> bytes:
    if text.isascii():
        return " ".join(text.lower().split()).encode()
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split()).encode()


def digest(canon: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(canon)


def _fingerprints(mark: Callable[[bytes], str]):
    def run(batches):
        for batch in (p for whole in batches for p in pieces(whole, SLICE)):
            marks = [mark(canonical(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], ["doc_id", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: Callable[[bytes], str] = digest) -> DataFrame:
    """(doc_id, fingerprint) per row; a null text counts as empty. A narrow map."""
    return id_text(docs, id_col, text_col).mapInArrow(_fingerprints(mark), "doc_id long, fingerprint string")


def _canonicals(mark: Callable[[bytes], str], bits: Broadcast):
    """The canonical bytes of the documents whose digest's hash is in the bitmap."""

    def run(batches):
        for batch in (p for whole in batches for p in pieces(whole, SLICE)):
            canon = [canonical(t) for t in batch.column(1).to_pylist()]
            marks = [mark(c) for c in canon]
            good = pa.array(in_bitmap(np.fromiter(map(_place, marks), np.uint64, len(marks)), bits.value))
            found = pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string()), pa.array(canon, pa.binary())], ["doc_id", "fingerprint", "canon"])
            yield found.filter(good)

    return run


def _place(mark: str) -> int:
    """64 bits of a digest: its MD5's first, as Spark's functions have it too."""
    return int.from_bytes(md5(mark.encode()).digest()[:8])


def _places(marks: DataFrame) -> DataFrame:
    """h: _place of each fingerprint."""
    digits = F.md5(F.col("fingerprint").cast("binary"))
    half = [F.conv(F.substring(digits, at, 8), 16, 10).cast("long") for at in (1, 9)]
    return marks.select(F.shiftleft(half[0], 32).bitwiseOR(half[1]).alias("h"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", marks: DataFrame | None = None, mark: Callable[[bytes], str] = digest) -> DataFrame:
    """(doc_id, fingerprint, group_id) per document: group_id is the smallest id with the same canonical bytes.

    marks: the documents' fingerprints by mark, if known. Buckets of one document need no comparison, and their texts are not
    moved: a bitmap of the other buckets' digests, of 64 MB at most, leaves them out where they are read. In the others each
    member's bytes are joined to those of the bucket's first document; a member that differs
    (a collision of 128 bits) forms a group with the members of its own SHA-256. The join's member side can be split,
    so a bucket with a third of all rows is no single task. Rows of one id with several texts count once each; rows with
    a null id get a null group.
    """
    source = id_text(docs, id_col, text_col)
    if marks is None:
        marks = written(fingerprints(docs, id_col, text_col, mark), "marks")
    marks = marks.select("doc_id", "fingerprint")
    buckets = marks.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    full = written(buckets.filter("n > 1"), "buckets")
    texts = source.mapInArrow(_canonicals(mark, bitmap(_places(full))), "doc_id long, fingerprint string, canon binary")
    # The first document of a bucket is found by its id, which no bucket's size makes hot.
    starts = full.select(F.col("first_id").alias("doc_id"), "fingerprint")
    first = texts.join(starts, ["doc_id", "fingerprint"]).groupBy("fingerprint").agg(F.min("canon").alias("first_canon"), F.min("doc_id").alias("first_id"))
    first = written(first, "first")
    release(docs.sparkSession)
    same = F.col("canon") == F.col("first_canon")
    # No aggregate follows the join on its key, so a bucket's members can be split among tasks.
    checked = texts.join(full.select("fingerprint"), "fingerprint", "left_semi").join(first, "fingerprint", "left").select("doc_id", "fingerprint", "first_id", F.when(same, F.lit("")).otherwise(F.sha2("canon", 256)).alias("apart"))
    checked = written(checked, "checked")
    odd = checked.filter("apart <> ''")
    ranked = odd.groupBy("fingerprint", "apart").agg(F.min("doc_id").alias("group_id"))
    grouped = odd.join(ranked, ["fingerprint", "apart"]).unionByName(checked.filter("apart = ''").withColumn("group_id", F.col("first_id")), allowMissingColumns=True)
    grouped = grouped.select("doc_id", F.concat("fingerprint", "apart").alias("fingerprint"), "group_id")
    alone = marks.join(full, "fingerprint", "left_anti").select("doc_id", "fingerprint", F.col("doc_id").alias("group_id"))
    return alone.unionByName(grouped)


def edited(text: str, following: str) -> str:
    """text with its last quarter of code points replaced by as many from the start of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _row(doc_id, text, following, part, place, keep):
    canon, after = canonical(text), canonical(following)
    changed = edited(text, following)
    canon_changed = canonical(changed)
    mark, mark_changed = digest(canon), digest(canon_changed)
    alike = float(mark == mark_changed and canon == canon_changed)
    alike_next = float(digest(after) == mark and after == canon)
    return doc_id, len(text), sha256(changed.encode()).hexdigest(), mark, mark_changed, alike, alike_next, part, place, keep


def _batch(rows):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
    names = [x.split()[0] for x in PAIR_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _neighbours(batches):
    """Within one sorted partition: a finished row for all but its last document, and its ends' texts."""
    part = TaskContext.get().partitionId()
    held = None
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if held is None:
                rows.append((doc_id, None, None, None, None, None, None, part, "head", text))
            else:
                rows.append(_row(*held, text, part, "row", None))
            held = (doc_id, text)
        if rows:
            yield _batch(rows)
    if held is not None:
        yield _batch([(held[0], None, None, None, None, None, None, part, "tail", held[1])])


def _ends(batches):
    for batch in batches:
        rows = [_row(i, t, f, p, "row", None) for i, t, f, p in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)]
        if rows:
            yield _batch(rows)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each document, of its edited text, and how alike they and the next document's are (1 or 0).

    The next document is the next by id (null first, then by text among equal ids), after the last the first. Rows are
    dealt by ranges of the id and read in order; only each range's first and last text cross to the neighbour range, so
    no task sees more than its range. Null texts count as empty.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = id_text(docs, id_col, text_col).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    found = written(ranged.mapInArrow(_neighbours, PAIR_SCHEMA), "neighbours")
    ends = found.filter("place <> 'row'").select("doc_id", "part", "place", "text")
    heads = ends.filter("place = 'head'")
    # One row per partition: small whatever the input, so ordering them in one task is safe.
    order = Window.orderBy("part")
    turn = heads.select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next_part"))
    tails = ends.filter("place = 'tail'").join(turn, "part")
    firsts = heads.select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    last = tails.join(firsts, "next_part").select("doc_id", "text", "next_text", "part").mapInArrow(_ends, PAIR_SCHEMA)
    return found.filter("place = 'row'").unionByName(last).drop("part", "place", "text")


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """compare_with_next with group_id of exact_groups, where the bytes inside equal buckets are compared."""
    rows = written(compare_with_next(docs, id_col, text_col), "report")
    release(docs.sparkSession)  # the texts' shuffle
    groups = exact_groups(docs, id_col, text_col, rows)
    # An id may have several texts, so a row is found again by a hash of its digest as well. A digest that is not the group's
    # own, after a collision, is carried; others are known.
    name, own = F.xxhash64(F.substring("fingerprint", 1, 32)).alias("_mark"), F.when(F.length("fingerprint") > 32, F.col("fingerprint"))
    groups = groups.select("doc_id", name, own.alias("apart"), "group_id").groupBy("doc_id", "_mark").agg(F.min("apart").alias("apart"), F.min("group_id").alias("group_id"))
    rows = rows.withColumn("_mark", F.xxhash64("fingerprint"))
    return rows.join(groups, ["doc_id", "_mark"], "left").select("doc_id", "n_chars", "edited_sha256", F.coalesce("apart", "fingerprint").alias("fingerprint"), "edited_fingerprint", "near_edited", "near_next", "group_id")
