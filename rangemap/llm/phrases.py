"""Phrase collocations by set-oriented mining (SETM): relations of occurrences, merge-joined with themselves.

R1 has a row for each occurrence of a word: piece, position, word. R(k+1) is R(k) merge-joined with R(k) where the
piece is the same and the position the next; its groups are counted, and only occurrences of frequent groups stay before
the next length. A phrase is frequent only if both phrases it is made of are, so nothing frequent is lost.

A relation is stored in blocks, sorted, each of whole texts of one language. Piece and position are one number, `place`,
that grows by one from word to word and by more where a piece ends, so adjacency is a difference of one. A block's groups
are numbered, exactly, by its own dictionary.

Words are counted once, by their text. Longer groups are counted twice. First by 64-bit hashes, of all groups: a hash occurs at least as often as each of its phrases, so
the semi-join with the frequent hashes, by a bitmap of at most 64 MB at any size of input, drops no frequent phrase. Then
what is left is counted by its text, which is exact; whatever passed by chance falls out there.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import running
from ..session import FEW_ROWS
from .common import bitmap, discard, in_bitmap, mix64, small_batches, written

BLOCK_SCHEMA = "lang string, words long, place array<int>, code array<int>, phrases array<string>, hash array<long>"
COUNT_SCHEMA = "lang string, phrase string, n long"
#: Distinct hashes that a task holds before it sends their counts on (of phrases, half as many again), and rows of a batch of
#: them. Hardly any hash of a pair is in a task more often than in its block, so a task gains little by holding many.
HELD, SENT = 500_000, 100_000
_WORD, _GAP, _BREAK = 0, 1, 2
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[9, 32]] = _GAP
_KIND[[ord(c) for c in ".,;:!?\n\v\f\r"]] = _BREAK


class Block:
    """Sorted occurrences: phrases[code[i]] begins at place[i]; hash has 64 bits of each phrase and the language."""

    def __init__(self, place: np.ndarray, code: np.ndarray, phrases: pa.Array, hashes: np.ndarray):
        self.place, self.code, self.phrases, self.hash = place, code, phrases, hashes

    @classmethod
    def of_texts(cls, lang: str, texts: list[str]) -> Block:
        """The words of texts. A text's end is a piece's end."""
        raw = "\n".join(texts).encode().lower()  # of bytes: A-Z only
        data = np.frombuffer(raw, np.uint8)
        kind = _KIND[data]
        inside = kind == _WORD
        edge = np.diff(inside.view(np.int8), prepend=0, append=0)
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        place = np.arange(len(start)) + np.searchsorted(np.flatnonzero(kind == _BREAK), start)
        offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        coded = words.dictionary_encode()
        seed, digest = xxhash.xxh64_intdigest(lang), xxhash.xxh64_intdigest
        phrases = coded.dictionary.cast(pa.string())
        hashes = np.fromiter((digest(p, seed) for p in phrases.to_pylist()), np.uint64, len(phrases))
        return cls(place.astype(np.int32), coded.indices.to_numpy(), phrases, hashes)

    def _pairs(self) -> tuple[np.ndarray, ...]:
        """The merge join of the sorted relation with itself at adjacent places: where, each row's pair, the distinct pairs'
        first and second phrase, and their hashes."""
        at = np.flatnonzero(np.diff(self.place) == 1)
        m = max(len(self.phrases), 1)
        pairs, code = np.unique(self.code[at].astype(np.int64) * m + self.code[at + 1], return_inverse=True)
        first, second = pairs // m, pairs % m
        return at, code, first, second, mix64(self.hash[first] * np.uint64(0x9E3779B97F4A7C15) + self.hash[second])

    def longer_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the phrases one word longer, and how often each occurs."""
        _, code, _, _, hashes = self._pairs()
        return hashes, np.bincount(code, minlength=len(hashes))

    def longer(self, bits: np.ndarray) -> Block:
        """The occurrences one word longer whose hash is in the bitmap."""
        at, code, first, second, hashes = self._pairs()
        good = in_bitmap(hashes, bits)
        kept, first, second = good[code], first[good], second[good]
        last = pa.array([p.rpartition(" ")[2] for p in self.phrases.take(pa.array(second)).to_pylist()], pa.string())
        phrases = pc.binary_join_element_wise(self.phrases.take(pa.array(first)), last, " ")
        return Block(self.place[at[kept]], (np.cumsum(good) - 1)[code[kept]].astype(np.int32), phrases, hashes[good])

    def counts(self) -> np.ndarray:
        return np.bincount(self.code, minlength=len(self.phrases))

    def only(self, bits: np.ndarray) -> Block:
        """The occurrences whose hash is in the bitmap, with a dictionary of these."""
        good = in_bitmap(self.hash, bits)
        kept = good[self.code]
        return Block(self.place[kept], (np.cumsum(good) - 1)[self.code[kept]].astype(np.int32), self.phrases.filter(pa.array(good)), self.hash[good])

    def row(self, lang: str, words: int) -> pa.RecordBatch:
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v)) for v in (self.place, self.code, self.phrases, self.hash.view(np.int64))]
        return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([words], pa.int64()), *lists], ["lang", "words", "place", "code", "phrases", "hash"])


def _texts(batches):
    """(lang, block) of each batch's texts of each language."""
    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            yield lang, Block.of_texts(lang, texts)


def _blocks(batches):
    for batch in batches:
        for i in range(len(batch)):
            place, code, phrases, hashes = (batch.column(c)[i].values for c in ("place", "code", "phrases", "hash"))
            yield batch.column("lang")[i].as_py(), Block(place.to_numpy(), code.to_numpy(), phrases, hashes.to_numpy().view(np.uint64))


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.concatenate([h for h, _ in held])
    order = np.argsort(hashes)
    hashes = hashes[order]
    first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
    n = np.concatenate([n for _, n in held])[order]
    return hashes[first], np.add.reduceat(n, first) if len(first) else n


def _hash_counts(batches):
    """(h, n): counts of the hashes of the phrases one word longer in a task's blocks, added up there as far as HELD allows."""

    def rows(held):
        hashes, n = _summed(held)
        for at in range(0, len(hashes), SENT):
            yield pa.RecordBatch.from_arrays([pa.array(hashes[at : at + SENT].view(np.int64)), pa.array(n[at : at + SENT])], ["h", "n"])

    held, size = [], 0
    for _, block in _blocks(batches):
        held.append(block.longer_hashes())
        size += len(held[-1][0])
        if size > 2 * HELD:
            held = [_summed(held)]
            size = len(held[0][0])
            if size > HELD:
                yield from rows(held)
                held, size = [], 0
    if held:
        yield from rows(held)


def _word_hashes(batches):
    """(h): the hashes of words, as blocks of texts have them."""
    for batch in batches:
        pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        found = np.fromiter((xxhash.xxh64_intdigest(p, xxhash.xxh64_intdigest(lang)) for lang, p in pairs), np.uint64, len(batch))
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["h"])


def _semi_joined(bits: Broadcast, source, longer: bool):
    """The source's blocks, or their join with themselves, without the occurrences whose hash is not frequent. A block of
    texts stays, with its number of words, even if nothing of it is left."""

    def run(batches):
        for lang, block in source(batches):
            words = 0 if longer else len(block.code)
            block = block.longer(bits.value) if longer else block.only(bits.value)
            if words or len(block.place):
                yield block.row(lang, words)

    return run


def _text_counts(blocks):
    """(lang, phrase, n): counts of the phrases of a task's blocks, added up there as far as HELD allows."""
    held, size, known = {}, 0, 0

    def summed(tables):
        return pa.concat_tables(tables).group_by("phrase", use_threads=False).aggregate([("n", "sum")]).rename_columns(["phrase", "n"])

    def rows():
        for lang, tables in held.items():
            for batch in summed(tables).to_batches(max_chunksize=SENT):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(batch), pa.string()), *batch.columns], ["lang", "phrase", "n"])

    for lang, block in blocks:
        held.setdefault(lang, []).append(pa.table({"phrase": block.phrases, "n": pa.array(block.counts(), pa.int64())}))
        size += len(block.phrases)
        if size > max(2 * known, HELD // 2):
            held = {lang: [summed(tables)] for lang, tables in held.items()}
            size = known = sum(len(t) for t, in held.values())
            if size > HELD + HELD // 2:
                yield from rows()
                held, size, known = {}, 0, 0
    if held:
        yield from rows()


def _word_counts(batches):
    yield from _text_counts(_texts(batches))


def _phrase_counts(batches):
    yield from _text_counts(_blocks(batches))


def frequent_phrases(docs: DataFrame, least: int = 100, most_words: int = 5, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f), (lang, n)): the phrases of 1 to most_words words that occur least times or more in a
    language, with their counts, and each language's number of words. Counts are of all texts, overlaps included."""
    source = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    relation, found, totals = None, [], None
    with small_batches(docs.sparkSession, 2000, "4m"):
        for k in range(1, most_words + 1):
            frequent = lambda rows, count: written(rows.mapInArrow(count, COUNT_SCHEMA).groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= least), "phrase-counts")
            rows, form = (source, _texts) if relation is None else (relation, _blocks)
            if relation is None:
                found.append(frequent(source, _word_counts))
                hashes = found[0].select("lang", "phrase").mapInArrow(_word_hashes, "h long")
            else:
                hashes = relation.mapInArrow(_hash_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("h")
            hashes = written(hashes, "frequent-hashes")
            joined = written(rows.mapInArrow(_semi_joined(bitmap(hashes), form, k > 1), BLOCK_SCHEMA), "relation", FEW_ROWS)
            if relation is not None:
                found.append(frequent(joined, _phrase_counts))
            if totals is None:
                totals = written(joined.groupBy("lang").agg(F.sum("words").alias("n")), "totals")
            discard(hashes, *([relation] if relation is not None else []))
            relation = joined
        discard(relation)
    every = reduce(DataFrame.unionByName, (f.withColumn("words", F.lit(i)) for i, f in enumerate(found, 1)))
    return every.select("lang", "phrase", "words", "f"), totals


def _part(k: Column | int, rest: bool) -> Column:
    words = F.split("phrase", " ")
    return F.array_join(F.slice(words, k + 1, F.size(words) - k) if rest else F.slice(words, 1, k), " ")


def maximal(frequent: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, a) without those inside a longer candidate that occurs as often. If a phrase is inside a much
    longer one that does, it is inside one a single word longer that does too, so only these are looked at."""
    candidates = frequent.filter("words > 1").select("lang", "phrase", F.col("f").alias("a"))
    longer = frequent.filter("words > 2").select("lang", "f", F.explode(F.array(_part(1, True), _part(F.size(F.split("phrase", " ")) - 1, False))).alias("phrase"))
    inner = longer.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    kept = candidates.join(inner, ["lang", "phrase"], "left").filter("f IS NULL OR f < a")
    return kept.drop("f")


def scored(candidates: DataFrame, frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with l, r, n and score of their worst cut: floor(1000 a n / (l r)) in decimals of 38 digits."""
    counts = frequent.select("lang", F.col("phrase").alias("part"), "f")
    k = F.col("k")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(F.split("phrase", " ")) - 1)))
    cuts = cuts.withColumns({"head": _part(k, False), "tail": _part(k, True)})
    cuts = cuts.join(counts.withColumnsRenamed({"part": "head", "f": "l"}), ["lang", "head"]).join(counts.withColumnsRenamed({"part": "tail", "f": "r"}), ["lang", "tail"])
    cuts = cuts.join(F.broadcast(totals), "lang") if totals.count() <= 10_000 else cuts.join(totals, "lang")
    score = F.expr("(cast(a AS decimal(18,0)) * 1000 * cast(n AS decimal(15,0))) div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))")
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    return worst.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of 2 to 5 words.

    a, l, r are the counts of the phrase, of its first and its other part at the worst cut, n of all words. A null text
    is empty, a null language `und`; repeated rows count each time; ties are ordered by a, then by the phrase's bytes. Other
    columns are left out. An empty table has no phrases. A task holds some 4 MB of texts, or one longer text.
    """
    frequent, totals = frequent_phrases(docs, least, text_col=text_col, lang_col=lang_col)
    found = scored(maximal(frequent), frequent, totals)
    # Ranks by ranges of the order, so that no task sees a whole language.
    order = F.struct(-F.col("score"), -F.col("a"), "phrase")
    ranked = running(found.withColumns({"order": order, "one": F.lit(1).cast("long")}), ["lang"], "order", {"before": "one"})
    ranked = ranked.filter(F.col("before") < top).withColumn("rank", F.col("before") + 1)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
