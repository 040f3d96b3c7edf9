"""Substring dedup: remove passages that another document already has, found by suffix automata.

The reference is the corpus itself: a window of WINDOW words goes if it starts in a document with a smaller id, too. The
reference is cut into shards; documents stream through a shard's suffix automaton in the order of their ids, for matching
statistics; maximal matched spans of WINDOW words or more are removed, and what did not match is added to the automaton.
The reference grows with the corpus, so its automata are not broadcast, which would lead every document through every
shard; a span goes to the one shard that can match it:

1. Each window has an anchor, its smallest hash of ANCHOR consecutive words. Consecutive windows with one anchor make a
   stretch. Equal windows have equal anchors, so a window can recur only if its anchor does. Documents' anchors are sorted
   by Spark; those in one document only are dropped.
2. The first document that has an anchor, and the place there in blocks of BLOCK words, name the anchor's shard. What
   copies one document travels in long spans that way, since its stretches have neighbouring shards in the same order.
   A span that a task has already sent for a smaller id is settled there and needs no shard, and one that repeats in a
   text is sent once, so that a group of copies is pre-aggregated before the shuffle. An anchor of more than HOT documents deals its windows singly, each by its own
   hash, so that no shard holds more than about BLOCK * HOT documents' stretches.
3. Shards are sorted by Spark and streamed. A task holds one shard's automaton at a time.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, discard, id_text, mix64, pieces, release, small_batches, written

WINDOW, ANCHOR = 13, 5
BLOCK = 64
HOT = 500
#: Spans a task remembers to settle copies before the shuffle, and bytes of text worked on at once.
KNOWN, SLICE = 50_000, 1 << 20
SETTLED, REPEATED = 1, 2

RANGES = "doc_id long, sign long, begin int, finish int"


class SuffixAutomaton:
    """Of several sequences of words."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.size = [-1], [0]

    def _state(self, size: int, step: dict, link: int) -> int:
        self.next.append(step)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _clone(self, p: int, word, q: int) -> int:
        clone = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, words: list) -> None:
        nxt, link, size = self.next, self.link, self.size
        last = 0
        for word in words:
            q = nxt[last].get(word)
            if q is not None:
                last = q if size[q] == size[last] + 1 else self._clone(last, word, q)
            else:
                new, p = self._state(size[last] + 1, {}, 0), last
                while p >= 0 and word not in nxt[p]:
                    nxt[p][word] = new
                    p = link[p]
                if p >= 0:
                    q = nxt[p][word]
                    link[new] = q if size[q] == size[p] + 1 else self._clone(p, word, q)
                last = new

    def matched(self, words: list, least: int) -> tuple[list[list[int]], bool]:
        """The maximal ranges [a, b) of words whose every word lies in a match of least words or more; and whether the
        automaton knows words as a whole."""
        nxt, link, size = self.next, self.link, self.size
        spans: list[list[int]] = []
        state = length = 0
        for i, word in enumerate(words, 1):
            while state and word not in nxt[state]:
                state = link[state]
                length = size[state]
            q = nxt[state].get(word)
            if q is not None:
                state, length = q, length + 1
                if length >= least:
                    if spans and i - length <= spans[-1][1]:
                        spans[-1][1] = i
                    else:
                        spans.append([i - length, i])
        return spans, length == len(words)


def stretches(words: Words, window: int, anchor: int):
    """Of every text: anchor hash, first word (in the column), and number of windows of each stretch."""
    runs, at = words.runs(anchor)
    wide = window - anchor + 1
    n = len(runs) - wide + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.astype(np.uint64), none, none
    best, place = runs[:n].copy(), np.arange(n)
    for j in range(1, wide):
        better = runs[j : j + n] < best
        best[better] = runs[j : j + n][better]
        place[better] = np.flatnonzero(better) + j
    good = np.flatnonzero(at[wide - 1 :][:n] - at[:n] == wide - 1)
    if not len(good):
        return none.astype(np.uint64), none, none
    place, best = place[good], best[good]
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (np.diff(good) != 1)])
    return best[first], at[good[first]], np.diff(np.r_[first, len(good)])


def _anchors(window: int, anchor: int, hot: int):
    """(anchor, doc_id, word) of every anchor of every text, with the first word of its first stretch. A task sends no more
    than hot + 1 rows of one anchor, enough to show that it is hot; its further ones go anywhere, marked by a negative word,
    so that no anchor gathers the rows of a third of all texts."""

    def run(batches):
        sent: dict[int, int] = {}
        for whole in batches:
            for batch in pieces(whole, SLICE):
                words = Words(batch.column(1))
                marks, at, _ = stretches(words, window, anchor)
                doc = np.searchsorted(words.first, at, side="right") - 1
                first = _groups(doc, marks)[0]
                marks, at, doc = marks[first], at[first], doc[first]
                word = at - words.first[doc]
                order = np.argsort(marks, kind="stable")
                begins = np.flatnonzero(np.r_[True, np.diff(marks[order]) != 0]) if len(order) else order
                size = np.diff(np.r_[begins, len(order)])
                some = np.flatnonzero(size > 1)
                free = np.full(len(begins), hot + 1)
                for i, mark, n in zip(some.tolist(), marks[order[begins[some]]].tolist(), size[some].tolist(), strict=True):
                    free[i] -= sent.get(mark, 0)
                    sent[mark] = sent.get(mark, 0) + min(n, int(free[i]))
                if len(sent) > KNOWN:
                    sent.clear()
                over = order[np.arange(len(order)) - np.repeat(begins, size) >= np.repeat(free, size)]
                marks[over] = mix64((doc[over].astype(np.uint64) << np.uint64(32)) + word[over].astype(np.uint64))
                word[over] = -1 - word[over]
                yield pa.RecordBatch.from_arrays([pa.array(marks.view(np.int64)), batch.column(0).take(pa.array(doc)), pa.array(word.astype(np.int32))], ["anchor", "doc_id", "word"])

    return run


def _groups(doc: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of one text with one anchor: the first of each group, in order; the group of every stretch; and the
    stretches by group with where each group begins (n + 1)."""
    order = np.lexsort((marks, doc))
    fresh = np.r_[True, (np.diff(doc[order]) != 0) | (np.diff(marks[order]) != 0)] if len(order) else np.zeros(0, bool)
    begins = np.flatnonzero(fresh)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return np.sort(order[begins]), group, order, np.r_[begins, len(order)]


def _shared(block: int, hot: int):
    """Of anchors sorted by (anchor, doc_id, word): the stretches of those in several documents, with their shards. Of an
    anchor that goes on over batches, no more than hot rows are held back until it is known to be shared, or hot."""

    def run(batches):
        anchor = doc = word = None  # rows held back, of one anchor
        settled = None  # (anchor, lo, part) of an anchor whose further rows need no decision
        for batch in batches:
            a, d, w = (batch.column(k).to_numpy() for k in range(3))
            sure = w < 0
            out = [(d[sure], -1 - w[sure], d[sure], np.full(sure.sum(), -1))]
            a, d, w = a[~sure], d[~sure], w[~sure]
            if not len(a):
                yield _hits(out)
                continue
            if settled is not None:
                n = int(np.searchsorted(a != settled[0], True)) if a[-1] != settled[0] else len(a)
                out.append((d[:n], w[:n], np.full(n, settled[1]), np.full(n, settled[2])))
                a, d, w = a[n:], d[n:], w[n:]
            if len(a):
                settled = None
                if anchor is not None:
                    a, d, w = np.r_[anchor, a], np.r_[doc, d], np.r_[word, w]
                first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
                size = np.diff(np.r_[first, len(a)])
                lo, part = d[first], w[first] // block
                part = np.where(size > hot, -1, part)
                shared = d[first + size - 1] > lo
                if size[-1] <= hot:  # its end is not known
                    shared[-1] = False
                    anchor, doc, word = a[first[-1] :], d[first[-1] :], w[first[-1] :]
                else:
                    anchor = doc = word = None
                    settled = (a[-1], lo[-1], -1)
                    shared[-1] = True
                rows = np.repeat(shared, size)
                out.append((d[rows], w[rows], np.repeat(lo, size)[rows], np.repeat(part, size)[rows]))
            yield _hits(out)
        if anchor is not None and doc[-1] > doc[0]:
            yield _hits([(doc, word, np.full(len(doc), doc[0]), np.full(len(doc), word[0] // block))])

    return run


def _hits(parts) -> pa.RecordBatch:
    cols = [np.concatenate(c) for c in zip(*parts, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(cols, (np.int64, np.int32, np.int64, np.int32), strict=True)], ["doc_id", "word", "lo", "part"])


def _spans(window: int, anchor: int):
    """The texts of documents' spans, one for each run of stretches of one shard, and windows of hot anchors singly."""

    def run(batches):
        known: dict[bytes, int] = {}
        for whole in batches:
            for batch in pieces(whole, SLICE):
                words = Words(batch.column(2))
                marks, at, n = stretches(words, window, anchor)
                hits = batch.column(3)
                count = np.diff(hits.offsets.to_numpy())
                word, lo, part = (hits.flatten().field(k).to_numpy() for k in range(3))
                doc = np.repeat(np.arange(len(batch)), count)
                # Rows of one id share their hits: those of another text are found out by the anchors' places or match nothing.
                s = np.searchsorted(at, words.first[doc] + word)
                good = (word < words.count[doc]) & (s < len(at))
                good[good] = at[s[good]] == (words.first[doc] + word)[good]
                s, lo, part = s[good], lo[good], part[good]
                # A hit tells of the first stretch that has the anchor: the text's others have it too.
                _, group, members, begins = _groups(np.searchsorted(words.first, at, side="right") - 1, marks)
                g = group[s]
                more = begins[g + 1] - begins[g]
                place = np.repeat(begins[g] - np.r_[0, np.cumsum(more)[:-1]], more) + np.arange(more.sum()) if len(g) else g
                s, lo, part = members[place], np.repeat(lo, more), np.repeat(part, more)
                single = np.unique(s[part < 0])
                s, lo, part = s[part >= 0], lo[part >= 0], part[part >= 0]
                order = np.lexsort((s, part, lo))
                s, lo, part = s[order], lo[order], part[order]
                begin = words.runs(window)[1] if len(single) else None
                text, starts, stops = words.joined()
                first = np.flatnonzero(np.r_[True, (lo[1:] != lo[:-1]) | (part[1:] != part[:-1]) | (at[s[:-1]] + n[s[:-1]] != at[s[1:]])]) if len(s) else np.zeros(0, np.int64)
                a = at[s[first]]
                size = at[s[np.r_[first[1:], len(s)] - 1]] + n[s[np.r_[first[1:], len(s)] - 1]] - a + window - 1 if len(s) else a
                lo, part = lo[first], part[first]
                if len(single):
                    places = np.concatenate([np.arange(at[x], at[x] + n[x]) for x in single])
                    own = words.runs(window)[0][np.searchsorted(begin, places)]
                    a, size = np.r_[a, places], np.r_[size, np.full(len(places), window)]
                    lo, part = np.r_[lo, mix64(own).view(np.int64)], np.r_[part, np.full(len(places), -1)]
                doc = np.searchsorted(words.first, a, side="right") - 1
                ids, signs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                x, y = starts[a].tolist(), stops[a + size - 1].tolist()
                where = a - words.first[doc]
                out, again, sent = [], [], {}  # texts to send, their other places in the same row, and which they are
                state = np.zeros(len(a), np.int8)
                for i, (row, d, begin_byte, end_byte) in enumerate(zip(doc.tolist(), ids[doc].tolist(), x, y, strict=True)):
                    span = text[begin_byte:end_byte]
                    digest = xxhash.xxh3_128_digest(span)
                    low = known.get(digest)
                    if low is not None and low < d:
                        state[i] = SETTLED
                    elif (digest, row) in sent:
                        state[i] = REPEATED
                        again[sent[digest, row]].append(int(where[i]))
                    else:
                        known[digest] = d
                        sent[digest, row] = len(out)
                        out.append(span)
                        again.append([])
                if len(known) > KNOWN:
                    known.clear()
                send, settled = state == 0, state == SETTLED
                cols = [lo[send], part[send], ids[doc][send], signs[doc][send], where[send], size[send]]
                done = _merged(doc[settled], where[settled], where[settled] + size[settled])
                k = len(done[0])
                cols = [np.r_[c, e] for c, e in zip(cols, [np.zeros(k), np.zeros(k), ids[done[0]], signs[done[0]], done[1], done[2] - done[1]], strict=True)]
                kinds = (np.int64, np.int32, np.int64, np.int64, np.int32, np.int32)
                yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(t)) for c, t in zip(cols, kinds, strict=True)), pa.array(out + [None] * k, pa.binary()), pa.array(again + [[]] * k, pa.list_(pa.int32()))], ["lo", "part", "doc_id", "sign", "word", "n", "span", "again"])

    return run


def _merged(doc: np.ndarray, begin: np.ndarray, finish: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of each doc with overlapping and touching ones made one."""
    if not len(doc):
        return doc, begin, finish
    order = np.lexsort((begin, doc))
    doc, begin, finish = doc[order], begin[order], finish[order]
    shift = doc * (int(finish.max()) + 1)  # so that no range reaches into the next doc's
    reach = np.maximum.accumulate(finish + shift)
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (begin[1:] + shift[1:] > reach[:-1])])
    last = np.r_[first[1:], len(doc)] - 1
    return doc[first], begin[first], reach[last] - shift[last]


def _streamed(window: int):
    """Matches of spans sorted by (lo, part, doc_id) in the spans of smaller ids of the same shard."""

    def run(batches):
        key = doc = None
        automaton, seen, waiting = SuffixAutomaton(), set(), []
        for whole in batches:
            for batch in pieces(whole, SLICE):
                out = []
                for lo, part, d, sign, at, span, again in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                    if (lo, part) != key:
                        key, doc, automaton, seen, waiting = (lo, part), d, SuffixAutomaton(), set(), []
                    elif d != doc:
                        for text, words in waiting:
                            automaton.add(words)
                            seen.add(text)
                        doc, waiting = d, []
                    words = span.split(b" ")
                    if span in seen:
                        out += [(d, sign, p, p + len(words)) for p in (at, *again)]
                        continue
                    spans, whole_known = automaton.matched(words, window)
                    out += [(d, sign, p + a, p + b) for p in (at, *again) for a, b in spans]
                    if not whole_known:
                        waiting.append((span, words))
                cols = list(zip(*out, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["doc_id", "sign", "begin", "finish"])

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sign, spans) of the documents that lose words. sign: xxhash64 of the text. spans: word ranges to remove, an
    array of (begin, finish); they may overlap. Texts meet their hits in a shuffle, at every size."""
    source = id_text(docs, id_col, text_col).filter("doc_id is not null and text <> ''")
    with small_batches(docs.sparkSession):
        anchors = source.mapInArrow(_anchors(window, anchor, HOT), "anchor long, doc_id long, word int")
        ordered = anchors.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "word")
        hits = ordered.mapInArrow(_shared(BLOCK, HOT), "doc_id long, word int, lo long, part int")
        hits = hits.groupBy("doc_id").agg(F.collect_list(F.struct("word", "lo", "part")).alias("hits"))
        found = source.join(hits.hint("merge"), "doc_id").select("doc_id", F.xxhash64("text").alias("sign"), "text", "hits")
        spans = written(found.mapInArrow(_spans(window, anchor), "lo long, part int, doc_id long, sign long, word int, n int, span binary, again array<int>"), "spans")
        del anchors, ordered, hits, found
        release(docs.sparkSession)
        ordered = spans.filter("span is not null").drop("n").repartition("lo", "part").sortWithinPartitions("lo", "part", "doc_id", "word")
        settled = spans.filter("span is null").select("doc_id", "sign", F.col("word").alias("begin"), (F.col("word") + F.col("n")).alias("finish"))
        ranges = written(ordered.mapInArrow(_streamed(window), RANGES).unionByName(settled), "ranges")
        del ordered, settled
    discard(spans)
    return ranges.groupBy("doc_id", "sign").agg(F.collect_list(F.struct("begin", "finish")).alias("spans"))


def _kept(words: Words, spans: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which words of a column stay, and how many of each text go. spans: ranges of each text's words, or null."""
    n = np.array([0 if x is None else x for x in pc.list_value_length(spans).to_pylist()], np.int64)
    doc = np.repeat(np.arange(len(spans)), n)
    ranges = spans.flatten()
    begin, finish = (ranges.field(k).to_numpy() + words.first[doc] for k in range(2))
    change = np.zeros(len(words.start) + 1, np.int32)
    np.add.at(change, begin, 1)
    np.add.at(change, finish, -1)
    gone = np.cumsum(change[:-1]) > 0
    return ~gone, np.diff(np.r_[0, np.cumsum(gone)][words.first])


def _report(batches):
    for whole in batches:
        for batch in pieces(whole, SLICE):
            words = Words(batch.column(1))
            keep, lost = _kept(words, batch.column(2))
            text, starts, stops = words.joined()
            # Runs of kept words, cut at the texts' ends: a run's bytes are contiguous.
            first = np.zeros(len(keep), bool)
            first[words.first[:-1][words.count > 0]] = True
            begins = np.flatnonzero(keep & np.r_[True, ~keep[:-1]] | keep & first) if len(keep) else np.zeros(0, np.int64)
            last = np.r_[first[1:], True] if len(keep) else first
            ends = np.flatnonzero(keep & np.r_[~keep[1:], True] | keep & last) if len(keep) else begins
            cuts = np.searchsorted(begins, words.first).tolist()
            x, y = starts[begins].tolist(), stops[ends].tolist()
            digest = [sha256(b" ".join([text[x[i] : y[i]] for i in range(a, b)])).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words.count.astype(np.int64)), pa.array(lost.astype(np.int64)), pa.array(digest, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def dedup_report(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row: what is left of each whole text without the words of windows
    that start in a document with a smaller id too. Null and empty texts have no words; a row with a null id neither
    loses nor takes; repeated rows of one id are one document; other columns are left out."""
    spans = repeated_spans(docs, window, id_col=id_col, text_col=text_col)
    source = id_text(docs, id_col, text_col).withColumn("sign", F.xxhash64("text"))
    joined = source.join(spans.hint("merge"), ["doc_id", "sign"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_report, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _cut(batches):
    for whole in batches:
        for batch in pieces(whole, SLICE):
            words = Words(batch.column(0))
            data = words.data.tobytes()
            keep, lost = _kept(words, batch.column(1))
            texts = batch.column(0).to_pylist()
            for d in np.flatnonzero(lost).tolist():
                a, b = words.first[d], words.first[d + 1]
                begin = words.start[a:b].tolist()
                begin.append(int(words.text_start[d + 1]))
                lead = data[int(words.text_start[d]) : begin[0]]
                texts[d] = (lead + b"".join([data[begin[i] : begin[i + 1]] for i in np.flatnonzero(keep[a:b]).tolist()])).decode()
            yield batch.set_column(0, batch.schema.names[0], pa.array(texts, pa.string()))


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all rows and columns, with the repeated words cut out of text_col together with the white space after them.
    Texts without repeats stay as they are to the byte, null ones stay null. A row with a null id neither loses nor takes;
    repeated rows of one id are one document, and each stays a row."""
    from pyspark.sql import types as T

    spans = repeated_spans(docs, window, id_col=id_col, text_col=text_col)
    spans = spans.select(F.col("doc_id").alias("_span_id"), F.col("sign").alias("_span_sign"), F.col("spans").alias("_spans"))
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    text, key = f"c{names.index(text_col)}", f"c{names.index(id_col)}"
    joined = plain.join(spans.hint("merge"), (F.col(key).cast("long") == F.col("_span_id")) & (F.xxhash64(text) == F.col("_span_sign")), "left").drop("_span_id", "_span_sign")
    joined = joined.select(text, "_spans", *(c for c in plain.columns if c != text))
    out = joined.mapInArrow(_cut, T.StructType([T.StructField(f.name, f.dataType) for f in joined.schema]))
    return out.select(*plain.columns).toDF(*names)
