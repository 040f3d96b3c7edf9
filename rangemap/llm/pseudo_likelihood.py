"""LM scoring by masked pseudo-likelihood.

A small window network predicts a word's bucket from the buckets of the SIDE words on either side of it. Words are hashed
to CLASSES x MEMBERS buckets, and a prediction is a class and a member of it, so that each conditional probability is
exactly normalised at the cost of two short softmaxes. Inside its bucket a word has its share of the bucket's occurrences,
from counts of every distinct word of the whole corpus: P(word | near) = P(bucket | near) n(word) / n(bucket). The network is trained in numpy by data-parallel rounds: every partition of the whole
corpus trains a copy on its own documents, masking one word in MASK, and the copies are averaged by the number of words
each has seen. The masks of the MASK rounds are disjoint, so that every word of every text has been a target once. A document's score is the sum of the log-probabilities of all its words, each from both sides.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, discard, id_text, mix64, pieces, small_batches, written

CLASSES, MEMBERS = 64, 64
SIDE, WIDTH, HIDDEN = 2, 16, 32
MASK, BATCH, RATE = 8, 2048, 0.08
IDS = CLASSES * MEMBERS
#: Shares of the partitions whose copies are averaged first.
SHARES = 64
COPIES, BLOCK = "block int, value binary, seen long", 4096
COMMON = 200_000  # words whose counts are broadcast at most, about 3 MB
EDGE = IDS  # what stands outside a text
SHAPES = {"embed": (IDS + 1, WIDTH), "into": (2 * SIDE * WIDTH, HIDDEN), "into_0": (HIDDEN,), "group": (HIDDEN, CLASSES), "group_0": (CLASSES,), "member": (CLASSES, HIDDEN, MEMBERS), "member_0": (CLASSES, MEMBERS)}


def fresh(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {k: (np.zeros(s) if k.endswith("_0") else rng.normal(0, 0.1, s)).astype(np.float32) for k, s in SHAPES.items()}


def flat(model: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in SHAPES])


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = values[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


def texts_of(first: np.ndarray) -> np.ndarray:
    """The text of each word. first: where texts begin (n + 1)."""
    return np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))


def contexts(ids: np.ndarray, first: np.ndarray, where: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Ids of the SIDE words before and after each place; EDGE beyond the ends of its text. doc: texts_of(first)."""
    places = where[:, None] + np.r_[-SIDE:0, 1 : SIDE + 1]
    out = ids.take(places, mode="clip")
    # Texts are in order, so what is between two places of one text is of it too; only the others are looked at one by one.
    first, last = places[:, 0], places[:, -1]
    some = np.flatnonzero((doc.take(first, mode="clip") != doc.take(last, mode="clip")) | (first < 0) | (last >= len(ids)))
    if len(some):
        at = places[some]
        inside = (at >= 0) & (at < len(ids))
        out[some] = np.where(inside & (doc.take(at, mode="clip") == doc[where[some], None]), out[some], EDGE)
    return out


_ROOM: dict[str, np.ndarray] = {}


def _room(name: str, *shape: int) -> np.ndarray:
    """An array kept from one step to the next: fresh memory for each step costs more than some of the arithmetic in it."""
    size = math.prod(shape)
    if name not in _ROOM or len(_ROOM[name]) < size:
        _ROOM[name] = np.empty(size, np.float32)
    return _ROOM[name][:size].reshape(shape)


def _bounded(weights: np.ndarray, shift: np.ndarray) -> bool:
    """No logit of hidden values in -1..1 can be so large that its exponential overflows."""
    return bool((np.abs(weights, out=_room("abs", *weights.shape)).sum(axis=-2) + np.abs(shift)).max() < 60)


def _exp(logits: np.ndarray, bounded: bool) -> np.ndarray:
    """Each row's exponentials, in place, up to a factor; their sums as a column."""
    if not bounded:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    return logits @ np.ones((logits.shape[1], 1), np.float32)


def _off(logits: np.ndarray, each: np.ndarray, at: np.ndarray, bounded: bool) -> np.ndarray:
    """The gradient of the mean negative log-softmax of each row, at its column at. Changes logits."""
    part = np.float32(1 / len(logits))
    logits *= part / _exp(logits, bounded)
    logits[each, at] -= part
    return logits


def _picked(logits: np.ndarray, n: np.ndarray, at: np.ndarray, bounded: bool) -> np.ndarray:
    """The log-softmax of each row n, at its column at. Changes logits."""
    if not bounded:
        logits -= logits.max(axis=1, keepdims=True)
    own = logits[n, at].astype(np.float64)
    return own - np.log(_exp(logits, True)[:, 0])


def _tanh(x: np.ndarray) -> np.ndarray:
    """In place, as 1 - 2 / (e^2x + 1): numpy's exponential takes less than its tanh."""
    x *= 2
    with np.errstate(over="ignore"):  # 1 then
        np.exp(x, out=x)
    x += 1
    np.divide(2, x, out=x)
    return np.subtract(1, x, out=x)


def _hidden(model: dict[str, np.ndarray], near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The contexts' embeddings and hidden values."""
    n = len(near)
    x = model["embed"].take(near, axis=0, out=_room("x", n, 2 * SIDE, WIDTH), mode="clip").reshape(n, -1)
    hidden = np.matmul(x, model["into"], out=_room("hidden", n, HIDDEN))
    hidden += model["into_0"]
    return x, _tanh(hidden)


def _group_logits(model: dict[str, np.ndarray], hidden: np.ndarray) -> np.ndarray:
    logits = np.matmul(hidden, model["group"], out=_room("group", len(hidden), CLASSES))
    logits += model["group_0"]
    return logits


def _member_logits(model: dict[str, np.ndarray], hidden: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Logits of the members of each row's group, rows in the order of groups; and (group, first row, end)."""
    cuts = np.searchsorted(group, np.arange(CLASSES + 1)).tolist()
    some = [(g, a, b) for g, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
    logits = _room("member", len(group), MEMBERS)
    for g, a, b in some:
        np.dot(hidden[a:b], model["member"][g], out=logits[a:b])
    logits += model["member_0"].take(group, axis=0, out=_room("shift", len(group), MEMBERS), mode="clip")
    return logits, some


def log_probs(model: dict[str, np.ndarray], near: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-probability of each target id given its context; over all ids the probabilities sum to one."""
    order = np.argsort((target // MEMBERS).astype(np.uint16), kind="stable")
    target, n = target[order], np.arange(len(target))
    group, member = target // MEMBERS, target % MEMBERS
    _, hidden = _hidden(model, near[order])
    logs = _picked(_group_logits(model, hidden), n, group, _bounded(model["group"], model["group_0"]))
    logits, _ = _member_logits(model, hidden, group)
    out = np.empty(len(target))
    out[order] = logs + _picked(logits, n, member, _bounded(model["member"], model["member_0"]))
    return out


def train_step(model: dict[str, np.ndarray], sums: dict[str, np.ndarray], near: np.ndarray, target: np.ndarray) -> None:
    """One AdaGrad step on the mean negative log-probability, in place."""
    n = len(target)
    order = np.argsort((target // MEMBERS).astype(np.uint16), kind="stable")
    near, target, each = near[order], target[order], np.arange(n)
    group, member = target // MEMBERS, target % MEMBERS
    x, hidden = _hidden(model, near)
    grad = {k: _room(f"grad {k}", *s) for k, s in SHAPES.items()}
    ones = np.ones(n, np.float32)
    off = _off(_group_logits(model, hidden), each, group, _bounded(model["group"], model["group_0"]))
    np.matmul(hidden.T, off, out=grad["group"])
    np.dot(ones, off, out=grad["group_0"])
    back = np.matmul(off, model["group"].T, out=_room("back", n, HIDDEN))
    off, some = _member_logits(model, hidden, group)
    off = _off(off, each, member, _bounded(model["member"], model["member_0"]))
    more, columns, turned = _room("more", n, HIDDEN), hidden.T, model["member"].transpose(0, 2, 1)
    for g, a, b in some:
        own = off[a:b]
        np.dot(columns[:, a:b], own, out=grad["member"][g])
        np.dot(ones[a:b], own, out=grad["member_0"][g])
        np.dot(own, turned[g], out=more[a:b])
    back += more
    for g in set(range(CLASSES)).difference(g for g, _, _ in some):
        grad["member"][g], grad["member_0"][g] = 0, 0
    hidden *= hidden
    back *= np.subtract(1, hidden, out=hidden)
    np.matmul(x.T, back, out=grad["into"])
    np.dot(ones, back, out=grad["into_0"])
    into = np.matmul(model["into"], back.T, out=_room("into", 2 * SIDE * WIDTH, n)).reshape(2 * SIDE, WIDTH, n)
    places = near.T.ravel()
    for j in range(WIDTH):
        grad["embed"][:, j] = np.bincount(places, into[:, j].ravel(), IDS + 1)
    for k, g in grad.items():
        step = np.multiply(g, g, out=_room("step", *g.shape))
        sums[k] += step
        np.sqrt(sums[k], out=step)
        step += 1e-6
        np.divide(g, step, out=step)
        step *= RATE
        model[k] -= step


def _binary(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A row of bytes for each text, of the values of its words."""
    ends = pa.array((first * values.itemsize).astype(np.int32)).buffers()[1]
    return pa.BinaryArray.from_buffers(pa.binary(), len(first) - 1, [None, ends, pa.py_buffer(values.tobytes())])


def _tokens(batches):
    for whole in batches:
        for batch in pieces(whole):
            words = Words(batch.column(1))
            ids = (words.hash >> np.uint64(52)).astype("<u2")
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(ids, words.first), _binary(words.hash.astype("<u8"), words.first)], ["doc_id", "tokens", "words"])


def _unpacked(column: pa.Array, kind: str = "<u2") -> tuple[np.ndarray, np.ndarray]:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind), np.cumsum(np.r_[0, [len(r) // np.dtype(kind).itemsize for r in rows]])


def _counts(batches):
    for whole in batches:
        for batch in pieces(whole):
            words, n = np.unique(_unpacked(batch.column(0), "<u8")[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])


def targets(row: np.ndarray, first: np.ndarray, turn: int) -> np.ndarray:
    """The words masked in a round, in random order: every MASK-th of a text, from a place drawn by its row's number. Over the
    MASK rounds each word is in one."""
    begin = ((mix64(row.astype(np.uint64)) + np.uint64(turn)) % np.uint64(MASK)).astype(np.int64)
    n = np.maximum(0, -(-(np.diff(first) - begin) // MASK))
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    where = np.repeat(first[:-1] + begin, n) + MASK * step
    draw = mix64(np.repeat(mix64(row.astype(np.uint64)), n) + step.astype(np.uint64)) >> np.uint64(48)
    return where[np.argsort(draw.astype(np.uint16), kind="stable")]


def _train(values: np.ndarray, turn: int):
    def run(batches):
        model = shaped(values)
        sums = {k: np.full(s, 1e-3, np.float32) for k, s in SHAPES.items()}
        seen = 0
        for whole in batches:
            for batch in pieces(whole, 2 << 20):
                ids, first = _unpacked(batch.column(1))
                if not len(ids):
                    continue
                ids = ids.astype(np.int64)
                where, doc = targets(batch.column(0).to_numpy(), first, turn), texts_of(first)
                for a in range(0, len(where), BATCH):
                    part = where[a : a + BATCH]
                    train_step(model, sums, contexts(ids, first, part, doc), ids[part])
                seen += len(where)
        if seen:
            parts = [x.astype("<f4").tobytes() for x in np.split(flat(model), range(BLOCK, len(values), BLOCK))]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts), dtype=np.int32)), pa.array(parts, pa.binary()), pa.array(np.full(len(parts), seen, np.int64))], ["block", "value", "seen"])

    return run


def _mean(copies: pa.Table) -> pa.Table:
    """A block of parameters, averaged over the partitions' copies by the words each has seen."""
    total, seen = 0.0, 0
    for value, n in zip(copies["value"], copies["seen"].to_pylist(), strict=True):
        total, seen = total + np.frombuffer(value.as_py(), "<f4").astype(np.float64) * n, seen + n
    return pa.table({"block": copies["block"][:1], "value": pa.array([(total / seen).astype("<f4").tobytes()], pa.binary()), "seen": pa.array([seen], pa.int64())})


def tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, tokens, words): a number for each row, 16-bit buckets and 64-bit hashes of the words of each whole
    text, written to the shared folder for the rounds to come."""
    found = id_text(docs, id_col, text_col).mapInArrow(_tokens, "doc_id long, tokens binary, words binary")
    return written(found.select(F.monotonically_increasing_id().alias("row"), *found.columns), "tokens")


def vocabulary(ids: DataFrame) -> DataFrame:
    """(word, n): each distinct word's hash and how often it occurs in the whole corpus."""
    return written(ids.select("words").mapInArrow(_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")


def common(counts: DataFrame, most: int = COMMON) -> tuple[np.ndarray, np.ndarray, int]:
    """The hashes, in order, and counts of the words that occur more than a number of times, and that number: the least that
    leaves no more than most of them."""
    sizes = counts.groupBy("n").agg(F.count("*").alias("words")).toArrow().sort_by([("n", "descending")])
    few = sizes["n"].to_numpy()[np.cumsum(sizes["words"].to_numpy()) > most]
    cut = max(1, int(few[0])) if len(few) else 1
    found = counts.filter(F.col("n") > cut).toArrow()
    words = found["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    return words[order], found["n"].to_numpy()[order], cut


def bucket_totals(counts: DataFrame) -> np.ndarray:
    found = counts.groupBy(F.shiftrightunsigned("word", 52).cast("int").alias("bucket")).agg(F.sum("n").alias("n")).toArrow()
    out = np.ones(IDS)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def train(ids: DataFrame) -> dict[str, np.ndarray]:
    """The averaged network. What the driver gets is one value per parameter, whatever the corpus's size."""
    values = flat(fresh())
    ids = written(ids.select("row", "tokens"), "targets")  # so that partitions, and copies, follow what the rounds read
    for turn in range(MASK):
        copies = ids.mapInArrow(_train(values, turn), COPIES).withColumn("share", F.spark_partition_id() % SHARES)
        # In two steps: no task holds a copy of every partition.
        means = copies.groupBy("block", "share").applyInArrow(_mean, COPIES).groupBy("block").applyInArrow(_mean, COPIES)
        found = means.toArrow().sort_by("block")
        if len(found):
            values = np.frombuffer(b"".join(found["value"].to_pylist()), "<f4")
    discard(ids)
    return shaped(values)


def _score(values: np.ndarray, words: np.ndarray, n: np.ndarray, cut: int, totals: np.ndarray):
    def run(batches):
        model = shaped(values)
        share, whole_bucket = np.log(n), np.log(totals)
        for whole in batches:
            for batch in pieces(whole, 4 << 20):
                ids, first = _unpacked(batch.column(2))
                hashes, _ = _unpacked(batch.column(3), "<u8")
                ids = ids.astype(np.int64)
                logs, doc = np.empty(len(ids)), texts_of(first)
                for a in range(0, len(ids), 1 << 13):
                    part = np.arange(a, min(a + (1 << 13), len(ids)))
                    logs[part] = log_probs(model, contexts(ids, first, part, doc), ids[part])
                logs -= whole_bucket[ids]
                rare = np.ones(len(ids), bool)
                if len(words):
                    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
                    rare = words[at] != hashes
                    logs += np.where(rare, 0, share[at])
                rare &= cut > 1  # else what is not among the words occurs once, and the logarithm of its count is 0
                left = np.r_[0, np.cumsum(rare)][first]
                lists = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), pa.array(hashes[rare].view(np.int64)))
                total = np.zeros(len(first) - 1)
                full = np.flatnonzero(np.diff(first))
                if len(full):
                    total[full] = np.add.reduceat(logs, first[full])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(first)), pa.array(total), lists], ["row", "doc_id", "n_words", "log_likelihood", "rare"])

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = COMMON) -> DataFrame:
    """(doc_id, n_words, log_likelihood, mean_log_prob) per row of docs, by a network trained and words counted on all of docs.

    Every word of every whole text is predicted. Null and empty texts have no words and score 0; a null id stays null;
    other columns are left out. An empty table trains nothing and gives no rows. Counts of the most frequent words travel
    to the texts by broadcast, up to most of them; those of rarer ones meet their occurrences in a shuffle.
    """
    with small_batches(docs.sparkSession):
        ids = tokens(docs, id_col, text_col)
        counts = vocabulary(ids)
        words, n, cut = common(counts, most)
        found = ids.mapInArrow(_score(flat(train(ids)), words, n, cut, bucket_totals(counts)), "row long, doc_id long, n_words long, log_likelihood double, rare array<long>")
        found = found if cut == 1 else written(found, "scores")
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).otherwise(0.0).alias("mean_log_prob")
    if cut == 1:
        return found.select("doc_id", "n_words", "log_likelihood", mean)
    discard(ids)
    rare = found.select("row", F.explode("rare").alias("word")).join(counts.filter(F.col("n") <= cut), "word")
    terms = rare.select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_words"), F.log("n").alias("log_likelihood"))
    every = found.drop("rare").unionByName(terms).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n_words").alias("n_words"), F.sum("log_likelihood").alias("log_likelihood"))
    return every.select("doc_id", "n_words", "log_likelihood", mean)
