"""N-gram Jaccard join: near-duplicate documents by their sets of word shingles. Exact.

1. Every text becomes a set of 64-bit shingle hashes; texts with equal sets are one class from here on.
2. Two sets that link share one of the first n - ceil(n percent / 100) + 1 shingles of either, in whatever order, if it is
   the same for all. The order is by four ranges of the hash, then rare shingles first, then by hash. So a set needs counts
   of the shingles in its first ranges only, mostly a quarter of them. They are sorted by Spark, and only shingles of several
   sets come back; the others count as one each. A text with enough shingles of its own has no partner and is left out.
3. What is left of a set's first shingles puts it into tiles: a shingle and a size band, the set's own or the one below. A
   tile is a star: its first class and the others. In a tile, hashed bitmaps bound the overlap of a pair from above by
   counting bits; pairs that pass are settled by intersecting their sorted arrays. Pairs already joined through others need
   no test. Tiles are not closed transitively.
4. At first a class goes to one star only, the smallest it is in; stars whose members are then in several components meet
   as a whole. Large stars are dealt into blocks; there the classes outside the star's largest component visit every block,
   which is all that can still join anything.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, discard, id_text, mix64, pieces, small_batches, written
from .components import connected_components

BITS = 2048
#: Most classes of a block, most shingles of a block (8 MB), on average.
TILE, TILE_SHINGLES = 1000, 1_000_000
#: Bytes of text worked on at once; sets a task remembers so that it sends the parts of copies once.
SLICE, KNOWN = 1 << 20, 50_000
#: Sets from which on a shingle's count is not told.
COMMON = 1000


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one text after another; and where each text's begin (n + 1)."""
    words = Words(texts, lower=True)
    runs, at = words.runs(k)
    doc = np.searchsorted(words.first, at, side="right") - 1
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for i, d in enumerate(short):
            a, b = words.first[d], words.first[d + 1]
            h = np.array([b - a], np.uint64)
            for x in words.hash[a:b]:
                h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + x)
            extra[i] = h[0]
        runs, doc = np.concatenate([runs, extra]), np.concatenate([doc, short])
    order = np.lexsort((runs, doc))
    runs, doc = runs[order], doc[order]
    if len(runs):
        fresh = np.r_[True, (runs[1:] != runs[:-1]) | (doc[1:] != doc[:-1])]
        runs, doc = runs[fresh], doc[fresh]
    return runs, np.searchsorted(doc, np.arange(len(texts) + 1))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - -(-n * percent // 100) + 1, 0)


def prefix_ranges(sets: np.ndarray, first: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which shingles lie in the hash ranges that a set's prefix can reach; and for each set the last such range, how many
    of its shingles lie in the ranges before it, and how many in it. sets: ascending in each set."""
    n = np.diff(first)
    of, level = np.repeat(np.arange(len(n)), n), (sets >> np.uint64(62)).astype(np.int64)
    count = np.bincount(of * 4 + level, minlength=4 * len(n)).reshape(-1, 4)
    total = count.cumsum(axis=1)
    last = (total >= prefix_length(n, percent)[:, None]).argmax(axis=1)
    rows = np.arange(len(n))
    return level <= last[of], last, (total - count)[rows, last], count[rows, last]


def _sums(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set as a whole."""
    full = np.flatnonzero(np.diff(first))
    one, two = np.zeros(len(first) - 1, np.uint64), np.zeros(len(first) - 1, np.uint64)
    if len(full):
        one[full] = np.add.reduceat(mix64(sets), first[full])
        two[full] = np.add.reduceat(mix64(sets ^ np.uint64(0xA0761D6478BD642F)), first[full])
    return one.view(np.int64), two.view(np.int64)


def _signatures(k: int, percent: int):
    def run(batches):
        for whole in batches:
            for batch in pieces(whole, SLICE):
                sets, first = shingle_sets(batch.column(1), k)
                one, two = _sums(sets, first)
                _, last, before, at = prefix_ranges(sets, first, percent)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(first)), pa.array(one), pa.array(two), *(pa.array(x) for x in (last, before, at))], ["doc_id", "n_shingles", "one", "two", "last", "before", "at"])

    return run


def _prefixes(k: int, percent: int):
    """(shingle, one) of the shingles that a set's prefix can reach; copies that a task has met lately are left out."""

    def run(batches):
        known: set[int] = set()
        for whole in batches:
            for batch in pieces(whole, SLICE):
                sets, first = shingle_sets(batch.column(1), k)
                one, _ = _sums(sets, first)
                send = prefix_ranges(sets, first, percent)[0]
                fresh = np.zeros(len(one), bool)
                for i, x in enumerate(one.tolist()):
                    fresh[i] = x not in known
                    known.add(x)
                if len(known) > KNOWN:
                    known.clear()
                of = np.repeat(np.arange(len(one)), np.diff(first))
                send &= fresh[of]
                yield pa.RecordBatch.from_arrays([pa.array(sets[send].view(np.int64)), pa.array(one[of[send]])], ["shingle", "one"])

    return run


def _counted(batches):
    """(one, shingle, c) of shingles in several sets, sorted by (shingle, one): c sets, COMMON at most. No more than COMMON
    rows of a shingle are held back."""
    held_a = held_b = np.zeros(0, np.int64)  # distinct rows of a shingle whose end hasn't come yet
    many = None  # (shingle, last set) of one that has reached COMMON
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        out = []
        if many is not None and len(a):
            n = len(a) if a[-1] == many[0] else int(np.argmax(a != many[0]))
            rows = b[:n][b[:n] != np.r_[many[1], b[: n - 1]]] if n else b[:0]
            out.append((rows, np.full(len(rows), many[0]), np.full(len(rows), COMMON)))
            many = (many[0], b[n - 1]) if n == len(a) else None
            a, b = a[n:], b[n:]
        if len(a):
            a, b = np.r_[held_a, a], np.r_[held_b, b]
            fresh = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            a, b = a[fresh], b[fresh]
            first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            size = np.diff(np.r_[first, len(a)])
            if size[-1] >= COMMON:
                many, end = (a[-1], b[-1]), len(a)
                held_a = held_b = a[:0]
            else:
                end = first[-1]
                held_a, held_b = a[end:], b[end:]
            c = np.repeat(np.minimum(size, COMMON), size)[:end]
            rows = c > 1
            out.append((b[:end][rows], a[:end][rows], c[rows]))
        if out:
            yield _rows(out)
    if len(held_a) > 1:
        yield _rows([(held_b, held_a, np.full(len(held_a), min(len(held_a), COMMON)))])


def _rows(parts) -> pa.RecordBatch:
    one, shingle, c = (np.concatenate(x) for x in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(one), pa.array(shingle), pa.array(c.astype(np.int32))], ["one", "shingle", "c"])


def _stars(batches):
    """(low, node) of tiles' nodes, sorted by (tile, node): low is the first node of the tile."""
    tile = low = last = None
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(a):
            continue
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        lows = b[first].copy()
        before = np.r_[b[0], b[:-1]]
        before[first] = b[first]
        if a[0] == tile:
            lows[0], before[0] = low, last
        lows = np.repeat(lows, np.diff(np.r_[first, len(a)]))
        other = b != before
        tile, low, last = a[-1], lows[-1], b[-1]
        yield pa.RecordBatch.from_arrays([pa.array(lows[other]), pa.array(b[other])], ["low", "node"])


def bitmaps(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """BITS bits per set, packed in 64-bit words; each member flips one, so that bits tell apart sets of any size."""
    out = np.zeros((len(first) - 1, BITS // 8), np.uint8)
    bit = (sets >> np.uint64(20)).astype(np.int64) & (BITS - 1)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    np.bitwise_xor.at(out, (row, bit >> 3), (1 << (bit & 7)).astype(np.uint8))
    return out.view(np.uint64)


def _sets(k: int):
    def run(batches):
        for whole in batches:
            for batch in pieces(whole, SLICE):
                sets, first = shingle_sets(batch.column(1), k)
                marks = bitmaps(sets, first)
                ends = pa.array((first * 8).astype(np.int32)).buffers()[1]
                members = pa.BinaryArray.from_buffers(pa.binary(), len(batch), [None, ends, pa.py_buffer(sets.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_sums(sets, first)[0]), pa.array([m.tobytes() for m in marks], pa.binary()), members], ["doc_id", "one", "bits", "members"])

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b| for sorted arrays without repeats."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def join_tile(ids, sizes, bits, member, component, probe, percent: int) -> list[tuple[int, int]]:
    """Edges that connect a tile as far as it goes, from each component's smallest id. component: groups known to be
    connected. probe: if any is set, only pairs of a set and an unset place are tested. member: the set at a place."""
    order = np.lexsort((ids, sizes))
    ids, sizes, probe, bits = ids[order], sizes[order], probe[order], bits[order]
    _, known = np.unique(component[order], return_inverse=True)
    group = known.copy()
    one_sided = bool(probe.any())
    arrays: dict[int, np.ndarray] = {}
    for i in range(1, len(ids)):
        low = np.searchsorted(sizes[:i], -(-percent * int(sizes[i]) // 100))
        span = np.arange(low, i)
        span = span[group[span] != group[i]]
        if one_sided:
            span = span[probe[span] != probe[i]]
        if not len(span):
            continue
        total = sizes[span] + sizes[i]
        apart = np.bitwise_count(bits[span] ^ bits[i]).sum(axis=1, dtype=np.int64)
        most = (total - apart) // 2
        passed = 100 * most >= percent * (total - most)
        span, most = span[passed], most[passed]
        for j in span[np.argsort(-most, kind="stable")]:
            if group[j] == group[i]:
                continue
            for x in (i, j):
                if x not in arrays:
                    arrays[x] = member(order[x])
            if linked(arrays[i], arrays[j], percent):
                group[group == group[j]] = group[i]
    if (group == known).all():
        return []
    order = np.lexsort((ids, group))
    root = ids[order][np.searchsorted(group[order], group, side="left")]
    order = np.lexsort((ids, known))
    first = np.searchsorted(known[order], np.arange(known.max() + 1), side="left")
    own = order[first]  # of each component that was known, its smallest id
    return [(int(a), int(b)) for a, b in zip(root[own], ids[own], strict=True) if a != b]


def _tiles(percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, sizes, family, x, y, component, probe = (table.column(c).to_numpy() for c in ("doc_id", "n", "family", "x", "y", "component", "probe"))
        bits, members = (table.column(c).chunk(0) if table.column(c).num_chunks else pa.array([], pa.binary()) for c in ("bits", "members"))
        bits = np.frombuffer(b"".join(bits.to_pylist()), np.uint64).reshape(len(ids), -1)
        order = np.lexsort((y, x, family))
        keys = np.stack([family, x, y])[:, order]
        cuts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0), True])
        links = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            rows = order[a:b]
            links += join_tile(ids[rows], sizes[rows], bits[rows], lambda i, rows=rows: np.frombuffer(members[int(rows[i])].as_buffer(), np.uint64), component[rows], probe[rows], percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def jaccard_components(docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of docs.

    n_shingles: distinct k-word shingles of the whole text, A-Z lower-cased; a text of fewer words is one shingle; null
    and empty texts have none and link with nothing. component_id: the smallest id reachable over pairs with
    100 * intersection >= percent * union. Repeated rows are rows of one document; a row with a null id has no links and
    a null component.
    """
    source = id_text(docs, id_col, text_col)
    key, ranges = ["n_shingles", "one", "two"], ["last", "before", "at"]
    with small_batches(docs.sparkSession):
        signs = written(source.mapInArrow(_signatures(k, percent), "doc_id long, n_shingles long, one long, two long, last long, before long, at long"), "signatures")
        known = signs.filter("doc_id is not null and n_shingles > 0")
        classes = written(known.groupBy(*key, *ranges).agg(F.min("doc_id").alias("class")), "classes")
        first, more = verified_links(source.filter("doc_id is not null"), classes, k, percent)
        classes = classes.drop(*ranges)
        # A document that repeats with another text counts with all its classes.
        again = known.join(classes, key).select("doc_id", "class").distinct()
        several = again.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("z")).filter("a < z").select("doc_id", "a")
        more = more.unionByName(again.join(several, "doc_id").select("a", F.col("class").alias("b")))
        for end in ("a", "b"):
            named = first.select(F.col("node").alias(end), F.col("component").alias("to"))
            more = more.join(named, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        second = connected_components(more)
    joined = signs.join(classes, key, "left").join(first.withColumnRenamed("node", "class"), "class", "left").withColumn("node", F.coalesce("component", "class", "doc_id"))
    joined = joined.drop("component").join(second, "node", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node")).alias("component_id"))


def tiles(source: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(tile, node): the tiles of every class that has shared shingles in its prefix."""
    rows = source.select("doc_id", "text").mapInArrow(_prefixes(k, percent), "shingle long, one long")
    hits = rows.repartition("shingle").sortWithinPartitions("shingle", "one").mapInArrow(_counted, "one long, shingle long, c int")
    level = F.shiftrightunsigned("shingle", 62).cast("int").alias("level")
    hits = hits.groupBy("one").agg(F.array_sort(F.collect_list(F.struct(level, "c", "shingle"))).alias("hits"))
    hits = hits.join(classes.select("one", "last", "before", "at", F.col("n_shingles").alias("n"), "class"), "one")
    here = F.size(F.filter("hits", lambda x: x["level"] == F.col("last")))
    # Shingles of one set come first in the last range; what of the prefix is left there are the rarest of several sets.
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    left = F.least(F.greatest(length - F.col("before") - (F.col("at") - here), F.lit(0)), here)
    hits = hits.withColumn("take", (F.size("hits") - here + left).cast("int")).filter("take > 0")
    width = -math.log(percent / 100 - 0.002)
    hits = hits.select("class", F.floor(F.log("n") / width).cast("int").alias("band"), F.explode(F.slice("hits", 1, F.col("take"))).alias("hit"))
    hits = hits.select(F.col("class").alias("node"), "hit.shingle", F.explode(F.array(F.col("band") - 1, F.col("band"))).alias("band"))
    return hits.select(F.xxhash64("shingle", "band").alias("tile"), "node")


def star_pairs(source: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(family, doc_id, n, sign): the classes of each star, its first one included."""
    rows = written(tiles(source, classes, k, percent), "tiles")
    stars = written(rows.repartition("tile").sortWithinPartitions("tile", "node").mapInArrow(_stars, "low long, node long").distinct(), "stars")
    named = classes.select(F.col("class").alias("node"), F.col("n_shingles").alias("n"), F.col("one").alias("sign"))
    every = stars.unionByName(stars.select("low", F.col("low").alias("node")).distinct())
    pairs = written(every.join(named, "node").select(F.col("low").alias("family"), F.col("node").alias("doc_id"), "n", "sign"), "pairs")
    discard(rows, stars)
    return pairs


def _blocks(count: str, shingles: str) -> F.Column:
    return F.ceil(F.greatest(F.col(count) / TILE, F.col(shingles) / TILE_SHINGLES)).cast("int")


def _joined(sets: DataFrame, rows: DataFrame, shards: int, percent: int, name: str) -> DataFrame:
    """Edges found in the tiles of rows (doc_id, sign, n, family, x, y, component, probe), several tiles to a call."""
    full = sets.join(rows.withColumn("shard", F.pmod(F.xxhash64("family", "x", "y"), F.lit(shards))), ["doc_id", "sign"])
    return written(full.groupBy("shard").applyInArrow(_tiles(percent), "a long, b long"), name)


def verified_links(source: DataFrame, classes: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Components (node, component) of the links found in every class's smallest star, and further links (a, b): together
    they connect all classes that are connected."""
    pairs = star_pairs(source, classes, k, percent)
    shards = max(1, pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // (TILE_SHINGLES // 2))
    # Sorted and merged at every size: there is no telling how many ids there are.
    sets = source.join(pairs.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi").mapInArrow(_sets(k), "doc_id long, one long, bits binary, members binary")
    sets = sets.withColumnRenamed("one", "sign").join(pairs.select("doc_id", "sign").distinct(), ["doc_id", "sign"], "left_semi").dropDuplicates(["doc_id", "sign"])
    sets = written(sets, "sets")
    keep = ["doc_id", "sign", "n", "family"]
    # A star's first class is in every block, which leaves few classes for the second round.
    own = pairs.filter("doc_id <> family").groupBy("doc_id").agg(F.min(F.struct("family", "n", "sign")).alias("s")).select("doc_id", "s.sign", "s.n", "s.family")
    counts = own.groupBy("family").agg(F.count("*").alias("c"), F.sum("n").alias("m")).select("family", _blocks("c", "m").alias("blocks"))
    counts = written(counts, "counts")  # a join right behind the aggregate couldn't be split where a star is large
    dealt = own.join(counts, "family").select(*keep, F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("x"))
    centres = pairs.filter("doc_id = family").join(counts, "family").select(*keep, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x"))
    rows = dealt.unionByName(centres).select(*keep, "x", F.lit(0).alias("y"), F.col("doc_id").alias("component"), F.lit(False).alias("probe"))
    links = _joined(sets, rows, shards, percent, "links")
    parts = written(connected_components(links), "parts")
    placed = pairs.join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    placed = placed.join(own.select("doc_id", F.col("family").alias("own")), "doc_id", "left")
    here = F.count_if((F.col("own") == F.col("family")) & (F.col("doc_id") != F.col("family"))) + 1
    spread = placed.groupBy("family").agg(F.min("component").alias("a"), F.max("component").alias("z"), F.count("*").alias("c"), F.sum("n").alias("m"), here.alias("here"))
    # Open is a star of several components, unless it was a single block that all its members were in.
    spread = spread.select("*", _blocks("c", "m").alias("blocks")).filter("a <> z AND (blocks > 1 OR here < c)")
    spread = written(spread.select("family", "blocks"), "open")
    placed = written(placed.drop("own").join(spread, "family"), "placed")
    keep.append("component")
    small = placed.filter("blocks = 1").select(*keep, F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(False).alias("probe"))
    large = placed.filter("blocks > 1").withColumn("x", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    main = large.groupBy("family", "component").agg(F.count("*").alias("c")).groupBy("family").agg(F.max(F.struct("c", "component"))["component"].alias("main"))
    large = large.join(main, "family")
    # Every class in its block; those outside the largest component, in stray blocks of bounded size, visit all.
    strays = large.filter("component <> main").groupBy("family").agg(F.count("*").alias("c"), F.sum("n").alias("m")).select("family", _blocks("c", "m").alias("stray_blocks"))
    large = large.join(strays, "family")
    still = large.select(*keep, "x", F.explode(F.sequence(F.lit(0), F.col("stray_blocks") - 1)).alias("y"), F.lit(False).alias("probe"))
    visit = large.filter("component <> main").select(*keep, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x"), F.pmod(F.xxhash64("doc_id", F.lit("stray")), F.col("stray_blocks")).cast("int").alias("y"), F.lit(True).alias("probe"))
    more = links.limit(0) if placed.isEmpty() else _joined(sets, small.unionByName(still).unionByName(visit), shards, percent, "more")
    discard(sets, pairs, counts, spread, placed)
    return parts, more


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs' rows but those of a component whose smallest id is another; all columns. Null ids stay."""
    found = jaccard_components(docs, k, percent).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(found.hint("merge"), "doc_id", "left_anti")
