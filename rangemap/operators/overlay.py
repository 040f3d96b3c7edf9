"""Overlay of polygons that overlap: union and difference, as closed rings with holes told apart.

Edges meet in buckets of a grid and are cut at their crossings; a piece of edge belongs to the result's outline if the
result lies on one side of it only, which is known from the polygons that hold a place just beside it. Pieces are linked
into rings by the next piece around each end, and a ring's pieces are put in order by pointer doubling. All of it are
joins and aggregates over rows of edges, so a coastline of any length spreads over tasks.

Places are taken to a lattice of LATTICE metres, so that what touches has equal coordinates. Strips narrower than BESIDE are
below what is told apart.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..session import discard, merged, written
from .grid import GridSpec
from .vector import edge_cells, polygon_cells, rows_of, segments

LATTICE, BESIDE = 1e-6, 1e-4
_ENDS = ["x1", "y1", "x2", "y2"]


def _snap(v: Column | str) -> Column:
    v = F.col(v) if isinstance(v, str) else v
    return F.round(v / LATTICE) * LATTICE + F.lit(0.0)


def bucket_grid(edges: DataFrame, per_bucket: float = 2.0) -> GridSpec:
    """A grid over all edges whose cells hold some per_bucket edges on average, and are no smaller than edges are long."""
    r = edges.agg(F.min(F.least("x1", "x2")).alias("a"), F.max(F.greatest("x1", "x2")).alias("b"), F.min(F.least("y1", "y2")).alias("c"), F.max(F.greatest("y1", "y2")).alias("d"), F.count("*").alias("n"), F.avg(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("long")).first()
    if not r["n"]:
        return GridSpec(0.0, 1.0, 1.0, 1, 1)
    width, height = max(r["b"] - r["a"], 1.0), max(r["d"] - r["c"], 1.0)
    res = max(math.sqrt(width * height * per_bucket / r["n"]), r["long"], max(width, height) / 1e6)
    return GridSpec(r["a"] - 1, r["d"] + 1, res, int((height + 2) // res) + 1, int((width + 2) // res) + 1)


def _cut(named: DataFrame, by: str, spec: GridSpec) -> DataFrame:
    """Distinct (by, x1, y1, x2, y2): the pieces of distinct edges (edge, by, x1, y1, x2, y2), lesser end first as theirs is, cut
    where another of the same group crosses, touches or overlaps them."""
    at = edge_cells(named, spec)
    # Both sides are the same rows, dealt once. A place at which an edge ends anyway cuts nothing.
    near = at.alias("m").join(merged(at.alias("o")), (F.col(f"m.{by}") == F.col(f"o.{by}")) & (F.col("m.row") == F.col("o.row")) & (F.col("m.col") == F.col("o.col"))).filter("m.edge <> o.edge")
    near = near.select(*(F.col(f"m.{c}").alias(c) for c in ["edge", *_ENDS]), *(F.col(f"o.{c}").alias(f"o{c}") for c in ["edge", *_ENDS]))
    near = near.filter((F.least("x1", "x2") <= F.greatest("ox1", "ox2")) & (F.least("ox1", "ox2") <= F.greatest("x1", "x2")) & (F.least("y1", "y2") <= F.greatest("oy1", "oy2")) & (F.least("oy1", "oy2") <= F.greatest("y1", "y2")))
    x1, y1, x2, y2, ox1, oy1, ox2, oy2 = (F.col(c) for c in [*_ENDS, *(f"o{c}" for c in _ENDS)])
    dx, dy, ex, ey = x2 - x1, y2 - y1, ox2 - ox1, oy2 - oy1
    cross = dx * ey - dy * ex
    t = ((ox1 - x1) * ey - (oy1 - y1) * ex) / cross
    u = ((x1 - ox1) * dy - (y1 - oy1) * dx) / (ex * dy - ey * dx)
    size = F.hypot(dx, dy)
    # Ends of the other edge that lie on this one: touching, and overlapping along a line.
    on = lambda px, py: (F.abs(dx * (py - y1) - dy * (px - x1)) <= size * LATTICE / 2) & ((px - x1) * dx + (py - y1) * dy > 0) & ((px - x2) * dx + (py - y2) * dy < 0)
    place = lambda px, py: F.struct(_snap(px).alias("x"), _snap(py).alias("y"))
    # Both edges take their crossing from the one with the lesser number, so that they round alike.
    first = F.col("edge") < F.col("oedge")
    crossing = place(F.when(first, x1 + t * dx).otherwise(ox1 + u * ex), F.when(first, y1 + t * dy).otherwise(oy1 + u * ey))
    met = F.array(F.when((cross != 0) & t.between(0, 1) & u.between(0, 1), crossing), F.when(on(ox1, oy1), place(ox1, oy1)), F.when(on(ox2, oy2), place(ox2, oy2)))
    ends = lambda a, b: F.struct(F.col(a).alias("x"), F.col(b).alias("y"))
    inner = F.filter(met, lambda p: p.isNotNull() & (p != ends("x1", "y1")) & (p != ends("x2", "y2")))
    cuts = near.select("edge", F.explode(inner).alias("p")).distinct()
    cuts = cuts.groupBy("edge").agg(F.collect_list("p").alias("cuts"))
    along = lambda p: F.struct(((p["x"] - x1) * dx + (p["y"] - y1) * dy).alias("at"), p["x"].alias("x"), p["y"].alias("y"))
    every = F.array_distinct(F.concat(F.array(ends("x1", "y1")), F.coalesce("cuts", F.array().cast("array<struct<x:double,y:double>>")), F.array(ends("x2", "y2"))))
    line = named.join(merged(cuts), "edge", "left").withColumn("line", F.array_sort(F.transform(every, along)))
    piece = F.transform(F.sequence(F.lit(1), F.size("line") - 1), lambda i: F.struct(F.element_at("line", i)["x"].alias("x1"), F.element_at("line", i)["y"].alias("y1"), F.element_at("line", i + 1)["x"].alias("x2"), F.element_at("line", i + 1)["y"].alias("y2")))
    return _plain(line.filter(F.size("line") > 1).select(by, F.explode(piece).alias("s")).select(by, "s.*"), by)


def _plain(edges: DataFrame, by: str) -> DataFrame:
    """The distinct edges of each group, lesser end first."""
    swap = (F.col("x1") > F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") > F.col("y2")))
    return edges.select(by, *(F.when(swap, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1")))).distinct()


def _holding(spots: DataFrame, layer: DataFrame, by: str, spec: GridSpec) -> DataFrame:
    """(piece, side, geom_id), distinct, of spots (by, piece, side, x, y) inside polygons of their own group, as point_in_layer
    finds them; polygons of other groups meet no spot."""
    same = lambda a, b: a[by].eqNullSafe(b[by]) & (a["row"] == b["row"]) & (a["col"] == b["col"])
    keyed = spots.withColumns({"row": spec.row(F.col("y")), "col": spec.col(F.col("x"))})
    entered = edge_cells(segments(layer, by), spec).select(by, "geom_id", "row", "col").distinct()
    own = layer.select("geom_id", by)
    whole = polygon_cells(layer.select("geom_id", "rings"), spec).join(merged(entered.select("geom_id", "row", "col")), ["geom_id", "row", "col"], "left_anti").join(merged(own), "geom_id")
    sure = keyed.join(merged(whole), same(keyed, whole)).select("piece", "side", "geom_id")
    edges = segments(layer).filter("y1 <> y2")
    edges = rows_of(edges, spec)
    x, y = F.col("x"), F.col("y")
    crosses = ((F.col("y1") > y) != (F.col("y2") > y)) & (x < (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    inner = keyed.join(merged(entered), same(keyed, entered)).select("piece", "side", "x", "y", "geom_id", keyed["row"])
    met = inner.join(merged(edges), ["geom_id", "row"]).filter(crosses)
    odd = met.groupBy("piece", "side", "geom_id").agg(F.count("*").alias("_n")).filter("_n % 2 = 1")
    return sure.unionByName(odd.drop("_n"))


def outline(layer: DataFrame, by: str, inside: Callable[[Column], Column] = lambda held: F.size(held) > 0) -> DataFrame:
    """(by, x1, y1, x2, y2): the outline of where inside holds in each group, once each, with the inside on the left.

    layer: by, geom_id, rings, even-odd within a polygon. inside: from the array of ids (as text) of the group's polygons that hold
    a place to whether the place is in the result; the usual one gives the union.
    """
    edges = segments(layer, by).select(by, *(_snap(c).alias(c) for c in _ENDS)).filter("x1 <> x2 OR y1 <> y2")
    edges = written(_plain(edges, by).withColumn("edge", F.monotonically_increasing_id()), "edges")
    spec = bucket_grid(edges)
    named = written(_cut(edges, by, spec).withColumn("piece", F.monotonically_increasing_id()), "pieces")
    discard(edges)
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    size = F.hypot(dx, dy)
    sides = F.array(*(F.struct(F.lit(s).alias("side"), ((F.col("x1") + F.col("x2")) / 2 - s * BESIDE * dy / size).alias("x"), ((F.col("y1") + F.col("y2")) / 2 + s * BESIDE * dx / size).alias("y")) for s in (1, -1)))
    spots = named.select(by, "piece", F.explode(sides).alias("p")).select(by, "piece", "p.side", "p.x", "p.y")
    rings = layer.select(by, F.col("geom_id").cast("string").alias("geom_id"), F.transform("rings", lambda r: F.transform(r, lambda p: F.array(_snap(p[0]), _snap(p[1])))).alias("rings"))
    held = _holding(spots, rings, by, spec)
    of = lambda side: F.collect_list(F.when(F.col("side") == side, F.col("geom_id")))
    sets = held.groupBy("piece").agg(of(1).alias("_left"), of(-1).alias("_right"))
    none = F.array().cast("array<string>")
    both = named.join(merged(sets), "piece", "left").withColumns({"left": inside(F.coalesce("_left", none)), "right": inside(F.coalesce("_right", none))})
    kept = both.filter(F.col("left") != F.col("right"))
    way = lambda a, b: F.when(F.col("left"), F.col(a)).otherwise(F.col(b)).alias(a)
    out = written(kept.select(by, way("x1", "x2"), way("y1", "y2"), way("x2", "x1"), way("y2", "y1")), "outline")
    discard(named)
    return out


def rings_of(edges: DataFrame, by: str) -> DataFrame:
    """(by, ring, hole, area, points): the closed rings that directed edges with the inside on their left make, points in
    order with the first at the end, area signed, negative for holes.

    At an end where several rings touch, the next edge is the first clockwise from where one came, so rings never cross.
    Rings are named and put in order in as many rounds as the longest has doublings, each written.
    """
    e = written(edges.withColumn("edge", F.monotonically_increasing_id()), "half-edges")
    back = F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2"))
    arriving = e.select(by, "edge", F.col("x2").alias("x"), F.col("y2").alias("y"), back.alias("back"))
    leaving = e.select(by, F.col("edge").alias("next"), F.col("x1").alias("x"), F.col("y1").alias("y"), F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")).alias("ahead"))
    turn = F.pmod(F.col("back") - F.col("ahead") - 1e-12, F.lit(2 * math.pi))
    links = arriving.join(merged(leaving), [by, "x", "y"]).groupBy("edge").agg(F.min_by("next", turn).alias("next"))

    # The least edge of each ring, by doubling: after k rounds an edge knows the least of the 2^k after it.
    state = written(links.select("edge", F.col("next").alias("to"), F.least("edge", "next").alias("ring")), "ring-names")
    while True:
        far = state.select(F.col("edge").alias("to"), F.col("to").alias("beyond"), F.col("ring").alias("theirs"))
        new = written(state.join(merged(far), "to").select("edge", F.col("beyond").alias("to"), F.least("ring", "theirs").alias("ring"), (F.col("theirs") < F.col("ring")).alias("moved")), "ring-names")
        discard(state)
        state, moved = new.drop("moved"), new
        if moved.filter("moved").isEmpty():
            break
    # Cut each ring before its least edge; how far the cut is ahead, by doubling, is the order from the end.
    ends = links.join(merged(state.select("edge", "ring")), "edge")
    rank = written(ends.select("edge", "ring", F.when(F.col("next") != F.col("ring"), F.col("next")).alias("to"), F.when(F.col("next") != F.col("ring"), 1).otherwise(0).cast("long").alias("left")), "ring-places")
    while not rank.filter("to IS NOT NULL").isEmpty():
        far = rank.select(F.col("edge").alias("to"), F.col("to").alias("beyond"), F.col("left").alias("more"))
        new = written(rank.join(merged(far), "to", "left").select("edge", "ring", F.col("beyond").alias("to"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left")), "ring-places")
        discard(rank)
        rank = new
    placed = e.join(merged(rank.select("edge", "ring", "left")), "edge")
    listed = placed.groupBy(by, "ring").agg(F.sort_array(F.collect_list(F.struct((-F.col("left")).alias("at"), "x1", "y1"))).alias("v"), (F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("area"))
    points = F.transform("v", lambda p: F.array(p["x1"], p["y1"]))
    return listed.select(by, "ring", (F.col("area") < 0).alias("hole"), "area", F.concat(points, F.slice(points, 1, 1)).alias("points"))


def union(layer: DataFrame, by: str) -> DataFrame:
    """rings_of the union of each group's polygons, overlapping or not."""
    return rings_of(outline(layer, by), by)


def difference(near: DataFrame, land: DataFrame, by: str) -> DataFrame:
    """rings_of what is in a group's polygons of near and in none of land's polygons of the same group."""
    tag = lambda df, t: df.select(by, F.concat(F.lit(t), F.col("geom_id").cast("string")).alias("geom_id"), "rings")
    starts = lambda held, t: F.exists(held, lambda g: g.startswith(t))
    return rings_of(outline(tag(near, "+").unionByName(tag(land, "-")), by, lambda held: starts(held, "+") & ~starts(held, "-")), by)


def polygons(rings: DataFrame, by: str) -> DataFrame:
    """(by, geom_id, rings) of rings_of: each outer ring with its holes. A hole is in the smallest outer ring around it."""
    rings = written(rings, "rings")
    outer = rings.filter("NOT hole").select(by, F.col("ring").alias("geom_id"), F.array("points").alias("rings"), "area")
    p, q = F.col("points")[0], F.col("points")[1]
    size = F.hypot(q[0] - p[0], q[1] - p[1])
    beside = rings.filter("hole").select(by, "ring", "points", ((p[0] + q[0]) / 2 - BESIDE * (q[1] - p[1]) / size).alias("x"), ((p[1] + q[1]) / 2 + BESIDE * (q[0] - p[0]) / size).alias("y"))
    spots = beside.select(by, F.col("ring").alias("piece"), F.lit(0).alias("side"), "x", "y")
    around = _holding(spots, outer.select(by, "geom_id", "rings"), by, bucket_grid(segments(outer.select("geom_id", "rings"))))
    home = around.join(merged(outer.select("geom_id", "area")), "geom_id").groupBy(F.col("piece").alias("ring")).agg(F.min_by("geom_id", "area").alias("geom_id"))
    holes = home.join(merged(beside.select("ring", "points")), "ring").groupBy("geom_id").agg(F.collect_list("points").alias("holes"))
    joined = outer.join(merged(holes), "geom_id", "left")
    return joined.select(by, "geom_id", F.concat("rings", F.coalesce("holes", F.array().cast("array<array<array<double>>>"))).alias("rings"))


def shapes_area() -> Column:
    """Area of a polygon: that of its first ring less its holes'."""
    return G.ring_area(F.col("rings")[0]) - F.aggregate(F.slice("rings", 2, F.greatest(F.size("rings") - 1, F.lit(1))), F.lit(0.0), lambda a, r: a + G.ring_area(r))
