"""Connected components of a graph in a table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a, b: long); component is the smallest node that can be reached.

    Each round every node moves to the neighbour (or itself) that comes first in an order, and the edges follow. In the
    first round that is the order of the nodes, which settles stars at once; later ones draw an order each, so that the
    nodes left fall by a constant factor and a chain takes logarithmically many rounds too. Minimum and distinct combine
    before their shuffles, so a node with very many edges makes no large task. Each round's tables are written to the
    shared folder. Rows with a null end and loops are left out; no edges give no rows.
    """
    edges = written(edges.select("a", "b").filter("a is not null and b is not null and a <> b").distinct(), "edges")
    steps: list[DataFrame] = []
    for r in range(rounds):
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c, r=r: F.xxhash64(F.col(c), F.lit(r)) if r else F.col(c)
        first = F.min(F.struct(order("b").alias("o"), F.col("b").alias("n")))
        own = F.struct(order("a").alias("o"), F.col("a").alias("n"))
        moves = both.groupBy("a").agg(first.alias("f")).select(F.col("a").alias("from"), F.least(F.col("f"), own)["n"].alias("to"))
        moves = written(moves, "moves")
        steps.append(moves)
        to_a = moves.select(F.col("from").alias("a"), F.col("to").alias("na"))
        to_b = moves.select(F.col("from").alias("b"), F.col("to").alias("nb"))
        after = written(edges.join(to_a, "a").join(to_b, "b").select(F.col("na").alias("a"), F.col("nb").alias("b")).filter("a <> b").distinct(), "edges")
        discard(edges)
        edges = after
    else:
        raise RuntimeError("the components did not settle")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    place = steps[0].select(F.col("from").alias("node"), F.col("to").alias("root"))
    for moves in steps[1:]:
        place = place.join(moves, place["root"] == moves["from"], "left").select("node", F.coalesce("to", "root").alias("root"))
    place = written(place, "place")
    discard(edges, *steps)
    low = place.groupBy("root").agg(F.min("node").alias("component"))
    return place.join(low, "root").select("node", "component")
