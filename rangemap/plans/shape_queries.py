"""Queries of overlays and of grids in other reference systems, with SQL where it can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import grid, overlay, raster
from ..operators.grid import GridSpec
from . import standins as T
from .queries import KEY, rounded

QUERIES = {}
ORACLE_SQL = {}

_SIDE = "(SELECT CAST(greatest(20, ceil(8 * sqrt(count(*) / 25.0))) AS BIGINT) FROM part)"
_BOXES = f"""boxes AS (SELECT p_partkey AS id, p_brand AS brand, p_partkey * 7919 % {_SIDE} AS x, p_partkey * 104729 // 7 % {_SIDE} AS y, 1 + p_size % 5 AS w, 1 + p_partkey % 4 AS h FROM part),
land AS (SELECT DISTINCT brand, i AS x, j AS y FROM boxes, LATERAL unnest(range(x, x + w)) a(i), LATERAL unnest(range(y, y + h)) b(j)),
near AS (SELECT DISTINCT brand, i AS x, j AS y FROM boxes, LATERAL unnest(range(x - 1, x + w + 1)) a(i), LATERAL unnest(range(y - 1, y + h + 1)) b(j))"""
_MEASURED = """SELECT brand, CAST(10000 * n AS DOUBLE) AS area, CAST(100 * (4 * n - 2 * touching) AS DOUBLE) AS length FROM (
 SELECT a.brand, count(*) AS n, sum((SELECT count(*) FROM {0} b WHERE b.brand = a.brand AND ((b.x = a.x + 1 AND b.y = a.y) OR (b.x = a.x AND b.y = a.y + 1)))) AS touching FROM {0} a GROUP BY a.brand) z"""


def boxes(spark: SparkSession, sf: str, grown: int = 0) -> DataFrame:
    """Axis-parallel boxes of whole hundreds of metres, many of them overlapping, a group for each brand. Their extent grows with
    the table."""
    part = T.read(spark, sf, "part")
    side = max(20, int(-(-8 * (part.count() / 25.0) ** 0.5 // 1)))
    x, y = F.col("p_partkey") * 7919 % side - grown, F.expr(f"p_partkey * 104729 DIV 7 % {side}") - grown
    w, h = 1 + F.col("p_size") % 5 + 2 * grown, 1 + F.col("p_partkey") % 4 + 2 * grown
    at = lambda a, b: F.array((a * 100).cast("double"), (b * 100).cast("double"))
    ring = F.array(at(x, y), at(x + w, y), at(x + w, y + h), at(x, y + h), at(x, y))
    return part.select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("geom_id"), F.array(ring).alias("rings"))


def measured(rings: DataFrame) -> DataFrame:
    """(brand, area, length): of all rings, holes taken off."""
    along = F.aggregate(G.edges(F.col("points")), F.lit(0.0), lambda s, e: s + F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"]))
    return rounded(rings.groupBy("brand").agg(F.sum("area").alias("area"), F.sum(along).alias("length")), 3)


ORACLE_SQL["a18_union"] = f"WITH {_BOXES} {_MEASURED.format('land')}"


def a18_union(spark: SparkSession, sf: str) -> DataFrame:
    """Area and outline of the union of each brand's overlapping boxes, as closed rings."""
    return measured(overlay.union(boxes(spark, sf), "brand"))


ORACLE_SQL["u5_buffer_minus_land"] = f"WITH {_BOXES}, sea AS (SELECT * FROM near EXCEPT SELECT * FROM land) {_MEASURED.format('sea')}"


def u5_buffer_minus_land(spark: SparkSession, sf: str) -> DataFrame:
    """What lies within a hundred metres of a brand's boxes and in none of them."""
    return measured(overlay.difference(boxes(spark, sf, 1), boxes(spark, sf), "brand"))


ORACLE_SQL["g9_outline_parts"] = f"WITH {_BOXES} SELECT brand, CAST(10000 * count(*) AS DOUBLE) AS area FROM land GROUP BY 1"


def g9_outline_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The union as polygons with holes in the ring that is around them: their areas add up to the union's."""
    whole = overlay.polygons(overlay.union(boxes(spark, sf), "brand"), "brand")
    return rounded(whole.groupBy("brand").agg(F.sum(overlay.shapes_area()).alias("area")), 3)


def degrees(spark: SparkSession, sf: str) -> tuple[DataFrame, GridSpec]:
    """The environmental stack as a layer in longitude and latitude, that covers the model grid at its place in Devon."""
    m = T.scale(spark, sf)
    res = 0.0012
    spec = GridSpec(-3.6, 50.75 + (42 * m + 20) * res, res, 42 * m + 40, 38 * m + 40)
    cells = T.cells(spark, sf)
    at = lambda r, c: F.pmod(r, F.lit(c)).cast("int")
    every = grid.model_grid(spark, spec).withColumns({"_r": at(F.col("row"), 42 * m), "_c": at(F.col("col"), 38 * m)})
    return every.join(cells.withColumnsRenamed({"row": "_r", "col": "_c"}), ["_r", "_c"]).select(*KEY, "v", "t"), spec


def devon(spark: SparkSession, sf: str) -> GridSpec:
    m = T.scale(spark, sf)
    return GridSpec(290_000.0, 100_000.0 + 4200 * m, 100.0, 42 * m, 38 * m)


def r14_warp(spark: SparkSession, sf: str) -> DataFrame:
    """A layer in degrees on the model grid of the National Grid, bilinear."""
    cells, spec = degrees(spark, sf)
    target = devon(spark, sf)
    return rounded(raster.resample(cells, spec, target, grid.model_grid(spark, target), source_epsg=4326))


QUERIES |= {"a18_union": a18_union, "u5_buffer_minus_land": u5_buffer_minus_land, "g9_outline_parts": g9_outline_parts, "r14_warp": r14_warp}
