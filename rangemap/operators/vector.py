"""Polygons and lines on the grid: rasterising, cover, clipping masks, dissolving, simplifying.

A layer has geom_id and rings (array of rings of [x, y]; for a line, one open ring). Heavy work runs on the segment
table, one row per edge, so that a long coastline spreads over tasks like anything else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import merged
from .grid import GridSpec
from .raster import KEY


def segments(layer: DataFrame, *keep: str) -> DataFrame:
    """(geom_id, *keep, x1, y1, x2, y2)."""
    return layer.select("geom_id", *keep, F.explode(G.all_edges(F.col("rings"))).alias("e")).select("geom_id", *keep, "e.*")


def _clamped(value: Column, n: int) -> Column:
    return F.least(F.greatest(value, F.lit(0)), F.lit(n - 1))


def polygon_cells(layer: DataFrame, spec: GridSpec) -> DataFrame:
    """(geom_id, row, col) of cells whose centre lies in a polygon. Scan lines: each edge meets the rows it crosses, and
    between every odd and even crossing of a row lie the cells."""
    y0, x0, res = F.lit(float(spec.ytop)), F.lit(float(spec.x0)), F.lit(float(spec.res))
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    # Rows with lo <= centre < hi.
    first = F.greatest(F.floor((y0 - hi) / res - 0.5).cast("int") + 1, F.lit(0))
    last = F.least(F.floor((y0 - lo) / res - 0.5).cast("int"), F.lit(spec.nrows - 1))
    rows = segments(layer).filter("y1 <> y2").select("*", first.alias("a"), last.alias("b")).filter("a <= b").withColumn("row", F.explode(F.sequence("a", "b")))
    y = spec.y(F.col("row"))
    at = rows.select("geom_id", "row", (F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1"))).alias("at"))
    lines = at.groupBy("geom_id", "row").agg(F.sort_array(F.collect_list("at")).alias("xs"))
    spans = lines.select("geom_id", "row", F.explode(F.sequence(F.lit(0), F.expr("size(xs) DIV 2 - 1"))).alias("i"), "xs").select("geom_id", "row", F.expr("xs[2 * i]").alias("l"), F.expr("xs[2 * i + 1]").alias("r"))
    # Columns with l <= centre < r.
    spans = spans.select("geom_id", "row", F.greatest(F.ceil((F.col("l") - x0) / res - 0.5).cast("int"), F.lit(0)).alias("a"), F.least(F.ceil((F.col("r") - x0) / res - 0.5).cast("int") - 1, F.lit(spec.ncols - 1)).alias("b")).filter("a <= b")
    return spans.select("geom_id", "row", F.explode(F.sequence("a", "b")).alias("col"))


def edge_cells(edges: DataFrame, spec: GridSpec) -> DataFrame:
    """edges (x1, y1, x2, y2 and more), each once in each cell (row, col) that it passes through, row by row along it."""
    y0, res = F.lit(float(spec.ytop)), F.lit(float(spec.res))
    seg = edges.withColumns({"_top": F.greatest("y1", "y2"), "_low": F.least("y1", "y2")})
    seg = seg.withColumns({"_a": spec.row(F.col("_top")), "_b": spec.row(F.col("_low"))}).filter((F.col("_b") >= 0) & (F.col("_a") < spec.nrows))
    rows = seg.withColumn("row", F.explode(F.sequence(_clamped(F.col("_a"), spec.nrows), _clamped(F.col("_b"), spec.nrows))))
    upper, lower = F.least(F.col("_top"), y0 - F.col("row") * res), F.greatest(F.col("_low"), y0 - (F.col("row") + 1) * res)

    def x_at(y: Column) -> Column:
        return F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1"))

    flat = F.col("y1") == F.col("y2")
    xa, xb = F.when(flat, F.col("x1")).otherwise(x_at(upper)), F.when(flat, F.col("x2")).otherwise(x_at(lower))
    cols = rows.select(*edges.columns, "row", spec.col(F.least(xa, xb)).alias("_a"), spec.col(F.greatest(xa, xb)).alias("_b")).filter((F.col("_b") >= 0) & (F.col("_a") < spec.ncols))
    return cols.select(*edges.columns, "row", F.explode(F.sequence(_clamped(F.col("_a"), spec.ncols), _clamped(F.col("_b"), spec.ncols))).alias("col"))


def line_cells(layer: DataFrame, spec: GridSpec) -> DataFrame:
    """Distinct (geom_id, row, col) of cells that an edge passes through, row by row along the edge."""
    return edge_cells(segments(layer), spec).select("geom_id", *KEY).distinct()


def touched_cells(layer: DataFrame, spec: GridSpec) -> DataFrame:
    """(geom_id, row, col) of cells that meet a polygon at all: centres inside, or an edge passing through."""
    return polygon_cells(layer, spec).unionByName(line_cells(layer, spec)).distinct()


def rasterise(layer: DataFrame, spec: GridSpec, grid: DataFrame, lines: bool = False) -> DataFrame:
    """The dense grid with value 1 in cells of any geometry and 0 elsewhere."""
    found = (line_cells if lines else polygon_cells)(layer, spec).select(*KEY).distinct().withColumn("value", F.lit(1))
    return grid.select(*KEY).join(merged(found), KEY, "left").select(*KEY, F.coalesce("value", F.lit(0)).cast("int").alias("value"))


def feature_cover(layers: dict[str, tuple[DataFrame, bool]], spec: GridSpec, grid: DataFrame, base: float = 10.0) -> DataFrame:
    """row, col and, for each layer (rows, whether lines), how many of its cells at base resolution are covered."""
    k = spec.res / base
    if k != int(k):
        raise ValueError("the target resolution is no multiple of the base resolution")
    k = int(k)
    fine = GridSpec(spec.x0, spec.ytop, base, spec.nrows * k, spec.ncols * k)
    out = grid.select(*KEY)
    for name, (layer, lines) in layers.items():
        hit = (line_cells if lines else polygon_cells)(layer, fine).select(*KEY).distinct()
        share = hit.groupBy(F.expr(f"CAST(row DIV {k} AS INT)").alias("row"), F.expr(f"CAST(col DIV {k} AS INT)").alias("col")).agg(F.count("*").alias(name))
        out = out.join(merged(share), KEY, "left")
    return out.na.fill(0, subset=list(layers))


def rows_of(edges: DataFrame, spec: GridSpec) -> DataFrame:
    """edges, each once in each row that it meets."""
    edges = edges.withColumns({"_a": spec.row(F.greatest("y1", "y2")), "_b": spec.row(F.least("y1", "y2"))}).filter((F.col("_b") >= 0) & (F.col("_a") < spec.nrows))
    return edges.withColumn("row", F.explode(F.sequence(_clamped(F.col("_a"), spec.nrows), _clamped(F.col("_b"), spec.nrows)))).drop("_a", "_b")


def point_in_layer(points: DataFrame, layer: DataFrame, spec: GridSpec, point_id: str = "point_id") -> DataFrame:
    """Distinct (point_id, geom_id) of each point inside each polygon, on spec, a grid of the caller's choice that covers all.

    A cell that no edge of a polygon enters lies inside or outside as a whole, as its centre does. In the others a point's
    crossings with the polygon's edges in the cell's row decide; no geometry is joined as a whole.
    """
    keyed = points.select(point_id, "x", "y", spec.row(F.col("y")).alias("row"), spec.col(F.col("x")).alias("col")).distinct()
    entered = line_cells(layer, spec)
    whole = polygon_cells(layer, spec).join(merged(entered), ["geom_id", *KEY], "left_anti")
    sure = keyed.join(merged(whole), KEY).select(point_id, "geom_id")
    edges = rows_of(segments(layer).filter("y1 <> y2"), spec)
    x, y = F.col("x"), F.col("y")
    crosses = ((F.col("y1") > y) != (F.col("y2") > y)) & (x < (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    met = keyed.join(merged(entered), KEY).join(merged(edges), ["geom_id", "row"]).filter(crosses)
    odd = met.groupBy(point_id, "x", "y", "geom_id").agg(F.count("*").alias("_n")).filter("_n % 2 = 1")
    return sure.unionByName(odd.select(point_id, "geom_id")).distinct()


def split_roads(roads: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Major roads (motorways and A roads) and the others; an unknown class is minor."""
    major = F.coalesce(F.col(column).rlike("Motorway*|A Road*"), F.lit(False))
    marked = roads.withColumn("major_road", major)
    return marked.filter("major_road"), marked.filter("NOT major_road")


def parts(layer: DataFrame, column: str = "parts") -> DataFrame:
    """One row per part of a multi-part geometry: geom_id, part, rings."""
    return layer.select("geom_id", F.posexplode(column).alias("part", "rings"))


def large_parts(layer: DataFrame, least_km2: float) -> DataFrame:
    """Polygons whose outer ring (the first) is larger than this."""
    return layer.filter(G.ring_area(F.col("rings")[0]) / 1e6 > least_km2)


def valid(layer: DataFrame) -> DataFrame:
    """Polygons with only the rings that are closed and have an area; those without any are dropped."""
    return layer.withColumn("rings", F.filter("rings", G.valid_ring)).filter(F.size("rings") > 0)


def simplify(layer: DataFrame, tolerance: float) -> DataFrame:
    return layer.withColumn("rings", F.transform("rings", lambda r: G.thinned(r, tolerance)))


def dissolved_edges(layer: DataFrame, by: str) -> DataFrame:
    """(by, x1, y1, x2, y2): a group's outline. An edge that two of its polygons share occurs twice and falls away.

    Edges are dealt before they are counted: hardly any is twice in a task that reads polygons, and counts kept there would
    hold all edges of its file, however many polygons that is."""
    swap = (F.col("x1") > F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") > F.col("y2")))
    pick = lambda a, b: F.when(swap, F.col(b)).otherwise(F.col(a))
    plain = segments(layer, by).select(by, pick("x1", "x2").alias("x1"), pick("y1", "y2").alias("y1"), pick("x2", "x1").alias("x2"), pick("y2", "y1").alias("y2"))
    edge = [by, "x1", "y1", "x2", "y2"]
    return plain.repartition(*edge).groupBy(*edge).count().filter("count % 2 = 1").drop("count")


def dissolve(layer: DataFrame, by: str) -> DataFrame:
    """(by, part, rings): a multi-part geometry per group, a row per part, named by the polygon it was; a point is inside a
    group if it is inside any part. A group may hold any number of polygons, so they stay rows."""
    return layer.select(by, F.col("geom_id").alias("part"), "rings")


def difference_cells(near: DataFrame, land: DataFrame) -> DataFrame:
    """Cells of near that are not in land: a buffer minus land is the sea within its distance."""
    return near.join(merged(land.select(*KEY).distinct()), KEY, "left_anti")


#: So many rows of a region map are broadcast at most.
MAPPED = 10_000


def join_regions(counties: DataFrame, regions: DataFrame, on: str) -> DataFrame:
    """Counties that the region map names, with their region. A mapped county that is absent is an error.

    A short map goes to the counties, whatever size Spark takes them for: their files may be small and the shapes in them are
    not, and dealt by name the counties of one region would meet in one task."""
    absent = regions.join(counties.select(on).distinct(), on, "left_anti").limit(20).collect()
    if absent:
        raise ValueError(f"not among the counties: {[r[on] for r in absent]}")
    return counties.join(F.broadcast(regions) if regions.limit(MAPPED + 1).count() <= MAPPED else merged(regions), on)


def whole_rings(layer: DataFrame) -> DataFrame:
    return layer.filter(F.forall("rings", G.valid_ring))
