"""The shared grid: snapped bounds, cell keys, cell centres, point grids and tiles.

A raster is a table with one row per cell, keyed by (row, col). Row 0 is the northern edge, column 0 the western one.
x and y of a centre are computed from the key and never joined on.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Bounds = tuple[float, float, float, float]


@dataclass(frozen=True)
class GridSpec:
    """Western edge, northern edge, cell size, and numbers of rows and columns."""

    x0: float
    ytop: float
    res: float
    nrows: int
    ncols: int

    @staticmethod
    def from_bounds(bounds: Bounds, res: float) -> GridSpec:
        """The grid over bounds snapped outward; an upper edge that is aligned already moves by one more cell."""
        xmin, ymin, xmax, ymax = snap_bounds(bounds, res)
        return GridSpec(xmin, ymax, res, round((ymax - ymin) / res), round((xmax - xmin) / res))

    @property
    def bounds(self) -> Bounds:
        return self.x0, self.ytop - self.nrows * self.res, self.x0 + self.ncols * self.res, self.ytop

    def row(self, y: Column) -> Column:
        return F.floor((F.lit(float(self.ytop)) - y) / F.lit(float(self.res))).cast("int")

    def col(self, x: Column) -> Column:
        return F.floor((x - F.lit(float(self.x0))) / F.lit(float(self.res))).cast("int")

    def x(self, col: Column) -> Column:
        return F.lit(float(self.x0)) + (col + F.lit(0.5)) * F.lit(float(self.res))

    def y(self, row: Column) -> Column:
        return F.lit(float(self.ytop)) - (row + F.lit(0.5)) * F.lit(float(self.res))


def snap_bounds(bounds: Bounds, res: float) -> Bounds:
    xmin, ymin, xmax, ymax = bounds
    return xmin - xmin % res, ymin - ymin % res, xmax + (res - xmax % res), ymax + (res - ymax % res)


def with_cell(points: DataFrame, spec: GridSpec, x: str = "x", y: str = "y", inside: bool = True) -> DataFrame:
    """points with the row and col that they fall in; inside: only those on the grid."""
    out = points.withColumns({"row": spec.row(F.col(y)), "col": spec.col(F.col(x))})
    return out.filter(F.col("row").between(0, spec.nrows - 1) & F.col("col").between(0, spec.ncols - 1)) if inside else out


def with_centre(cells: DataFrame, spec: GridSpec) -> DataFrame:
    return cells.withColumns({"x": spec.x(F.col("col")), "y": spec.y(F.col("row"))})


def model_grid(spark: SparkSession, spec: GridSpec) -> DataFrame:
    """Every cell of the grid with its centre and the value 0."""
    keys = spark.range(spec.nrows * spec.ncols).select(F.expr(f"CAST(id DIV {spec.ncols} AS INT)").alias("row"), F.expr(f"CAST(id % {spec.ncols} AS INT)").alias("col"))
    return with_centre(keys, spec).withColumn("value", F.lit(0.0))


def _steps(low: float, high: float, size: float) -> int:
    return max(0, math.ceil((high - low) / size))


def point_grid(spark: SparkSession, bounds: Bounds, res: float) -> DataFrame:
    """Points half a step inside unsnapped bounds, both coordinates ascending."""
    xmin, ymin, xmax, ymax = bounds
    nx, ny = _steps(xmin + res / 2, xmax, res), _steps(ymin + res / 2, ymax, res)
    at = spark.range(nx * ny)
    return at.select((F.lit(xmin + res / 2) + F.expr(f"id % {max(nx, 1)}") * F.lit(float(res))).alias("x"), (F.lit(ymin + res / 2) + F.expr(f"id DIV {max(nx, 1)}") * F.lit(float(res))).alias("y"))


def offset(value: Column, origin: float, res: float) -> Column:
    """How far value lies past the last grid line."""
    return F.pmod(value - F.lit(float(origin)), F.lit(float(res)))


def align(value: Column, origin: float, res: float, decimals: int = 10) -> Column:
    return F.round(value - offset(value, origin, res), decimals)


def squares(points: DataFrame, size: float = 100.0, origin: tuple[float, float] = (0.0, 0.0), x: str = "x", y: str = "y") -> DataFrame:
    """points with the edges of the aligned grid square that each lies in, to one decimal."""
    left, bottom = align(F.col(x), origin[0], size, 1), align(F.col(y), origin[1], size, 1)
    return points.withColumns({"xmin": left, "ymin": bottom, "xmax": left + size, "ymax": bottom + size})


def pad_and_align(bounds: Bounds, tile: tuple[float, float], origin: tuple[float, float]) -> Bounds:
    """The smallest box of whole tiles around bounds."""
    (w, h), (ox, oy) = tile, origin
    xmin, ymin, xmax, ymax = bounds
    return ox + math.floor((xmin - ox) / w) * w, oy + math.floor((ymin - oy) / h) * h, ox + math.ceil((xmax - ox) / w) * w, oy + math.ceil((ymax - oy) / h) * h


def _tiles(spark: SparkSession, xmin: float, ymin: float, nx: int, ny: int, w: float, h: float) -> DataFrame:
    at = spark.range(nx * ny).select(F.expr(f"id % {max(nx, 1)}").alias("i"), F.expr(f"id DIV {max(nx, 1)}").alias("j"))
    left, bottom = F.lit(float(xmin)) + F.col("i") * F.lit(float(w)), F.lit(float(ymin)) + F.col("j") * F.lit(float(h))
    return at.select(left.alias("xmin"), bottom.alias("ymin"), (left + float(w)).alias("xmax"), (bottom + float(h)).alias("ymax"))


def tile_box(spark: SparkSession, bounds: Bounds, tile: tuple[float, float], origin: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Tiles of a lattice through origin that cover bounds."""
    xmin, ymin, xmax, ymax = pad_and_align(bounds, tile, origin)
    return _tiles(spark, xmin, ymin, round((xmax - xmin) / tile[0]), round((ymax - ymin) / tile[1]), *tile)


def tile_from_corner(spark: SparkSession, bounds: Bounds, shape: tuple[int, int], res: float) -> DataFrame:
    """Tiles of shape cells from the lower left corner; an exact multiple still gets one more tile."""
    xmin, ymin, xmax, ymax = bounds
    w, h = int(shape[0] * res), int(shape[1] * res)
    return _tiles(spark, xmin, ymin, math.floor((xmax - xmin) / w) + 1, math.floor((ymax - ymin) / h) + 1, w, h)


def total_bounds(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    return points.agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax"))


def with_tile(cells: DataFrame, size: int = 256) -> DataFrame:
    """cells with the key by which cell tables are partitioned on disk."""
    return cells.withColumn("tile", F.concat_ws("_", F.expr(f"row DIV {size}"), F.expr(f"col DIV {size}")))
