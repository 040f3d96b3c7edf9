"""Raster algebra on cell tables: merging, coarsening, clipping, resampling, gap filling, statistics.

Missing values are NULL; NaN and sentinels become NULL when a table is read (see sources.tables.clean_bands).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.geometry import reproject
from ..functions.scalars import tidy_name
from .grid import GridSpec

KEY = ["row", "col"]


def bands_of(cells: DataFrame) -> list[str]:
    return [c for c in cells.columns if c not in {*KEY, "x", "y", "tile"}]


def merge_layers(layers: dict[str, DataFrame]) -> DataFrame:
    """One wide table of all layers' bands on the union of their cells. A band name in two layers is an error.

    Layers are stacked and aggregated once per cell, so k layers cost one shuffle and not k joins; the aggregate combines
    before the shuffle. A layer's repeated cell takes its largest value.
    """
    names = [b for cells in layers.values() for b in bands_of(cells)]
    if len(names) != len(set(names)):
        raise ValueError(f"bands occur twice: {sorted({b for b in names if names.count(b) > 1})}")
    kinds = {f.name: f.dataType for cells in layers.values() for f in cells.schema}
    parts = [cells.select(*KEY, *(F.col(f"`{b}`") if b in cells.columns else F.lit(None).cast(kinds[b]).alias(b) for b in names)) for cells in layers.values()]
    return reduce(DataFrame.unionByName, parts).groupBy(*KEY).agg(*(F.max(f"`{b}`").alias(b) for b in names))


def mosaic(tiles: list[DataFrame], order: str) -> DataFrame:
    """All tiles' cells; where they overlap, the row with the smallest order column."""
    rows = reduce(DataFrame.unionByName, tiles)
    values = [c for c in rows.columns if c not in KEY]
    first = F.min(F.struct(F.col(order).alias("_order"), *values))
    return rows.groupBy(*KEY).agg(first.alias("_first")).select(*KEY, *(F.col(f"_first.{c}").alias(c) for c in values))


def _block(k: int) -> list[Column]:
    return [F.expr(f"CAST(row DIV {k} AS INT)").alias("row"), F.expr(f"CAST(col DIV {k} AS INT)").alias("col")]


def coarsen_sum(cells: DataFrame, spec: GridSpec, k: int, strict: bool = False) -> DataFrame:
    """Sums over k x k blocks; blocks that the grid's edge cuts are left out. Nulls are skipped, and an all-null block is
    0; strict: a block with a null or absent cell is null."""
    whole = cells.filter((F.col("row") < spec.nrows // k * k) & (F.col("col") < spec.ncols // k * k))
    if strict:
        made = [F.when(F.count(b) == k * k, F.sum(b)).alias(b) for b in bands_of(cells)]
    else:
        made = [F.coalesce(F.sum(b), F.lit(0.0)).alias(b) for b in bands_of(cells)]
    return whole.groupBy(*_block(k)).agg(*made)


def coarsen_stats(cells: DataFrame, k: int, band: str, prefix: str, target_res: int) -> DataFrame:
    """Mean, min, max and population std over k x k blocks, partial ones too, named {prefix}_{stat}_{res}m. With k of 1
    or less, the same of the whole raster in one row."""
    stats = {"mean": F.avg(band), "min": F.min(band), "max": F.max(band), "std": F.stddev_pop(band)}
    made = [v.alias(f"{prefix}_{s}_{target_res}m") for s, v in stats.items()]
    return cells.groupBy(*_block(k)).agg(*made) if k > 1 else cells.agg(*made)


def band_statistics(cells: DataFrame) -> DataFrame:
    """One row per band: mean, population std, min, max. One pass over all bands."""
    bands = bands_of(cells)
    row = cells.agg(*(F.struct(F.avg(b).alias("mean"), F.stddev_pop(b).alias("std"), F.min(b).cast("double").alias("min"), F.max(b).cast("double").alias("max")).alias(b) for b in bands))
    return row.select(F.explode(F.array(*(F.struct(F.lit(b).alias("variable"), F.col(b).alias("s")) for b in bands))).alias("e")).select("e.variable", "e.s.mean", "e.s.std", "e.s.min", "e.s.max")


def point_counts(points: DataFrame, spec: GridSpec, grid: DataFrame) -> DataFrame:
    """Points per cell on the dense grid, 0 where there are none. A point on the outer eastern or southern edge counts in
    the last cell, as the last bin of a histogram is closed."""
    row, col = spec.row(F.col("y")), spec.col(F.col("x"))
    row = F.when((F.col("y") == F.lit(float(spec.bounds[1]))), F.lit(spec.nrows - 1)).otherwise(row)
    col = F.when((F.col("x") == F.lit(float(spec.bounds[2]))), F.lit(spec.ncols - 1)).otherwise(col)
    found = points.select(row.alias("row"), col.alias("col")).groupBy(*KEY).agg(F.count("*").alias("n"))
    return grid.select(*KEY).join(found, KEY, "left").select(*KEY, F.coalesce("n", F.lit(0)).cast("double").alias("value"))


def box_keys(spec: GridSpec, bounds: tuple[float, float, float, float]) -> tuple[int, int, int, int]:
    """First and last row, first and last col of the cells whose centres lie in the box. Centres are computed as GridSpec.x and
    y do, so that a centre on the border falls on the same side; a first after its last is an empty box."""
    xmin, ymin, xmax, ymax = bounds
    x, y = (lambda c: spec.x0 + (c + 0.5) * spec.res), (lambda r: spec.ytop - (r + 0.5) * spec.res)

    def first(guess: float, reached) -> int:
        """The least whole number that has reached a bound, near guess."""
        n = math.floor(guess) - 2
        while not reached(n):
            n += 1
        return n

    cols = first((xmin - spec.x0) / spec.res - 0.5, lambda c: x(c) >= xmin), first((xmax - spec.x0) / spec.res - 0.5, lambda c: x(c) > xmax) - 1
    rows = first((spec.ytop - ymax) / spec.res - 0.5, lambda r: y(r) <= ymax), first((spec.ytop - ymin) / spec.res - 0.5, lambda r: y(r) < ymin) - 1
    return *rows, *cols


def clip_box(cells: DataFrame, spec: GridSpec, bounds: tuple[float, float, float, float]) -> DataFrame:
    """Cells whose centres lie in the box: bounds on the stored keys, which reach the scan and prune its row groups."""
    r0, r1, c0, c1 = box_keys(spec, bounds)
    return cells.filter(F.col("row").between(r0, r1) & F.col("col").between(c0, c1))


def clip_cells(cells: DataFrame, inside: DataFrame) -> DataFrame:
    """Cells whose key is in inside (see vector.polygon_cells)."""
    return cells.join(inside.select(*KEY).distinct(), KEY, "left_semi")


def interpolate_gaps(cells: DataFrame, bands: list[str] | None = None) -> DataFrame:
    """Fill nulls between known neighbours linearly, along columns first, then along rows; no extrapolation.

    Gaps must be rows with a null (see densify). Two shuffles, for all bands together; frames only grow, so a line costs its
    length.
    """
    for across, along in (("col", "row"), ("row", "col")):
        back = Window.partitionBy(across).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
        ahead = Window.partitionBy(across).orderBy(F.desc(along)).rowsBetween(Window.unboundedPreceding, -1)
        made = {}
        for b in bands or bands_of(cells):
            at = F.when(F.col(b).isNotNull(), F.col(along))
            v0, v1 = F.last(b, True).over(back), F.last(b, True).over(ahead)
            p0, p1 = F.last(at, True).over(back), F.last(at, True).over(ahead)
            made[b] = F.coalesce(F.col(b), v0 + (v1 - v0) * (F.col(along) - p0) / (p1 - p0))
        cells = cells.withColumns(made)
    return cells


def densify(cells: DataFrame, grid: DataFrame) -> DataFrame:
    """cells with a null row for every cell of grid that they lack."""
    return grid.select(*KEY).join(cells, KEY, "left")


def resample(cells: DataFrame, source: GridSpec, target: GridSpec, targets: DataFrame, method: str = "bilinear", source_epsg: int = 27700, target_epsg: int = 27700) -> DataFrame:
    """Bands at the target grid's centres: bilinear (weights of known neighbours, renormalised), nearest, or average of
    the source cells whose centres fall in a target cell.

    Grids of different reference systems: each target centre is projected back by itself (for averages, each source centre
    forward), a narrow map of arithmetic, and finds its place among the source's cells without any mesh's error.
    """
    bands = bands_of(cells)
    if method == "average":
        centres = reproject(cells.withColumns({"_px": source.x(F.col("col")), "_py": source.y(F.col("row"))}), source_epsg, target_epsg, "_px", "_py")
        keyed = centres.select(target.row(F.col("_py")).alias("trow"), target.col(F.col("_px")).alias("tcol"), *bands)
        found = keyed.groupBy(F.col("trow").alias("row"), F.col("tcol").alias("col")).agg(*(F.avg(b).alias(b) for b in bands))
        return targets.select(*KEY).join(found, KEY, "left")
    fx = (F.col("_px") - F.lit(float(source.x0))) / float(source.res)
    fy = (F.lit(float(source.ytop)) - F.col("_py")) / float(source.res)
    centres = reproject(targets.select(*KEY, target.x(F.col("col")).alias("_px"), target.y(F.col("row")).alias("_py")), target_epsg, source_epsg, "_px", "_py")
    at = centres.select(F.col("row").alias("trow"), F.col("col").alias("tcol"), fx.alias("fx"), fy.alias("fy"))
    if method == "nearest":
        at = at.select("trow", "tcol", F.floor("fy").cast("int").alias("row"), F.floor("fx").cast("int").alias("col"))
        return at.join(cells, KEY, "left").select(F.col("trow").alias("row"), F.col("tcol").alias("col"), *bands)
    if method != "bilinear":
        raise ValueError(f"no such method: {method}")
    at = at.select("trow", "tcol", F.floor(F.col("fx") - 0.5).cast("int").alias("c0"), F.floor(F.col("fy") - 0.5).cast("int").alias("r0"), "fx", "fy")
    wx, wy = F.col("fx") - 0.5 - F.col("c0"), F.col("fy") - 0.5 - F.col("r0")
    corners = [F.struct((F.col("r0") + i).alias("row"), (F.col("c0") + j).alias("col"), ((wy if i else 1 - wy) * (wx if j else 1 - wx)).alias("w")) for i in (0, 1) for j in (0, 1)]
    near = at.select("trow", "tcol", F.explode(F.array(*corners)).alias("p")).select("trow", "tcol", "p.*").filter("w > 0")
    made = [(F.sum(F.col("w") * F.col(b)) / F.sum(F.when(F.col(b).isNotNull(), F.col("w")))).alias(b) for b in bands]
    return near.join(cells, KEY, "left").groupBy(F.col("trow").alias("row"), F.col("tcol").alias("col")).agg(*made)


def z_score(cells: DataFrame, bands: list[str], eps: float = 1e-8) -> DataFrame:
    """Bands minus their mean over max(population std, eps)."""
    stats = cells.agg(*(x for b in bands for x in (F.avg(b).alias(f"_m_{b}"), F.stddev_pop(b).alias(f"_s_{b}"))))
    out = cells.crossJoin(F.broadcast(stats))  # one row
    return out.select(*(c for c in cells.columns if c not in bands), *(((F.col(b) - F.col(f"_m_{b}")) / F.greatest(F.col(f"_s_{b}"), F.lit(eps))).alias(b) for b in bands))


def min_max(cells: DataFrame, bands: list[str], clip: bool = True) -> DataFrame:
    """Bands scaled to their own range, in 0..1; a constant band is 0.5. clip is for values scaled by another range."""
    stats = cells.agg(*(x for b in bands for x in (F.min(b).alias(f"_l_{b}"), F.max(b).alias(f"_h_{b}"))))

    def scaled(b: str) -> Column:
        lo, hi = F.col(f"_l_{b}"), F.col(f"_h_{b}")
        v = (F.col(b) - lo) / (hi - lo)
        v = F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0))) if clip else v
        return F.when(F.col(b).isNotNull() & (lo == hi), F.lit(0.5)).otherwise(F.when(lo != hi, v)).alias(b)

    return cells.crossJoin(F.broadcast(stats)).select(*(c for c in cells.columns if c not in bands), *map(scaled, bands))


def layer_paths(items: list[str]) -> dict[str, str]:
    """`name=path` items to paths by name; a bare path is named by its file's stem."""
    out = {}
    for item in items:
        name, has_name, path = item.partition("=")
        path = path if has_name else item
        name = name if has_name else path.rstrip("/").rsplit("/", 1)[-1].split(".")[0]
        if name in out:
            raise ValueError(f"two layers named {name}")
        out[name] = path
    return out


def merge_on_grid(layers: dict[str, tuple[DataFrame, GridSpec]], spec: GridSpec, targets: DataFrame, inside: DataFrame | None = None) -> DataFrame:
    """Layers on their own grids to one stack on spec's: bands named by the layer, or {layer}_{band} where it has several,
    tidied; resampled bilinearly unless they are on the grid already; merged; cut to inside."""
    placed = {}
    for name, (cells, own) in layers.items():
        bands = bands_of(cells)
        names = {b: tidy_name(name if len(bands) == 1 else f"{name}_{b}") for b in bands}
        moved = cells if own == spec else resample(cells, own, spec, targets)
        placed[name] = moved.select(*KEY, *(F.col(f"`{b}`").cast("double").alias(n) for b, n in names.items()))
    out = merge_layers(placed)
    return clip_cells(out, inside) if inside is not None else out
