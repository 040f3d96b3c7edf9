"""Exact distance transform of a raster: how far each cell's centre is from the nearest cell of a feature.

The work is linear in the cells, times the logarithm of a line's length, however far the features are. Squared distances are
whole numbers of cells, so they are exact. Two passes, a shuffle each: along columns the nearest feature cell above or below
(windows), then along rows the lowest of the parabolas that these heights raise. Only a line of cells is ever in one task,
as long as the grid is wide or high.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import merged
from .grid import GridSpec
from .raster import KEY
from .vector import touched_cells


def lowest_parabolas(at: np.ndarray, sites: np.ndarray, heights: np.ndarray) -> np.ndarray:
    """For each of the ascending places at, the least of (place - site)^2 + height over the ascending sites.

    The best site never moves back as the place moves on. So the middle place of a stretch cuts the sites of its halves;
    all stretches of a level are looked at together, which costs about one visit of each site and place a level.
    """
    best = np.zeros(len(at), np.int64)
    lo, hi = np.array([0]), np.array([len(at)])  # stretches of places, ends exclusive
    first, last = np.array([0]), np.array([len(sites) - 1])  # their sites, ends inclusive
    while len(lo):
        middle = (lo + hi) // 2
        count = last - first + 1
        begin = np.cumsum(count) - count
        stretch = np.repeat(np.arange(len(lo)), count)
        site = np.arange(len(stretch)) - begin[stretch] + first[stretch]
        cost = (at[middle][stretch] - sites[site]) ** 2 + heights[site]
        least = np.minimum.reduceat(cost, begin)
        equal = np.flatnonzero(cost == least[stretch])
        _, earliest = np.unique(stretch[equal], return_index=True)
        chosen = site[equal[earliest]]
        best[middle] = chosen
        lo, hi, first, last = (np.concatenate(x) for x in ((lo, middle + 1), (middle, hi), (first, chosen), (chosen, last)))
        left = lo < hi
        lo, hi, first, last = lo[left], hi[left], first[left], last[left]
    return (at - sites[best]) ** 2 + heights[best]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows row, col, height in order, of whole lines; a line may go on in the next batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        row = table.column("row").to_numpy()
        if not len(row):
            continue
        cut = int(np.searchsorted(row, row[-1]))
        held = table.slice(cut)
        yield from _solved(table.slice(0, cut))
    if held is not None:
        yield from _solved(held)


def _solved(table: pa.Table) -> Iterator[pa.RecordBatch]:
    row, col = table.column("row").to_numpy(), table.column("col").to_numpy().astype(np.int64)
    height = table.column("height")
    known, height = ~height.is_null().to_numpy(), height.fill_null(0).to_numpy()
    edges = np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1, [len(row)]]) if len(row) else np.array([0])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        site = np.flatnonzero(known[a:b]) + a
        found = lowest_parabolas(col[a:b], col[site], height[site]) if len(site) else None
        squared = pa.nulls(b - a, pa.int64()) if found is None else pa.array(found)
        yield pa.RecordBatch.from_arrays([pa.array(row[a:b], pa.int32()), pa.array(col[a:b], pa.int32()), squared], ["row", "col", "squared"])


def distance_transform(cells: DataFrame, features: DataFrame, res: float = 1.0) -> DataFrame:
    """(row, col, squared, distance) for every cell: the squared number of cells to the nearest feature cell, 0 in one, and that
    distance in map units.

    cells must be dense in the rows and columns where features are (a model grid is); features are keys row, col, repeated
    keys count once, and keys that aren't in cells or are null have no effect. Without any features both values are null.
    """
    marked = features.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col")).distinct().withColumn("_at", F.col("row"))
    keys = cells.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"))
    every = keys.join(merged(marked), KEY, "left")
    line = Window.partitionBy("col").orderBy("row")
    above = F.last("_at", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, 0))
    # From the other end: a frame up to a line's end is gone through anew for every row, which is a line's length squared.
    below = F.last("_at", ignorenulls=True).over(Window.partitionBy("col").orderBy(F.desc("row")).rowsBetween(Window.unboundedPreceding, 0))
    steps = F.least(F.col("row") - above, below - F.col("row")).cast("long")  # least() passes over a null
    high = every.select(*KEY, (steps * steps).alias("height"))
    found = high.repartition("row").sortWithinPartitions(*KEY).mapInArrow(_lines, "row int, col int, squared long")
    return found.withColumn("distance", F.sqrt("squared") * F.lit(float(res)))


def within_of(cells: DataFrame, features: DataFrame, d: float, res: float = 1.0) -> DataFrame:
    """Keys of the cells whose centre is d map units or less from that of a feature cell."""
    return distance_transform(cells, features, res).filter(F.col("squared") * F.lit(float(res) ** 2) <= F.lit(float(d) ** 2)).select(*KEY)


def within_of_polygons(layer: DataFrame, spec: GridSpec, cells: DataFrame, d: float) -> DataFrame:
    """Keys of the cells within d of a cell that a polygon of layer touches: a buffered boundary as a mask. Distances are those
    of cell centres, so the mask is right to a cell's diagonal."""
    return within_of(cells, touched_cells(layer, spec), d, spec.res)
