"""Moving windows on rasters, in two passes of one-dimensional windows.

Sums, counts, minima and maxima over a square are separable: along each row first, then along each column on the first
results. Two shuffles, whatever the window or the number of bands. A window of size w reaches w // 2 cells back and
w - 1 - w // 2 ahead. Strict: a window with a null or absent cell is null.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .raster import KEY, bands_of


def _span(across: str, along: str, low: int, high: int):
    return Window.partitionBy(across).orderBy(along).rangeBetween(low, high)


def _reach(w: int) -> tuple[int, int]:
    return -(w // 2), w - 1 - w // 2


def focal(cells: DataFrame, windows: list[int], bands: list[str], parts: dict[str, Callable[[str], tuple[Callable[[Column], Column], Column]]]) -> DataFrame:
    """cells with _{part}_{band}_{w} for each part: (aggregate, first-pass value) of the band's name."""
    first, second = {}, {}
    for w in windows:
        for b in bands:
            for name, part in parts.items():
                how, value = part(b)
                out = f"_{name}_{b}_{w}"
                first[out] = how(value).over(_span("row", "col", *_reach(w)))
                second[out] = how(F.col(out)).over(_span("col", "row", *_reach(w)))
    return cells.withColumns(first).withColumns(second)


SUM = {"s": lambda b: (F.sum, F.col(b)), "n": lambda b: (F.sum, F.col(b).isNotNull().cast("long"))}
SQUARE = {"q": lambda b: (F.sum, F.col(b) * F.col(b))}


def multiscale_mean(cells: DataFrame, windows: list[int], res: float = 100.0, bands: list[str] | None = None, strict: bool = True) -> DataFrame:
    """row, col and, for each band and window, the mean as {band}_{round(w / 2 * res)}m."""
    bands = bands or bands_of(cells)
    out = focal(cells, windows, bands, SUM)

    def mean(b: str, w: int) -> Column:
        n = F.col(f"_n_{b}_{w}")
        return F.when(n == w * w if strict else n > 0, F.col(f"_s_{b}_{w}") / n).alias(f"{b}_{round(w / 2 * res)}m")

    return out.select(*KEY, *(mean(b, w) for b in bands for w in windows))


def focal_std(cells: DataFrame, band: str, window: int = 3, name: str = "roughness") -> DataFrame:
    """Population std over each full window. Values are taken from the band's mean first, against cancellation."""
    mean = cells.agg(F.avg(band).alias("_mean"))
    centred = cells.crossJoin(F.broadcast(mean)).withColumn("_v", F.col(band) - F.col("_mean"))  # one row
    out = focal(centred, [window], ["_v"], SUM | SQUARE)
    n, s, q = (F.col(f"_{p}__v_{window}") for p in "nsq")
    std = F.sqrt(F.greatest(q / n - (s / n) * (s / n), F.lit(0.0)))
    return out.select(*KEY, F.when(n == window * window, std).alias(name))


def position_index(cells: DataFrame, band: str, window: int = 3, name: str = "tpi") -> DataFrame:
    """The value minus the mean of its full window."""
    out = focal(cells, [window], [band], SUM)
    n = F.col(f"_n_{band}_{window}")
    return out.select(*KEY, F.when(n == window * window, F.col(band) - F.col(f"_s_{band}_{window}") / n).alias(name))


def ruggedness_index(cells: DataFrame, band: str, window: int = 3, name: str = "tri") -> DataFrame:
    """sqrt of the sum of squared differences to the centre over each full window. Values are taken from the band's mean
    first, against cancellation."""
    mean = cells.agg(F.avg(band).alias("_mean"))
    centred = cells.crossJoin(F.broadcast(mean)).withColumn("_v", F.col(band) - F.col("_mean"))  # one row
    out = focal(centred, [window], ["_v"], SUM | SQUARE)
    n, s, q = (F.col(f"_{p}__v_{window}") for p in "nsq")
    v = F.col("_v")
    return out.select(*KEY, F.when(n == window * window, F.sqrt(F.greatest(q - 2 * v * s + n * v * v, F.lit(0.0)))).alias(name))


def focal_extreme(cells: DataFrame, band: str, window: int, how: str, name: str | None = None) -> DataFrame:
    """Smallest or largest known value of each window; how: "min" or "max"."""
    pick = {"min": F.min, "max": F.max}[how]
    out = focal(cells, [window], [band], {"e": lambda b: (pick, F.col(b))})
    return out.select(*KEY, F.col(f"_e_{band}_{window}").alias(name or band))


#: So many classes of a layer are told apart by bits.
CLASSES = 512


def diversity(cells: DataFrame, band: str, window: int, name: str = "diversity") -> DataFrame:
    """Number of distinct classes in each window of a layer that has all cells of its grid; null counts for none.

    A class is a bit of one of few words of 62, by its rank among the band's classes, and words are joined by "or" along rows
    and then along columns. Beyond CLASSES classes, cells' classes are sent to the windows and counted there instead.
    """
    a, b = _reach(window)
    classes = sorted(r[0] for r in cells.select(band).filter(F.col(band).isNotNull()).distinct().limit(CLASSES + 1).collect())
    if len(classes) > CLASSES:
        spread = lambda col: F.explode(F.sequence(F.col(col) - b, F.col(col) - a)).alias(col)
        along = cells.filter(F.col(band).isNotNull()).select("row", spread("col"), band).distinct()
        found = along.select(spread("row"), "col", band).distinct().groupBy(*KEY).agg(F.count("*").cast("int").alias(name))
        return cells.select(*KEY).join(found, KEY, "left").na.fill(0, [name])
    size, kind = 62, cells.schema[band].dataType
    words = [classes[i : i + size] for i in range(0, len(classes), size)]
    out = cells.select(*KEY, band)
    for i, word in enumerate(words):
        bits = F.create_map(*(x for k, c in enumerate(word) for x in (F.lit(c).cast(kind), F.lit(1 << k).cast("long"))))
        out = out.withColumn(f"_w{i}", F.when(F.col(band).isNotNull(), F.coalesce(bits[F.col(band)], F.lit(0).cast("long"))))
    for across, along in (("row", "col"), ("col", "row")):
        out = out.withColumns({f"_w{i}": F.bit_or(f"_w{i}").over(_span(across, along, a, b)) for i in range(len(words))})
    count = reduce(Column.__add__, (F.bit_count(F.coalesce(f"_w{i}", F.lit(0).cast("long"))) for i in range(len(words))), F.lit(0))
    return out.select(*KEY, count.cast("int").alias(name))


def dominance(cells: DataFrame, band: str, window: int, name: str = "dominance") -> DataFrame:
    """Share of the most frequent class among the known cells of each window.

    Counts per class go to the window's cells of a row first and are summed there before they go to those of a column,
    so a cell is copied window and not window squared times.
    """
    a, b = _reach(window)
    known = cells.filter(F.col(band).isNotNull()).select(*KEY, F.col(band).alias("class"))
    spread = lambda col: F.explode(F.sequence(F.col(col) - b, F.col(col) - a)).alias(col)
    along = known.select("row", spread("col"), "class").groupBy(*KEY, "class").agg(F.count("*").alias("n"))
    both = along.select(spread("row"), "col", "class", "n").groupBy(*KEY, "class").agg(F.sum("n").alias("n"))
    share = both.groupBy(*KEY).agg((F.max("n") / F.sum("n")).alias(name))
    return cells.select(*KEY).join(share, KEY, "left")


def neighbours(cells: DataFrame, band: str) -> DataFrame:
    """cells with a struct n of the eight neighbours' values: nw, north, ne, west, east, sw, south, se.

    Neighbours stand one step apart along a row, a column or a diagonal, so four windows give all eight, each of one
    step, whatever cells are absent in between. Four shuffles.
    """
    row, col = F.col("row"), F.col("col")
    lines = {"west": (row, col, -1), "east": (row, col, 1), "north": (col, row, -1), "south": (col, row, 1), "nw": (row - col, row, -1), "se": (row - col, row, 1), "ne": (row + col, row, -1), "sw": (row + col, row, 1)}
    order = ("nw", "north", "ne", "west", "east", "sw", "south", "se")
    out = cells.withColumns({f"_{k}": F.max(band).over(Window.partitionBy(line).orderBy(along).rangeBetween(d, d)) for k, (line, along, d) in lines.items()})
    return out.withColumn("n", F.struct(*(F.col(f"_{k}").alias(k) for k in order))).drop(*(f"_{k}" for k in order))


def focal_apply(cells: DataFrame, band: str, window: int, fn: Callable[[Column], Column], name: str) -> DataFrame:
    """fn of the array of all values in each full window, by rows from the north and from west to east; else null."""
    a, b = _reach(window)
    rows = cells.withColumn("_row", F.sort_array(F.collect_list(F.struct(F.col("col"), F.col(band).alias("v"))).over(_span("row", "col", a, b))))
    both = rows.withColumn("_all", F.sort_array(F.collect_list(F.struct(F.col("row").alias("r"), F.col("_row").alias("c"))).over(_span("col", "row", a, b))))
    values = F.flatten(F.transform("_all", lambda r: F.transform(r["c"], lambda c: c["v"])))
    full = (F.size(values) == window * window) & ~F.exists(values, lambda v: v.isNull())
    return both.select(*KEY, F.when(full, fn(values)).alias(name))


def gaussian(cells: DataFrame, nrows: int, ncols: int, band: str, sigma: float = 1.5, cut: float = 4.0, name: str | None = None) -> DataFrame:
    """Gaussian smoothing of a dense raster (a row for every cell; nulls weigh nothing), mirrored at the edges, one axis
    after the other. A window gives each cell its neighbours along a line and their weighted sum is taken in place: two
    shuffles, and no cell is copied."""
    reach = int(cut * sigma + 0.5)
    weights = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-reach, reach + 1)]
    total = sum(weights)
    out = cells.select(*KEY, F.col(band).cast("double").alias("_v"))
    for axis, n in (("row", nrows), ("col", ncols)):
        line = Window.partitionBy("col" if axis == "row" else "row").orderBy(axis).rowsBetween(-reach, reach)
        out = out.withColumn("_near", F.collect_list(F.struct("_v")).over(line))
        first = F.greatest(F.col(axis) - reach, F.lit(0))
        terms = []
        for d, w in zip(range(-reach, reach + 1), weights, strict=True):
            # A line mirrored without end: of the 2n places of a period, i and 2n - 1 - i are cell i.
            at = F.pmod(F.col(axis) + d, F.lit(2 * n))
            at = F.when(at < n, at).otherwise(F.lit(2 * n - 1) - at)
            terms.append(F.coalesce(F.get("_near", at - first)["_v"], F.lit(0.0)) * (w / total))
        known = F.exists("_near", lambda x: x["_v"].isNotNull())
        out = out.select(*KEY, F.when(known, reduce(Column.__add__, terms)).alias("_v"))
    return out.select(*KEY, F.col("_v").alias(name or band))
