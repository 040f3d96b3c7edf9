"""Background points and other samples.

Every sampler takes a seed and draws from unit_hash of an integer key, so a draw is the same on any cluster and in SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.geometry import inside
from ..functions.scalars import unit_hash
from ..session import written
from . import focal
from .distance import knn_weights
from .grid import GridSpec, model_grid, with_centre
from .occurrence import annotate, background_size, densest, drop_in_presence_cells, stack, thin_to_cells, with_enough
from .ordered import first_rows, quantiles, running
from .raster import KEY, point_counts


def average_rank(df: DataFrame, value: str, name: str = "rank") -> DataFrame:
    """df with the average rank of value over n. Ranks are taken over distinct values with their counts, dealt by ranges."""
    counts = df.groupBy(value).agg(F.count("*").alias("_n"))
    n = df.agg(F.count("*").alias("_all"))
    ranks = running(counts, [], value, {"_before": "_n"}).select(value, (F.col("_before") + (F.col("_n") + 1) / 2).alias("_rank")).crossJoin(F.broadcast(n))  # one row
    return df.join(ranks.select(value, (F.col("_rank") / F.col("_all")).alias(name)), value)


def transform_counts(cells: DataFrame, method: str, cap_percentile: float = 90.0, band: str = "value") -> DataFrame:
    """Counts by log (of 1 + n), sqrt, presence, cap (at a percentile of those above 0) or rank; others stay raw."""
    v = F.col(band)
    if method == "log":
        return cells.withColumn(band, F.log1p(v))
    if method == "sqrt":
        return cells.withColumn(band, F.sqrt(v))
    if method == "presence":
        return cells.withColumn(band, (v > 0).cast("double"))
    if method == "cap":
        cap = quantiles(cells.filter(v > 0), [], band, {"_cap": cap_percentile / 100})
        return cells.crossJoin(F.broadcast(cap)).withColumn(band, F.when(F.col("_cap").isNull(), v).otherwise(F.least(v, F.col("_cap")))).drop("_cap")
    if method == "rank":
        return average_rank(cells, band, "_r").drop(band).withColumnRenamed("_r", band)
    return cells


def probabilities(cells: DataFrame, method: str, value: float, band: str = "value") -> DataFrame:
    """cells with p: the density raised to a floor, then over its sum; the same for all cells if the sum is nothing.

    Floor: contrast (share of the maximum, share in 0..1), percentile (of all values), scale (any share of the maximum),
    fixed, or binary (1 wherever there is any density). Null cells are left out.
    """
    known = cells.filter(F.col(band).isNotNull())
    if method == "binary":
        known = known.withColumn(band, (F.col(band) > 1e-9).cast("double"))
        floor: Column = F.lit(0.0)
    elif method in ("contrast", "scale"):
        floor = F.max(band) * float(min(max(value, 0.0), 1.0) if method == "contrast" else value)
    elif method == "percentile":
        floor = F.first("_q")
        known = known.crossJoin(F.broadcast(quantiles(known, [], band, {"_q": value / 100})))  # one row
    elif method == "fixed":
        floor = F.lit(float(value))
    else:
        raise ValueError(f"no such method: {method}")
    low = known.agg(floor.alias("_floor"))
    raised = known.crossJoin(F.broadcast(low)).withColumn("_v", F.greatest(band, "_floor"))
    total = raised.agg(F.sum("_v").alias("_sum"), F.count("*").alias("_n"))
    p = F.when(F.col("_sum") > 1e-9, F.col("_v") / F.col("_sum")).otherwise(1 / F.col("_n"))
    return raised.crossJoin(F.broadcast(total)).withColumn("p", p).drop("_floor", "_v", "_sum", "_n", "_q")


def weighted_sample(df: DataFrame, n: int, key: str, p: str = "p", seed: int = 42) -> DataFrame:
    """n rows without replacement with chances by p: the largest log(u) / p, which has the law of successive draws."""
    return df.filter(F.col(p) > 0).orderBy((F.log(unit_hash(F.col(key), seed)) / F.col(p)).desc(), key).limit(n)


def weighted_sample_replace(df: DataFrame, n: int, key: str, p: str = "p", seed: int = 42) -> DataFrame:
    """n rows with replacement: n uniforms, each taking the row whose stretch of the cumulative sum it falls in.

    The total is cut into n equal bins, and a row stands in each bin that its stretch meets, so rows and bins together bound
    the table. A uniform meets its own bin's rows by an equality join and takes the last that begins before it. key is
    distinct; without a row of positive p there are no draws.
    """
    if n <= 0:
        return df.limit(0).select(F.lit(0).cast("long").alias("draw"), *df.columns)
    rows = running(df.filter(F.col(p) > 0), [], key, {"_begin": p}).withColumn("_begin", F.col("_begin").cast("double"))
    whole = rows.agg(F.max(F.col("_begin") + F.col(p)).alias("_all"))
    bin_of = lambda at: F.least(F.floor(at / F.col("_all") * n), F.lit(n - 1)).cast("long")
    # The margin closes the gaps that rounding leaves between the end of a stretch and the next one's begin.
    ends = F.col("_begin") + F.col(p) + F.col("_all") * 1e-12
    binned = rows.crossJoin(F.broadcast(whole)).withColumn("_bin", F.explode(F.sequence(bin_of(F.col("_begin")), bin_of(ends)))).drop("_all")  # one row
    draws = df.sparkSession.range(n).select(F.col("id").alias("draw"), unit_hash(F.col("id"), seed).alias("_u"))
    draws = draws.crossJoin(F.broadcast(whole)).withColumn("_u", F.col("_u") * F.col("_all")).withColumn("_bin", bin_of(F.col("_u"))).drop("_all")  # one row
    met = draws.join(binned, "_bin").filter(F.col("_begin") <= F.col("_u"))
    return met.groupBy("draw").agg(F.max(F.struct("_begin", *df.columns)).alias("r")).select("draw", *(F.col(f"r.{c}").alias(c) for c in df.columns))


def exact_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all, if fewer), every subset equally likely."""
    return df.orderBy(unit_hash(F.col(key), seed), key).limit(n)


def points_in_polygon(spark, rings: list[list[list[float]]], n: int, seed: int = 42) -> DataFrame:
    """n uniform points inside a polygon: draws in its box, kept if inside. How many draws are made follows from the ratio
    of the areas, with a margin; a shortfall is an error."""
    xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
    xmin, xmax, ymin, ymax = min(xs), max(xs), min(ys), max(ys)
    area = lambda r: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:], strict=False))) / 2
    share = max((area(rings[0]) - sum(map(area, rings[1:]))) / ((xmax - xmin) * (ymax - ymin)), 1e-6)
    draws = math.ceil((n + 6 * math.sqrt(n) + 20) / share)
    literal = F.array(*(F.array(*(F.array(F.lit(float(x)), F.lit(float(y))) for x, y in r)) for r in rings))
    at = spark.range(draws).select(F.col("id").alias("point_id"), (xmin + unit_hash(F.col("id") * 2, seed) * (xmax - xmin)).alias("x"), (ymin + unit_hash(F.col("id") * 2 + 1, seed) * (ymax - ymin)).alias("y"))
    return at.filter(inside(F.col("x"), F.col("y"), literal)).orderBy("point_id").limit(n)


def background_points(points: DataFrame, spec: GridSpec, n: int, transform: str = "log", sigma: float = 1.5, background: str = "contrast", value: float = 0.1, seed: int = 42, cap_percentile: float = 90.0) -> DataFrame:
    """row, col, x, y, p, presence = 0: cells drawn by the smoothed density of points.

    Without replacement if the grid has n cells or more, else with. The cell key row * ncols + col seeds the draw.
    """
    grid = model_grid(points.sparkSession, spec)
    counts = transform_counts(point_counts(points, spec, grid), transform, cap_percentile)
    smooth = focal.gaussian(counts, spec.nrows, spec.ncols, "value", sigma)
    keyed = probabilities(smooth, background, value).withColumn("cell_id", (F.col("row") * spec.ncols + F.col("col")).cast("long"))
    drawn = weighted_sample(keyed, n, "cell_id", seed=seed) if spec.nrows * spec.ncols >= n else weighted_sample_replace(keyed, n, "cell_id", seed=seed)
    return with_centre(drawn, spec).select(*KEY, "x", "y", "p", F.lit(0).alias("presence"))


def first_for_each(rows: DataFrame, groups: DataFrame, order: str, most: str, block: int = 4096) -> DataFrame:
    """groups' columns with the first rows in order for each group, as many as its column most says; null: all rows.

    Every group takes from the same rows, in which a value of order occurs once. Rows are numbered once, by ranges, and
    blocks of them are met by an equality join, so the work is that of the rows given out.
    """
    numbered = running(rows.withColumn("_one", F.lit(1).cast("long")), [], order, {"_place": "_one"}).drop("_one")
    numbered = numbered.withColumn("_block", F.floor(F.col("_place") / block))
    total = F.broadcast(numbered.agg(F.count("*").alias("_total")))  # one row
    least = groups.crossJoin(total).withColumn("_most", F.least(F.coalesce(most, "_total"), "_total")).filter("_most > 0").drop("_total")
    spread = least.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_most") - 1) / block))))
    return spread.join(numbered, "_block").filter(F.col("_place") < F.col("_most")).drop("_block", "_place", "_most")


def training_table(presence: DataFrame, background: DataFrame, cells: DataFrame, spec: GridSpec, bands: list[str], by: str = "identifier", point_id: str = "point_id", tolerance: float = 50.0, subset: str | None = None, neighbours: int = 5, least: int = 15, seed: int = 42) -> DataFrame:
    """Training rows of all identifiers at once: by, point_id, x, y, bands, class, sample_weight.

    presence has by, point_id, x, y; background point_id, x, y, weight and serves every identifier. Both are thinned to
    one point per cell, background cells that hold a presence of the identifier are left out, each identifier's
    background is cut to background_size of its presences if subset is "density" (largest weight first) or "random",
    points without a value in any band are dropped, and weights come from the distances to the nearest neighbours.
    Identifiers with fewer than least presences are left out.
    """
    enough = with_enough(presence, [by], least)
    thin = thin_to_cells(enough.select(by, point_id, "x", "y"), spec, [by], point_id, tolerance)
    base = thin_to_cells(background.select(point_id, "x", "y", "weight"), spec, [], point_id, tolerance)
    sizes = thin.groupBy(by).agg(F.count("*").alias("_held"), background_size(F.count("*")).alias("_want"))
    # A group loses a background point at most for each of its presences: so many more of the first ones are enough.
    reach = F.lit(None).cast("long") if subset is None else F.col("_held") + F.col("_want")
    leading = F.struct(F.col("weight").isNull(), -F.col("weight")) if subset == "density" else F.struct(unit_hash(F.col(point_id), seed))
    every = first_for_each(base.withColumn("_order", F.struct(leading, point_id, "x", "y")), sizes.select(by, "_want", reach.alias("_reach")), "_order", "_reach")
    every = drop_in_presence_cells(every, thin, [by])
    if subset is not None:
        every = first_rows(every, [by], [F.asc("_order")], F.col("_want"), point_id)
    both = stack(thin.select(by, point_id, "x", "y"), every.select(by, point_id, "x", "y"))
    known = annotate(both, cells, spec, bands)
    known = written(known.withColumn("_key", F.concat_ws(":", "class", point_id)), "known")  # read twice
    weights = knn_weights(known.select(by, "_key", "x", "y"), by, "_key", neighbours, start=spec.res)
    return known.join(weights.select(by, "_key", F.col("weight").alias("sample_weight")), [by, "_key"]).select(by, point_id, "x", "y", *bands, "class", "sample_weight")


__all__ = ["average_rank", "background_points", "densest", "exact_sample", "first_for_each", "points_in_polygon", "probabilities", "training_table", "transform_counts", "weighted_sample", "weighted_sample_replace"]
