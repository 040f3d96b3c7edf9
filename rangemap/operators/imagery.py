"""Satellite scenes as pixel tables: cloud and shadow masks, median composites."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .occurrence import first_of
from .raster import KEY

SCENE = ["scene", *KEY]


def with_cloud_probability(scenes: DataFrame, clouds: DataFrame, order: str) -> DataFrame:
    """Scenes with the probability of the first cloud record of the same index."""
    return scenes.join(first_of(clouds, ["scene"], order), "scene")


def usable(scenes: DataFrame, first_day: str, last_day: str, most_cloud: float = 60.0) -> DataFrame:
    return scenes.filter(F.col("date").between(first_day, last_day) & (F.col("cloud_percent") <= most_cloud))


def flags(pixels: DataFrame, cloud_above: float = 50.0, dark_below: float = 0.15, scale: float = 1e4, water: int = 6) -> DataFrame:
    """pixels with cloud, and dark: near infrared below a share of the scale and no water."""
    return pixels.withColumns({"cloud": F.col("probability") > cloud_above, "dark": (F.col("nir") < dark_below * scale) & (F.col("scl") != water)})


def shadows(pixels: DataFrame, azimuth: float, reach: int) -> DataFrame:
    """(scene, row, col) of dark pixels that lie within reach steps of a cloud, away from the sun."""
    angle = math.radians(90 - azimuth)
    dx, dy = math.cos(angle), math.sin(angle)
    steps = F.array(*(F.struct(F.lit(-round(k * dy)).alias("dr"), F.lit(round(k * dx)).alias("dc")) for k in range(1, reach + 1)))
    thrown = pixels.filter("cloud").select(*SCENE, F.explode(steps).alias("s")).select("scene", (F.col("row") + F.col("s.dr")).alias("row"), (F.col("col") + F.col("s.dc")).alias("col")).distinct()
    return pixels.filter("dark").select(*SCENE).join(thrown, SCENE, "left_semi")


def masked(pixels: DataFrame, azimuth: float, reach: int, open_size: int = 3, grow_size: int = 7) -> DataFrame:
    """Pixels that are neither cloud nor shadow. The mask is opened by a minimum over open_size and grown by a maximum
    over grow_size (squares), scene by scene."""
    shade = shadows(pixels, azimuth, reach).withColumn("_shade", F.lit(1))
    bad = pixels.join(shade, SCENE, "left").withColumn("_bad", F.when(F.col("cloud") | (F.col("_shade") == 1), 1).otherwise(0))
    mask = bad.select(*SCENE, "_bad")
    for pick, size in ((F.min, open_size), (F.max, grow_size)):
        lo, hi = -(size // 2), size - 1 - size // 2
        mask = mask.withColumn("_h", pick("_bad").over(Window.partitionBy("scene", "row").orderBy("col").rangeBetween(lo, hi)))
        mask = mask.withColumn("_bad", pick("_h").over(Window.partitionBy("scene", "col").orderBy("row").rangeBetween(lo, hi))).drop("_h")
    return pixels.join(mask.filter("_bad = 1").select(*SCENE), SCENE, "left_anti")


def median_composite(pixels: DataFrame, bands: list[str]) -> DataFrame:
    """Median of each band over all scenes, per cell."""
    return pixels.groupBy(*KEY).agg(*(F.median(b).alias(b) for b in bands))

