"""Layers in degrees on the metric grid."""

import pytest
from pyspark.sql import functions as F

from rangemap.functions.geometry import reproject
from rangemap.operators import raster
from rangemap.operators.grid import GridSpec, model_grid, with_centre


def plane(spark, spec):
    """A layer whose values are a plane over its coordinates, so that bilinear values are exact anywhere."""
    at = with_centre(model_grid(spark, spec), spec)
    return at.select("row", "col", (F.col("x") * 10 + F.col("y") * 3).alias("v"))


@pytest.mark.parametrize(("source", "source_epsg", "target", "target_epsg"), [
    (GridSpec(-3.7, 50.9, 0.01, 40, 40), 4326, GridSpec(285_000.0, 95_000.0, 500.0, 30, 20), 27700),
    (GridSpec(280_000.0, 110_000.0, 1000.0, 60, 60), 27700, GridSpec(-3.6, 50.8, 0.01, 10, 12), 4326),
])
def test_values_are_those_of_each_centre_projected(spark, source, source_epsg, target, target_epsg):
    targets = model_grid(spark, target)
    got = raster.resample(plane(spark, source), source, target, targets, source_epsg=source_epsg, target_epsg=target_epsg)
    centres = reproject(with_centre(targets, target), target_epsg, source_epsg)
    both = got.join(centres, ["row", "col"]).collect()
    assert len(both) == target.nrows * target.ncols
    assert max(abs(r.v - (r.x * 10 + r.y * 3)) for r in both) < 1e-6 * max(abs(r.v) for r in both)


def test_nearest_and_average(spark):
    source, target = GridSpec(-3.7, 50.9, 0.002, 150, 200), GridSpec(285_000.0, 100_000.0, 1000.0, 8, 8)
    layer = plane(spark, source)
    targets = model_grid(spark, target)
    near, mean = (raster.resample(layer, source, target, targets, how, 4326) for how in ("nearest", "average"))
    centres = reproject(with_centre(targets, target), 27700, 4326)
    for found, off in ((near, 0.02), (mean, 0.02)):
        rows = found.join(centres, ["row", "col"]).collect()
        assert len(rows) == 64 and all(abs(r.v - (r.x * 10 + r.y * 3)) < off for r in rows)


def test_outside_is_null(spark):
    source, target = GridSpec(-3.7, 50.9, 0.01, 5, 5), GridSpec(600_000.0, 300_000.0, 1000.0, 2, 2)
    got = raster.resample(plane(spark, source), source, target, model_grid(spark, target), source_epsg=4326)
    assert got.count() == 4 and got.filter("v IS NOT NULL").count() == 0
