import random

import pytest
from pyspark.sql import functions as F

from rangemap.functions import geometry as G
from rangemap.operators import grid


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_box_tiler_facts(spark):
    box = (0.1, 1.2, 93.3, 100.1)
    assert grid.pad_and_align(box, (10, 10), (0, 0)) == (0, 0, 100, 110)
    assert grid.pad_and_align(box, (50, 50), (5, 5)) == (-45, -45, 105, 105)
    assert grid.pad_and_align(box, (50, 50), (0, 0))[2:] == (100, 150)
    tiles = rows(grid.tile_box(spark, box, (50.0, 50.0)), "xmin", "ymin", "xmax", "ymax")
    assert len(tiles) == 6 and tiles[0] == (0, 0, 50, 50) and tiles[-1] == (50, 100, 100, 150)


def test_aligned_box_encloses():
    rng = random.Random(42)
    for _ in range(100):
        a, b = rng.uniform(-500, 500), rng.uniform(-500, 500)
        box = (a, b, a + rng.uniform(1, 900), b + rng.uniform(1, 900))
        p = grid.pad_and_align(box, (100, 100), (rng.uniform(-50, 50), rng.uniform(-50, 50)))
        assert p[0] <= box[0] and p[1] <= box[1] and p[2] >= box[2] and p[3] >= box[3]


def test_exact_multiple_gains_a_tile(spark):
    assert grid.tile_from_corner(spark, (0, 0, 100, 100), (5, 5), 10).count() == 9


def test_snapping_moves_aligned_upper_edges():
    assert grid.snap_bounds((3, 4, 100, 51), 10) == (0, 0, 110, 60)
    spec = grid.GridSpec.from_bounds((3, 4, 100, 51), 10)
    assert (spec.nrows, spec.ncols, spec.bounds) == (6, 11, (0, 0, 110, 60))


def test_point_grid_and_model_grid(spark):
    assert rows(grid.point_grid(spark, (0, 0, 10, 10), 5), "x", "y") == [(2.5, 2.5), (2.5, 7.5), (7.5, 2.5), (7.5, 7.5)]
    cells = grid.model_grid(spark, grid.GridSpec(0, 20, 10, 2, 3))
    assert rows(cells, "row", "col", "x", "y")[0] == (0, 0, 5, 15) and cells.count() == 6


def test_centres_fall_in_their_cells(spark):
    spec = grid.GridSpec(7.0, 113.0, 3.0, 9, 11)
    again = grid.with_cell(grid.model_grid(spark, spec).withColumnsRenamed({"row": "r", "col": "c"}), spec)
    assert again.filter("r <> row OR c <> col").count() == 0 and again.count() == 99


def test_align_and_squares(spark):
    p = spark.createDataFrame([(-3.0, 12.0), (250.0, 99.9)], "x double, y double")
    assert rows(grid.squares(p, 100.0), "xmin", "ymin", "xmax", "ymax") == [(-100, 0, 0, 100), (200, 0, 300, 100)]
    assert rows(p.select(grid.offset(F.col("x"), 10.0, 100.0).alias("o")), "o") == [(40.0,), (87.0,)]


def test_national_grid_published_example(spark):
    """The Ordnance Survey's worked example of the projection alone: 52 39 27.2531 N, 1 43 4.5177 E on Airy."""
    lat, lon = 52 + 39 / 60 + 27.2531 / 3600, 1 + 43 / 60 + 4.5177 / 3600
    df = spark.createDataFrame([(lon, lat)], "_lon double, _lat double")
    r = G._project(df).first()
    assert r["_e"] == pytest.approx(651409.903, abs=0.01) and r["_n"] == pytest.approx(313177.270, abs=0.01)


def test_reprojection_round_trip_and_unknown_pairs(spark):
    p = spark.createDataFrame([(430000.0, 433000.0), (530000.0, 180000.0)], "x double, y double")
    there = G.reproject(p, 27700, 4326)
    a = sorted(there.collect())
    assert a[0]["x"] == pytest.approx(-1.5467, abs=0.001) and a[0]["y"] == pytest.approx(53.7924, abs=0.001)
    back = rows(G.reproject(there, 4326, 27700), "x", "y")
    for (x, y), (u, v) in zip(back, rows(p, "x", "y"), strict=True):
        assert x == pytest.approx(u, abs=0.5) and y == pytest.approx(v, abs=0.5)
    with pytest.raises(ValueError):
        G.reproject(p, 27700, 3857)


def test_rings(spark):
    square = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]]
    hole = [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0], [4.0, 4.0]]
    df = spark.createDataFrame([([square, hole], [0.0, 0.0])], "rings array<array<array<double>>>, p array<double>")
    at = lambda x, y: df.select(G.inside(F.lit(x), F.lit(y), F.col("rings"))).first()[0]
    assert at(1.0, 1.0) and at(0.0, 5.0) and not at(5.0, 5.0) and not at(10.0, 5.0) and not at(-1.0, 5.0)
    r = df.select(G.ring_area(F.col("rings")[0]), G.valid_ring(F.col("rings")[0]), G.valid_ring(F.slice(F.col("rings")[0], 1, 4)), G.box_of(F.col("rings"))).first()
    assert r[0] == 100 and r[1] and not r[2] and tuple(r[3]) == (0, 0, 10, 10)
