"""Distance transform, boxes of keys and clustered tables, against plain loops."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from rangemap.operators import grid, raster, transform
from rangemap.operators.grid import GridSpec
from rangemap.sources import tables


@pytest.mark.parametrize("seed", range(8))
def test_lowest_parabolas(seed):
    rng = np.random.default_rng(seed)
    at = np.sort(rng.choice(300, rng.integers(1, 200), replace=False)).astype(np.int64)
    sites = np.sort(rng.choice(300, rng.integers(1, 60), replace=False)).astype(np.int64)
    heights = rng.integers(0, [3, 100, 40000][seed % 3], len(sites))
    want = ((at[:, None] - sites) ** 2 + heights).min(axis=1)
    assert (transform.lowest_parabolas(at, sites, heights) == want).all()


@pytest.mark.parametrize("n", [1, 7, 60])
def test_distance_transform(spark, n):
    rng = random.Random(n)
    marks = [(rng.randrange(23), rng.randrange(31)) for _ in range(n)]
    cells = spark.range(23 * 31).selectExpr("cast(id div 31 as int) AS row", "cast(id % 31 as int) AS col", "1.5 AS squared")
    features = spark.createDataFrame([*marks, *marks, (None, 3), (500, 2)], "row int, col int")
    found = transform.distance_transform(cells, features, 50.0).collect()
    assert len(found) == 23 * 31
    for r in found:
        want = min((r["row"] - a) ** 2 + (r["col"] - b) ** 2 for a, b in marks)
        assert (r["squared"], r["distance"]) == (want, pytest.approx(50 * want**0.5))
    near = {tuple(r) for r in transform.within_of(cells, features, 150.0, 50.0).collect()}
    assert near == {(r["row"], r["col"]) for r in found if r["squared"] <= 9}


def test_lines_go_on_in_the_next_batch(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_distance_transform(spark, 7)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_features_and_no_cells(spark):
    cells = spark.createDataFrame([(0, 0), (0, 1)], "row int, col int")
    assert [r["squared"] for r in transform.distance_transform(cells, cells.limit(0)).collect()] == [None, None]
    assert transform.within_of(cells, cells.limit(0), 1e9).count() == 0
    assert transform.distance_transform(cells.limit(0), cells).count() == 0


def test_polygons_within(spark):
    square = [[[210.0, 210.0], [290.0, 210.0], [290.0, 290.0], [210.0, 290.0], [210.0, 210.0]]]
    layer = spark.createDataFrame([(1, square)], "geom_id long, rings array<array<array<double>>>")
    spec = GridSpec(0.0, 500.0, 100.0, 5, 5)
    cells = spark.range(25).selectExpr("cast(id div 5 as int) AS row", "cast(id % 5 as int) AS col")
    found = {tuple(r) for r in transform.within_of_polygons(layer, spec, cells, 100.0).collect()}
    assert found == {(2, 2), (1, 2), (3, 2), (2, 1), (2, 3)}


@pytest.mark.parametrize("bounds", [(50.0, 50.0, 250.0, 350.0), (51.0, 49.0, 249.0, 351.0), (60.0, 60.0, 61.0, 61.0), (-1e4, -1e4, 1e4, 1e4)])
def test_box_keys_are_those_of_the_centres(spark, bounds):
    spec = GridSpec(0.0, 400.0, 100.0, 4, 4)
    r0, r1, c0, c1 = raster.box_keys(spec, bounds)
    want = {(r, c) for r in range(4) for c in range(4) if bounds[0] <= (c + 0.5) * 100 <= bounds[2] and bounds[1] <= 400 - (r + 0.5) * 100 <= bounds[3]}
    assert {(r, c) for r in range(4) for c in range(4) if r0 <= r <= r1 and c0 <= c <= c1} == want


def test_curve_key(spark):
    rows = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1), (5, 3), (70000, 2**31 - 1)], "row int, col int")
    plain = lambda r, c: sum((r >> i & 1) << 2 * i + 1 | (c >> i & 1) << 2 * i for i in range(31))
    found = rows.select("row", "col", tables.curve_key(rows["row"], rows["col"], 1).alias("k")).collect()
    assert all(r["k"] == plain(r["row"], r["col"]) for r in found)


def test_clustered_table_prunes(spark, tmp_path, capsys):
    path = str(tmp_path / "clustered")
    side = 128
    cells = spark.range(side * side).selectExpr(f"cast(id div {side} as int) AS row", f"cast(id % {side} as int) AS col", "cast(id as double) AS v")
    tables.write_clustered(cells, path, 8, files=16)
    spec = GridSpec(0.0, 100.0 * side, 100.0, side, side)
    box = raster.clip_box(spark.read.parquet(path), spec, (0.0, 100.0 * 96, 100.0 * 32, 100.0 * side))
    assert box.count() == 32 * 32
    box.explain("formatted")
    plan = capsys.readouterr().out
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert all(f"{bound}({key}" in pushed for bound in ("GreaterThanOrEqual", "LessThanOrEqual") for key in ("row", "col"))
    met = total = 0
    for file in (tmp_path / "clustered").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for i in range(meta.num_row_groups):
            row, col = (meta.row_group(i).column(c).statistics for c in (0, 1))
            total += 1
            met += row.min <= 31 and col.min <= 31
    assert total >= 16 and met <= 3


def test_no_frame_runs_to_a_lines_end(spark):
    """A frame from a row to its line's end is gone through anew for each row: work by the square of a line's length."""
    cells = grid.model_grid(spark, GridSpec(0, 30, 1, 30, 4))
    features = spark.createDataFrame([(3, 1), (20, 2)], "row int, col int")
    found = transform.distance_transform(cells, features)
    assert "unboundedfollowing" not in found._jdf.queryExecution().executedPlan().toString().lower()
    squared = {(r["row"], r["col"]): r["squared"] for r in found.collect()}
    assert squared == {(i, j): min((i - a) ** 2 + (j - b) ** 2 for a, b in ((3, 1), (20, 2))) for i in range(30) for j in range(4)}
