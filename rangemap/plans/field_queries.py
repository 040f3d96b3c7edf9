"""Queries of distance transforms, clustered cell tables, and numbering within groups, with their SQL."""

from __future__ import annotations

from ..operators import grid, maxent, raster, transform, vector
from ..sources import tables
from . import standins as T
from .io_queries import new_path
from .queries import KEY, _u, rounded

QUERIES = {}
ORACLE_SQL = {}

_LAND = """land AS (SELECT DISTINCT g."row", g.col FROM grid g JOIN zones z ON abs(g.x - z.cx) + abs(g.y - z.cy) < z.w)"""
_FAR = """far AS (SELECT g."row", g.col, min((g."row" - l."row") * (g."row" - l."row") + (g.col - l.col) * (g.col - l.col)) AS squared FROM grid g CROSS JOIN land l GROUP BY 1, 2)"""
ORACLE_SQL["n4_distance_transform"] = T.with_tables(f""", {_LAND}, {_FAR} SELECT "row", col, CAST(squared AS BIGINT) AS squared, round(sqrt(squared) * 100, 6) + 0.0 AS distance FROM far""", "grid", "zones")
ORACLE_SQL["s12_within_distance"] = T.with_tables(f""", {_LAND}, {_FAR} SELECT "row", col FROM far WHERE squared * 10000 <= 62500""", "grid", "zones")
ORACLE_SQL["k1_clustered_box"] = T.with_tables("""SELECT c."row", c.col, c.v FROM cells c JOIN grid g ON g."row" = c."row" AND g.col = c.col WHERE g.x BETWEEN 1000 * @M AND 2000 * @M AND g.y BETWEEN 1000 * @M AND 1950 * @M""", "cells", "grid")
ORACLE_SQL["m7_random_folds"] = T.with_tables(f"""SELECT latin_name, point_id, CAST(ntile(3) OVER (PARTITION BY latin_name ORDER BY {_u("point_id")}, point_id) - 1 AS INTEGER) AS fold FROM points""", "points")


def n4_distance_transform(spark, sf):
    """How far each cell is from the nearest cell of a polygon."""
    spec = T.spec(spark, sf)
    return rounded(transform.distance_transform(grid.model_grid(spark, spec), vector.polygon_cells(T.zones(spark, sf), spec), spec.res))


def s12_within_distance(spark, sf):
    """Cells within 250 m of the cell of a polygon."""
    spec = T.spec(spark, sf)
    return transform.within_of(grid.model_grid(spark, spec), vector.polygon_cells(T.zones(spark, sf), spec), 250.0, spec.res)


def k1_clustered_box(spark, sf):
    """A cell table written along a curve, and a box of it read back by bounds on the stored keys."""
    path, m = new_path(spark, "clustered"), T.scale(spark, sf)
    tables.write_clustered(T.cells(spark, sf).select(*KEY, "v"), path, 8)
    return raster.clip_box(spark.read.parquet(path), T.spec(spark, sf), (1000 * m, 1000 * m, 2000 * m, 1950 * m))


def m7_random_folds(spark, sf):
    """Three even shares of each species' points."""
    points = T.points(spark, sf).selectExpr("latin_name", "point_id", "1 AS class")
    return maxent.with_random_folds(points, by="latin_name").select("latin_name", "point_id", "fold")


QUERIES |= {"n4_distance_transform": n4_distance_transform, "s12_within_distance": s12_within_distance, "k1_clustered_box": k1_clustered_box, "m7_random_folds": m7_random_folds}
