"""Layers derived from the given tables. The grid grows with the tables, so that every operator's work does.

Each layer has a Spark form and the same as SQL text, by integer arithmetic or exact sums only. In SQL, @M stands for the
grid's scale, @R, @C and @Y for its rows, columns and northern edge.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.grid import GridSpec


def scale(spark: SparkSession, sf_dir: str) -> int:
    """The grid has 42 by 38 cells of 100 m times this squared: about four line items a cell at any size of the tables."""
    return max(1, math.floor(math.sqrt(read(spark, sf_dir, "lineitem").count() / 6000.0)))


def spec(spark: SparkSession, sf_dir: str, res: float = 100.0) -> GridSpec:
    """Over the extent of points(): 3,703 by 4,104 metres times the scale. res: 100, or 200 for the coarse grid."""
    m = scale(spark, sf_dir)
    k = round(res / 100)
    return GridSpec(0.0, 4200.0 * m, res, 42 * m // k, 38 * m // k)


def wide(spark: SparkSession, sf_dir: str) -> GridSpec:
    """A coarse grid beyond all points, to meet polygons on."""
    m = scale(spark, sf_dir)
    return GridSpec(-400.0, 4200.0 * m + 400, 200.0, 21 * m + 5, 19 * m + 5)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The environmental stack: v, d and t per cell. Some cells are absent."""
    m = scale(spark, sf_dir)
    t = read(spark, sf_dir, "lineitem").select(F.expr(f"CAST(l_partkey % {42 * m} AS INT)").alias("row"), F.expr(f"CAST(l_orderkey % {38 * m} AS INT)").alias("col"), "l_quantity", F.round(F.col("l_discount") * 100).cast("int").alias("dd"), F.round(F.col("l_tax") * 100).cast("int").alias("tt"))
    return t.groupBy("row", "col").agg(F.avg("l_quantity").alias("v"), F.avg("dd").alias("d"), F.avg("tt").alias("t"))


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category raster: the largest line number of a cell's lines with an even quantity; null if there are none."""
    m = scale(spark, sf_dir)
    t = read(spark, sf_dir, "lineitem").select(F.expr(f"CAST(l_partkey % {42 * m} AS INT)").alias("row"), F.expr(f"CAST((l_orderkey * 7 + l_suppkey) % {38 * m} AS INT)").alias("col"), F.expr("CASE WHEN CAST(l_quantity AS INT) % 5 = 0 THEN CAST(l_linenumber AS INT) END").alias("k"))
    return t.groupBy("row", "col").agg(F.expr("CAST(sum(k * 3 + 1) % 7 AS INT)").alias("k"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences."""
    m = scale(spark, sf_dir)
    return read(spark, sf_dir, "events").select(F.col("event_id").alias("point_id"), F.col("event_type").alias("latin_name"), F.expr("CASE WHEN user_id % 2 = 0 THEN 'Roost' ELSE 'In flight' END").alias("activity_type"), F.expr(f"CAST(event_id * 7919 % 10007 AS DOUBLE) * CAST(0.37 AS DOUBLE) * {m}").alias("x"), F.expr(f"CAST(event_id * 104729 % 10009 AS DOUBLE) * CAST(0.41 AS DOUBLE) * {m}").alias("y"), F.col("value").alias("accuracy"), F.col("user_id"), F.to_date("ts").alias("date"))


def background(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = scale(spark, sf_dir)
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("point_id"), F.expr(f"CAST(o_orderkey * 6091 % 10007 AS DOUBLE) * CAST(0.37 AS DOUBLE) * {m}").alias("x"), F.expr(f"CAST(o_orderkey * 15485863 % 10009 AS DOUBLE) * CAST(0.41 AS DOUBLE) * {m}").alias("y"), F.col("o_totalprice").alias("weight"))


def diamonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons: a diamond per part."""
    m = scale(spark, sf_dir)
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("geom_id"), F.col("p_brand").alias("brand"), F.expr(f"CAST(p_partkey * 7919 % (3701 * {m}) AS DOUBLE) + CAST(0.13 AS DOUBLE)").alias("cx"), F.expr(f"CAST(p_partkey * 104729 % (4099 * {m}) AS DOUBLE) + CAST(0.17 AS DOUBLE)").alias("cy"), F.expr("CAST(20 + p_size * 3 AS DOUBLE)").alias("w"))
    at = lambda x, y: F.array(x, y)
    cx, cy, w = F.col("cx"), F.col("cy"), F.col("w")
    ring = F.array(at(cx - w, cy), at(cx, cy + w), at(cx + w, cy), at(cx, cy - w), at(cx - w, cy))
    return p.select("geom_id", "brand", "cx", "cy", "w", F.array(ring).alias("rings"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons: a diamond per supplier."""
    m = scale(spark, sf_dir)
    p = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("geom_id"), F.expr(f"CAST(s_suppkey * 7919 % (3701 * {m}) AS DOUBLE) + CAST(0.13 AS DOUBLE)").alias("cx"), F.expr(f"CAST(s_suppkey * 104729 % (4099 * {m}) AS DOUBLE) + CAST(0.17 AS DOUBLE)").alias("cy"), F.expr("CAST(20 + s_suppkey * 13 % 151 AS DOUBLE)").alias("w"))
    return with_diamond(p)


def with_diamond(p: DataFrame, more: float = 0.0) -> DataFrame:
    """geom_id, cx, cy, w and rings: the diamond of half width w + more."""
    at = lambda x, y: F.array(x, y)
    cx, cy, w = F.col("cx"), F.col("cy"), F.col("w") + more
    ring = F.array(at(cx - w, cy), at(cx, cy + w), at(cx + w, cy), at(cx, cy - w), at(cx - w, cy))
    return p.select("geom_id", "cx", "cy", "w", F.array(ring).alias("rings"))


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines: a segment per supplier."""
    m = scale(spark, sf_dir)
    p = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("geom_id"), F.expr(f"CAST(s_suppkey * 6151 % (3301 * {m}) AS DOUBLE) + CAST(0.29 AS DOUBLE)").alias("x1"), F.expr(f"CAST(s_suppkey * 7309 % (3701 * {m}) AS DOUBLE) + CAST(0.31 AS DOUBLE)").alias("y1"), F.expr("CAST(s_suppkey * 37 % 401 AS DOUBLE)").alias("dx"), F.expr("CAST(s_suppkey * 91 % 397 AS DOUBLE) + CAST(0.5 AS DOUBLE)").alias("dy"))
    line = F.array(F.array("x1", "y1"), F.array(F.col("x1") + F.col("dx"), F.col("y1") + F.col("dy")))
    return p.select("geom_id", F.array(line).alias("rings"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long prediction table: three models per cell from the line items."""
    m = scale(spark, sf_dir)
    t = read(spark, sf_dir, "lineitem").select(F.expr(f"CAST(l_partkey % {42 * m} AS INT)").alias("row"), F.expr(f"CAST(l_orderkey % {38 * m} AS INT)").alias("col"), F.concat(F.col("l_returnflag"), F.lit("_Roost")).alias("identifier"), F.expr("CAST(CAST(l_quantity AS INT) % 51 AS INT)").alias("q"))
    return t.groupBy("row", "col", "identifier").agg((F.max("q") / F.lit(50.0)).alias("p"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a class and a score with many ties."""
    return read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("identifier"), F.expr("CAST(CASE WHEN (o_custkey * 31 + o_orderkey) % 7 < 2 THEN 1 ELSE 0 END AS INT)").alias("class"), F.expr("CAST((o_custkey * 31 + o_orderkey) % 7 * 9 + o_orderkey % 41 AS DOUBLE) / CAST(100 AS DOUBLE)").alias("p"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Satellite pixels: a scene per day."""
    m = scale(spark, sf_dir)
    return read(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("scene"), F.expr(f"CAST(user_id % {20 * m} AS INT)").alias("row"), F.expr(f"CAST(event_id * 13 % {20 * m} AS INT)").alias("col"), F.col("event_id"), F.expr("CAST(event_id * 37 % 101 AS DOUBLE)").alias("probability"), F.expr("CAST(event_id * 53 % 4001 AS DOUBLE)").alias("nir"), F.expr("CAST(event_id % 11 AS INT)").alias("scl"))


#: The same as SQL, by name.
SQL = {
    "cells": """SELECT CAST(l_partkey % @R AS INTEGER) AS "row", CAST(l_orderkey % @C AS INTEGER) AS col, avg(l_quantity) AS v, avg(CAST(round(l_discount * 100) AS INTEGER)) AS d, avg(CAST(round(l_tax * 100) AS INTEGER)) AS t FROM lineitem GROUP BY 1, 2""",
    "classes": """SELECT CAST(l_partkey % @R AS INTEGER) AS "row", CAST((l_orderkey * 7 + l_suppkey) % @C AS INTEGER) AS col, CAST(sum(CASE WHEN CAST(l_quantity AS INTEGER) % 5 = 0 THEN CAST(l_linenumber AS INTEGER) * 3 + 1 END) % 7 AS INTEGER) AS k FROM lineitem GROUP BY 1, 2""",
    "points": """SELECT event_id AS point_id, event_type AS latin_name, CASE WHEN user_id % 2 = 0 THEN 'Roost' ELSE 'In flight' END AS activity_type, CAST(event_id * 7919 % 10007 AS DOUBLE) * CAST(0.37 AS DOUBLE) * @M AS x, CAST(event_id * 104729 % 10009 AS DOUBLE) * CAST(0.41 AS DOUBLE) * @M AS y, value AS accuracy, user_id, CAST(ts AS DATE) AS date FROM events""",
    "background": """SELECT o_orderkey AS point_id, CAST(o_orderkey * 6091 % 10007 AS DOUBLE) * CAST(0.37 AS DOUBLE) * @M AS x, CAST(o_orderkey * 15485863 % 10009 AS DOUBLE) * CAST(0.41 AS DOUBLE) * @M AS y, o_totalprice AS weight FROM orders""",
    "diamonds": """SELECT p_partkey AS geom_id, p_brand AS brand, CAST(p_partkey * 7919 % (3701 * @M) AS DOUBLE) + CAST(0.13 AS DOUBLE) AS cx, CAST(p_partkey * 104729 % (4099 * @M) AS DOUBLE) + CAST(0.17 AS DOUBLE) AS cy, CAST(20 + p_size * 3 AS DOUBLE) AS w FROM part""",
    "zones": """SELECT s_suppkey AS geom_id, CAST(s_suppkey * 7919 % (3701 * @M) AS DOUBLE) + CAST(0.13 AS DOUBLE) AS cx, CAST(s_suppkey * 104729 % (4099 * @M) AS DOUBLE) + CAST(0.17 AS DOUBLE) AS cy, CAST(20 + s_suppkey * 13 % 151 AS DOUBLE) AS w FROM supplier""",
    "roads": """SELECT geom_id, x1, y1, x1 + dx AS x2, y1 + dy AS y2 FROM (SELECT s_suppkey AS geom_id, CAST(s_suppkey * 6151 % (3301 * @M) AS DOUBLE) + CAST(0.29 AS DOUBLE) AS x1, CAST(s_suppkey * 7309 % (3701 * @M) AS DOUBLE) + CAST(0.31 AS DOUBLE) AS y1, CAST(s_suppkey * 37 % 401 AS DOUBLE) AS dx, CAST(s_suppkey * 91 % 397 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS dy FROM supplier) s""",
    "predictions": """SELECT CAST(l_partkey % @R AS INTEGER) AS "row", CAST(l_orderkey % @C AS INTEGER) AS col, l_returnflag || '_Roost' AS identifier, max(CAST(l_quantity AS INTEGER) % 51) / CAST(50.0 AS DOUBLE) AS p FROM lineitem GROUP BY 1, 2, 3""",
    "scored": """SELECT o_orderpriority AS identifier, CASE WHEN (o_custkey * 31 + o_orderkey) % 7 < 2 THEN 1 ELSE 0 END AS class, CAST((o_custkey * 31 + o_orderkey) % 7 * 9 + o_orderkey % 41 AS DOUBLE) / CAST(100 AS DOUBLE) AS p FROM orders""",
    "pixels": """SELECT strftime(ts, '%Y-%m-%d') AS scene, CAST(user_id % (20 * @M) AS INTEGER) AS "row", CAST(event_id * 13 % (20 * @M) AS INTEGER) AS col, event_id, CAST(event_id * 37 % 101 AS DOUBLE) AS probability, CAST(event_id * 53 % 4001 AS DOUBLE) AS nir, CAST(event_id % 11 AS INTEGER) AS scl FROM events""",
    "grid": """SELECT CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col, (c + 0.5) * CAST(100 AS DOUBLE) AS x, @Y - (r + 0.5) * CAST(100 AS DOUBLE) AS y FROM (SELECT unnest(range(42 * m)) AS r FROM size) a, (SELECT unnest(range(38 * m)) AS c FROM size) b""",
    "placed": """SELECT *, CAST(floor((@Y - y) / 100) AS INTEGER) AS "row", CAST(floor(x / 100) AS INTEGER) AS col FROM points""",
    "bgplaced": """SELECT *, CAST(floor((@Y - y) / 100) AS INTEGER) AS "row", CAST(floor(x / 100) AS INTEGER) AS col FROM background""",
    "near": """SELECT * FROM placed WHERE sqrt((x - (col + 0.5) * 100) * (x - (col + 0.5) * 100) + (y - (@Y - ("row" + 0.5) * 100)) * (y - (@Y - ("row" + 0.5) * 100))) <= 50""",
    "thin": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY latin_name, "row", col ORDER BY point_id) AS rn FROM near) n WHERE rn = 1""",
}
SIZE = "size AS (SELECT CAST(greatest(1, floor(sqrt(count(*) / 6000.0))) AS BIGINT) AS m FROM lineitem)"
NEEDS = {"placed": ["points"], "bgplaced": ["background"], "near": ["points", "placed"], "thin": ["points", "placed", "near"]}


def with_tables(body: str, *names: str) -> str:
    """body after WITH clauses for the named layers and what they need."""
    wanted: list[str] = []
    for n in names:
        for x in (*NEEDS.get(n, []), n):
            if x not in wanted:
                wanted.append(x)
    lead = "WITH RECURSIVE " if "/*recursive*/" in body else "WITH "
    text = ",\n".join([SIZE, *(f"{n} AS ({SQL[n]})" for n in wanted)]) + "\n" + body.replace("/*recursive*/", "")
    for mark, value in {"@M": "m", "@R": "42 * m", "@C": "38 * m", "@Y": "4200.0 * m"}.items():
        text = text.replace(mark, f"(SELECT CAST({value} AS DOUBLE) FROM size)" if mark == "@Y" else f"(SELECT {value} FROM size)")
    return lead + text
