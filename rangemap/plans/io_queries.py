"""Readers and writers: layers of standins are written to the shared folder, read back by the library, and compared."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalars as S
from ..operators import grid, sampling
from ..session import shared_dir, written
from ..sources import geojson, tables
from . import standins as T
from .queries import KEY, r6, rounded
from .standins import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, body: str, *layers: str):
    def add(fn):
        QUERIES[name] = fn
        ORACLE_SQL[name] = with_tables(body, *layers) if layers else body
        return fn

    return add


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> str:
    return written(df, name).written_to


@query("s1_read_points", """SELECT CAST(point_id AS VARCHAR) AS unique_id, latin_name, round(x, 3) + 0.0 AS x, round(y, 3) + 0.0 AS y FROM points WHERE accuracy <= 60""", "points")
def s1(spark, sf):
    """A GeoJSON feature collection per species, written as text and read by the point reader."""
    p = T.points(spark, sf)
    at = F.struct(F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("point_id").cast("string").alias("unique_id"), "latin_name", F.col("accuracy").alias("accuracy")).alias("properties"), at.alias("geometry"))
    lines = p.select(F.pmod("point_id", F.lit(16)).alias("part"), F.to_json(feature).alias("f"))  # a collection is one document: small parts
    lines = lines.groupBy("part").agg(F.collect_list("f").alias("fs")).select("part", F.concat(F.lit('{"type": "FeatureCollection", "features": ['), F.array_join("fs", ","), F.lit("]}")).alias("value"))
    path = new_path(spark, "points")
    lines.write.partitionBy("part").text(path)
    return rounded(geojson.read_points(spark, path, {"unique_id": "string", "latin_name": "string", "accuracy": "double"}, 60.0).select("unique_id", "latin_name", "x", "y"), 3)


@query("s3_read_cells", """SELECT "row", col, CASE WHEN "row" % 5 <> 0 THEN v END AS v FROM cells""", "cells")
def s3(spark, sf):
    c = T.cells(spark, sf).select(*KEY, F.when(F.col("row") % 5 == 0, -9999.0).otherwise(F.col("v")).alias("v"))
    return tables.read_cells(spark, stored(c, "cells"))


@query("s4_s5_read_stack", """SELECT coalesce(a."row", b."row") AS "row", coalesce(a.col, b.col) AS col, a.v AS env_v, b.k AS land_k FROM cells a FULL JOIN (SELECT "row", col, CAST(k AS DOUBLE) AS k FROM classes) b ON a."row" = b."row" AND a.col = b.col""", "cells", "classes")
def s5(spark, sf):
    return tables.read_stack(spark, {"env": stored(T.cells(spark, sf).select(*KEY, "v"), "env"), "land": stored(T.classes(spark, sf), "land")})


@query("s6_s7_datasets_and_tiles", """SELECT dataset, count(*) AS n FROM (SELECT 'roads' AS dataset FROM roads UNION ALL SELECT 'parts' FROM diamonds UNION ALL SELECT 'tile' FROM zones) d GROUP BY 1""", "roads", "diamonds", "zones")
def s7(spark, sf):
    folder = new_path(spark, "datasets")
    T.roads(spark, sf).write.parquet(f"{folder}/roads.parquet")
    T.diamonds(spark, sf).select("geom_id", "rings").write.parquet(f"{folder}/parts.parquet")
    T.zones(spark, sf).write.parquet(f"{folder}/tiles/NZ")
    both = tables.read_datasets(spark, folder, ["roads", "absent", "parts"]).select("dataset", "geom_id")
    tiles = tables.read_tiles(spark, f"{folder}/tiles", "part-", "tile").select("dataset", "geom_id")
    return both.unionByName(tiles).groupBy("dataset").agg(F.count("*").alias("n"))


@query("s8_cache_layer", """SELECT geom_id FROM diamonds WHERE cx - w <= 1500 * @M AND cx + w >= 100 AND cy - w <= 2500 * @M AND cy + w >= 100""", "diamonds")
def s8(spark, sf):
    path, m = new_path(spark, "layer"), T.scale(spark, sf)
    tables.cache_layer(T.diamonds(spark, sf), path, bounds=(100, 100, 1500 * m, 2500 * m))
    return tables.cache_layer(T.zones(spark, sf), path).select("geom_id")  # is there already


@query("s10_s11_csv", """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders""")
def s10(spark, sf):
    source, target = new_path(spark, "csv"), new_path(spark, "parquet")
    T.read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").write.option("header", "true").csv(source)
    tables.csv_to_parquet(spark, source, target, "o_orderkey long, o_orderstatus string, o_totalprice double")
    known = tables.read_summary(spark, source).select(F.col("o_orderkey").cast("long").alias("o_orderkey"))
    return spark.read.parquet(target).join(known, "o_orderkey", "left_semi")


@query("s12_s13_k5_shapes", """SELECT name, round(2 * w * w, 2) + 0.0 AS area, CAST(floor((SELECT min(cx - w) FROM diamonds) / 100) * 100 AS DOUBLE) AS x0 FROM (SELECT CAST(geom_id AS VARCHAR) AS name, w FROM diamonds) d""", "diamonds")
def s12(spark, sf):
    """Shapes written as GeoJSON features, read back, with the snapped grid around them."""
    path = new_path(spark, "shapes")
    lines = geojson.features_json(T.diamonds(spark, sf).withColumn("name", F.col("geom_id").cast("string")), ["name"])
    lines = lines.groupBy(F.pmod(F.xxhash64("value"), F.lit(64)).alias("part")).agg(F.array_join(F.collect_list("value"), ",").alias("value"))
    lines.select("part", F.concat(F.lit('{"features": ['), "value", F.lit("]}")).alias("value")).write.partitionBy("part").text(path)
    shapes = geojson.read_shapes(spark, path, {"name": "string"}, "name")
    spec = geojson.boundary_grid(shapes, 100.0)
    return shapes.select("name", r6(G.ring_area(F.col("rings")[0]), "area", 2), F.lit(float(spec.x0)).alias("x0"))


@query("s17_read_predictions", """SELECT "row", col, identifier, p FROM predictions WHERE identifier LIKE '%A_%'""", "predictions")
def s17(spark, sf):
    per_cent = T.predictions(spark, sf).withColumn("p", S.percent(F.col("p")).cast("int"))
    return tables.read_predictions(spark, stored(per_cent, "predictions"), "A_", per_cent=True)


@query("s20_read_climate", """SELECT c."row", c.col, c.v FROM cells c JOIN classes k ON k."row" = c."row" AND k.col = c.col WHERE k.k = 1""", "cells", "classes")
def s20(spark, sf):
    folder = new_path(spark, "climate")
    T.cells(spark, sf).select(*KEY, "v").write.parquet(f"{folder}/bio5.parquet")
    return tables.read_climate(spark, folder, ["bio5", "none"], T.classes(spark, sf).filter("k = 1"))["bio5"]


@query("k1_write_cells", """SELECT "row", col, v FROM cells""", "cells")
def k1(spark, sf):
    path = new_path(spark, "cells")
    tables.write_cells(grid.with_tile(T.cells(spark, sf).select(*KEY, "v"), 64), path)
    return spark.read.parquet(path).select(*KEY, "v")


@query("k3_k4_results_and_models", """SELECT identifier, count(*) AS n FROM scored GROUP BY 1""", "scored")
def k3(spark, sf):
    path, models = new_path(spark, "results"), new_path(spark, "models")
    found = T.scored(spark, sf).groupBy("identifier").agg(F.count("*").alias("n"))
    tables.write_results(found, path)
    tables.write_models(found.select("identifier"), models)
    return spark.read.parquet(path).filter("timestamp IS NOT NULL").join(spark.read.parquet(models), "identifier").select("identifier", "n")


@query("g2_g3_point_grid", """SELECT (i + 0.5) * CAST(50 AS DOUBLE) AS x, (j + 0.5) * CAST(50 AS DOUBLE) AS y FROM (SELECT unnest(range(CAST((SELECT count(*) FROM supplier) AS BIGINT))) AS i) a, (SELECT unnest(range(20)) AS j) b""")
def g2(spark, sf):
    n = T.read(spark, sf, "supplier").count()
    return grid.point_grid(spark, (0.0, 0.0, 50.0 * n, 1000.0), 50.0)


@query("g8_tiles_from_corner", """SELECT count(*) AS n, min(xmin) AS x, max(ymax) AS y FROM (SELECT i * CAST(500 AS DOUBLE) AS xmin, (j + 1) * CAST(500 AS DOUBLE) AS ymax FROM (SELECT unnest(range(CAST(floor((SELECT max(x) FROM points) / 500) AS BIGINT) + 1)) AS i) a, (SELECT unnest(range(CAST(floor((SELECT max(y) FROM points) / 500) AS BIGINT) + 1)) AS j) b) t""", "points")
def g8(spark, sf):
    b = grid.total_bounds(T.points(spark, sf)).first()
    return grid.tile_from_corner(spark, (0.0, 0.0, b["xmax"], b["ymax"]), (5, 5), 100.0).agg(F.count("*").alias("n"), F.min("xmin").alias("x"), F.max("ymax").alias("y"))


@query("x6_points_in_polygon", """SELECT count(*) AS n, CAST(count(*) FILTER (abs(x - 500) + abs(y - 500) < 400) AS BIGINT) AS within FROM (SELECT 500.0 AS x, 500.0 AS y FROM supplier) s""")
def x6(spark, sf):
    n = T.read(spark, sf, "supplier").count()
    ring = [[100.0, 500.0], [500.0, 900.0], [900.0, 500.0], [500.0, 100.0], [100.0, 500.0]]
    p = sampling.points_in_polygon(spark, [ring], n)
    return p.agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("x") - 500) + F.abs(F.col("y") - 500) < 400.0001).alias("within"))
