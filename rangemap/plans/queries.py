"""One query per operator over the layers of standins, with SQL that any engine can check it by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalars as S
from ..operators import distance, evaluate, features, focal, grid, landcover, occurrence, raster, sampling, terrain, vector
from ..operators import imagery, maxent, predict
from . import standins as T
from .standins import with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
KEY = ["row", "col"]


def query(name: str, body: str | None = None, *tables: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if body is not None:
            ORACLE_SQL[name] = with_tables(body, *tables) if tables else body
        return fn

    return add


def r6(c: Column | str, name: str | None = None, digits: int = 6) -> Column:
    """Rounded for comparison, without a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    out = F.round(c, digits) + F.lit(0.0)
    return out.alias(name) if name else out


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(r6(F.col(f"`{c}`"), c, digits) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes))


def dense(spark: SparkSession, sf: str) -> DataFrame:
    return raster.densify(T.cells(spark, sf), grid.model_grid(spark, T.spec(spark, sf)))


# ---------------------------------------------------------------- occurrences

@query("flagship_habitat", """SELECT t.latin_name, count(*) AS n_cells, round(avg(c.v), 6) + 0.0 AS mean_v FROM thin t JOIN cells c ON c."row" = t."row" AND c.col = t.col GROUP BY 1""", "thin", "cells")
def flagship_habitat(spark, sf):
    """Per species: cells with a record within 50 m of the centre, and the mean environment there."""
    thin = occurrence.thin_to_cells(T.points(spark, sf), T.spec(spark, sf), ["latin_name"], "point_id", 50.0)
    found = occurrence.annotate(thin.drop(*KEY), T.cells(spark, sf), T.spec(spark, sf), ["v"])
    return found.groupBy("latin_name").agg(F.count("*").alias("n_cells"), r6(F.avg("v"), "mean_v"))


@query("s1_accurate_records", "SELECT point_id, latin_name FROM points WHERE accuracy <= 60", "points")
def s1(spark, sf):
    return occurrence.accurate(T.points(spark, sf), 60.0).select("point_id", "latin_name")


@query("s2_default_weight", "SELECT latin_name, count(*) AS n, sum(CAST(1.0 AS DOUBLE)) AS weight FROM points GROUP BY 1", "points")
def s2(spark, sf):
    return occurrence.with_weight(T.points(spark, sf)).groupBy("latin_name").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))


@query("s9_box_pushdown", "SELECT geom_id FROM (SELECT geom_id, cx - w AS minx, cy - w AS miny, cx + w AS maxx, cy + w AS maxy FROM diamonds) d WHERE minx >= 500 AND miny >= 500 AND maxx <= 3000 * @M AND maxy <= 3000 * @M", "diamonds")
def s9(spark, sf):
    from ..sources.tables import within_box

    d = T.diamonds(spark, sf).selectExpr("geom_id", "cx - w AS minx", "cy - w AS miny", "cx + w AS maxx", "cy + w AS maxy")
    return within_box(d, (500, 500, 3000 * T.scale(spark, sf), 3000 * T.scale(spark, sf))).select("geom_id")


@query("s16_s18_k6_grid_points", """SELECT "row", col FROM cells WHERE v IS NOT NULL AND d IS NOT NULL AND t IS NOT NULL""", "cells")
def s16(spark, sf):
    from ..sources.tables import grid_points

    return grid_points(dense(spark, sf))


@query("s18_from_percent", "SELECT event_id, CASE WHEN event_id % 103 - 2 >= 0 THEN CAST(event_id % 103 - 2 AS DOUBLE) / 100 END AS p FROM events")
def s18(spark, sf):
    e = T.read(spark, sf, "events")
    return e.select("event_id", S.from_percent((F.col("event_id") % 103 - 2).cast("double")).alias("p"))


@query("p1_filter_records", "SELECT point_id FROM points WHERE latin_name = 'click' AND activity_type = 'Roost'", "points")
def p1(spark, sf):
    return occurrence.filter_records(T.points(spark, sf), genus="absent", latin_name="click", activity_type="Roost").select("point_id")


@query("p2_among", "SELECT point_id FROM points WHERE latin_name IN ('click', 'purchase')", "points")
def p2(spark, sf):
    return occurrence.among(T.points(spark, sf), latin_name=["click", "purchase"], activity_type=None).select("point_id")


@query("p3_succeeded", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0")
def p3(spark, sf):
    o = T.read(spark, sf, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderstatus = 'F' THEN 'Success' ELSE 'Error' END AS status", "CASE WHEN o_orderkey % 3 <> 0 THEN 'm' END AS model_path")
    return occurrence.succeeded(o).select("o_orderkey")


@query("p4_point_in_polygon", "SELECT p.point_id, d.geom_id FROM points p JOIN diamonds d ON abs(p.x - d.cx) + abs(p.y - d.cy) < d.w", "points", "diamonds")
def p4(spark, sf):
    return vector.point_in_layer(T.points(spark, sf), T.diamonds(spark, sf), T.wide(spark, sf))


@query("p5_box_overlap", "SELECT geom_id FROM diamonds WHERE cx - w <= 1500 * @M AND cx + w >= 1000 AND cy - w <= 2500 * @M AND cy + w >= 1000", "diamonds")
def p5(spark, sf):
    d = T.diamonds(spark, sf)
    return d.filter(G.meets_box(G.box_of(F.col("rings")), (1000, 1000, 1500 * T.scale(spark, sf), 2500 * T.scale(spark, sf)))).select("geom_id")


_TOUCH = """SELECT DISTINCT geom_id, "row", col FROM (
 SELECT g."row", g.col, d.geom_id FROM grid g JOIN diamonds d ON
  greatest(g.x - 50 - d.cx, d.cx - g.x - 50, 0) + greatest(g.y - 50 - d.cy, d.cy - g.y - 50, 0) < d.w) z"""


@query("p6_touched_cells", _TOUCH, "grid", "diamonds")
def p6(spark, sf):
    return vector.touched_cells(T.diamonds(spark, sf), T.spec(spark, sf))


@query("p6_p7_clip", """SELECT c."row", c.col, c.v FROM cells c JOIN grid g ON g."row" = c."row" AND g.col = c.col WHERE EXISTS (SELECT 1 FROM diamonds d WHERE abs(g.x - d.cx) + abs(g.y - d.cy) < d.w)""", "grid", "diamonds", "cells")
def p7(spark, sf):
    inside = vector.polygon_cells(T.diamonds(spark, sf), T.spec(spark, sf))
    return raster.clip_cells(T.cells(spark, sf).select("row", "col", "v"), inside)


@query("p8_clip_box", """SELECT c."row", c.col, c.v FROM cells c JOIN grid g ON g."row" = c."row" AND g.col = c.col WHERE g.x BETWEEN 500 AND 2000 * @M AND g.y BETWEEN 1000 AND 3000 * @M""", "grid", "cells")
def p8(spark, sf):
    return raster.clip_box(T.cells(spark, sf), T.spec(spark, sf), (500, 1000, 2000 * T.scale(spark, sf), 3000 * T.scale(spark, sf))).select("row", "col", "v")


@query("p10_p11_p9_subset", """SELECT point_id, accuracy, CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS class FROM points WHERE user_id % 4 <> 0""", "points")
def p10(spark, sf):
    p = T.points(spark, sf).withColumn("f", F.when(F.col("user_id") % 4 != 0, 1.0)).withColumn("class", F.when(F.col("user_id") % 3 == 0, 1).otherwise(0))
    return features.subset(p, ["f"], ["point_id", "accuracy", "class"], drop_missing=True).drop("f")


@query("p12_large_parts", "SELECT geom_id, round(2 * w * w, 6) + 0.0 AS area FROM diamonds WHERE 2 * w * w / 1e6 > 0.02", "diamonds")
def p12(spark, sf):
    d = T.diamonds(spark, sf)
    return vector.large_parts(d, 0.02).select("geom_id", r6(G.ring_area(F.col("rings")[0]), "area"))


@query("p13_prefix_p14_p9", """SELECT "row", col, d FROM cells""", "cells")
def p13(spark, sf):
    c = T.cells(spark, sf)
    flags = spark.createDataFrame([("v", 0), ("d", 1), ("t", 0)], "variable string, include int")  # a table of the user's choices
    return features.subset(c, [b for b in features.with_prefix(raster.bands_of(c), ["d", "v"]) if b in features.included(flags)], KEY)


@query("p15_valid_rings", "SELECT geom_id FROM diamonds WHERE geom_id % 5 <> 0", "diamonds")
def p15(spark, sf):
    broken = F.when(F.col("geom_id") % 5 == 0, F.transform("rings", lambda r: F.slice(r, 1, 3))).otherwise(F.col("rings"))
    return vector.valid(T.diamonds(spark, sf).withColumn("rings", broken)).select("geom_id")


# ---------------------------------------------------------------- joins

@query("j1_annotate", """SELECT p.point_id, c.v, c.d FROM placed p JOIN cells c ON c."row" = p."row" AND c.col = p.col""", "placed", "cells")
def j1(spark, sf):
    return occurrence.annotate(T.points(spark, sf), T.cells(spark, sf), T.spec(spark, sf), ["v", "d"]).select("point_id", "v", "d")


@query("j2_j3_sample_band", """SELECT p.point_id, c.v FROM placed p LEFT JOIN cells c ON c."row" = p."row" + 5 AND c.col = p.col""", "placed", "cells")
def j2(spark, sf):
    spec = T.spec(spark, sf)
    shifted = grid.GridSpec(spec.x0, spec.ytop + 500, spec.res, spec.nrows, spec.ncols)
    return occurrence.annotate(T.points(spark, sf), T.cells(spark, sf), shifted, ["v"], drop_missing=False).select("point_id", "v")


@query("j4_t20_thin", """SELECT point_id, latin_name, "row", col FROM thin""", "thin")
def j4(spark, sf):
    return occurrence.thin_to_cells(T.points(spark, sf), T.spec(spark, sf), ["latin_name"], "point_id", 50.0).select("point_id", "latin_name", "row", "col")


@query("j5_merge_layers", """SELECT coalesce(a."row", b."row") AS "row", coalesce(a.col, b.col) AS col, a.v, b.k FROM cells a FULL JOIN (SELECT "row" + 5 AS "row", col - 3 AS col, k FROM classes) b ON a."row" = b."row" AND a.col = b.col""", "cells", "classes")
def j5(spark, sf):
    return raster.merge_layers({"a": T.cells(spark, sf).select(*KEY, "v"), "b": T.classes(spark, sf).selectExpr("row + 5 AS row", "col - 3 AS col", "k")})


@query("j6_background_outside_presence", """SELECT b.point_id FROM bgplaced b WHERE NOT EXISTS (SELECT 1 FROM placed p WHERE p.latin_name = 'purchase' AND p.activity_type = 'Roost' AND p."row" = b."row" AND p.col = b.col)""", "placed", "bgplaced")
def j6(spark, sf):
    pres = grid.with_cell(occurrence.filter_records(T.points(spark, sf), latin_name="purchase", activity_type="Roost"), T.spec(spark, sf), inside=False)
    return occurrence.drop_in_presence_cells(grid.with_cell(T.background(spark, sf), T.spec(spark, sf), inside=False), pres).select("point_id")


@query("j8_regions", "SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey")
def j8(spark, sf):
    counties = T.read(spark, sf, "customer").withColumnRenamed("c_nationkey", "key")
    used = T.read(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), "n_name").join(counties.select("key").distinct(), "key", "left_semi")
    return vector.join_regions(counties, used, "key").select("c_custkey", "n_name")


@query("j10_pairs", "SELECT a.latin_name, b.activity_type FROM (SELECT DISTINCT latin_name FROM points) a CROSS JOIN (SELECT DISTINCT activity_type FROM points) b", "points")
def j10(spark, sf):
    return occurrence.pairs(T.points(spark, sf))


@query("j11_scene_clouds", """SELECT s.scene, s.n, c.cloud FROM (SELECT scene, count(*) AS n FROM pixels GROUP BY 1) s JOIN (SELECT scene, probability AS cloud FROM (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY event_id) AS rn FROM pixels) q WHERE rn = 1) c USING (scene)""", "pixels")
def j11(spark, sf):
    px = T.pixels(spark, sf)
    scenes = px.groupBy("scene").agg(F.count("*").alias("n"))
    return imagery.with_cloud_probability(scenes, px.select("scene", "event_id", F.col("probability").alias("cloud")), "event_id").select("scene", "n", "cloud")


# ---------------------------------------------------------------- aggregates

@query("a1_band_statistics", """SELECT variable, round(avg(x), 6) + 0.0 AS mean, round(stddev_pop(x), 6) + 0.0 AS std, min(x) AS min, max(x) AS max FROM (SELECT 'v' AS variable, v AS x FROM cells UNION ALL SELECT 'd', d FROM cells UNION ALL SELECT 't', t FROM cells) u GROUP BY 1""", "cells")
def a1(spark, sf):
    s = raster.band_statistics(T.cells(spark, sf))
    return s.select("variable", r6("mean", "mean"), r6("std", "std"), "min", "max")


_BLOCK = """CAST("row" // 4 AS INTEGER) AS "row", CAST(col // 4 AS INTEGER) AS col"""


@query("a2_a5_coarsen_sum", f"""SELECT {_BLOCK}, round(coalesce(sum(v), 0), 6) + 0.0 AS v FROM cells WHERE "row" < @R // 4 * 4 AND col < @C // 4 * 4 GROUP BY 1, 2""", "cells")
def a2(spark, sf):
    return rounded(raster.coarsen_sum(T.cells(spark, sf).select(*KEY, "v"), T.spec(spark, sf), 4))


@query("a3_coarsen_strict", f"""SELECT {_BLOCK}, CASE WHEN count(v) = 16 THEN round(sum(v), 6) + 0.0 END AS v FROM (SELECT "row", col, CASE WHEN ("row" * 31 + col * 17) % 23 <> 0 THEN v END AS v FROM cells) c WHERE "row" < @R // 4 * 4 AND col < @C // 4 * 4 GROUP BY 1, 2""", "cells")
def a3(spark, sf):
    c = T.cells(spark, sf).select(*KEY, F.when((F.col("row") * 31 + F.col("col") * 17) % 23 != 0, F.col("v")).alias("v"))
    return rounded(raster.coarsen_sum(c, T.spec(spark, sf), 4, strict=True))


@query("a4_coarsen_stats", f"""SELECT {_BLOCK}, round(avg(v), 6) + 0.0 AS veg_mean_400m, round(min(v), 6) + 0.0 AS veg_min_400m, round(max(v), 6) + 0.0 AS veg_max_400m, round(stddev_pop(v), 6) + 0.0 AS veg_std_400m FROM cells GROUP BY 1, 2""", "cells")
def a4(spark, sf):
    return rounded(raster.coarsen_stats(T.cells(spark, sf), 4, "v", "veg", 400))


@query("a6_point_counts", """SELECT g."row", g.col, CAST(count(p.point_id) AS DOUBLE) AS value FROM grid g LEFT JOIN placed p ON least(p."row", @R - 1) = g."row" AND p.col = g.col GROUP BY 1, 2""", "grid", "placed")
def a6(spark, sf):
    return raster.point_counts(T.points(spark, sf), T.spec(spark, sf), grid.model_grid(spark, T.spec(spark, sf)))


@query("a7_a8_a10_class_counts", """SELECT latin_name || '_' || activity_type AS identifier, count(*) FILTER (user_id % 3 = 0) AS n_presence, count(*) FILTER (user_id % 3 <> 0) AS n_background FROM points GROUP BY 1""", "points")
def a8(spark, sf):
    p = T.points(spark, sf).select(S.identifier(F.col("latin_name"), F.col("activity_type")).alias("identifier"), F.when(F.col("user_id") % 3 == 0, 1).otherwise(0).alias("class"))
    return occurrence.class_counts(p)


@query("a9_cv_summary", """SELECT identifier, round(avg(auc), 6) + 0.0 AS mean_cv_score, round(stddev_pop(auc), 6) + 0.0 AS std_cv_score FROM (SELECT identifier, class, CASE WHEN avg(p) > 0.2 THEN avg(p) END AS auc FROM scored GROUP BY 1, 2) s GROUP BY 1""", "scored")
def a9(spark, sf):
    s = T.scored(spark, sf).groupBy("identifier", "class").agg(F.avg("p").alias("auc")).withColumn("auc", F.when(F.col("auc") > 0.2, F.col("auc")))
    return rounded(evaluate.cv_summary(s, ["identifier"]))


@query("a11_missing_fraction", """SELECT variable, round(m, 9) + 0.0 AS missing FROM (SELECT 'k' AS variable, avg(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS m FROM classes UNION ALL SELECT 'zero', avg(CASE WHEN nullif(k, 0) IS NULL THEN 1 ELSE 0 END) FROM classes) u WHERE m > 0""", "classes")
def a11(spark, sf):
    c = T.classes(spark, sf).withColumn("zero", F.nullif(F.col("k"), F.lit(0)))
    return features.missing_fraction(c, ["k", "zero"]).select("variable", r6("missing", "missing", 9))


@query("a12_correlations", """SELECT variable_1, variable_2, round(r, 6) + 0.0 AS r FROM (SELECT 'v' AS variable_1, 'd' AS variable_2, corr(v, d) AS r FROM cells UNION ALL SELECT 'v', 't', corr(v, t) FROM cells UNION ALL SELECT 'd', 't', corr(d, t) FROM cells UNION ALL SELECT 'd', 'v', corr(v, d) FROM cells UNION ALL SELECT 't', 'v', corr(v, t) FROM cells UNION ALL SELECT 't', 'd', corr(d, t) FROM cells) u""", "cells")
def a12(spark, sf):
    return rounded(features.correlations(T.cells(spark, sf), ["v", "d", "t"]))


@query("a13_l2_m14_select_features", """SELECT feature, round(score, 6) + 0.0 AS score FROM (SELECT 'd' AS feature, abs(corr(d, v)) AS score FROM cells UNION ALL SELECT 't', abs(corr(t, v)) FROM cells UNION ALL SELECT 'row', abs(corr("row", v)) FROM cells UNION ALL SELECT 'col', abs(corr(col, v)) FROM cells) u WHERE score >= 0.0001 ORDER BY score DESC, feature LIMIT 3""", "cells")
def a13(spark, sf):
    return rounded(features.select_features(features.target_correlation(T.cells(spark, sf), ["d", "t", "row", "col"], "v"), 0.0001, 3))


@query("a14_mutual_information")
def a14(spark, sf):
    p = occurrence.annotate(T.points(spark, sf), T.cells(spark, sf), T.spec(spark, sf), ["v", "d", "t"])
    return features.mutual_information(p, ["v", "d", "t", "x", "y"], "latin_name")


@query("a15_l3_importance_summary", """SELECT latin_name, round(avg(accuracy - 50), 6) + 0.0 AS mean_importance, avg(accuracy - 50) > 0 AS keep_var FROM points GROUP BY 1""", "points")
def a15(spark, sf):
    p = T.points(spark, sf).select("latin_name", (F.col("accuracy") - 50).alias("importance"))
    return rounded(evaluate.importance_summary(p, ["latin_name"]))


@query("a16_mean_prediction", """SELECT identifier, round(avg(p), 6) + 0.0 AS mean_p FROM predictions WHERE identifier LIKE '%Roost%' GROUP BY 1""", "predictions")
def a16(spark, sf):
    return rounded(predict.mean_prediction(T.predictions(spark, sf), "Roost"))


@query("a17_richness", """SELECT "row", col, CAST(count(*) FILTER (p >= 0.7) AS INTEGER) AS richness FROM predictions GROUP BY 1, 2""", "predictions")
def a17(spark, sf):
    return predict.richness(T.predictions(spark, sf), 0.7)


_EDGES = """SELECT brand, geom_id, floor(cx / 100) * 100 AS bx, floor(cy / 100) * 100 AS by_ FROM diamonds"""


@query("a18_dissolve", f"""SELECT brand, x1, y1, x2, y2 FROM (
 SELECT brand, bx AS x1, by_ AS y1, bx + 100 AS x2, by_ AS y2 FROM ({_EDGES}) e UNION ALL
 SELECT brand, bx, by_ + 100, bx + 100, by_ + 100 FROM ({_EDGES}) e UNION ALL
 SELECT brand, bx, by_, bx, by_ + 100 FROM ({_EDGES}) e UNION ALL
 SELECT brand, bx + 100, by_, bx + 100, by_ + 100 FROM ({_EDGES}) e) z GROUP BY 1, 2, 3, 4, 5 HAVING count(*) % 2 = 1""", "diamonds")
def a18(spark, sf):
    """Outlines of the brands' grid squares."""
    s = grid.squares(T.diamonds(spark, sf), 100.0, (0.0, 0.0), "cx", "cy")
    at = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(at("xmin", "ymin"), at("xmax", "ymin"), at("xmax", "ymax"), at("xmin", "ymax"), at("xmin", "ymin"))
    return vector.dissolved_edges(s.select("geom_id", "brand", F.array(ring).alias("rings")), "brand")


@query("a19_confusion", """SELECT identifier, tp, fp, tn, fn, round((tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE), 6) + 0.0 AS accuracy, CASE WHEN tp + fn > 0 THEN round(tp / CAST(tp + fn AS DOUBLE), 6) + 0.0 ELSE 0.0 END AS sensitivity, CASE WHEN tn + fp > 0 THEN round(tn / CAST(tn + fp AS DOUBLE), 6) + 0.0 ELSE 0.0 END AS specificity, CASE WHEN tp + fp > 0 THEN round(tp / CAST(tp + fp AS DOUBLE), 6) + 0.0 ELSE 0.0 END AS precision, CASE WHEN 2 * tp + fp + fn > 0 THEN round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) + 0.0 ELSE 0.0 END AS f1 FROM (SELECT identifier, count(*) FILTER (p >= 0.5 AND class = 1) AS tp, count(*) FILTER (p >= 0.5 AND class = 0) AS fp, count(*) FILTER (p < 0.5 AND class = 0) AS tn, count(*) FILTER (p < 0.5 AND class = 1) AS fn FROM scored GROUP BY 1) c""", "scored")
def a19(spark, sf):
    return rounded(evaluate.confusion(T.scored(spark, sf), ["identifier"]))


@query("a20_auc", """SELECT a.identifier, round(sum(a.np * (b.below + a.nn / 2.0)) / (sum(a.np) * CAST(sum(a.nn) AS DOUBLE)), 9) + 0.0 AS auc FROM (SELECT identifier, p, count(*) FILTER (class = 1) AS np, count(*) FILTER (class = 0) AS nn FROM scored GROUP BY 1, 2) a JOIN (SELECT s.identifier, s.p, count(t.p) AS below FROM (SELECT DISTINCT identifier, p FROM scored) s LEFT JOIN (SELECT identifier, p FROM scored WHERE class = 0) t ON t.identifier = s.identifier AND t.p < s.p GROUP BY 1, 2) b ON b.identifier = a.identifier AND b.p = a.p GROUP BY 1""", "scored")
def a20(spark, sf):
    return evaluate.auc(T.scored(spark, sf), ["identifier"]).select("identifier", r6("auc", "auc", 9))


@query("a21_linear_fit", "SELECT round(regr_slope(v, d), 6) + 0.0 AS slope, round(regr_intercept(v, d), 6) + 0.0 AS intercept, round(corr(d, v), 6) + 0.0 AS r FROM cells", "cells")
def a21(spark, sf):
    return rounded(evaluate.linear_fit(T.cells(spark, sf), "d", "v"))


@query("a22_total_bounds", "SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM points", "points")
def a22(spark, sf):
    return grid.total_bounds(T.points(spark, sf))


_BIN = ", ".join(f"CAST(k = {i} AS INTEGER)" for i in range(7))


@query("v5_a24_v4_habitats", """SELECT "row", col, coalesce(CAST(k = 0 AS INTEGER), 0) * CAST(100 AS DOUBLE) AS urban, (coalesce(CAST(k = 1 AS INTEGER), 0) + coalesce(CAST(k = 2 AS INTEGER), 0)) * CAST(100 AS DOUBLE) AS grassland, coalesce(CAST(k = 3 AS INTEGER), 0) * CAST(100 AS DOUBLE) AS wetland FROM classes""", "classes")
def v5(spark, sf):
    layers = landcover.binary_layers(T.classes(spark, sf), "k", {0: "urban", 1: "Neutral Grassland", 2: "Acid-grassland", 3: "Bog", 4: "Inland rock"})
    area = landcover.as_area(layers, 10.0)
    return landcover.aggregate_layers(area, {"grassland": ["Neutral grassland", "Acid grassland"], "wetland": ["Bog", "absent"], "none": ["absent"]}, ["Inland rock"])


@query("a25_only_groups", """SELECT "row", col, CAST(CAST(k = 1 AS INTEGER) + CAST(k = 2 AS INTEGER) AS DOUBLE) AS g FROM classes""", "classes")
def a25(spark, sf):
    layers = landcover.binary_layers(T.classes(spark, sf), "k", {1: "a", 2: "b", 3: "c"})
    return landcover.only_groups(layers, {"g": ["a", "b"], "h": ["c"]}, ["h"])


@query("v5_null_as_zero", """SELECT "row", col, CAST(coalesce(CAST(k = 1 AS INTEGER), 0) AS DOUBLE) AS one FROM classes""", "classes")
def v5z(spark, sf):
    return landcover.binary_layers(T.classes(spark, sf), "k", {1: "one"}, null_as_zero=True)


# ---------------------------------------------------------------- windows

def _focal_sql(w: int, select: str, value: str = "v", table: str = "cells") -> str:
    a, b = w // 2, w - 1 - w // 2
    return f"""SELECT c."row", c.col, {select} FROM {table} c JOIN {table} n ON n."row" BETWEEN c."row" - {a} AND c."row" + {b} AND n.col BETWEEN c.col - {a} AND c.col + {b} GROUP BY c."row", c.col, c.{value}"""


def _strict(w: int, expr: str, name: str, value: str = "v") -> str:
    return f"CASE WHEN count(n.{value}) = {w * w} THEN round({expr}, 6) + 0.0 END AS {name}"


@query("t1_multiscale_mean", """SELECT a."row", a.col, a.v_150m, b.v_500m FROM (""" + _focal_sql(3, _strict(3, "avg(n.v)", "v_150m")) + ") a JOIN (" + _focal_sql(10, _strict(10, "avg(n.v)", "v_500m")) + """) b ON a."row" = b."row" AND a.col = b.col""", "cells")
def t1(spark, sf):
    return rounded(focal.multiscale_mean(T.cells(spark, sf), [3, 10], 100.0, ["v"]))


@query("t2_roughness", _focal_sql(3, _strict(3, "stddev_pop(n.v)", "roughness")), "cells")
def t2(spark, sf):
    return rounded(focal.focal_std(T.cells(spark, sf), "v"))


@query("t3_t4_position", _focal_sql(5, _strict(5, "c.v - avg(n.v)", "tpi")), "cells")
def t3(spark, sf):
    return rounded(focal.position_index(T.cells(spark, sf), "v", 5))


@query("t9_ruggedness", _focal_sql(3, _strict(3, "sqrt(sum((n.v - c.v) * (n.v - c.v)))", "tri")), "cells")
def t9(spark, sf):
    return rounded(focal.ruggedness_index(T.cells(spark, sf), "v"))


@query("t18_extremes", """SELECT a."row", a.col, a.low, b.high FROM (""" + _focal_sql(3, "min(n.v) AS low") + ") a JOIN (" + _focal_sql(5, "max(n.v) AS high") + """) b ON a."row" = b."row" AND a.col = b.col""", "cells")
def t18(spark, sf):
    c = raster.densify(T.cells(spark, sf), grid.model_grid(spark, T.spec(spark, sf))).select(*KEY, "v")
    both = focal.focal_extreme(c, "v", 3, "min", "low").join(focal.focal_extreme(c, "v", 5, "max", "high"), KEY)
    return both.join(T.cells(spark, sf).select(*KEY), KEY, "left_semi")


@query("t10_diversity", """SELECT c."row", c.col, CAST(count(DISTINCT n.k) AS INTEGER) AS diversity FROM classes c JOIN classes n ON n."row" BETWEEN c."row" - 1 AND c."row" + 1 AND n.col BETWEEN c.col - 1 AND c.col + 1 GROUP BY 1, 2""", "classes")
def t10(spark, sf):
    dense_k = raster.densify(T.classes(spark, sf), grid.model_grid(spark, T.spec(spark, sf)))
    return focal.diversity(dense_k, "k", 3).join(T.classes(spark, sf).select(*KEY), KEY, "left_semi")


@query("t11_dominance", """SELECT c."row", c.col, m.dominance FROM classes c LEFT JOIN (SELECT "row", col, max(n) / CAST(sum(n) AS DOUBLE) AS dominance FROM (SELECT c."row", c.col, n.k, count(*) AS n FROM classes c JOIN classes n ON n."row" BETWEEN c."row" - 1 AND c."row" + 1 AND n.col BETWEEN c.col - 1 AND c.col + 1 WHERE n.k IS NOT NULL GROUP BY 1, 2, 3) q GROUP BY 1, 2) m ON m."row" = c."row" AND m.col = c.col""", "classes")
def t11(spark, sf):
    return focal.dominance(T.classes(spark, sf), "k", 3)


_NINE = """SELECT c."row", c.col, c.v AS e, """ + ", ".join(f"""max(n.v) FILTER (n."row" = c."row" + {i} AND n.col = c.col + {j}) AS {name}""" for name, (i, j) in {"a": (-1, -1), "b": (-1, 0), "c": (-1, 1), "d": (0, -1), "f": (0, 1), "g": (1, -1), "h": (1, 0), "i": (1, 1)}.items()) + """ FROM cells c JOIN cells n ON n."row" BETWEEN c."row" - 1 AND c."row" + 1 AND n.col BETWEEN c.col - 1 AND c.col + 1 GROUP BY 1, 2, 3"""
_FILLED = f"""SELECT "row", col, e, {", ".join(f"coalesce({x}, e) AS {x}" for x in "abcdfghi")} FROM ({_NINE}) s"""
_HORN = f"""SELECT *, ((c + 2 * f + i) - (a + 2 * d + g)) / 800.0 AS dx, ((a + 2 * b + c) - (g + 2 * h + i)) / 800.0 AS dy FROM ({_FILLED}) z"""


@query("t5_slope_aspect", f"""SELECT "row", col, round(atan(sqrt(dx * dx + dy * dy)), 9) + 0.0 AS slope, CASE WHEN dx <> 0 OR dy <> 0 THEN round((degrees(atan2(-dx, -dy)) + 360) % 360, 6) + 0.0 END AS aspect FROM ({_HORN}) z2""", "cells")
def t5(spark, sf):
    s = terrain.slope_aspect(T.cells(spark, sf), "v", 100.0)
    return s.select(*KEY, r6("slope", "slope", 9), r6("aspect", "aspect"))


@query("t6_slope_aspect_strict", f"""SELECT "row", col, CASE WHEN full_ THEN round(degrees(atan(sqrt(dx * dx + dy * dy))), 6) + 0.0 END AS slope, CASE WHEN full_ THEN round((degrees(atan2(dy, CASE WHEN dx = 0 THEN 0.0 ELSE -dx END)) + 360) % 360, 6) + 0.0 END AS aspect FROM (SELECT *, (f - d) / 200.0 AS dx, (h - b) / 200.0 AS dy, a + b + c + d + e + f + g + h + i IS NOT NULL AS full_ FROM ({_NINE}) z) z2""", "cells")
def t6(spark, sf):
    return rounded(terrain.slope_aspect_strict(T.cells(spark, sf), "v", 100.0))


@query("t7_t8_aspect_components", f"""SELECT "row", col, round(sin(radians(aspect)), 6) + 0.0 AS eastness, round(cos(radians(aspect)), 6) + 0.0 AS northness, round(slope * sin(radians(aspect)), 6) + 0.0 AS weighted_eastness, round(slope * cos(radians(aspect)), 6) + 0.0 AS weighted_northness FROM (SELECT "row", col, atan(sqrt(dx * dx + dy * dy)) AS slope, CASE WHEN dx <> 0 OR dy <> 0 THEN (degrees(atan2(-dx, -dy)) + 360) % 360 END AS aspect FROM ({_HORN}) z2) z3""", "cells")
def t7(spark, sf):
    s = terrain.weighted_aspect(terrain.aspect_components(terrain.slope_aspect(T.cells(spark, sf), "v", 100.0)))
    return rounded(s.drop("slope", "aspect"))


@query("t12_curvature", f"""SELECT "row", col, CASE WHEN gg * gg + hh * hh = 0 THEN 0.0 ELSE round(-2 * (dd * hh * hh + ee * gg * gg - ff * gg * hh) / (gg * gg + hh * hh) * 100, 6) + 0.0 END AS planform_curvature FROM (SELECT "row", col, ((d + f) / 2 - e) / 10000.0 AS dd, ((b + h) / 2 - e) / 10000.0 AS ee, (c + g - a - i) / 40000.0 AS ff, (f - d) / 200.0 AS gg, (b - h) / 200.0 AS hh FROM ({_FILLED}) z) z2""", "cells")
def t12(spark, sf):
    return rounded(terrain.curvature(T.cells(spark, sf), "v", 100.0))


_FLOW = """, moves AS (SELECT "row", col, nr, nc FROM (SELECT c."row", c.col, n."row" AS nr, n.col AS nc, row_number() OVER (PARTITION BY c."row", c.col ORDER BY (c.v - n.v) / sqrt(CAST((c."row" - n."row") * (c."row" - n."row") + (c.col - n.col) * (c.col - n.col) AS DOUBLE)) DESC, n."row", n.col) AS rn FROM cells c JOIN cells n ON n."row" BETWEEN c."row" - 1 AND c."row" + 1 AND n.col BETWEEN c.col - 1 AND c.col + 1 AND n.v < c.v) q WHERE rn = 1),
 paths AS (SELECT "row" AS r0, col AS c0, "row", col FROM cells UNION ALL SELECT p.r0, p.c0, m.nr, m.nc FROM paths p JOIN moves m ON m."row" = p."row" AND m.col = p.col),
 flow AS (SELECT "row", col, count(*) AS flow FROM paths GROUP BY 1, 2)"""


def _flow_sql(select: str) -> str:
    return with_tables("/*recursive*/" + _FLOW.replace("/*recursive*/", "") + "\n" + select, "cells")


QUERY_FLOW = _flow_sql("""SELECT "row", col, flow FROM flow""")


@query("t14_flow_accumulation", QUERY_FLOW)
def t14(spark, sf):
    return terrain.flow_accumulation(T.cells(spark, sf).select(*KEY, "v"), "v")


@query("t13_wetness", _flow_sql(f"""SELECT f."row", f.col, round(ln(f.flow / greatest(atan(sqrt(z2.dx * z2.dx + z2.dy * z2.dy)), 0.001)), 6) + 0.0 AS twi FROM flow f JOIN ({_HORN}) z2 ON z2."row" = f."row" AND z2.col = f.col"""))
def t13(spark, sf):
    return rounded(terrain.wetness_index(T.cells(spark, sf).select(*KEY, "v"), "v", 100.0))


_BUNDLE = f""", horn AS ({_HORN}), base AS (SELECT "row", col, atan(sqrt(dx * dx + dy * dy)) AS slope, CASE WHEN dx <> 0 OR dy <> 0 THEN radians((degrees(atan2(-dx, -dy)) + 360) % 360) END AS a FROM horn),
 rough AS ({_focal_sql(3, _strict(3, "stddev_pop(n.slope)", "roughness", "slope"), "slope", "base")}), tpi AS ({_focal_sql(3, _strict(3, "c.v - avg(n.v)", "tpi"))})
 SELECT b."row", b.col, round(b.slope, 6) + 0.0 AS slope, round(sin(a), 6) + 0.0 AS eastness, round(cos(a), 6) + 0.0 AS northness, round(b.slope * sin(a), 6) + 0.0 AS weighted_eastness, round(b.slope * cos(a), 6) + 0.0 AS weighted_northness, r.roughness, t.tpi, round(ln(f.flow / greatest(b.slope, 0.001)), 6) + 0.0 AS twi,
  CASE WHEN gg * gg + hh * hh = 0 THEN 0.0 ELSE round(-2 * (dd * hh * hh + ee * gg * gg - ff * gg * hh) / (gg * gg + hh * hh) * 100, 6) + 0.0 END AS planform_curvature
 FROM base b JOIN rough r ON r."row" = b."row" AND r.col = b.col JOIN tpi t ON t."row" = b."row" AND t.col = b.col JOIN flow f ON f."row" = b."row" AND f.col = b.col
 JOIN (SELECT "row", col, ((d + f) / 2 - e) / 10000.0 AS dd, ((b + h) / 2 - e) / 10000.0 AS ee, (c + g - a - i) / 40000.0 AS ff, (f - d) / 200.0 AS gg, (b - h) / 200.0 AS hh FROM ({_FILLED}) z) k ON k."row" = b."row" AND k.col = b.col"""


@query("t15_terrain_bundle", _flow_sql(_BUNDLE))
def t15(spark, sf):
    return rounded(terrain.terrain_attributes(T.cells(spark, sf), "v", 100.0))


def _mirror(axis: str, n: str) -> str:
    return f"CASE WHEN {axis} < 0 THEN -1 - ({axis}) WHEN {axis} >= {n} THEN 2 * {n} - 1 - ({axis}) ELSE {axis} END"


_KERNEL = "SELECT d, exp(-0.5 * d * d / 2.25) / (SELECT sum(exp(-0.5 * q * q / 2.25)) FROM range(-6, 7) b(q)) AS w FROM range(-6, 7) a(d)"


# One pass of 13 terms along each axis.
@query("t16_gaussian", f""", whole AS (SELECT g."row", g.col, coalesce(c.v, 0) AS v FROM grid g LEFT JOIN cells c ON c."row" = g."row" AND c.col = g.col), kernel AS ({_KERNEL}),
 down AS (SELECT c."row", c.col, sum(c.w * n.v) AS v FROM (SELECT g."row", g.col, k.w, {_mirror('g."row" + k.d', "@R")} AS r FROM grid g CROSS JOIN kernel k) c JOIN whole n ON n."row" = c.r AND n.col = c.col GROUP BY 1, 2)
 SELECT c."row", c.col, round(sum(c.w * n.v), 6) + 0.0 AS v FROM (SELECT g."row", g.col, k.w, {_mirror('g.col + k.d', "@C")} AS c FROM grid g CROSS JOIN kernel k) c JOIN down n ON n."row" = c."row" AND n.col = c.c GROUP BY 1, 2""", "grid", "cells")
def t16(spark, sf):
    return rounded(focal.gaussian(dense(spark, sf).na.fill(0.0, ["v"]), T.spec(spark, sf).nrows, T.spec(spark, sf).ncols, "v", 1.5))


_GAPS = """SELECT g."row", g.col, CASE WHEN (g."row" * 31 + g.col * 17) % 7 < 5 THEN c.v END AS v FROM grid g LEFT JOIN cells c ON c."row" = g."row" AND c.col = g.col"""


def _fill(src: str, across: str, along: str) -> str:
    known = f"(SELECT * FROM {src} WHERE v IS NOT NULL)"
    return f"""SELECT s."row", s.col, coalesce(s.v, CASE WHEN lo.v IS NOT NULL AND hi.v IS NOT NULL THEN lo.v + (hi.v - lo.v) * (s.{along} - lo.{along}) / CAST(hi.{along} - lo.{along} AS DOUBLE) END) AS v FROM {src} s LEFT JOIN (SELECT s."row" AS r, s.col AS c, max(k.{along}) AS at FROM {src} s JOIN {known} k ON k.{across} = s.{across} AND k.{along} < s.{along} GROUP BY 1, 2) b ON b.r = s."row" AND b.c = s.col LEFT JOIN {known} lo ON lo.{across} = s.{across} AND lo.{along} = b.at LEFT JOIN (SELECT s."row" AS r, s.col AS c, min(k.{along}) AS at FROM {src} s JOIN {known} k ON k.{across} = s.{across} AND k.{along} > s.{along} GROUP BY 1, 2) e ON e.r = s."row" AND e.c = s.col LEFT JOIN {known} hi ON hi.{across} = s.{across} AND hi.{along} = e.at"""


@query("t17_interpolate_gaps", f""", gaps AS ({_GAPS}), first_ AS ({_fill("gaps", "col", '"row"')}), second_ AS ({_fill("first_", '"row"', "col")}) SELECT "row", col, round(v, 6) + 0.0 AS v FROM second_""", "grid", "cells")
def t17(spark, sf):
    gaps = dense(spark, sf).select(*KEY, F.when((F.col("row") * 31 + F.col("col") * 17) % 7 < 5, F.col("v")).alias("v"))
    return rounded(raster.interpolate_gaps(gaps, ["v"]))


@query("t19_average_rank", """SELECT o_orderkey, (rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0) / count(*) OVER () AS rank FROM (SELECT o_orderkey, o_custkey % 50 AS v FROM orders) o""")
def t19(spark, sf):
    o = T.read(spark, sf, "orders").selectExpr("o_orderkey", "o_custkey % 50 AS v")
    return sampling.average_rank(o, "v").select("o_orderkey", "rank")


@query("udf_focal_apply", _focal_sql(3, _strict(3, "max(n.v) - min(n.v)", "relief")), "cells")
def udf(spark, sf):
    return rounded(focal.focal_apply(T.cells(spark, sf).select(*KEY, "v"), "v", 3, lambda a: F.array_max(a) - F.array_min(a), "relief"))


# ---------------------------------------------------------------- sorts, sets

@query("l1_densest", """SELECT point_id, weight FROM background ORDER BY weight DESC, point_id LIMIT 100""", "background")
def l1(spark, sf):
    return occurrence.densest(T.background(spark, sf), 100).select("point_id", "weight")


@query("l1_densest_by_group", """SELECT point_id, g FROM (SELECT *, point_id % 7 AS g, row_number() OVER (PARTITION BY point_id % 7 ORDER BY weight DESC, point_id) AS rn FROM background) b WHERE rn <= 20""", "background")
def l1g(spark, sf):
    return occurrence.densest(T.background(spark, sf).withColumn("g", F.col("point_id") % 7), 20, ["g"]).select("point_id", "g")


@query("u1_stack", """SELECT point_id, 1 AS class FROM points UNION ALL SELECT point_id, 0 FROM background""", "points", "background")
def u1(spark, sf):
    return occurrence.stack(T.points(spark, sf).select("point_id"), T.background(spark, sf).select("point_id"))


@query("u2_s15_mosaic", """SELECT "row", col, v FROM (SELECT *, row_number() OVER (PARTITION BY "row", col ORDER BY tile) AS rn FROM (SELECT "row", col, v, 1 AS tile FROM cells WHERE "row" < 25 * @M UNION ALL SELECT "row", col, v + 1, 2 FROM cells WHERE "row" >= 20 * @M) u) q WHERE rn = 1""", "cells")
def u2(spark, sf):
    c = T.cells(spark, sf).select(*KEY, "v")
    return raster.mosaic([c.filter(F.col("row") < 25 * T.scale(spark, sf)).withColumn("tile", F.lit(1)), c.filter(F.col("row") >= 20 * T.scale(spark, sf)).withColumn("v", F.col("v") + 1).withColumn("tile", F.lit(2))], "tile").select(*KEY, "v")


@query("u4_missing_features", "SELECT DISTINCT l_partkey FROM lineitem EXCEPT SELECT p_partkey FROM part WHERE p_size > 25")
def u4(spark, sf):
    return features.missing_from(T.read(spark, sf, "lineitem"), T.read(spark, sf, "part").filter("p_size > 25").select(F.col("p_partkey").alias("l_partkey")), "l_partkey")


@query("u5_sea_within_buffer", """SELECT g."row", g.col FROM grid g WHERE EXISTS (SELECT 1 FROM diamonds d WHERE abs(g.x - d.cx) + abs(g.y - d.cy) < d.w + 100) AND NOT EXISTS (SELECT 1 FROM diamonds d WHERE abs(g.x - d.cx) + abs(g.y - d.cy) < d.w)""", "grid", "diamonds")
def u5(spark, sf):
    z = T.diamonds(spark, sf)
    near = vector.polygon_cells(T.with_diamond(z, 100.0), T.spec(spark, sf)).select(*KEY).distinct()
    return vector.difference_cells(near, vector.polygon_cells(z, T.spec(spark, sf)))


@query("u6_explode_parts", "SELECT brand, count(*) AS parts, round(sum(2 * w * w), 3) + 0.0 AS area FROM (SELECT brand, w FROM diamonds UNION ALL SELECT brand, w / 2 FROM diamonds) d GROUP BY 1", "diamonds")
def u6(spark, sf):
    """Multi-part geometries of two diamonds each, to parts; a brand's parts are its dissolved geometry."""
    d = T.diamonds(spark, sf)
    half = T.with_diamond(d.withColumn("w", F.col("w") / 2)).select("geom_id", F.col("rings").alias("inner"))
    p = vector.parts(d.join(half, "geom_id").select("geom_id", F.array("rings", "inner").alias("parts")))
    p = vector.dissolve(p.join(d.select("geom_id", "brand"), "geom_id").select("brand", F.concat_ws(".", "geom_id", "part").alias("geom_id"), "rings"), "brand")
    return p.groupBy("brand").agg(F.count("*").alias("parts"), r6(F.sum(G.ring_area(F.col("rings")[0])), "area", 3))


@query("l5_by_group", "SELECT latin_name, point_id, accuracy FROM points ORDER BY latin_name, accuracy DESC, point_id", "points")
def l5(spark, sf):
    return evaluate.by_group(T.points(spark, sf).select("latin_name", "point_id", "accuracy"), ["latin_name"], "accuracy")


# ---------------------------------------------------------------- grid and geometry

@query("g1_reproject_round_trip", "SELECT point_id, true AS close FROM points", "points")
def g1(spark, sf):
    p = T.points(spark, sf).select("point_id", (F.col("x") + 430000).alias("x"), (F.col("y") + 450000).alias("y"))
    back = G.reproject(G.reproject(p.withColumns({"x0": F.col("x"), "y0": F.col("y")}), 27700, 4326), 4326, 27700)
    return back.select("point_id", ((F.abs(F.col("x") - F.col("x0")) < 0.5) & (F.abs(F.col("y") - F.col("y0")) < 0.5)).alias("close"))


@query("g5_g6_grid_squares", "SELECT point_id, round(x - x % 100, 1) + 0.0 AS xmin, round(y - y % 100, 1) + 0.0 AS ymin FROM points", "points")
def g6(spark, sf):
    s = grid.squares(T.points(spark, sf), 100.0)
    return s.select("point_id", r6("xmin", "xmin", 1), r6("ymin", "ymin", 1))


@query("g7_g8_tiles", "SELECT CAST(floor(x / 500) * 500 AS DOUBLE) AS xmin, CAST(floor(y / 500) * 500 AS DOUBLE) AS ymin, count(*) AS n FROM points GROUP BY 1, 2", "points")
def g7(spark, sf):
    p = T.points(spark, sf)
    b = grid.total_bounds(p).first()
    tiles = grid.tile_box(spark, tuple(b), (500.0, 500.0))
    keyed = p.select(grid.align(F.col("x"), 0.0, 500.0).alias("xmin"), grid.align(F.col("y"), 0.0, 500.0).alias("ymin"))
    return tiles.join(keyed.groupBy("xmin", "ymin").agg(F.count("*").alias("n")), ["xmin", "ymin"]).select("xmin", "ymin", "n")


# The first two corners of a small diamond may fall on one place, which makes them one; the second is then the right corner.
@query("g10_simplify", """SELECT geom_id, CASE WHEN one THEN round((cx + w) / 25) * 25 ELSE round(cx / 25) * 25 END AS x, CASE WHEN one THEN round(cy / 25) * 25 ELSE round((cy + w) / 25) * 25 END AS y
 FROM (SELECT *, round((cx - w) / 25) = round(cx / 25) AND round(cy / 25) = round((cy + w) / 25) AS one FROM diamonds) z""", "diamonds")
def g10(spark, sf):
    s = vector.simplify(T.diamonds(spark, sf), 25.0).select("geom_id", F.col("rings")[0][1].alias("p"))
    return s.select("geom_id", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


@query("v1_rasterise", """SELECT g."row", g.col, CASE WHEN EXISTS (SELECT 1 FROM diamonds d WHERE abs(g.x - d.cx) + abs(g.y - d.cy) < d.w) THEN 1 ELSE 0 END AS value FROM grid g""", "grid", "diamonds")
def v1(spark, sf):
    return vector.rasterise(T.diamonds(spark, sf), T.spec(spark, sf), grid.model_grid(spark, T.spec(spark, sf)))


_SLAB = """SELECT DISTINCT r.geom_id, g."row", g.col FROM grid g JOIN roads r ON greatest((g.x - 50 - r.x1) / nullif(r.x2 - r.x1, 0), (g.y - 50 - r.y1) / (r.y2 - r.y1), 0) < least((g.x + 50 - r.x1) / nullif(r.x2 - r.x1, 0), (g.y + 50 - r.y1) / (r.y2 - r.y1), 1) WHERE r.x2 > r.x1 OR (r.x1 >= g.x - 50 AND r.x1 < g.x + 50)"""


@query("v2_line_cells", _SLAB, "grid", "roads")
def v2(spark, sf):
    return vector.line_cells(T.roads(spark, sf), T.spec(spark, sf))


_FINE = """SELECT CAST(r AS INTEGER) AS r, CAST(c AS INTEGER) AS c, (c + 0.5) * CAST(20 AS DOUBLE) AS x, @Y - (r + 0.5) * CAST(20 AS DOUBLE) AS y FROM (SELECT unnest(range(210 * m)) AS r FROM size) a, (SELECT unnest(range(190 * m)) AS c FROM size) b"""


@query("v3_feature_cover", f"""SELECT g."row", g.col, CAST(coalesce(n, 0) AS BIGINT) AS buildings FROM grid g LEFT JOIN (SELECT CAST(r // 5 AS INTEGER) AS "row", CAST(c // 5 AS INTEGER) AS col, count(*) AS n FROM ({_FINE}) f WHERE EXISTS (SELECT 1 FROM zones d WHERE abs(f.x - d.cx) + abs(f.y - d.cy) < d.w) GROUP BY 1, 2) h ON h."row" = g."row" AND h.col = g.col""", "grid", "zones")
def v3(spark, sf):
    return vector.feature_cover({"buildings": (T.zones(spark, sf), False)}, T.spec(spark, sf), grid.model_grid(spark, T.spec(spark, sf)), 20.0)


@query("v6_j9_split_roads", "SELECT p_partkey, p_size % 3 = 0 AS major_road FROM part")
def v6(spark, sf):
    p = T.read(spark, sf, "part").selectExpr("p_partkey", "CASE WHEN p_size % 3 = 0 THEN 'A Road' WHEN p_size % 3 = 1 THEN 'Minor Road' END AS class")
    major, minor = vector.split_roads(p, "class")
    return major.unionByName(minor).select("p_partkey", "major_road")


@query("n1_distance_to_points", """SELECT g."row", g.col, round(min(sqrt((g.x - p.x) * (g.x - p.x) + (g.y - p.y) * (g.y - p.y))), 6) + 0.0 AS distance FROM grid g CROSS JOIN points p GROUP BY 1, 2""", "grid", "points")
def n1(spark, sf):
    return rounded(distance.to_points(grid.model_grid(spark, T.spec(spark, sf)), T.points(spark, sf).select("x", "y"), KEY, 50.0))


_SEG = """sqrt(power(g.x - (r.x1 + k * (r.x2 - r.x1)), 2) + power(g.y - (r.y1 + k * (r.y2 - r.y1)), 2))"""
_ONTO = """least(greatest(((g.x - r.x1) * (r.x2 - r.x1) + (g.y - r.y1) * (r.y2 - r.y1)) / ((r.x2 - r.x1) * (r.x2 - r.x1) + (r.y2 - r.y1) * (r.y2 - r.y1)), 0), 1)"""


@query("n2_distance_to_lines", f"""SELECT g."row", g.col, round(min({_SEG.replace('k *', _ONTO + ' *')}), 6) + 0.0 AS distance FROM grid g CROSS JOIN roads r GROUP BY 1, 2""", "grid", "roads")
def n2(spark, sf):
    return rounded(distance.to_segments(grid.model_grid(spark, T.spec(spark, sf)), vector.segments(T.roads(spark, sf)), KEY, 50.0))


@query("n2_n4_distance_to_polygons", """SELECT g."row", g.col, round(min(CASE WHEN abs(g.x - d.cx) + abs(g.y - d.cy) < d.w THEN 0 ELSE greatest((abs(g.x - d.cx) + abs(g.y - d.cy) - d.w) / sqrt(2), CASE WHEN abs(abs(g.x - d.cx) - abs(g.y - d.cy)) > d.w THEN sqrt(power(least(abs(g.x - d.cx), abs(g.y - d.cy)), 2) + power(greatest(abs(g.x - d.cx), abs(g.y - d.cy)) - d.w, 2)) ELSE 0 END) END), 6) + 0.0 AS distance FROM grid g CROSS JOIN diamonds d GROUP BY 1, 2""", "grid", "diamonds")
def n2p(spark, sf):
    z = T.diamonds(spark, sf)
    return rounded(distance.to_segments(grid.model_grid(spark, T.spec(spark, sf)), vector.segments(z), KEY, 50.0, vector.polygon_cells(z, T.spec(spark, sf))))


@query("n3_knn_weights", """, near5 AS (SELECT a.latin_name, a.point_id, a.dist FROM (SELECT a.latin_name, a.point_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist, row_number() OVER (PARTITION BY a.point_id ORDER BY sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), b.point_id) AS rn FROM points a JOIN points b ON a.latin_name = b.latin_name AND a.point_id <> b.point_id) a WHERE rn <= 5), means AS (SELECT latin_name, point_id, avg(dist) AS m FROM near5 GROUP BY 1, 2) SELECT m.latin_name, m.point_id, round(m.m, 6) + 0.0 AS mean_distance, round(m.m / q.med, 6) + 0.0 AS weight FROM means m JOIN (SELECT latin_name, quantile_cont(m, 0.5) AS med FROM means GROUP BY 1) q ON q.latin_name = m.latin_name""", "points")
def n3(spark, sf):
    return rounded(distance.knn_weights(T.points(spark, sf), "latin_name", "point_id", 5, 50.0))


@query("r14_resample_bilinear", """, tgt AS (SELECT CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col, (c + 0.5) * 2 - 0.5 AS fx, (r + 0.5) * 2 - 0.5 AS fy FROM (SELECT unnest(range(42 * m // 2)) AS r FROM size) a, (SELECT unnest(range(38 * m // 2)) AS c FROM size) b) SELECT t."row", t.col, round(sum((1 - abs(t.fx - c.col)) * (1 - abs(t.fy - c."row")) * c.v) / sum((1 - abs(t.fx - c.col)) * (1 - abs(t.fy - c."row"))), 6) + 0.0 AS v FROM tgt t JOIN cells c ON abs(t.fx - c.col) < 1 AND abs(t.fy - c."row") < 1 GROUP BY 1, 2""", "cells")
def r14(spark, sf):
    return rounded(raster.resample(T.cells(spark, sf).select(*KEY, "v"), T.spec(spark, sf), T.spec(spark, sf, 200.0), grid.model_grid(spark, T.spec(spark, sf, 200.0))))


@query("r14_resample_average", """SELECT CAST("row" // 2 AS INTEGER) AS "row", CAST(col // 2 AS INTEGER) AS col, round(avg(v), 6) + 0.0 AS v FROM cells GROUP BY 1, 2""", "cells")
def r14a(spark, sf):
    out = raster.resample(T.cells(spark, sf).select(*KEY, "v"), T.spec(spark, sf), T.spec(spark, sf, 200.0), grid.model_grid(spark, T.spec(spark, sf, 200.0)), "average")
    return rounded(out.filter("v IS NOT NULL"))


# ---------------------------------------------------------------- samples

def _u(key: str, seed: int = 42) -> str:
    m = f"((({key}) % 2147483647 + {seed}) * 48271 % 2147483647)"
    return f"(({m} * 69621 + 11) % 2147483647 + 1) / CAST(2147483649 AS DOUBLE)"


@query("x2_count_transforms", """, counts AS (SELECT g."row", g.col, CAST(count(p.point_id) AS DOUBLE) AS n FROM grid g LEFT JOIN placed p ON least(p."row", @R - 1) = g."row" AND p.col = g.col GROUP BY 1, 2) SELECT c."row", c.col, round(ln(1 + n), 6) + 0.0 AS log, round(sqrt(n), 6) + 0.0 AS sqrt, CAST(CASE WHEN n > 0 THEN 1 ELSE 0 END AS DOUBLE) AS presence, least(n, (SELECT quantile_cont(n, 0.9) FROM counts WHERE n > 0)) AS cap FROM counts c""", "grid", "placed")
def x2(spark, sf):
    counts = raster.point_counts(T.points(spark, sf), T.spec(spark, sf), grid.model_grid(spark, T.spec(spark, sf)))
    out = counts
    for m in ("log", "sqrt", "presence", "cap"):
        out = out.withColumn(m, F.col("value"))
        out = sampling.transform_counts(out, m, 90.0, m)
    return rounded(out.drop("value"))


@query("x3_probabilities", """, m AS (SELECT max(v) AS hi FROM cells), f AS (SELECT "row", col, greatest(v, 0.9 * hi) AS g FROM cells CROSS JOIN m) SELECT "row", col, round(g / (SELECT sum(g) FROM f), 9) + 0.0 AS p FROM f""", "cells")
def x3(spark, sf):
    return sampling.probabilities(T.cells(spark, sf), "contrast", 0.9, "v").select(*KEY, r6("p", "p", 9))


@query("x4_weighted_sample", f"""SELECT point_id FROM background ORDER BY ln({_u("point_id")}) / weight DESC, point_id LIMIT 500""", "background")
def x4(spark, sf):
    return sampling.weighted_sample(T.background(spark, sf), 500, "point_id", "weight").select("point_id")


@query("x5_exact_sample", f"""SELECT point_id FROM points ORDER BY {_u("point_id")}, point_id LIMIT 500""", "points")
def x5(spark, sf):
    return sampling.exact_sample(T.points(spark, sf), 500, "point_id").select("point_id")


@query("x7_background_size", "SELECT latin_name, CAST(greatest(least(count(*) * 10, 10000), 1000) AS BIGINT) AS n FROM points GROUP BY 1", "points")
def x7(spark, sf):
    return T.points(spark, sf).groupBy("latin_name").agg(occurrence.background_size(F.count("*")).cast("long").alias("n"))


@query("x8_with_enough", """SELECT point_id FROM placed p WHERE (SELECT count(*) FROM placed q WHERE q."row" = p."row" AND q.col = p.col) >= 5""", "placed")
def x8(spark, sf):
    return occurrence.with_enough(grid.with_cell(T.points(spark, sf), T.spec(spark, sf), inside=False), KEY, 5).select("point_id")


_OFF = """sqrt((x - (col + 0.5) * 100) * (x - (col + 0.5) * 100) + (y - (@Y - ("row" + 0.5) * 100)) * (y - (@Y - ("row" + 0.5) * 100)))"""
_APART = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))"


def _within(n: str, left: str, size: int) -> str:
    """found<n>: the five least distances of left's rows to others in their block of this size and those around, in order. They are
    right if the fifth is no more than the size."""
    return f""", blocks{n} AS (SELECT *, floor(x / {size}) AS bx, floor(y / {size}) AS by_ FROM known)
, spread{n} AS (SELECT identifier, class, point_id, x, y, floor(x / {size}) + i AS bx, floor(y / {size}) + j AS by_ FROM {left}, (SELECT unnest([-1, 0, 1]) AS i) s, (SELECT unnest([-1, 0, 1]) AS j) u)
, found{n} AS (SELECT a.identifier, a.class, a.point_id, min({_APART}, 5) AS d FROM spread{n} a JOIN blocks{n} b ON a.identifier = b.identifier AND a.bx = b.bx AND a.by_ = b.by_ AND (a.class <> b.class OR a.point_id <> b.point_id) GROUP BY 1, 2, 3)"""


# Rows whose five nearest aren't within a block's size go on to larger blocks, and at last to all rows, at any size of the tables.
_TRAINING = f"""
, pres AS (SELECT latin_name || '_' || activity_type AS identifier, * FROM placed)
, enough AS (SELECT * FROM pres WHERE identifier IN (SELECT identifier FROM pres GROUP BY 1 HAVING count(*) >= 15))
, taken AS (SELECT identifier, "row", col, min(point_id) AS point_id FROM enough WHERE {_OFF} <= 50 GROUP BY 1, 2, 3)
, thinned AS (SELECT e.* FROM enough e JOIN taken t ON t.identifier = e.identifier AND t.point_id = e.point_id)
, base AS (SELECT b.* FROM bgplaced b JOIN (SELECT "row", col, min(point_id) AS point_id FROM bgplaced WHERE {_OFF} <= 50 GROUP BY 1, 2) t ON t.point_id = b.point_id)
, wanted AS (SELECT identifier, greatest(least(count(*) * 10, 10000), 1000) AS want FROM thinned GROUP BY 1)
, free AS (SELECT w.identifier, w.want, b.* FROM wanted w CROSS JOIN base b ANTI JOIN thinned t ON t.identifier = w.identifier AND t."row" = b."row" AND t.col = b.col)
, chosen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY weight DESC, point_id) AS rn FROM free) q WHERE rn <= want)
, rows2 AS (SELECT identifier, point_id, x, y, "row", col, 1 AS class FROM thinned UNION ALL SELECT identifier, point_id, x, y, "row", col, 0 FROM chosen)
, known AS (SELECT r.*, c.v, c.d, c.t FROM rows2 r JOIN cells c ON c."row" = r."row" AND c.col = r.col)
{_within("0", "known", 800)}
, left1 AS (SELECT k.* FROM known k ANTI JOIN (SELECT * FROM found0 WHERE d[5] <= 800) f ON f.identifier = k.identifier AND f.class = k.class AND f.point_id = k.point_id)
{_within("1", "left1", 6400)}
, left2 AS (SELECT k.* FROM left1 k ANTI JOIN (SELECT * FROM found1 WHERE d[5] <= 6400) f ON f.identifier = k.identifier AND f.class = k.class AND f.point_id = k.point_id)
, found2 AS (SELECT a.identifier, a.class, a.point_id, min({_APART}, 5) AS d FROM left2 a JOIN known b ON a.identifier = b.identifier AND (a.class <> b.class OR a.point_id <> b.point_id) GROUP BY 1, 2, 3)
, near AS (SELECT identifier, class, point_id, list_avg(d) AS m FROM (SELECT * FROM found0 WHERE d[5] <= 800 UNION ALL SELECT * FROM found1 WHERE d[5] <= 6400 UNION ALL SELECT * FROM found2) f)
, medians AS (SELECT identifier, quantile_cont(m, 0.5) AS med FROM near GROUP BY 1)
SELECT k.identifier, k.point_id, round(k.x, 6) + 0.0 AS x, round(k.y, 6) + 0.0 AS y, round(k.v, 6) + 0.0 AS v, round(k.d, 6) + 0.0 AS d, round(k.t, 6) + 0.0 AS t, k.class, round(coalesce(CASE WHEN q.med > 0 THEN n.m / q.med END, 1), 6) + 0.0 AS sample_weight FROM known k LEFT JOIN near n ON n.identifier = k.identifier AND n.class = k.class AND n.point_id = k.point_id LEFT JOIN medians q ON q.identifier = k.identifier"""


@query("x9_x10_training_table", _TRAINING, "placed", "bgplaced", "cells")
def x9(spark, sf):
    p = T.points(spark, sf).withColumn("identifier", S.identifier(F.col("latin_name"), F.col("activity_type")))
    return rounded(sampling.training_table(p, T.background(spark, sf), T.cells(spark, sf), T.spec(spark, sf), ["v", "d", "t"], subset="density"))


# ---------------------------------------------------------------- scalars

_SEPARATED = """CASE p_partkey % 4 WHEN 0 THEN p_type || ':(' || p_brand || ')' WHEN 1 THEN ' ' || p_type || ' {' || p_brand || '}, [x];' WHEN 2 THEN p_type || '\\' || p_brand || './-y' ELSE p_type || '__&' || p_brand END"""


@query("f1_f3_f4_f5_names", f"""SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(lower({_SEPARATED}), '[\\s\\-/\\\\.:;,()\\[\\]{{}}]', '_', 'g'), '[^a-z0-9_]', '', 'g'), '_+', '_', 'g'), '_') AS tidy, p_brand || '_' || p_type AS identifier, substring(split_part(p_type, ' ', 1), 1, 3) || CASE WHEN p_type LIKE '% %' THEN '_' || substring(split_part(p_type, ' ', 2), 1, 3) ELSE '' END AS code, CASE p_size % 3 WHEN 0 THEN 'Bioclimatic variable 7' WHEN 1 THEN 'Wind speed' ELSE 'other' END AS climate FROM part""")
def f1(spark, sf):
    names = {"bio_7": 0, "wind": 1, "other": 2}
    climate = F.coalesce(*(F.when(F.col("p_size") % 3 == i, F.lit(S.climate_name(c))) for c, i in names.items()))
    p = T.read(spark, sf, "part").withColumn("name", F.expr(_SEPARATED.replace("'\\'", "'\\\\'")))
    return p.select("p_partkey", S.tidy(F.col("name")).alias("tidy"), S.identifier(F.col("p_brand"), F.col("p_type")).alias("identifier"), S.species_code(F.col("p_type")).alias("code"), climate.alias("climate"))


@query("f6_z_score", """SELECT "row", col, round((v - m) / greatest(s, 1e-8), 6) + 0.0 AS v FROM cells CROSS JOIN (SELECT avg(v) AS m, stddev_pop(v) AS s FROM cells) q""", "cells")
def f6(spark, sf):
    return rounded(raster.z_score(T.cells(spark, sf).select(*KEY, "v"), ["v"]))


@query("f7_f8_min_max", """SELECT "row", col, round((v - lo) / (hi - lo), 6) + 0.0 AS v FROM cells CROSS JOIN (SELECT min(v) AS lo, max(v) AS hi FROM cells) q""", "cells")
def f7(spark, sf):
    return rounded(raster.min_max(T.cells(spark, sf).select(*KEY, "v"), ["v"]))


@query("f9_to_f15_arithmetic", """SELECT "row", col, v + CAST(1e-6 AS DOUBLE) AS eps, greatest(d - t, 0) AS rural, v * (d / 10) AS inside, v * (1 - d / 10) AS outside, least(greatest(v, 20), 30) AS clamped, round(d / 10 * 100) AS pct, round(d - 1.96 * t, 6) + 0.0 AS lower FROM cells""", "cells")
def f9(spark, sf):
    inside, outside = S.woodland_split(F.col("v"), F.col("d") / 10)
    return T.cells(spark, sf).select(*KEY, S.nonzero(F.col("v")).alias("eps"), S.rural_roads(F.col("d"), F.col("t")).alias("rural"), inside.alias("inside"), outside.alias("outside"), S.clamp(F.col("v"), 20, 30).alias("clamped"), S.percent(F.col("d") / 10).alias("pct"), r6(S.lower_bound(F.col("d"), F.col("t")), "lower"))


@query("f14_f16_explode_lists", """SELECT p_partkey, size AS s, name FROM (SELECT p_partkey, p_size AS size, p_name AS name FROM part UNION ALL SELECT p_partkey, p_size + 1, p_brand FROM part) u""")
def f16(spark, sf):
    p = T.read(spark, sf, "part").select("p_partkey", F.array(F.col("p_size"), F.col("p_size") + 1).alias("s"), F.array("p_name", "p_brand").alias("name"))
    return features.explode_lists(p, ["s", "name"])


@query("f17_melt", """SELECT "row", col, 'v' AS variable, v AS value FROM cells UNION ALL SELECT "row", col, 'd', d FROM cells""", "cells")
def f17(spark, sf):
    return features.melt(T.cells(spark, sf).select(*KEY, "v", "d"), KEY, ["v", "d"])


@query("f18_f19_flags", """SELECT event_id, probability > 50 AS cloud, nir < 1500 AND scl <> 6 AS dark FROM pixels""", "pixels")
def f18(spark, sf):
    return imagery.flags(T.pixels(spark, sf)).select("event_id", "cloud", "dark")


@query("f20_shadows", """SELECT DISTINCT p.scene, p."row", p.col FROM pixels p WHERE p.nir < 1500 AND p.scl <> 6 AND EXISTS (SELECT 1 FROM pixels c WHERE c.scene = p.scene AND c.probability > 50 AND c."row" = p."row" AND p.col - c.col BETWEEN 1 AND 2)""", "pixels")
def f20(spark, sf):
    return imagery.shadows(imagery.flags(T.pixels(spark, sf)), 90.0, 2).distinct()


_MASK = """, px AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scene, "row", col ORDER BY event_id) AS rn FROM pixels) q WHERE rn = 1),
 bad AS (SELECT p.scene, p."row", p.col FROM px p WHERE p.probability > 95 OR (p.nir < 1500 AND p.scl <> 6 AND EXISTS (SELECT 1 FROM px c WHERE c.scene = p.scene AND c."row" = p."row" AND c.col = p.col - 1 AND c.probability > 95))),
 along AS (SELECT DISTINCT p.scene, p."row", p.col FROM px p JOIN bad b ON b.scene = p.scene AND b."row" = p."row" AND b.col BETWEEN p.col - 1 AND p.col + 1)
 SELECT scene, "row", col, event_id FROM px p WHERE NOT EXISTS (SELECT 1 FROM along a WHERE a.scene = p.scene AND a.col = p.col AND a."row" BETWEEN p."row" - 1 AND p."row" + 1)"""


@query("f21_t18_mask", _MASK, "pixels")
def f21(spark, sf):
    px = imagery.flags(occurrence.first_of(T.pixels(spark, sf), ["scene", *KEY], "event_id"), cloud_above=95.0)
    return imagery.masked(px, 90.0, 1, 1, 3).select("scene", *KEY, "event_id")


@query("f22_median_composite", """SELECT "row", col, quantile_cont(nir, 0.5) AS nir FROM pixels WHERE scene BETWEEN '2024-01-05' AND '2024-01-20' GROUP BY 1, 2""", "pixels")
def f22(spark, sf):
    px = T.pixels(spark, sf).withColumns({"date": F.col("scene"), "cloud_percent": F.lit(10.0)})
    return imagery.median_composite(imagery.usable(px, "2024-01-05", "2024-01-20"), ["nir"])


# ---------------------------------------------------------------- models

@query("m1_standardise", """SELECT "row", col, round((v - m) / s, 6) + 0.0 AS v FROM cells CROSS JOIN (SELECT avg(v) AS m, stddev_pop(v) AS s FROM cells) q""", "cells")
def m1(spark, sf):
    return rounded(features.standardise(T.cells(spark, sf).select(*KEY, "v"), ["v"]))


@query("m2_one_hot", """SELECT point_id, CAST(activity_type = 'In flight' AS INTEGER) AS in_flight, CAST(activity_type = 'Roost' AS INTEGER) AS roost FROM points""", "points")
def m2(spark, sf):
    from pyspark.ml.functions import vector_to_array

    v = vector_to_array("activity_type_vec")
    return features.one_hot(T.points(spark, sf), ["activity_type"]).select("point_id", v[0].cast("int").alias("in_flight"), v[1].cast("int").alias("roost"))


@query("m15_correlated_groups")
def m15(spark, sf):
    c = T.cells(spark, sf).withColumns({"v2": F.col("v") * 2 + F.col("d"), "d2": -F.col("d")})
    return features.correlated_groups(c, ["v", "d", "t", "v2", "d2"], 0.8)


@query("m16_components")
def m16(spark, sf):
    return rounded(features.principal_components(T.cells(spark, sf), ["v", "d", "t"], KEY, 2)[0])


@query("m19_roc", """SELECT s.identifier, s.p AS threshold, round(count(*) FILTER (t.class = 1) / CAST(any_value(n.np) AS DOUBLE), 9) + 0.0 AS tpr, round(count(*) FILTER (t.class = 0) / CAST(any_value(n.nn) AS DOUBLE), 9) + 0.0 AS fpr FROM (SELECT DISTINCT identifier, p FROM scored) s JOIN scored t ON t.identifier = s.identifier AND t.p >= s.p JOIN (SELECT identifier, count(*) FILTER (class = 1) AS np, count(*) FILTER (class = 0) AS nn FROM scored GROUP BY 1) n ON n.identifier = s.identifier GROUP BY 1, 2""", "scored")
def m19(spark, sf):
    return rounded(evaluate.roc_points(T.scored(spark, sf), ["identifier"]), 9)


@query("m20_histogram", """SELECT identifier, bin, round(bin / 50.0, 9) + 0.0 AS low, round((bin + 1) / 50.0, 9) + 0.0 AS high, n, round(n * 50 / CAST(sum(n) OVER (PARTITION BY identifier) AS DOUBLE), 9) + 0.0 AS density FROM (SELECT identifier, CAST(least(floor(p * 50), 49) AS INTEGER) AS bin, count(*) AS n FROM scored GROUP BY 1, 2) h""", "scored")
def m20(spark, sf):
    return rounded(evaluate.histogram(T.scored(spark, sf), ["identifier"]), 9)


@query("m21_ensemble", """SELECT "row", col, 'all' AS identifier, round(avg(p), 6) + 0.0 AS mean_p, round(stddev_pop(p), 6) + 0.0 AS std_p FROM predictions GROUP BY 1, 2""", "predictions")
def m21(spark, sf):
    return rounded(predict.ensemble(T.predictions(spark, sf).withColumn("identifier", F.lit("all"))))


@query("d11_wide_predictions", """SELECT "row", col, max(p) FILTER (identifier = 'A_Roost') AS a, max(p) FILTER (identifier = 'N_Roost') AS n, max(p) FILTER (identifier = 'R_Roost') AS r FROM predictions GROUP BY 1, 2""", "predictions")
def d11(spark, sf):
    names = ["A_Roost", "N_Roost", "R_Roost"]
    return predict.wide(T.predictions(spark, sf), names).withColumnsRenamed(dict(zip(names, "anr", strict=True)))


_MODELS = [
    ("a_Roost", "linear", "v", None, 0.0, True, 10.0, 40.0, 1.5), ("a_Roost", "quadratic", "d", None, 0.0, True, 2.0, 8.0, -0.7),
    ("a_Roost", "hinge", "t", None, 0.5, True, 1.0, 7.0, 0.9), ("a_Roost", "hinge", "t", None, 0.5, False, 1.0, 7.0, -0.4),
    ("a_Roost", "product", "v", "d", 0.0, True, 10.0, 40.0, 0.6), ("a_Roost", "alpha", None, None, None, None, None, None, -2.5), ("a_Roost", "entropy", None, None, None, None, None, None, 1.25),
    ("b_Roost", "threshold", "v", None, 0.4, True, 10.0, 40.0, 1.1), ("b_Roost", "linear", "t", None, 0.0, True, 1.0, 7.0, -0.8), ("b_Roost", "alpha", None, None, None, None, None, None, -1.5), ("b_Roost", "entropy", None, None, None, None, None, None, 0.5),
]
_SCALED = """SELECT *, least(greatest((v - 10) / 30.0, 0), 1) AS sv, least(greatest((d - 2) / 6.0, 0), 1) AS sd, least(greatest((t - 1) / 6.0, 0), 1) AS st FROM {}"""
_BOTH = """SELECT {key}, 'a_Roost' AS identifier, round(1 - exp(-exp(1.5 * sv - 0.7 * sd * sd + 0.9 * greatest((st - 0.5) / 0.5, 0) - 0.4 * greatest((0.5 - st) / 0.5, 0) + 0.6 * sv * sd - 1.25)), 6) + 0.0 AS p FROM z UNION ALL SELECT {key}, 'b_Roost', round(1 - exp(-exp(1.1 * CASE WHEN sv >= 0.4 THEN 1 ELSE 0 END - 0.8 * st - 1.0)), 6) + 0.0 FROM z"""


def fixed_models(spark: SparkSession) -> DataFrame:
    """A coefficient table that SQL repeats."""
    rows = [(i, -1, k, a, b, knot, up, lo, hi, 2.0 if b else None, 8.0 if b else None, c) for i, k, a, b, knot, up, lo, hi, c in _MODELS]
    return spark.createDataFrame(rows, maxent.COEFFICIENTS)


@query("m11_score_cells", f""", z AS ({_SCALED.format("cells")}) """ + _BOTH.format(key='"row", col'), "cells")
def m11(spark, sf):
    return rounded(predict.score(T.cells(spark, sf), fixed_models(spark), ["v", "d", "t"]))


@query("m13_score_points_fixed", f""", z AS ({_SCALED.format('(SELECT p.point_id, c.v, c.d, c.t FROM placed p JOIN cells c ON c."row" = p."row" AND c.col = p.col) q')}) """ + _BOTH.format(key="point_id"), "placed", "cells")
def m13(spark, sf):
    found = occurrence.annotate(T.points(spark, sf), T.cells(spark, sf), T.spec(spark, sf), ["v", "d", "t"])
    return rounded(predict.score(found, fixed_models(spark), ["v", "d", "t"], ["point_id"]))


@query("m3_terms", """SELECT "row", col, sv AS linear_v, sv * sv AS quadratic_v, sv * sd AS product_v_d, greatest((sv - 0.25) / 0.75, 0) AS hinge_v, CAST(CASE WHEN sv >= 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS threshold_v FROM (""" + _SCALED.format("cells") + ") z", "cells")
def m3(spark, sf):
    """The expansion of features to terms, by columns."""
    v, d = maxent.scaled_column("v", 10.0, 40.0), maxent.scaled_column("d", 2.0, 8.0)
    made = {"linear_v": (maxent.LINEAR, None, 0.0), "quadratic_v": (maxent.QUADRATIC, None, 0.0), "product_v_d": (maxent.PRODUCT, d, 0.0), "hinge_v": (maxent.HINGE, None, 0.25), "threshold_v": (maxent.THRESHOLD, None, 0.5)}
    return T.cells(spark, sf).select(*KEY, *(maxent.column(k, v, b, knot, True).alias(n) for n, (k, b, knot) in made.items()))


_BACK = f""", counts AS MATERIALIZED (SELECT g."row", g.col, ln(1 + CAST(coalesce(n, 0) AS DOUBLE)) AS v FROM grid g LEFT JOIN (SELECT least("row", @R - 1) AS r, col AS c, count(*) AS n FROM placed GROUP BY 1, 2) p ON p.r = g."row" AND p.c = g.col),
 first_ AS MATERIALIZED (SELECT g.r AS "row", g.col, sum(g.w * c.v) AS v FROM (SELECT g."row" AS r, g.col, k.w, {_mirror('g."row" + k.d', "@R")} AS at FROM grid g CROSS JOIN ({_KERNEL}) k) g JOIN counts c ON c."row" = g.at AND c.col = g.col GROUP BY 1, 2),
 smooth AS MATERIALIZED (SELECT g."row", g.c AS col, g.x, g.y, sum(g.w * c.v) AS v FROM (SELECT g."row", g.col AS c, g.x, g.y, k.w, {_mirror('g.col + k.d', "@C")} AS at FROM grid g CROSS JOIN ({_KERNEL}) k) g JOIN first_ c ON c."row" = g."row" AND c.col = g.at GROUP BY 1, 2, 3, 4),
 raised AS MATERIALIZED (SELECT *, greatest(v, 0.1 * (SELECT max(v) FROM smooth)) AS w FROM smooth),
 shares AS (SELECT *, w / (SELECT sum(w) FROM raised) AS p, "row" * @C + col AS id FROM raised)
 SELECT "row", col, x, y, round(p, 6) + 0.0 AS p, 0 AS presence FROM shares ORDER BY ln({_u("id")}) / p DESC, id LIMIT 400"""


@query("x1_background_points", _BACK, "grid", "placed")
def x1(spark, sf):
    return rounded(sampling.background_points(T.points(spark, sf), T.spec(spark, sf), 400))
