"""End-to-end jobs: compositions of operators from raw layers to tables of results."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalars as S
from ..operators import distance, evaluate, explain, grid, landcover, maxent, occurrence, predict, raster, sampling, terrain, vector
from ..session import merged, shared_dir, written
from . import shape_queries
from . import standins as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
KEY = ["row", "col"]
BANDS = ["v", "d", "t"]
CONFIG = maxent.Config(kinds=(maxent.LINEAR, maxent.QUADRATIC, maxent.HINGE))


def job(name: str):
    def add(fn):
        QUERIES[name] = fn
        return fn

    return add


def training(spark: SparkSession, sf: str) -> DataFrame:
    points = T.points(spark, sf).withColumn("identifier", S.identifier(F.col("latin_name"), F.col("activity_type")))
    return sampling.training_table(points, T.background(spark, sf), T.cells(spark, sf), T.spec(spark, sf), BANDS, subset="density")


def fitted(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The training table with folds, and the coefficients of all models; both written."""
    table = written(maxent.with_geographic_folds(training(spark, sf)), "training")
    return table, written(maxent.fit_all(table, BANDS, CONFIG), "coefficients")


@job("job_boundary_g9")
def boundary(spark, sf):
    """Counties of chosen regions, simplified, and their common outline."""
    # Dealt first: a small file is one task's, and the work is in its shapes.
    d = vector.simplify(vector.valid(T.diamonds(spark, sf).repartition("geom_id")), 10.0)
    chosen = written(d.select("brand").distinct().withColumn("region", F.substring("brand", 1, 7)), "regions")
    return vector.dissolved_edges(vector.join_regions(d, chosen, "brand"), "region")


@job("job_landcover")
def land(spark, sf):
    """Category raster, cut to a box, to areas of broad habitats on a coarser grid, moved to the model grid."""
    spec, half = T.spec(spark, sf), T.spec(spark, sf, 200.0)
    boxed = raster.clip_box(T.classes(spark, sf), spec, (0, 0, 3000 * T.scale(spark, sf), 4200 * T.scale(spark, sf)))
    found = landcover.cover(boxed, spec, "k", 2, {0: "Urban", 1: "Neutral Grassland", 2: "Acid Grassland", 3: "Bog", 4: "Freshwater"})
    moved = raster.resample(found, half, spec, grid.model_grid(spark, spec), "nearest")
    return moved.na.drop("all", subset=raster.bands_of(moved))


@job("job_vegetation_height")
def vom(spark, sf):
    """Height statistics of blocks, moved to the model grid."""
    found = raster.coarsen_stats(T.cells(spark, sf), 2, "v", "vom", 200)
    out = raster.resample(found, T.spec(spark, sf, 200.0), T.spec(spark, sf), grid.model_grid(spark, T.spec(spark, sf)), "nearest")
    return out.select(*KEY, *((F.round(c, 6) + F.lit(0.0)).alias(c) for c in out.columns if c not in KEY))


_PAIRS = """CAST("row" // 2 AS INTEGER) AS "row", CAST(col // 2 AS INTEGER) AS col"""
_AREA = "CASE WHEN count(*) = 4 THEN CAST(sum(CASE WHEN k IN ({}) THEN 10000 ELSE 0 END) AS DOUBLE) END"
ORACLE_SQL["job_vegetation_height"] = T.with_tables(f""", b AS (SELECT {_PAIRS}, round(avg(v), 6) + 0.0 AS vom_mean_200m, round(min(v), 6) + 0.0 AS vom_min_200m, round(max(v), 6) + 0.0 AS vom_max_200m, round(stddev_pop(v), 6) + 0.0 AS vom_std_200m FROM cells GROUP BY 1, 2) SELECT g."row", g.col, vom_mean_200m, vom_min_200m, vom_max_200m, vom_std_200m FROM grid g LEFT JOIN b ON b."row" = g."row" // 2 AND b.col = g.col // 2""", "grid", "cells")
ORACLE_SQL["job_landcover"] = T.with_tables(f""", b AS (SELECT {_PAIRS}, {_AREA.format(0)} AS "Urban", {_AREA.format(4)} AS "Freshwater", coalesce({_AREA.format("1, 2")}, 0) AS "Grassland", coalesce({_AREA.format(3)}, 0) AS "Wetland" FROM classes WHERE col * 100 + 50 <= 3000 * @M GROUP BY 1, 2) SELECT g."row", g.col, "Urban", "Freshwater", "Grassland", "Wetland" FROM grid g JOIN b ON b."row" = g."row" // 2 AND b.col = g.col // 2""", "grid", "classes")


@job("job_terrain")
def heights(spark, sf):
    """Two height tables on their own grids, moved to the model grid and merged."""
    spec, half = T.spec(spark, sf), T.spec(spark, sf, 200.0)
    coarse = raster.coarsen_stats(T.cells(spark, sf), 2, "v", "dsm", 200).select(*KEY, F.col("dsm_mean_200m").alias("dsm"))
    moved = raster.resample(coarse, half, spec, grid.model_grid(spark, spec), "nearest")
    out = raster.merge_layers({"dtm": T.cells(spark, sf).select(*KEY, F.col("v").alias("dtm")), "dsm": moved})
    return out.select(*KEY, "dtm", (F.round("dsm", 6) + F.lit(0.0)).alias("dsm"))


ORACLE_SQL["job_terrain"] = T.with_tables(f""", b AS (SELECT {_PAIRS}, round(avg(v), 6) + 0.0 AS dsm FROM cells GROUP BY 1, 2) SELECT g."row", g.col, c.v AS dtm, b.dsm FROM grid g LEFT JOIN cells c ON c."row" = g."row" AND c.col = g.col LEFT JOIN b ON b."row" = g."row" // 2 AND b.col = g.col // 2""", "grid", "cells")


@job("job_extract")
def extract(spark, sf):
    """Values at points, written by identifier and read back."""
    from ..sources import tables

    found = occurrence.annotate(T.points(spark, sf), T.cells(spark, sf), T.spec(spark, sf), BANDS)
    found = found.select(S.identifier(F.col("latin_name"), F.col("activity_type")).alias("identifier"), "point_id", *BANDS)
    path = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/extract-{uuid.uuid4().hex[:12]}"
    tables.write_training(found, path)
    return spark.read.schema(found.schema).parquet(path)


ORACLE_SQL["job_extract"] = T.with_tables("""SELECT p.latin_name || '_' || p.activity_type AS identifier, p.point_id, c.v, c.d, c.t FROM placed p JOIN cells c ON c."row" = p."row" AND c.col = p.col""", "placed", "cells")


@job("job_climate")
def climate(spark, sf):
    """A climate layer in degrees moved to the National Grid's cells, cut to the area, with statistics by long name."""
    layer, degrees = shape_queries.degrees(spark, sf)
    target = shape_queries.devon(spark, sf)
    moved = raster.resample(layer.select(*KEY, F.col("t").alias("bio5")), degrees, target, grid.model_grid(spark, target), source_epsg=4326)
    # The area has its own place; row and column are the same.
    inside = vector.polygon_cells(T.diamonds(spark, sf), T.spec(spark, sf))
    return raster.band_statistics(raster.clip_cells(moved, inside).withColumnRenamed("bio5", S.climate_name("bio5")))


@job("job_features")
def features(spark, sf):
    """Cover and distance of buildings in a box and of major and minor roads on the grid."""
    cells = grid.model_grid(spark, T.spec(spark, sf))
    d, r = T.diamonds(spark, sf), T.roads(spark, sf)
    d = d.filter(G.meets_box(G.box_of(F.col("rings")), T.spec(spark, sf).bounds))
    major, minor = vector.split_roads(r.withColumn("class", F.when(F.col("geom_id") % 3 == 0, "A Road").otherwise("Minor Road")), "class")
    cover = vector.feature_cover({"buildings": (d, False), "major_roads": (major, True), "minor_roads": (minor, True)}, T.spec(spark, sf), cells, 20.0)
    far = distance.to_segments(cells, vector.segments(major), KEY, 50.0).withColumnRenamed("distance", "distance_to_major_roads")
    return cover.join(merged(far), KEY)


@job("job_coastal")
def coastal(spark, sf):
    """Distance to land of large parts on a coarse grid, moved to the model grid, in the sea within a buffer."""
    coarse = T.spec(spark, sf, 200.0)
    land_ = vector.large_parts(T.zones(spark, sf), 0.02)
    far = distance.to_segments(grid.model_grid(spark, coarse), vector.segments(land_), KEY, 100.0, vector.polygon_cells(land_, coarse))
    fine = raster.resample(far, coarse, T.spec(spark, sf), grid.model_grid(spark, T.spec(spark, sf)))
    return fine.filter("distance > 0 AND distance <= 500")


@job("job_merge_r15")
def merge(spark, sf):
    half = T.spec(spark, sf, 200.0)
    coarse = raster.coarsen_stats(T.cells(spark, sf), 2, "d", "d", 200).select(*KEY, F.col("d_mean_200m").alias("d"))
    inside = vector.touched_cells(T.zones(spark, sf), T.spec(spark, sf))
    layers = {"Mean V.alue": (T.cells(spark, sf).select(*KEY, "v"), T.spec(spark, sf)), "Coarse-D": (coarse, half), "Both": (T.cells(spark, sf).select(*KEY, F.col("t").alias("T one"), F.col("d").alias("D two")), T.spec(spark, sf))}
    return raster.merge_on_grid(layers, T.spec(spark, sf), grid.model_grid(spark, T.spec(spark, sf)), inside)


@job("job_terrain_stats")
def terrain_stats(spark, sf):
    return terrain.terrain_attributes(T.cells(spark, sf), "v", 100.0, 5, 5)


@job("job_train_m9_m10")
def train(spark, sf):
    """Points to results of all models: annotate, thin, weigh, fold, fit, summarise."""
    return maxent.results(fitted(spark, sf)[1])


@job("job_predict_m11")
def predict_cells(spark, sf):
    """Every cell with every model."""
    return predict.score(T.cells(spark, sf), fitted(spark, sf)[1], BANDS)


@job("m13_score_points")
def score_points(spark, sf):
    found = occurrence.annotate(T.points(spark, sf), T.cells(spark, sf), T.spec(spark, sf), BANDS)
    return predict.score(found, fitted(spark, sf)[1], BANDS, ["point_id"])


ORACLE_SQL["m12_score_any_model"] = T.with_tables("SELECT \"row\", col, (v / 50 + d / 10) / 2 AS p FROM cells", "cells")


@job("m12_score_any_model")
def score_any(spark, sf):
    """A user's model, here a plain function, over the cells."""
    return predict.score_with(T.cells(spark, sf), lambda x: (x["v"] / 50 + x["d"] / 10) / 2, ["v", "d"], KEY)


ORACLE_SQL["m12_aligned_layers"] = T.with_tables(f""", b AS (SELECT {_PAIRS}, avg(d) AS d FROM cells GROUP BY 1, 2), moved AS (SELECT g."row", g.col, sum(w * b.d) / sum(w) AS d FROM (SELECT g."row", g.col, b."row" AS br, b.col AS bc, (1 - abs((g.col + 0.5) / 2 - 0.5 - b.col)) * (1 - abs((g."row" + 0.5) / 2 - 0.5 - b."row")) AS w FROM grid g JOIN b ON abs((g.col + 0.5) / 2 - 0.5 - b.col) < 1 AND abs((g."row" + 0.5) / 2 - 0.5 - b."row") < 1) g JOIN b ON b."row" = g.br AND b.col = g.bc GROUP BY 1, 2) SELECT g."row", g.col, round((c.v / 47 + 3 * m.d / 11) / 4, 6) + 0.0 AS p FROM grid g LEFT JOIN cells c ON c."row" = g."row" AND c.col = g.col LEFT JOIN moved m ON m."row" = g."row" AND m.col = g.col""", "grid", "cells")


@job("m12_aligned_layers")
def score_layers(spark, sf):
    """A user's model with an option over two layers, of which one is on a coarser grid."""
    spec, half = T.spec(spark, sf), T.spec(spark, sf, 200.0)
    coarse = raster.coarsen_stats(T.cells(spark, sf), 2, "d", "d", 200).select(*KEY, F.col("d_mean_200m").alias("d"))
    layers = {"fine": (T.cells(spark, sf).select(*KEY, "v"), spec), "coarse": (coarse, half)}
    found = predict.score_aligned(layers, spec, lambda x, weight: (x["v"] / 47 + weight * x["d"] / 11) / (1 + weight), ["v", "d"], weight=3)
    return found.select(*KEY, (F.round("p", 6) + F.lit(0.0)).alias("p"))


@job("m7_random_cv_a19")
def random_cv(spark, sf):
    """Random folds; the final models' confusion on their training rows."""
    table = written(maxent.with_random_folds(training(spark, sf)), "training")
    found = written(maxent.fit_all(table, BANDS, CONFIG), "coefficients")
    scored = _own(table, found)
    return evaluate.confusion(scored, ["identifier"]).join(evaluate.auc(scored, ["identifier"]), "identifier")


def _own(table: DataFrame, found: DataFrame) -> DataFrame:
    """Each training row with its own model's prediction."""
    return predict.score_own(table, found, BANDS, ["identifier", "point_id", "class"])


@job("m4_large_fit")
def large(spark, sf):
    """One model over all rows."""
    return maxent.fit_large(training(spark, sf), BANDS, maxent.Config(kinds=(maxent.LINEAR, maxent.HINGE)))


@job("m17_permutation_importance")
def importance(spark, sf):
    table, found = fitted(spark, sf)
    return explain.permutation_importance(table, found, BANDS)


@job("m18_partial_dependence")
def dependence(spark, sf):
    cells = T.cells(spark, sf).withColumn("cell_id", (F.col("row") * T.spec(spark, sf).ncols + F.col("col")).cast("long"))
    return explain.partial_dependence(cells, fitted(spark, sf)[1], BANDS)
