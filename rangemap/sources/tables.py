"""Reading and writing cell tables, vector layers and results as Parquet and CSV."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import box_of, meets_box
from ..functions.scalars import from_percent, no_nan
from ..operators.occurrence import with_weight
from ..operators.raster import KEY, bands_of, clip_cells, merge_layers
from ..operators.sampling import exact_sample

log = logging.getLogger(__name__)


def clean_bands(cells: DataFrame, sentinel: float | None = -9999.0) -> DataFrame:
    """All bands as double with NaN, the sentinel and absurd values as NULL."""
    bands = set(bands_of(cells))
    return cells.select(*(no_nan(F.col(c), sentinel).alias(c) if c in bands else c for c in cells.columns))


def read_cells(spark: SparkSession, path: str, sentinel: float | None = -9999.0) -> DataFrame:
    return clean_bands(spark.read.parquet(path), sentinel)


def read_layer(spark: SparkSession, path: str, stem: str) -> DataFrame:
    """A cell table whose bands get the stem as prefix."""
    cells = read_cells(spark, path)
    return cells.withColumnsRenamed({b: f"{stem}_{b}" for b in bands_of(cells)})


def read_stack(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Several layers (stem to path) merged on their cells."""
    return merge_layers({stem: read_layer(spark, path, stem) for stem, path in layers.items()})


def read_background(spark: SparkSession, path: str) -> DataFrame:
    return with_weight(spark.read.parquet(path))


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
    except AnalysisException:
        return False
    return True


def read_datasets(spark: SparkSession, folder: str, names: list[str], pattern: str = "{name}.parquet") -> DataFrame:
    """Vector layers of several names in one table with `dataset`; names without a file are skipped with a warning."""
    found = []
    for name in names:
        path = f"{folder}/{pattern.format(name=name)}"
        if exists(spark, path):
            found.append(spark.read.parquet(path).withColumn("dataset", F.lit(name)))
        else:
            log.warning("no file for %s", name)
    if not found:
        raise FileNotFoundError(f"none of {names} in {folder}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def read_tiles(spark: SparkSession, folder: str, keyword: str, dataset: str) -> DataFrame:
    """All files below folder whose name has the keyword, tagged."""
    return spark.read.option("pathGlobFilter", f"*{keyword}*").option("recursiveFileLookup", "true").parquet(folder).withColumn("dataset", F.lit(dataset))


def cache_layer(layer: DataFrame, path: str, overwrite: bool = False, bounds: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Write a layer unless it is there already, and read it. bounds: only geometries whose box meets them are written."""
    spark = layer.sparkSession
    if overwrite or not exists(spark, path):
        layer = layer if bounds is None else layer.filter(meets_box(box_of(F.col("rings")), bounds))
        layer.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def within_box(layer: DataFrame, bounds: tuple[float, float, float, float], columns: tuple[str, str, str, str] = ("minx", "miny", "maxx", "maxy")) -> DataFrame:
    """Rows whose own box lies inside bounds: plain comparisons, which reach the Parquet row groups."""
    (a, b, c, d), (xmin, ymin, xmax, ymax) = columns, bounds
    return layer.filter((F.col(a) >= xmin) & (F.col(b) >= ymin) & (F.col(c) <= xmax) & (F.col(d) <= ymax))


def csv_to_parquet(spark: SparkSession, source: str, target: str, schema: str | None = None) -> None:
    reader = spark.read.option("header", "true")
    (reader.schema(schema) if schema else reader.option("inferSchema", "true")).csv(source).write.mode("overwrite").parquet(target)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", "true").option("inferSchema", "true").csv(path)


def sample_cells(cells: DataFrame, n: int, key: str = "cell_id", seed: int = 42) -> DataFrame:
    """n cells without nulls."""
    return exact_sample(cells.na.drop(), n, key, seed)


def read_predictions(spark: SparkSession, path: str, containing: str | None = None, per_cent: bool = False) -> DataFrame:
    """The long prediction table, of identifiers that contain a text; per_cent: integers with negatives as nodata."""
    rows = spark.read.parquet(path)
    rows = rows.filter(F.col("identifier").contains(containing)) if containing else rows
    return rows.withColumn("p", from_percent(F.col("p"))) if per_cent else rows


def read_climate(spark: SparkSession, folder: str, variables: list[str], inside: DataFrame) -> dict[str, DataFrame]:
    """Climate layers cut to cells of inside; those that are missing are skipped."""
    return {v: clip_cells(read_cells(spark, f"{folder}/{v}.parquet"), inside) for v in variables if exists(spark, f"{folder}/{v}.parquet")}


def grid_points(cells: DataFrame) -> DataFrame:
    """Keys and centres of cells without a null."""
    return cells.na.drop(subset=bands_of(cells)).select(*KEY, *(c for c in ("x", "y") if c in cells.columns))


def write_cells(cells: DataFrame, path: str) -> None:
    """Cell tables are partitioned by their tile on disk, so that a box reads few files."""
    (cells.write.mode("overwrite").partitionBy("tile") if "tile" in cells.columns else cells.write.mode("overwrite")).parquet(path)


def curve_key(row: Column, col: Column, tile: int = 64) -> Column:
    """The place on the Z-order curve of the tile that a cell is in: the bits of its row and column by turns. For keys from 0
    to 2^31 - 1."""

    def spread(v: Column) -> Column:
        v = F.floor(v / tile).cast("long")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return F.shiftleft(spread(row), 1).bitwiseOR(spread(col))


def write_clustered(cells: DataFrame, path: str, tile: int = 64, files: int | None = None, group_mb: int = 16) -> None:
    """A cell table along the Z-order curve of its tiles, in files that each hold a stretch of it: their statistics are narrow boxes
    of row and col, so bounds on these (see raster.clip_box) skip files and row groups. files: how many ranges the curve is
    cut into, by default as many as shuffles have."""
    placed = cells.withColumn("_curve", curve_key(F.col("row"), F.col("col"), tile))
    ranged = placed.repartitionByRange(files, "_curve") if files else placed.repartitionByRange("_curve")
    ranged.sortWithinPartitions("_curve", *KEY).drop("_curve").write.option("parquet.block.size", group_mb << 20).parquet(path)


def write_training(training: DataFrame, path: str, files: int = 8) -> None:
    """A folder per identifier, of at most `files` files, each written by a task of its own."""
    training.repartition("identifier", F.pmod(F.xxhash64(*training.columns), F.lit(files))).write.mode("overwrite").partitionBy("identifier").parquet(path)


def write_results(results: DataFrame, path: str) -> None:
    results.withColumn("timestamp", F.current_timestamp()).write.mode("append").parquet(path)


def write_models(coefficients: DataFrame, path: str) -> None:
    coefficients.write.mode("overwrite").parquet(path)
