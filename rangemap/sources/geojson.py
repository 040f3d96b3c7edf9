"""GeoJSON feature collections as tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import reproject, reproject_shapes
from ..operators.grid import GridSpec
from ..operators.occurrence import accurate

PROPERTIES = {"unique_id": "string", "latin_name": "string", "genus": "string", "activity_type": "string", "date": "string", "accuracy": "double", "coordinateUncertaintyInMeters": "double"}


def _separator(spark: SparkSession, path: str) -> str | None:
    """How each feature of a collection begins, as its writer spaced it: `{"type": "Feature"`. None if the first feature's
    type does not come first, or not within the first brackets of the text. Reads the start of a file only."""
    pieces = spark.read.text(path, lineSep="{").select("value", F.col("_metadata.file_block_start").alias("start"))
    head = "{".join(r["value"] for r in pieces.filter("start = 0").limit(64).collect())
    found = re.search(r'"features"\s*:\s*\[\s*(\{\s*"type"\s*:\s*"Feature")', head)
    return found and found[1]


def _pieces(spark: SparkSession, path: str, separator: str, schema: T.StructType) -> DataFrame:
    """f: each feature of a collection, read as text that is cut where features begin, so that Spark can split its files.

    Quotes inside JSON strings are escaped, so the separator stands at the start of an object only. A piece is read as an
    array: one that holds more features (spaced in another way) gives them all, and one that does not parse is an error.
    """
    rows = spark.read.text(path, lineSep=separator)
    value = F.col("value")
    following = F.substring(value, 1, 64).rlike(r"^\s*[,}]")  # what stands after a separator; else the start of a file
    features = schema["features"].dataType
    listed = F.from_json(F.concat(F.lit("[" + separator), F.regexp_replace(value, r",\s*\z", ""), F.lit("]")), features)
    # A start that ends where its features begin holds none; one without any separator is a whole collection.
    opened = F.substring(value, -4096, 4096).rlike(r'"features"\s*:\s*\[\s*\z')
    whole = F.from_json(value, schema)["features"]
    none = F.array().cast(features)
    found = F.when(following, listed).when(opened | (F.trim(value) == ""), none).otherwise(whole)
    broken = F.raise_error(F.concat(F.lit("not a feature collection: "), F.substring(value, 1, 80)))
    return rows.select(F.explode(F.coalesce(found, F.when(found.isNull(), broken).cast(features))).alias("f"))


def read_features(spark: SparkSession, path: str, properties: dict[str, str]) -> DataFrame:
    """properties, geom_type and coordinates (JSON text) of each feature. Properties that no feature has come out null.

    A collection whose features begin with their type, as most writers do it, is split over tasks. Others are read whole, a
    file by a task.
    """
    props = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in properties.items()])
    geometry = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    feature = T.StructType([T.StructField("properties", props), T.StructField("geometry", geometry)])
    schema = T.StructType([T.StructField("features", T.ArrayType(feature))])
    separator = _separator(spark, path)
    if separator is None:
        rows = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    else:
        rows = _pieces(spark, path, separator, schema)
    return rows.select("f.properties.*", F.col("f.geometry.type").alias("geom_type"), F.col("f.geometry.coordinates").alias("coordinates"))


def read_points(spark: SparkSession, path: str, properties: dict[str, str] = PROPERTIES, threshold: float = 100.0, source: int = 27700, target: int = 27700) -> DataFrame:
    """Point features with x and y, whose stated uncertainty is at most threshold."""
    rows = read_features(spark, path, properties).filter("geom_type = 'Point'")
    at = F.from_json("coordinates", "array<double>")
    rows = rows.withColumns({"x": at[0], "y": at[1]}).drop("geom_type", "coordinates")
    for name in ("coordinateUncertaintyInMeters", "accuracy"):
        if name in rows.columns and rows.filter(F.col(name).isNotNull()).isEmpty():
            rows = rows.drop(name)  # the file has no such property
    return reproject(accurate(rows, threshold), source, target)


def _parts(kind: Column, text: Column) -> Column:
    """Coordinates of any line or polygon as an array of parts, a part being an array of rings."""
    line, ring2, ring3 = "array<array<double>>", "array<array<array<double>>>", "array<array<array<array<double>>>>"
    return (
        F.when(kind == "LineString", F.array(F.array(F.from_json(text, line))))
        .when(kind == "MultiLineString", F.transform(F.from_json(text, ring2), lambda r: F.array(r)))
        .when(kind == "Polygon", F.array(F.from_json(text, ring2)))
        .when(kind == "MultiPolygon", F.from_json(text, ring3))
    )


def read_shapes(spark: SparkSession, path: str, properties: dict[str, str], id_property: str | None = None, source: int = 27700, target: int = 27700) -> DataFrame:
    """Lines and polygons: properties, geom_id, part and rings, one row per part; moved from source to target (EPSG)."""
    rows = read_features(spark, path, properties).filter("geom_type <> 'Point'")
    rows = rows.withColumn("geom_id", F.col(id_property).cast("string") if id_property else F.sha2("coordinates", 256))
    shapes = rows.select(*properties, "geom_id", F.posexplode(_parts(F.col("geom_type"), F.col("coordinates"))).alias("part", "rings"))
    return reproject_shapes(shapes, source, target)


def boundary_grid(shapes: DataFrame, res: float, buffer: float = 0.0) -> GridSpec:
    """The snapped grid around all shapes, widened by buffer."""
    point = shapes.select(F.explode(F.flatten("rings")).alias("p"))
    b = point.agg(F.min(F.col("p")[0]), F.min(F.col("p")[1]), F.max(F.col("p")[0]), F.max(F.col("p")[1])).first()
    return GridSpec.from_bounds((b[0] - buffer, b[1] - buffer, b[2] + buffer, b[3] + buffer), res)


def features_json(shapes: DataFrame, properties: list[str]) -> DataFrame:
    """One GeoJSON feature per line of text, for writing with .write.text."""
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.col("rings").alias("coordinates")).alias("geometry"))
    return shapes.select(F.to_json(feature).alias("value"))
