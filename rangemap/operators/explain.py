"""Explaining models: permutation importance and partial dependence."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import unit_hash
from ..session import merged, written
from .evaluate import auc
from .ordered import quantiles, running
from .predict import score, score_own
from .sampling import exact_sample


def shuffled(i: np.ndarray, n: np.ndarray, seed: int) -> np.ndarray:
    """Where each i of 0 to n - 1 goes in a permutation of these that seed draws: a Feistel network on as many bits as n needs, gone
    through again by what it sends beyond n. Each place is computed by itself, so a permutation of any length is in no task."""
    half = np.array([max(1, (int(m - 1).bit_length() + 1) // 2) for m in np.unique(n)], np.uint64)[np.searchsorted(np.unique(n), n)]
    out, left = i.astype(np.uint64), np.arange(len(i))
    while len(left):
        h = half[left]
        mask = (np.uint64(1) << h) - np.uint64(1)
        high, low = out[left] >> h, out[left] & mask
        for k in range(6):
            x = low + np.uint64((seed * 1_000_003 + k * 7919 + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            high, low = low, high ^ ((x ^ (x >> np.uint64(31))) & mask)
        out[left] = (high << h) | low
        left = left[out[left] >= n[left].astype(np.uint64)]
    return out.astype(np.int64)


def permutation_importance(training: DataFrame, coefficients: DataFrame, features: list[str], repeats: int = 10, seed: int = 42, key: str = "point_id") -> DataFrame:
    """(identifier, feature, mean, std, importance): how much the AUC falls when one feature's values are dealt anew.

    All rows of each identifier take part. They are numbered by a hash of key, and a repeat has one permutation of the numbers for
    all features, each of which is dealt by itself.
    """
    order = F.struct(unit_hash(F.col(key), seed), F.col(key), F.col("class"), *(F.col(f) for f in features))
    numbered = running(training.select("identifier", "class", *features, order.alias("_order"), F.lit(1).cast("long").alias("_one")), ["identifier"], "_order", {"_row": "_one"})
    sizes = training.groupBy("identifier").agg(F.count("*").alias("_n"))
    rows = written(numbered.join(sizes, "identifier").select("identifier", "class", F.col("_row").cast("long").alias("_row"), "_n", *(F.col(f).cast("double").alias(f) for f in features)), "rows")
    given = [f"_given_{f}" for f in features]

    def deal(batches):
        for batch in batches:
            i, n = (batch.column(c).to_numpy() for c in ("_row", "_n"))
            for repeat in range(repeats):
                to = pa.array(shuffled(i, n, seed + repeat))
                yield pa.RecordBatch.from_arrays([batch.column("identifier"), to, pa.array(np.full(len(i), repeat, np.int32)), *(batch.column(f) for f in features)], ["identifier", "_row", "repeat", *given])

    schema = "identifier string, _row long, repeat int, " + ", ".join(f"`{g}` double" for g in given)
    dealt = rows.select("identifier", "_row", "_n", *features).mapInArrow(deal, schema)
    mixed = rows.drop("_n").join(merged(dealt), ["identifier", "_row"]).withColumn("feature", F.explode(F.array(*(F.lit(f) for f in features))))
    mixed = mixed.select("identifier", "feature", "repeat", "class", *(F.when(F.col("feature") == f, F.col(g)).otherwise(F.col(f)).alias(f) for f, g in zip(features, given, strict=True)))
    base = auc(score_own(rows, coefficients, features, ["identifier", "class"]), ["identifier"]).withColumnRenamed("auc", "base")
    after = auc(score_own(mixed, coefficients, features, ["identifier", "feature", "repeat", "class"]), ["identifier", "feature", "repeat"])
    fall = after.join(base, "identifier").withColumn("fall", F.col("base") - F.col("auc"))
    return fall.groupBy("identifier", "feature").agg(F.avg("fall").alias("mean"), F.stddev_pop("fall").alias("std")).withColumn("importance", F.col("mean"))


def partial_dependence(cells: DataFrame, coefficients: DataFrame, features: list[str], vary: list[str] | None = None, points: int = 30, most_rows: int = 1000, seed: int = 42, key: str = "cell_id") -> DataFrame:
    """(identifier, feature, step, value, p, centred): the mean prediction of a sample of at most most_rows cells with one
    feature set to each of `points` values from its 5th to its 95th percentile; centred on the first. vary: the features to show, by default all of the models'."""
    vary = vary or features
    full = cells.na.drop(subset=features)
    long = full.select(F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in vary))).alias("e")).select("e.*")
    ends = {r["feature"]: (r["low"], r["high"]) for r in quantiles(long, ["feature"], "value", {"low": 0.05, "high": 0.95}).collect()}  # a row per feature
    sample = exact_sample(full, most_rows, key, seed)
    grid = [(f, i, float(ends[f][0] + (ends[f][1] - ends[f][0]) * i / (points - 1))) for f in vary for i in range(points)]
    steps = cells.sparkSession.createDataFrame(grid, "feature string, step int, value double")
    mixed = sample.crossJoin(F.broadcast(steps))  # at most most_rows by features by points
    mixed = mixed.select("feature", "step", "value", *(F.when(F.col("feature") == f, F.col("value")).otherwise(F.col(f)).alias(f) for f in features))
    scored = score(mixed, coefficients, features, ["feature", "step", "value"])
    mean = scored.groupBy("identifier", "feature", "step", "value").agg(F.avg("p").alias("p"))
    first = F.first("p").over(Window.partitionBy("identifier", "feature").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return mean.withColumn("centred", F.col("p") - first)
