"""Evaluation tables: AUC, ROC, confusion metrics, cross-validation summaries, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ordered import join_groups, running


def auc(df: DataFrame, by: list[str], label: str = "class", score: str = "p") -> DataFrame:
    """(by, auc): exact, ties count half; null if a group has one class only. Distinct scores are dealt by ranges, so a
    group of any size spreads over tasks."""
    counts = df.groupBy(*by, score).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n"))
    won = running(counts, by, score, {"_below": "_n"}).withColumn("_won", F.col("_p") * (F.col("_below") + F.col("_n") / 2))
    total = won.groupBy(*by).agg(F.sum("_won").alias("w"), F.sum("_p").alias("p"), F.sum("_n").alias("n"))
    return total.select(*by, F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("w") / (F.col("p") * F.col("n"))).alias("auc"))


def roc_points(df: DataFrame, by: list[str], label: str = "class", score: str = "p") -> DataFrame:
    """(by, threshold, tpr, fpr) at each distinct score, from the highest."""
    counts = df.groupBy(*by, F.col(score).alias("threshold")).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n"))
    so_far = running(counts, by, "threshold", {"_ahead_p": "_p", "_ahead_n": "_n"}, descending=True)
    whole = counts.groupBy(*by).agg(F.sum("_p").alias("_all_p"), F.sum("_n").alias("_all_n"))
    share = lambda c: (F.col(f"_ahead_{c}") + F.col(f"_{c}")) / F.nullif(F.col(f"_all_{c}"), F.lit(0))
    return join_groups(so_far, whole, by).select(*by, "threshold", share("p").alias("tpr"), share("n").alias("fpr"))


def confusion(df: DataFrame, by: list[str], label: str = "class", score: str = "p", threshold: float = 0.5) -> DataFrame:
    """(by, tp, fp, tn, fn, accuracy, sensitivity, specificity, precision, f1); 0 where a denominator is 0."""
    hit, real = F.col(score) >= threshold, F.col(label) == 1
    c = df.groupBy(*by).agg(F.count_if(hit & real).alias("tp"), F.count_if(hit & ~real).alias("fp"), F.count_if(~hit & ~real).alias("tn"), F.count_if(~hit & real).alias("fn"))
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    over = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return c.select(*by, "tp", "fp", "tn", "fn", over(tp + tn, tp + fp + tn + fn).alias("accuracy"), over(tp, tp + fn).alias("sensitivity"), over(tn, tn + fp).alias("specificity"), over(tp, tp + fp).alias("precision"), over(2 * tp, 2 * tp + fp + fn).alias("f1"))


def cv_summary(scores: DataFrame, by: list[str], score: str = "auc") -> DataFrame:
    """(by, mean_cv_score, std_cv_score) over folds; folds without a score are left out."""
    return scores.groupBy(*by).agg(F.avg(score).alias("mean_cv_score"), F.stddev_pop(score).alias("std_cv_score"))


def histogram(df: DataFrame, by: list[str], score: str = "p", bins: int = 50) -> DataFrame:
    """(by, bin, low, high, n, density) over 0..1; a value of 1 counts in the last bin. Bins without values are absent."""
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    n = df.filter(F.col(score).isNotNull()).groupBy(*by, at.alias("bin")).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    return n.select(*by, "bin", (F.col("bin") / bins).alias("low"), ((F.col("bin") + 1) / bins).alias("high"), "n", (F.col("n") * bins / F.sum("n").over(whole)).alias("density"))


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.corr(x, y).alias("r"))


def with_lower_bound(importance: DataFrame, z: float = 1.96) -> DataFrame:
    low = F.col("mean") - z * F.col("std")
    return importance.withColumns({"lower": low, "negative": low < 0})


def importance_summary(importance: DataFrame, by: list[str], top: int | None = None) -> DataFrame:
    """(by, mean_importance, keep_var), most important first, at most top."""
    out = importance.groupBy(*by).agg(F.avg("importance").alias("mean_importance"))
    out = out.withColumn("keep_var", F.col("mean_importance") > 0).orderBy(F.desc("mean_importance"), *by)
    return out.limit(top) if top is not None else out


def by_group(df: DataFrame, by: list[str], value: str, descending: bool = True) -> DataFrame:
    """Rows sorted by group and, within it, by value."""
    return df.orderBy(*by, F.desc(value) if descending else F.asc(value))
