"""Running totals, quantiles and the first rows of groups, of groups of any length.

An ordered window over a whole group puts the group into one task. Here rows are dealt by ranges of the order; windows see
one range, and a second window the ranges' totals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written


def join_groups(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """rows with the columns of their group's one row; a null group is a group. Without by, groups is one row."""
    if not by:
        return rows.crossJoin(F.broadcast(groups))
    renamed = groups.withColumnsRenamed({b: f"_by_{b}" for b in by})
    same = reduce(Column.__and__, [rows[b].eqNullSafe(renamed[f"_by_{b}"]) for b in by])
    return rows.join(renamed, same).drop(*(f"_by_{b}" for b in by))


def running(df: DataFrame, by: list[str], order: str, sums: dict[str, str], descending: bool = False) -> DataFrame:
    """df with, for each name in sums, the total of its column over the rows of the group that come before in order, 0 for
    the first. A value of order occurs once in a group."""
    key = F.desc(order) if descending else F.asc(order)
    ranged = written(df.repartitionByRange(*by, key).withColumn("_range", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy(*by, "_range").agg(*(F.sum(c).alias(f"_t_{n}") for n, c in sums.items()))
    # A row for each group and range: as many as groups and ranges together.
    ahead = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, "_range", *(F.coalesce(F.sum(f"_t_{n}").over(ahead), F.lit(0)).alias(f"_s_{n}") for n in sums))
    inner = Window.partitionBy(*by, "_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumns({n: F.coalesce(F.sum(c).over(inner), F.lit(0)) for n, c in sums.items()})
    placed = join_groups(rows, starts, [*by, "_range"])
    return placed.withColumns({n: F.col(n) + F.col(f"_s_{n}") for n in sums}).drop("_range", *(f"_s_{n}" for n in sums))


def quantiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(by, names of shares): exact quantiles of value, linear between ranks. Nulls are left out; without by always one row."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    placed = running(counts, by, "_v", {"_before": "_n"})
    placed = join_groups(placed, counts.groupBy(*by).agg(F.sum("_n").alias("_all")), by)
    made = []
    for name, share in shares.items():
        at = (F.col("_all") - 1) * F.lit(float(share))
        low, part = F.floor(at), at - F.floor(at)
        of = lambda rank: F.max(F.when((rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_n")), F.col("_v")))
        made.append((of(low) + (of(F.ceil(at)) - of(low)) * F.max(part)).alias(name))
    return placed.groupBy(*by).agg(*made) if by else placed.agg(*made)


def first_rows(df: DataFrame, by: list[str], order: list[Column], most: Column | int, key: str, name: str = "_rank", shares: int = 64) -> DataFrame:
    """The first rows, at most `most`, of each group in order, with their rank. Groups are cut into shares by a hash of key
    and only each share's first rows meet."""
    most = F.lit(most) if isinstance(most, int) else most
    cut = df.withColumn("_share", F.pmod(F.xxhash64(key), F.lit(shares)))
    for keys in ([*by, "_share"], by):
        cut = cut.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= most)
    return cut.drop("_share")
