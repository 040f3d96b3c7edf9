"""Looking at and choosing features: missing shares, correlations, information, groups, components, encodings."""

from __future__ import annotations

from pyspark.ml.feature import PCA, Bucketizer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _long(row: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    """One row per column of a one-row table."""
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias(label), F.col(f"`{n}`").alias(value)) for n in names))).alias("e")).select("e.*")


def missing_fraction(df: DataFrame, bands: list[str], threshold: float = 0.0) -> DataFrame:
    """(variable, missing), largest first, above the threshold."""
    row = df.agg(*(F.avg(F.col(b).isNull().cast("int")).alias(b) for b in bands))
    return _long(row, bands, "variable", "missing").filter(F.col("missing") > threshold).orderBy(F.desc("missing"), "variable")


def correlations(df: DataFrame, bands: list[str], null_as_zero: bool = True) -> DataFrame:
    """(variable_1, variable_2, r) of all ordered pairs in one pass."""
    v = (lambda b: F.coalesce(F.col(b).cast("double"), F.lit(0.0))) if null_as_zero else F.col
    pairs = [(a, b) for i, a in enumerate(bands) for b in bands[i + 1 :]]
    row = df.agg(*(F.corr(v(a), v(b)).alias(f"{a}|{b}") for a, b in pairs))
    half = _long(row, [f"{a}|{b}" for a, b in pairs], "pair", "r")
    one = half.select(F.split("pair", r"\|")[0].alias("variable_1"), F.split("pair", r"\|")[1].alias("variable_2"), "r")
    other = one.select(F.col("variable_2").alias("variable_1"), F.col("variable_1").alias("variable_2"), "r")
    return one.unionByName(other)


def target_correlation(df: DataFrame, bands: list[str], target: str) -> DataFrame:
    """(feature, score): absolute correlation of each feature with the target."""
    return _long(df.agg(*(F.abs(F.corr(b, target)).alias(b) for b in bands)), bands, "feature", "score")


def mutual_information(df: DataFrame, bands: list[str], target: str, bins: int = 10) -> DataFrame:
    """(feature, score) in nats: each feature in quantile bins against the target's classes."""
    cuts = df.approxQuantile(bands, [i / bins for i in range(1, bins)], 0.001)
    long = None
    for b, edges in zip(bands, cuts, strict=True):
        splits = [-float("inf"), *sorted(set(edges)), float("inf")]
        binned = Bucketizer(splits=splits, inputCol=b, outputCol="_bin", handleInvalid="skip").transform(df.select(F.col(b).cast("double").alias(b), target))
        part = binned.groupBy(F.lit(b).alias("feature"), "_bin", target).agg(F.count("*").alias("n"))
        long = part if long is None else long.unionByName(part)
    both = lambda *by: Window.partitionBy("feature", *by)
    p = F.col("n") / F.sum("n").over(both())
    p_bin, p_class = F.sum("n").over(both("_bin")) / F.sum("n").over(both()), F.sum("n").over(both(target)) / F.sum("n").over(both())
    return long.select("feature", (p * F.log(p / (p_bin * p_class))).alias("part")).groupBy("feature").agg(F.sum("part").alias("score"))


def select_features(scores: DataFrame, threshold: float, most: int | None = None) -> DataFrame:
    """Features whose score reaches the threshold, best first, at most `most`."""
    kept = scores.filter(F.col("score") >= threshold).orderBy(F.desc("score"), "feature")
    return kept.limit(most) if most is not None else kept


def correlated_groups(df: DataFrame, bands: list[str], least: float = 0.7) -> DataFrame:
    """(variable, group): variables joined by chains of absolute correlations of least or more; a group is named by its
    first member. The pairs of a table's columns are few, whatever its rows, so the chains are followed on the driver."""
    place = {b: b for b in bands}

    def root(b: str) -> str:
        while place[b] != b:
            b = place[b]
        return b

    for r in correlations(df, bands).filter(F.abs("r") >= least).collect():
        a, b = sorted((root(r["variable_1"]), root(r["variable_2"])))
        place[b] = a
    return df.sparkSession.createDataFrame([(b, root(b)) for b in bands], "variable string, `group` string")


def standardise(df: DataFrame, bands: list[str]) -> DataFrame:
    """Bands minus their mean over their population std; a constant band is 0."""
    stats = df.agg(*(x for b in bands for x in (F.avg(b).alias(f"_m_{b}"), F.stddev_pop(b).alias(f"_s_{b}"))))
    made = [F.when(F.col(f"_s_{b}") > 0, (F.col(b) - F.col(f"_m_{b}")) / F.col(f"_s_{b}")).otherwise(F.col(b) - F.col(f"_m_{b}")).alias(b) for b in bands]
    return df.crossJoin(F.broadcast(stats)).select(*(c for c in df.columns if c not in bands), *made)  # one row


def one_hot(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with {column}_vec; a value that fitting did not see is all zeros."""
    index = StringIndexer(inputCols=columns, outputCols=[f"_{c}_i" for c in columns], handleInvalid="keep", stringOrderType="alphabetAsc")
    coded = index.fit(df).transform(df)
    hot = OneHotEncoder(inputCols=[f"_{c}_i" for c in columns], outputCols=[f"{c}_vec" for c in columns], dropLast=True)
    return hot.fit(coded).transform(coded).drop(*(f"_{c}_i" for c in columns))


def principal_components(cells: DataFrame, bands: list[str], keys: list[str], n: int = 3) -> tuple[DataFrame, list[float]]:
    """keys with pc_1 to pc_n of the standardised bands, and the shares of variance. Rows with a null are left out. Each
    component's largest loading is made positive, as its sign is arbitrary."""
    full = standardise(cells.na.drop(subset=bands), bands)
    joined = VectorAssembler(inputCols=bands, outputCol="_v").transform(full)
    model = PCA(k=n, inputCol="_v", outputCol="_pc").fit(joined)
    load = model.pc.toArray()
    signs = [1.0 if abs(c.max()) >= abs(c.min()) else -1.0 for c in load.T]
    at = vector_to_array("_pc")
    return model.transform(joined).select(*keys, *((at[i] * signs[i]).alias(f"pc_{i + 1}") for i in range(n))), model.explainedVariance.toArray().tolist()


def melt(df: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    return df.unpivot(keys, bands, "variable", "value")


def with_prefix(columns: list[str], prefixes: list[str]) -> list[str]:
    return [c for c in columns if c.startswith(tuple(prefixes))]


def included(flags: DataFrame) -> list[str]:
    """Variables whose include is 1, of a table with one row per variable."""
    return [r["variable"] for r in flags.filter("include = 1").orderBy("variable").collect()]


def subset(df: DataFrame, names: list[str], keys: list[str] = (), drop_missing: bool = False) -> DataFrame:
    """keys and the named features of df; drop_missing: only rows with all of them. An absent feature is an error."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"no such features: {absent}")
    out = df.select(*keys, *(F.col(f"`{n}`") for n in names))
    return out.na.drop(subset=list(names)) if drop_missing else out


def missing_from(wanted: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """Distinct values of on that are wanted and not known."""
    return wanted.select(on).distinct().join(known.select(on), on, "left_anti")


def explode_lists(df: DataFrame, lists: list[str]) -> DataFrame:
    """A row for each place of several lists of one length; other columns are repeated."""
    rest = [c for c in df.columns if c not in lists]
    return df.select(*rest, F.explode(F.arrays_zip(*lists)).alias("_z")).select(*rest, *(F.col("_z")[c].alias(c) for c in lists))
