"""MaxEnt-style models: feature expansion, fitting, cross-validation, coefficient tables.

A model is an infinitely weighted logistic regression of presences against background with an L1 penalty per term, and
is kept as rows of a coefficient table. All models and folds are fitted together by Newton steps (solver.py): what Spark
adds up over the rows has the size of a model's terms, so one model may have few rows or all of a cluster's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import unit_hash
from ..session import discard, written
from . import evaluate
from .ordered import join_groups, running
from .solver import Problem, added_up, minimise, values_of

LINEAR, QUADRATIC, PRODUCT, HINGE, THRESHOLD = "linear", "quadratic", "product", "hinge", "threshold"
COEFFICIENTS = "identifier string, fold int, kind string, a string, b string, knot double, up boolean, lo_a double, hi_a double, lo_b double, hi_b double, coef double"
FINAL = -1  # the fold of the model fitted on all rows

# The published regularisation of term kinds by number of presences (points of a broken line).
PENALTY = {LINEAR: ([0, 10, 30, 100], [1.0, 1.0, 0.2, 0.05]), QUADRATIC: ([0, 10, 17, 30, 100], [1.3, 0.8, 0.5, 0.25, 0.05]), PRODUCT: ([0, 10, 17, 30, 100], [2.6, 1.6, 0.9, 0.55, 0.05]), HINGE: ([0, 1], [0.5, 0.5]), THRESHOLD: ([0, 100], [2.0, 1.0])}

# The features of a model, by activity.
FEATURES = {
    "In flight": [
        "ceh_landcover_improved_grassland",
        "ceh_landcover_suburban",
        "bgs_coast_distance_to_coast",
        "ceh_landcover_arable",
        "ceh_landcover_suburban_500m",
        "ceh_landcover_arable_500m",
        "climate_bioclim_bio_7",
        "vom_vegetation_height_max",
        "terrain_stats_slope",
        "ceh_landcover_broadleaved_woodland",
        "climate_bioclim_bio_9",
        "climate_stats_temp_ann_var",
        "os_cover_water",
        "climate_bioclim_bio_3",
        "ceh_landcover_improved_grassland_500m",
        "ceh_landcover_urban",
        "climate_stats_prec_ann_avg",
        "climate_stats_temp_ann_avg",
        "os_distance_distance_to_major_roads",
        "terrain_dtm",
        "os_distance_distance_to_buildings",
        "ceh_landcover_urban_500m",
        "climate_stats_wind_ann_avg",
    ],
    "Roost": [
        "ceh_landcover_suburban",
        "vom_vegetation_height_max",
        "os_distance_distance_to_buildings",
        "vom_vegetation_height_mean_500m",
        "ceh_landcover_suburban_500m",
        "bgs_coast_distance_to_coast",
        "ceh_landcover_broadleaved_woodland_500m",
        "ceh_landcover_improved_grassland",
        "terrain_stats_roughness",
        "climate_bioclim_bio_3",
        "climate_bioclim_bio_9",
        "ceh_landcover_broadleaved_woodland",
        "ceh_landcover_arable_500m",
        "ceh_landcover_improved_grassland_500m",
        "ceh_landcover_grassland",
        "climate_stats_temp_ann_avg",
    ],
}


@dataclass(frozen=True)
class Config:
    kinds: tuple[str, ...] = (LINEAR, HINGE, PRODUCT)
    n_hinge: int = 10
    n_threshold: int = 10
    clamp: bool = True
    beta: float = 1.5
    beta_kind: dict[str, float] = field(default_factory=lambda: {LINEAR: 1.0, QUADRATIC: 1.0, PRODUCT: 1.0, HINGE: 1.0, THRESHOLD: 1.0})
    background_weight: float | str = 100.0  # or "balanced"
    tolerance: float = 1e-7  # of the gap between the objective and its dual, relative
    iterations: int = 200
    transform: str = "cloglog"


def terms(features: list[str], config: Config) -> list[tuple[str, str, str, float, bool]]:
    """(kind, a, b, knot, up) of every term; knots are on features scaled to 0..1."""
    out = []
    if LINEAR in config.kinds:
        out += [(LINEAR, f, "", 0.0, True) for f in features]
    if QUADRATIC in config.kinds:
        out += [(QUADRATIC, f, "", 0.0, True) for f in features]
    if PRODUCT in config.kinds:
        out += [(PRODUCT, a, b, 0.0, True) for i, a in enumerate(features) for b in features[i + 1 :]]
    if HINGE in config.kinds:
        knots = np.linspace(0, 1, config.n_hinge)
        out += [(HINGE, f, "", float(k), True) for f in features for k in knots[:-1]]
        out += [(HINGE, f, "", float(k), False) for f in features for k in knots[1:]]
    if THRESHOLD in config.kinds:
        out += [(THRESHOLD, f, "", float(k), True) for f in features for k in np.linspace(0, 1, config.n_threshold + 2)[1:-1]]
    return out


def _value(kind, a, b, knot, up, most):
    """One term of scaled values: the same arithmetic for numpy arrays and columns."""
    if kind == LINEAR:
        return a
    if kind == QUADRATIC:
        return a * a
    if kind == PRODUCT:
        return a * b
    if kind == HINGE:
        return most((a - knot) / (1 - knot)) if up else most((knot - a) / knot)
    return (a >= knot) * 1.0 if isinstance(a, np.ndarray) else (a >= knot).cast("double")


def matrix(scaled: dict[str, np.ndarray], made: list) -> np.ndarray:
    n = len(next(iter(scaled.values())))
    cols = [_value(k, scaled[a], scaled.get(b), t, up, lambda v: np.maximum(v, 0)) for k, a, b, t, up in made]
    return np.stack(cols, 1) if cols else np.zeros((n, 0))


def column(kind: str, a: Column, b: Column | None, knot: float, up: bool) -> Column:
    return _value(kind, a, b, knot, up, lambda v: F.greatest(v, F.lit(0.0)))


def scaled_column(name: str, lo: float, hi: float, clamp: bool = True) -> Column:
    """A feature over its training range; constant features are 0. Null stays null."""
    v = (F.col(f"`{name}`") - F.lit(float(lo))) / F.lit(float(hi - lo) if hi > lo else 1.0)
    return F.when(F.col(f"`{name}`").isNotNull(), F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0))) if clamp else v


def penalties(spread: np.ndarray, n: int, made: list, config: Config) -> np.ndarray:
    """Of each term: the published value for n presences, times the term's spread among them."""
    base = np.array([np.interp(n, *PENALTY[t[0]]) * config.beta_kind[t[0]] for t in made])
    return config.beta * base * np.maximum(spread, 1e-3) * np.sqrt(n)


def rank_auc(y: np.ndarray, s: np.ndarray) -> float | None:
    p, n = int((y == 1).sum()), int((y == 0).sum())
    if not p or not n:
        return None
    ranks = pd.Series(s).rank().to_numpy()
    return float((ranks[y == 1].sum() - p * (p + 1) / 2) / (p * n))


Metric = Callable[[np.ndarray, np.ndarray], float | None]


@dataclass(frozen=True)
class Part:
    """One model and fold: its rows and terms."""

    identifier: str
    fold: int
    features: tuple[str, ...]
    terms: tuple
    lo: dict[str, float]
    hi: dict[str, float]

    def known(self, values: dict[str, np.ndarray]) -> np.ndarray:
        """Indices of the identifier's rows that have all features."""
        mine = values["identifier"] == self.identifier
        for f in self.features:
            mine &= ~np.isnan(values[f])
        return np.flatnonzero(mine)

    def fitted_on(self, values: dict[str, np.ndarray]) -> np.ndarray:
        rows = self.known(values)
        return rows if self.fold == FINAL else rows[values["fold"][rows] != self.fold]

    def design(self, values: dict[str, np.ndarray], rows: np.ndarray, clamp: bool = False) -> np.ndarray:
        scaled = {f: (values[f][rows] - self.lo[f]) / ((self.hi[f] - self.lo[f]) or 1.0) for f in self.features}
        return matrix({f: np.clip(v, 0, 1) for f, v in scaled.items()} if clamp else scaled, self.terms)

    def presence_moments(self, values: dict[str, np.ndarray]) -> np.ndarray | None:
        """Of the presences fitted on: the terms' sums and sums of squares, about a half, and their number."""
        rows = self.fitted_on(values)
        rows = rows[values["class"][rows] == 1]
        if not len(rows):
            return None
        x = self.design(values, rows) - 0.5
        return np.concatenate([x.sum(0), (x * x).sum(0), [len(rows)]])


def _custom(metric: Metric):
    def run(table: pa.Table) -> pa.Table:
        value = metric(table.column("class").to_numpy(), table.column("eta").to_numpy())
        return pa.table({"key": table.column("key").slice(0, 1), "auc": pa.array([value], pa.float64())})

    return run


def with_geographic_folds(training: DataFrame, k: int = 3, seed: int = 42) -> DataFrame:
    """training with fold: k clusters of the coordinates, common to all identifiers."""
    spots = VectorAssembler(inputCols=["x", "y"], outputCol="_xy").transform(training)
    return KMeans(k=k, seed=seed, featuresCol="_xy", predictionCol="fold").fit(spots).transform(spots).drop("_xy")


def with_random_folds(training: DataFrame, k: int = 3, seed: int = 42, by: str = "identifier", key: str = "point_id") -> DataFrame:
    """training with fold: k even shares of each identifier, in the order of a hash of the key; the first shares have one row
    more where k doesn't divide an identifier's rows. An identifier's rows are numbered by ranges, so they may be in any
    number of tasks."""
    order = F.struct(unit_hash(F.col(key), seed).alias("u"), F.col(key).alias("k"), F.col("class").alias("c"))
    placed = running(training.withColumns({"_order": order, "_one": F.lit(1).cast("long")}), [by], "_order", {"_before": "_one"})
    placed = join_groups(placed, training.groupBy(by).agg(F.count("*").alias("_n")), [by])
    before, small = F.col("_before"), F.expr(f"_n DIV {k}")
    wide = F.col("_n") % k * (small + 1)  # rows in the shares that have one more
    fold = F.when(before < wide, F.floor(before / (small + 1))).otherwise(F.col("_n") % k + F.floor((before - wide) / small))
    return placed.withColumn("fold", fold.cast("int")).drop("_order", "_one", "_before", "_n")


def fit_all(training: DataFrame, features: dict[str, list[str]] | list[str], config: Config = Config(), k: int = 3, metric: Metric | None = None) -> DataFrame:
    """The coefficient table of one model per identifier and fold 0..k-1, and of fold FINAL on all rows.

    training: identifier, class, sample_weight, fold, features. features: for all, or by the activity that ends an
    identifier. Rows with a null feature are left out. Rows of kind auc, status, n_presence, n_background carry a model's
    outcome, gap how far its objective may be from the least one, relative to it; a model without presences or without
    background has a status and no coefficients. Models and their terms are few and pass through the driver; rows never do, and a
    model's rows may be in any number of tasks. metric: instead of the AUC, of the classes and linear predictors of a
    fold's held-out rows, which it gets as arrays in one task.
    """
    spark = training.sparkSession
    by_activity = features if isinstance(features, dict) else {}
    every = features if isinstance(features, list) else sorted({f for v in features.values() for f in v})
    of = lambda name: by_activity.get(name.rsplit("_", 1)[-1], every)
    rows = written(training.select("identifier", F.col("class").cast("int").alias("class"), F.col("sample_weight").cast("double").alias("sample_weight"), F.col("fold").cast("int").alias("fold"), *(F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None).cast("double")).alias(f) for f in every)), "fit-rows")
    complete = lambda names: reduce(Column.__and__, [F.col(f"`{f}`").isNotNull() for f in names], F.lit(True))
    activity, known = F.element_at(F.split("identifier", "_"), -1), complete(every)
    for name, names in by_activity.items():
        known = F.when(activity == name, complete(names)).otherwise(known)
    there = lambda c: F.count_if(known & (F.col("class") == c)).alias(f"n{c}")
    heavy = lambda c: F.sum(F.when(known & (F.col("class") == c), F.col("sample_weight"))).alias(f"w{c}")
    edges = (x for f in every for x in (F.min(F.when(known, F.col(f"`{f}`"))).alias(f"lo {f}"), F.max(F.when(known, F.col(f"`{f}`"))).alias(f"hi {f}")))
    # A row per identifier and fold.
    stats = [r.asDict() for r in rows.groupBy("identifier", "fold").agg(there(0), there(1), heavy(0), heavy(1), *edges).collect()]
    total = lambda found, name: sum(r[name] or 0 for r in found)
    out: list[dict] = []
    parts: list[Part] = []
    counts: list[tuple[int, float, float]] = []
    for name in sorted({r["identifier"] for r in stats}):
        own = [r for r in stats if r["identifier"] == name]
        for fold in (*range(k), FINAL):
            fit = [r for r in own if fold == FINAL or r["fold"] != fold]
            n1, n0 = total(fit, "n1"), total(fit, "n0")
            status = "No presence data" if not n1 else "No background data" if not n0 else "Success"
            base = {"identifier": name, "fold": fold}
            out += [base | {"kind": "status", "a": status}, base | {"kind": "n_presence", "coef": float(total(own, "n1"))}, base | {"kind": "n_background", "coef": float(total(own, "n0"))}]
            if status == "Success":
                lo = {f: min(r[f"lo {f}"] for r in fit if r[f"lo {f}"] is not None) for f in of(name)}
                hi = {f: max(r[f"hi {f}"] for r in fit if r[f"hi {f}"] is not None) for f in of(name)}
                parts.append(Part(name, fold, tuple(of(name)), tuple(terms(of(name), config)), lo, hi))
                weight = n1 / n0 if config.background_weight == "balanced" else float(config.background_weight)
                counts.append((n1, weight, total(fit, "w1") / max(total(fit, "w1") + weight * total(fit, "w0"), 1e-300)))
    used = ["identifier", "class", "fold", *every]
    moments = added_up(rows, used, {i: p.presence_moments for i, p in enumerate(parts)}) if parts else {}
    problems = []
    for i, (p, (n, weight, share)) in enumerate(zip(parts, counts, strict=True)):
        s = np.frombuffer(moments[i])
        m = len(p.terms)
        spread = np.sqrt(np.maximum(s[m : 2 * m] / s[-1] - (s[:m] / s[-1]) ** 2, 0))
        problems.append(Problem(["identifier", "fold", *p.features], p.fitted_on, p.design, penalties(spread, n, list(p.terms), config), weight, share))
    states = minimise(rows, problems, config.tolerance, config.iterations)
    coefs = [s.beta for s in states]

    def predictors(batches):
        for batch in batches:
            values = values_of(batch, used)
            for i, (p, beta) in enumerate(zip(parts, coefs, strict=True)):
                mine = p.known(values)
                eta = p.design(values, mine, config.clamp) @ beta[:-1]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mine), i, np.int32)), pa.array(values["class"][mine].astype(np.int32)), pa.array(values["fold"][mine] == p.fold), pa.array(eta)], ["key", "class", "held", "eta"])

    if parts:
        etas = written(rows.select(*used).mapInArrow(predictors, "key int, class int, held boolean, eta double"), "predictors")
        final = F.col("key").isin([i for i, p in enumerate(parts) if p.fold == FINAL])
        tested = etas.filter(F.col("held") | final)
        scores = evaluate.auc(tested, ["key"], score="eta") if metric is None else tested.groupBy("key").applyInArrow(_custom(metric), "key int, auc double")
        auc = {r.key: r.auc for r in scores.collect()}
        back = etas.filter("class = 0 AND NOT held")
        tops = back.groupBy("key").agg(F.max("eta").alias("top"))
        raw = F.exp(F.col("eta") - F.col("top"))
        sums = back.join(F.broadcast(tops), "key").groupBy("key", "top").agg(F.sum(raw).alias("z"), F.sum(raw * F.col("eta")).alias("e"))
        spread_of = {r.key: (-(r.top + float(np.log(r.z))), r.e / r.z) for r in sums.collect()}
        for i, (p, state) in enumerate(zip(parts, states, strict=True)):
            alpha, mean = spread_of[i]
            base = {"identifier": p.identifier, "fold": p.fold}
            fixed = {"intercept": state.beta[-1], "alpha": alpha, "entropy": -(mean + alpha), "auc": auc.get(i), "gap": state.gap if np.isfinite(state.gap) else None}
            out += [base | {"kind": kind, "coef": None if v is None else float(v)} for kind, v in fixed.items()]
            for (kind, a, b, knot, up), c in zip(p.terms, state.beta[:-1], strict=True):
                if c:
                    out.append(base | {"kind": kind, "a": a, "b": b or None, "knot": knot, "up": up, "lo_a": p.lo[a], "hi_a": p.hi[a], "lo_b": p.lo[b] if b else None, "hi_b": p.hi[b] if b else None, "coef": float(c)})
        discard(etas)
    discard(rows)
    names = [c.split()[0] for c in COEFFICIENTS.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in out], COEFFICIENTS)


def fit_large(training: DataFrame, features: list[str], config: Config = Config(), identifier: str = "all_All") -> DataFrame:
    """The coefficient table of one model over all rows of training, whatever their identifiers."""
    return fit_all(training.withColumns({"identifier": F.lit(identifier), "fold": F.lit(0)}), features, config, k=0)


def results(coefficients: DataFrame) -> DataFrame:
    """One row per identifier: mean and std of the folds' AUC, numbers of rows, status of the final model."""
    cv = coefficients.filter((F.col("kind") == "auc") & (F.col("fold") != FINAL)).groupBy("identifier").agg(F.avg("coef").alias("mean_cv_score"), F.stddev_pop("coef").alias("std_cv_score"))
    pick = lambda kind, col, name: F.max(F.when(F.col("kind") == kind, F.col(col))).alias(name)
    last = coefficients.filter(F.col("fold") == FINAL).groupBy("identifier").agg(pick("status", "a", "status"), pick("n_presence", "coef", "n_presence"), pick("n_background", "coef", "n_background"))
    parts = F.split("identifier", "_(?=[^_]*$)")
    out = last.join(cv, "identifier", "left")
    return out.select("identifier", parts[0].alias("latin_name"), F.coalesce(F.nullif(F.get(parts, F.lit(1)), F.lit("")), F.lit("All")).alias("activity_type"), "mean_cv_score", "std_cv_score", F.col("n_presence").cast("long").alias("n_presence"), F.col("n_background").cast("long").alias("n_background"), "status")


def iterate_models(coefficients: DataFrame, fold: int = FINAL) -> Iterator[tuple[str, list]]:
    """Models with their rows. Their number is that of species and activities, and each has few terms."""
    rows = coefficients.filter((F.col("fold") == fold) & F.col("coef").isNotNull()).collect()
    for name in sorted({r["identifier"] for r in rows}):
        yield name, [r for r in rows if r["identifier"] == name]
