"""Scoring cells and points with models, and tables over the predictions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .grid import GridSpec, model_grid
from .maxent import FINAL, HINGE, LINEAR, PRODUCT, QUADRATIC, THRESHOLD, iterate_models, matrix
from .raster import KEY, bands_of, merge_layers, resample


@dataclass(frozen=True)
class Scorer:
    """One model's terms as arrays, small enough to travel with a task. Values are scaled to the training range."""

    name: str
    features: list[str]  # without a value in any of them there is no prediction
    terms: list[tuple[str, str, str | None, float, bool, float]]  # kind, a, b, knot, up, coefficient
    range: dict[str, tuple[float, float]]
    alpha: float
    entropy: float

    @staticmethod
    def of(name: str, rows: list, features: list[str]) -> Scorer:
        fixed = {r["kind"]: r["coef"] for r in rows if r["kind"] in ("alpha", "entropy")}
        kept = [r for r in rows if r["kind"] in (LINEAR, QUADRATIC, PRODUCT, HINGE, THRESHOLD)]
        kept.sort(key=lambda r: (r["kind"], r["a"] or "", r["b"] or "", r["knot"] or 0.0, r["up"]))
        span = {r["a"]: (r["lo_a"], r["hi_a"]) for r in kept} | {r["b"]: (r["lo_b"], r["hi_b"]) for r in kept if r["b"]}
        return Scorer(name, features, [(r["kind"], r["a"], r["b"], r["knot"], r["up"], r["coef"]) for r in kept], span, fixed.get("alpha", 0.0), fixed.get("entropy", 0.0))

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys([*self.features, *self.range]))

    def probability(self, values: dict[str, np.ndarray], transform: str, clamp: bool) -> np.ndarray:
        """cloglog 1 - exp(-exp(eta + alpha + entropy)), logistic, or raw; NaN where a feature is."""
        n = len(next(iter(values.values())))
        scaled = {}
        for f, (lo, hi) in self.range.items():
            v = (values[f] - lo) / (hi - lo if hi > lo else 1.0)
            scaled[f] = np.clip(v, 0.0, 1.0) if clamp else v
        made = matrix(scaled, [t[:5] for t in self.terms]) if self.terms else np.zeros((n, 0))
        eta = made @ np.array([t[5] for t in self.terms])
        if transform == "cloglog":
            p = 1 - np.exp(-np.exp(eta + self.alpha + self.entropy))
        elif transform == "logistic":
            p = 1 / (1 + np.exp(-(eta + self.alpha + self.entropy)))
        else:
            p = np.exp(eta + self.alpha)
        missing = np.zeros(n, bool)
        for f in self.features:
            missing |= np.isnan(values[f])
        return np.where(missing, np.nan, p)


def scorers(coefficients: DataFrame, features: list[str] | dict[str, list[str]], fold: int = FINAL) -> list[Scorer]:
    """The models of a fold; features for all, or by the activity that ends an identifier."""
    of = lambda name: features.get(name.rsplit("_", 1)[-1], []) if isinstance(features, dict) else features
    return [Scorer.of(name, rows, of(name)) for name, rows in iterate_models(coefficients, fold)]


def _values(batch: pa.RecordBatch, names: list[str], rows: np.ndarray | None = None) -> dict[str, np.ndarray]:
    cols = {f: batch.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in names}
    return cols if rows is None else {f: c[rows] for f, c in cols.items()}


def _rows(batch: pa.RecordBatch, keys: list[str], name: str | None, p: np.ndarray, rows: np.ndarray | None = None) -> pa.RecordBatch:
    cols = [batch.column(k) if rows is None else batch.column(k).take(pa.array(np.flatnonzero(rows))) for k in keys]
    own = [] if name is None else [pa.array([name] * len(p), pa.string())]
    return pa.RecordBatch.from_arrays([*cols, *own, pa.array(p, pa.float64(), from_pandas=True)], [*keys, *(["identifier"] if own else []), "p"])


def _schema(df: DataFrame, keys: list[str], *more: T.StructField) -> T.StructType:
    kinds = {f.name: f.dataType for f in df.schema}
    return T.StructType([T.StructField(k, kinds[k]) for k in keys] + list(more))


def score(df: DataFrame, coefficients: DataFrame, features: list[str] | dict[str, list[str]], keys: list[str] = KEY, fold: int = FINAL, transform: str = "cloglog", clamp: bool = True) -> DataFrame:
    """(keys, identifier, p) of every row with every model; null if a feature is null. One narrow map over Arrow batches with
    the models' terms, as many as species, activities and terms, whatever the rows; no code grows with the models."""
    models = scorers(coefficients, features, fold)
    used = list(dict.fromkeys(c for m in models for c in m.columns))

    def run(batches):
        for batch in batches:
            values = _values(batch, used)
            for m in models:
                yield _rows(batch, keys, m.name, m.probability(values, transform, clamp))

    schema = _schema(df, keys, T.StructField("identifier", T.StringType()), T.StructField("p", T.DoubleType()))
    return df.select(*dict.fromkeys([*keys, *used])).mapInArrow(run, schema)


def score_own(df: DataFrame, coefficients: DataFrame, features: list[str] | dict[str, list[str]], keys: list[str], identifier: str = "identifier", fold: int = FINAL, transform: str = "cloglog", clamp: bool = True) -> DataFrame:
    """(keys, p) of every row with the model that its identifier names; rows without a model are left out."""
    models = {m.name: m for m in scorers(coefficients, features, fold)}
    if not models:
        raise ValueError("no model was fitted")
    used = list(dict.fromkeys(c for m in models.values() for c in m.columns))

    def run(batches):
        for batch in batches:
            names = np.array(batch.column(identifier).to_pylist(), object)
            for name in sorted({n for n in names if n in models}):
                rows = names == name
                yield _rows(batch, keys, None, models[name].probability(_values(batch, used, rows), transform, clamp), rows)

    return df.select(*dict.fromkeys([*keys, identifier, *used])).mapInArrow(run, _schema(df, keys, T.StructField("p", T.DoubleType())))


def richness(predictions: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Species per cell with p of at least threshold; 0 where all are null."""
    return predictions.groupBy(*KEY).agg(F.count_if(F.col("p") >= threshold).cast("int").alias("richness"))


def mean_prediction(predictions: DataFrame, containing: str | None = None) -> DataFrame:
    """(identifier, mean_p), largest first, of identifiers that contain a text."""
    kept = predictions.filter(F.col("identifier").contains(containing)) if containing else predictions
    return kept.groupBy("identifier").agg(F.avg("p").alias("mean_p")).orderBy(F.desc("mean_p"), "identifier")


def ensemble(predictions: DataFrame) -> DataFrame:
    """Mean and population std per cell and identifier over predictions of several folds."""
    return predictions.groupBy(*KEY, "identifier").agg(F.avg("p").alias("mean_p"), F.stddev_pop("p").alias("std_p"))


def wide(predictions: DataFrame, identifiers: list[str]) -> DataFrame:
    """One column per identifier, for export."""
    return predictions.groupBy(*KEY).pivot("identifier", identifiers).agg(F.max("p"))


def score_with(df: DataFrame, predict, features: list[str], keys: list[str], **options) -> DataFrame:
    """(keys, p) by any callable from a pandas frame of features to an array, batch by batch; null features give null.
    options go to predict as they are."""

    def run(batches):
        for batch in batches:
            known = batch[features].notna().all(axis=1)
            out = batch[keys].copy()
            out["p"] = None
            if known.any():
                out.loc[known, "p"] = predict(batch.loc[known, features], **options)
            yield out.astype({"p": "float64"})

    types = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.select(*keys, *features).mapInPandas(run, ", ".join(f"`{k}` {types[k]}" for k in keys) + ", p double")


def score_aligned(layers: dict[str, tuple[DataFrame, GridSpec]], spec: GridSpec, predict, features: list[str], grids: dict[str, int] | None = None, **options) -> DataFrame:
    """(row, col, p) on the cells of spec by any callable, from layers that lie on grids of their own.

    layers: a table of cells and its grid by name; features are their bands. A layer on another grid is moved to spec's,
    bilinear; grids: the EPSG code of those in another reference system. Cells that no layer reaches have a null p.
    """
    spark = next(iter(layers.values()))[0].sparkSession
    cells = model_grid(spark, spec)
    there: dict[str, DataFrame] = {}
    for name, (table, own) in layers.items():
        epsg = (grids or {}).get(name)
        table = table.select(*KEY, *(b for b in bands_of(table) if b in features))
        there[name] = table if own == spec and epsg is None else resample(table, own, spec, cells, **({} if epsg is None else {"source_epsg": epsg}))
    return score_with(cells.select(*KEY).join(merge_layers(there), KEY, "left"), predict, features, KEY, **options)
