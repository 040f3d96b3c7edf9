"""Steps as pyspark.ml transformers, for pipelines of the user's own."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from . import features, predict
from .raster import KEY


class FeatureSubset(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Only the named features, and the columns to keep beside them."""

    names = Param(Params._dummy(), "names", "features to keep", TypeConverters.toListString)
    keys = Param(Params._dummy(), "keys", "other columns to keep", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, names: list[str] | None = None, keys: list[str] | None = None):
        super().__init__()
        self._setDefault(names=[], keys=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return features.subset(df, self.getOrDefault(self.names), self.getOrDefault(self.keys))


class ModelScores(Transformer):
    """(keys, identifier, p) of every row with every model of a coefficient table."""

    def __init__(self, coefficients: DataFrame, names: list[str] | dict[str, list[str]], keys: list[str] = KEY):
        super().__init__()
        self.coefficients, self.names, self.keys = coefficients, names, keys

    def _transform(self, df: DataFrame) -> DataFrame:
        return predict.score(df, self.coefficients, self.names, self.keys)
