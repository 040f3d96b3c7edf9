"""Occurrence records as they arrive: the stateless operators run unchanged on a streaming table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import occurrence, predict
from ..operators.grid import GridSpec


def scored_records(records: DataFrame, cells: DataFrame, spec: GridSpec, coefficients: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """(keys, identifier, p) of a stream of points, by a static stack and static models. No state and no watermark."""
    return predict.score(occurrence.annotate(records, cells, spec, features), coefficients, features, keys)


def write_records(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
