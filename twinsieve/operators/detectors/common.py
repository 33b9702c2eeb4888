"""Shared pieces of the detectors: Arrow batches to matrices, model state, scoring columns."""

from __future__ import annotations

import base64
import io
from collections.abc import Callable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame, functions as F

from ...functions.columns import c


class DetectorParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector or array<double> column", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "output score, higher is more anomalous", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "unique row key that every draw is based on", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed of all draws", TypeConverters.toInt)


class StateModel(DetectorParams):
    """Model state as named arrays, kept in a Param so that the standard ML writers store it."""

    state = Param(Params._dummy(), "state", "fitted arrays", TypeConverters.toString)

    def arrays(self) -> dict[str, np.ndarray]:
        return unpack(self.getOrDefault(self.state))


def pack(arrays: Mapping[str, np.ndarray]) -> str:
    buffer = io.BytesIO()
    np.savez_compressed(buffer, **arrays)
    return base64.b64encode(buffer.getvalue()).decode("ascii")


def unpack(text: str) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(base64.b64decode(text))) as stored:
        return {name: stored[name] for name in stored.files}


def feature_array(df: DataFrame, features: str) -> Column:
    """Features as array<double>, whether they come as a vector or as an array."""
    if isinstance(df.schema[features].dataType, VectorUDT):
        return vector_to_array(c(features))
    return c(features).cast("array<double>")


def matrix_of(rows: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """(rows, features) matrix over the flat values of a list column; no copy per row."""
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(rows), -1) if len(rows) else np.empty((0, 0))


def with_batch_score(df: DataFrame, features: str, out: str,
                     score: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Add ``score(matrix)`` per row. Only the feature column travels to Python, in Arrow batches."""
    @F.arrow_udf("double")
    def scored(rows: pa.Array) -> pa.Array:
        return pa.array(score(matrix_of(rows)) if len(rows) else [], pa.float64())

    return df.withColumn(out, scored(feature_array(df, features)))
