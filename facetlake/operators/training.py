"""Softmax regression by gradient descent, whose gradient is one aggregate a round."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_WEIGHTS = 1 << 22  # of the model, which travels with each task


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def softmax_regression(rows: DataFrame, vector: str, label: str, classes: int, width: int, rounds: int = 20, rate: float = 0.5, decay: float = 1e-3) -> np.ndarray:
    """Weights (classes, width + 1), the last column for a constant, after so many rounds from zero over labels 0 to classes - 1.

    Each round a task adds up the gradient over its rows, batch by batch, and gives one row of classes x (width + 1) sums; these are added as
    one aggregate over the place of each weight, so neither a task nor the driver ever holds more than a few models. Rows with a null vector or label, of
    another width, or with a label that is no class take no part.
    """
    size = classes * (width + 1)
    if size > MOST_WEIGHTS:
        raise ValueError(f"{size} weights; at most {MOST_WEIGHTS} travel with a task")
    clean = rows.select(F.col(vector).cast("array<double>").alias("x"), F.col(label).cast("int").alias("y")).where((F.size("x") == width) & (F.col("y") >= 0) & (F.col("y") < classes) & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    weights = np.zeros((classes, width + 1))
    for _ in range(rounds):

        def part(batches: Iterator[pa.RecordBatch], w: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros_like(w), 0
            for batch in batches:
                if batch.num_rows:
                    x = _matrix(batch.column(0), width)
                    y = batch.column(1).to_numpy(zero_copy_only=False)
                    score = x @ w[:, :-1].T + w[:, -1]
                    p = np.exp(score - score.max(1, keepdims=True))
                    p /= p.sum(1, keepdims=True)
                    p[np.arange(len(y)), y] -= 1
                    total[:, :-1] += p.T @ x
                    total[:, -1] += p.sum(0)
                    n += len(y)
            values = np.append(total.ravel(), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1), pa.int32()), pa.array(values)], names=["place", "value"])

        sums = clean.mapInArrow(part, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).toPandas()  # size + 1 rows
        if sums.empty:
            break
        g = sums.sort_values("place")["value"].to_numpy()
        if not g[-1]:
            break
        weights = weights - rate * (g[:-1].reshape(weights.shape) / g[-1] + decay * np.c_[weights[:, :-1], np.zeros(classes)])
    return weights


def classify(rows: DataFrame, key: str, vector: str, weights: np.ndarray) -> DataFrame:
    """(key, predicted, confidence): the class of the highest score and its softmax share; nulls where the vector is null or of another width."""
    width = weights.shape[1] - 1
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [v is not None and len(v) == width and None not in v for v in batch.column(1).to_pylist()]
            label, share = np.full(len(ok), -1), np.full(len(ok), np.nan)
            if any(ok):
                x = _matrix(batch.column(1).filter(pa.array(ok)), width)
                score = x @ weights[:, :-1].T + weights[:, -1]
                p = np.exp(score - score.max(1, keepdims=True))
                label[ok], share[ok] = score.argmax(1), p.max(1) / p.sum(1)
            off = ~np.array(ok, bool)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(label, pa.int32(), mask=off), pa.array(share, pa.float64(), mask=off)], names=[key, "predicted", "confidence"])

    return rows.select(key, F.col(vector).cast("array<double>").alias("x")).mapInArrow(run, f"{key} {kind}, predicted int, confidence double")
