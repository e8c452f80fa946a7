"""Linear support vector machine with the squared hinge loss, by Newton steps whose sums Spark computes.

The loss is ``|w|^2 / 2 + C * sum(max(0, 1 - y * f(x))^2)`` with the intercept as one more weight, regularised like
the others.  Gradient and Hessian products are sums over rows: a pass gives each task the present weights, a task adds
its Arrow batches into one vector, and Spark sums the tasks' entries by index.  The driver holds a few vectors of one
number per feature, never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..session import materialised

ENTRIES = "struct<v: struct<type: tinyint, size: int, indices: array<int>, values: array<double>>>"


def sparse_arrays(vector: str) -> tuple[Column, Column]:
    """Indices and values of an ML vector as array columns, dense vectors included."""
    v = F.from_json(F.to_json(F.struct(F.col(vector).alias("v"))), ENTRIES)["v"]
    places = F.when(F.size(v["values"]) > 0, F.sequence(F.lit(0), F.size(v["values"]) - 1)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(v["indices"], places), v["values"]


def flat_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row number, index and value of every entry of a batch, and the labels as -1 and 1."""
    idx, val = batch.column("idx"), batch.column("val")
    row = np.repeat(np.arange(len(batch)), np.diff(idx.offsets.to_numpy()))
    y = np.where(batch.column("y").to_numpy() == 1, 1.0, -1.0)
    return row, idx.flatten().to_numpy(), val.flatten().to_numpy(), y


def summed(rows: DataFrame, size: int, weights: np.ndarray, direction: np.ndarray | None, cost: float) -> tuple[float, np.ndarray]:
    """One pass: the loss over the rows and its gradient at ``weights``, or its Hessian times ``direction``.

    Entry ``size`` is the intercept's; the loss comes back under index -1.
    """
    context = rows.sparkSession.sparkContext
    shared = context.broadcast((weights, direction))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, v = shared.value
        total, loss = np.zeros(size + 1), 0.0
        for batch in batches:
            row, idx, val, y = flat_rows(batch)
            n = len(batch)
            gap = 1.0 - y * (np.bincount(row, w[idx] * val, n) + w[size])
            open_ = gap > 0
            if v is None:
                loss += cost * float((gap[open_] ** 2).sum())
                per_row = np.where(open_, -2.0 * cost * y * gap, 0.0)
            else:
                per_row = np.where(open_, 2.0 * cost * (np.bincount(row, v[idx] * val, n) + v[size]), 0.0)
            total[:size] += np.bincount(idx, per_row[row] * val, size)
            total[size] += per_row.sum()
        found = total.nonzero()[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1), pa.int64()), pa.array(np.append(total[found], loss), pa.float64())], ["i", "s"])

    parts = rows.mapInArrow(work, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).toArrow()
    shared.unpersist()
    index, value = parts.column("i").to_numpy(), parts.column("s").to_numpy()
    out = np.zeros(size + 1)
    out[index[index >= 0]] = value[index >= 0]
    return float(value[index < 0].sum()), out


def newton_direction(rows: DataFrame, size: int, w: np.ndarray, gradient: np.ndarray, cost: float, most: int = 30) -> np.ndarray:
    """Conjugate gradients on the Newton equation, to a tenth of the gradient's length."""
    step, residual = np.zeros_like(w), -gradient
    direction, length = residual.copy(), float(residual @ residual)
    goal = 0.01 * length
    for _ in range(most):
        product = direction + summed(rows, size, w, direction, cost)[1]
        move = length / float(direction @ product)
        step, residual = step + move * direction, residual - move * product
        shorter = float(residual @ residual)
        if shorter <= goal:
            break
        direction, length = residual + (shorter / length) * direction, shorter
    return step


class LinearScorer(Transformer):
    """Adds ``rawPrediction`` (minus margin, margin) for fitted weights; the last one is the intercept."""

    def __init__(self, weights: np.ndarray, features: str = "features"):
        super().__init__()
        self.weights, self.features = weights, features

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(self.weights)

        @pandas_udf("double")
        def margin(idx, val):
            w = shared.value
            return idx.combine(val, lambda i, v: float(w[i] @ v) + float(w[-1]))

        idx, val = sparse_arrays(self.features)
        scored = dataset.withColumn("_margin", margin(idx, val))
        pair = F.array(-F.col("_margin"), F.col("_margin"))
        return scored.withColumn("rawPrediction", array_to_vector(pair)).drop("_margin")


def fit_squared_hinge(train: DataFrame, size: int, label: str = "label", features: str = "features", c_value: float = 1.0,
                      tolerance: float = 1e-4, rounds: int = 50) -> LinearScorer:
    """Weights whose gradient is ``tolerance`` of the one at zero; ``size`` is the width of the feature vectors.

    An empty frame gives zero weights.
    """
    idx, val = sparse_arrays(features)
    rows = materialised(train.select(F.col(label).cast("int").alias("y"), idx.alias("idx"), val.alias("val")))
    w = np.zeros(size + 1)
    loss, slope = summed(rows, size, w, None, c_value)
    goal = tolerance * float(np.linalg.norm(slope))
    for _ in range(rounds):
        gradient = slope + w
        if float(np.linalg.norm(gradient)) <= goal:
            break
        step, share = newton_direction(rows, size, w, gradient, c_value), 1.0
        before, fall = loss + 0.5 * float(w @ w), float(gradient @ step)
        while True:
            new = w + share * step
            loss, slope = summed(rows, size, new, None, c_value)
            if loss + 0.5 * float(new @ new) <= before + 0.01 * share * fall or share < 1e-6:
                break
            share /= 2
        w = new
    return LinearScorer(w, features)
