"""Squared-hinge support vector machine: optimality and agreement with a plain solver."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ledgerline.operators import learn as L
from ledgerline.operators.svm import fit_squared_hinge


def data(spark, sparse):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 6)) * (rng.random((300, 6)) < 0.6)
    y = (x @ [2, -1, 0.5, 0, 0, 1] + 0.4 + rng.normal(size=300) > 0).astype(int)
    vector = (lambda r: Vectors.sparse(6, {int(i): float(r[i]) for i in r.nonzero()[0]})) if sparse else (lambda r: Vectors.dense(r))
    rows = [(i, int(t), vector(r)) for i, (r, t) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, ["id", "label", "features"]).repartition(3, "id")


def plain_gradient(x, y, w, cost):
    s, ones = np.where(y == 1, 1.0, -1.0), np.column_stack([x, np.ones(len(x))])
    gap = np.maximum(0, 1 - s * (ones @ w))
    return w - 2 * cost * ones.T @ (s * gap)


@pytest.mark.parametrize("sparse", [True, False])
def test_gradient_vanishes_at_the_fitted_weights(spark, sparse):
    x, y, df = data(spark, sparse)
    model = fit_squared_hinge(df, 6, c_value=0.7, tolerance=1e-6)
    start = np.linalg.norm(plain_gradient(x, y, np.zeros(7), 0.7))
    assert np.linalg.norm(plain_gradient(x, y, model.weights, 0.7)) <= 1.01e-6 * start
    scored = {r.id: r.score for r in L.probability(model.transform(df)).select("id", "score").collect()}
    assert [scored[i] for i in range(300)] == pytest.approx(list(x @ model.weights[:6] + model.weights[6]))
    assert np.mean([(scored[i] > 0) == y[i] for i in range(300)]) > 0.8


def test_empty_rows_and_empty_vectors(spark):
    df = spark.createDataFrame([(0, Vectors.sparse(3, {})), (1, Vectors.sparse(3, {1: 1.0}))], ["label", "features"])
    assert fit_squared_hinge(df.filter(F.lit(False)), 3).weights.tolist() == [0.0] * 4
    model = fit_squared_hinge(df, 3)
    low, high = (r.score for r in L.probability(model.transform(df)).orderBy("label").select("score").collect())
    assert low < high
