"""One pass over the rows for many models: sums by matrix products, ties, draws, and rows dealt out over the cores."""

import numpy as np
import pytest

from ledgerline.operators import kmeans as K


def frame(spark, n=3000, d=3):
    x = np.round(np.random.default_rng(5).normal(size=(n, d)), 1)
    return x, spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], "id int, " + ", ".join(f"f{j} double" for j in range(d))).coalesce(1)


def test_rows_of_one_part_are_dealt_out(spark):
    _, df = frame(spark)
    assert K.Rows(df, ["f0", "f1", "f2"]).source.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_sums_against_plain_numpy_with_equal_centres(spark):
    x, df = frame(spark)
    rng = np.random.default_rng(1)
    centers = [np.round(rng.normal(size=(k, 3)), 1) for k in (2, 2, 3, 70, 70)]
    centers[1][1] = centers[1][0]                     # the first of two equal centres has all rows
    n, cost, squares, sums = K.Rows(df, ["f0", "f1", "f2"]).sums(centers)
    at = 0
    for c in centers:
        far = K.squared_distances(x, c)
        near = far.min(axis=1)
        own = slice(at, at + len(c))
        at += len(c)
        assert n[own].sum() == len(x) and cost[own].sum() == pytest.approx(near.sum())
        assert squares[own].sum() == pytest.approx((x * x).sum()) and sums[own].sum(axis=0) == pytest.approx(x.sum(axis=0))
    assert n[3] == 0 and n[2] == len(x)


def test_draws_are_the_smallest_times(spark):
    x, df = frame(spark)
    rows = K.Rows(df, ["f0", "f1", "f2"])
    h = np.array([r["h"] for r in rows.source.select("h").collect()])
    points = np.array([tuple(r)[1:] for r in rows.source.collect()])
    centers = [x[:1], x[1:2], x[2:6]]
    found = rows.drawn(centers, [5, 7, 3], [11, 12, 13])
    for c, n, salt, got in zip(centers, [5, 7, 3], [11, 12, 13], found):
        weight = K.squared_distances(points, c).min(axis=1)
        with np.errstate(divide="ignore"):
            time = np.where(weight > 1e-9, -np.log(K.uniform(h, salt)) / weight, np.inf)
        assert got.tolist() == points[np.argsort(time, kind="stable")[:n]].tolist()
