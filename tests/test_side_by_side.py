"""Fits of several model families under cross-validation advance together and give what they give one after the other."""

import threading

from ledgerline.operators import learn as L
from ledgerline.plans import models as M


def test_folds_of_all_families_run_side_by_side(spark):
    rows = spark.createDataFrame([(i, i % 2, i % 3 % 2, float(i % 7)) for i in range(40)], "id int, label int, fold int, x double")
    meet = threading.Barrier(4, timeout=60)

    def fits(wait):
        def fit(train):
            wait()
            return L.Pipeline(stages=[L.VectorAssembler(inputCols=["x"], outputCol="features"), L.LogisticRegression(maxIter=3)]).fit(train)
        return {"a": fit, "b": fit}

    # All four fits must be under way at the same time, or the barrier breaks.
    together = L.cross_validate(rows, fits(meet.wait), ["id"], 2, at_once=4)
    in_turn = L.cross_validate(rows, fits(lambda: None), ["id"], 2)
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, in_turn.collect()))


def test_churn_folds_of_the_boosting_start_together():
    assert list(M.MODELS)[0] == "gradient_boosting" and M.AT_ONCE >= M.FOLDS
