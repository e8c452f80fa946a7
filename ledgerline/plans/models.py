"""Churn classifiers and the demand regressor, with splits, cross-validation and importance."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import learn as L
from ..operators import metrics as M
from ..operators import panel as N
from ..session import materialised
from ..sources import feeds as S
from ..sources import lineage
from .marts import feature_table
from .registry import query

c = F.col
ROUNDS, FOLDS = 500, 5
#: Fits of the cross-validation side by side: all folds of the boosting, whose rounds wait for the driver, beside two forests.
AT_ONCE = FOLDS + 2


def _with_features(fit):
    """A fit that learns the preprocessing from the same rows as the model."""
    def run(train):
        features = L.feature_pipeline(train, S.CHURN_NUMERIC, S.CHURN_CATEGORICAL)
        return PipelineModel(stages=features.stages + [fit(features.transform(train))])
    return run


#: The slowest family first, see ``AT_ONCE``.
MODELS = {
    "gradient_boosting": _with_features(lambda d: L.fit_boosting(d)),
    "random_forest": _with_features(lambda d: L.fit_forest(d)),
    "logistic_regression": _with_features(lambda d: L.fit_logreg(d)),
}


def split(t):
    return materialised(L.stratified_split(S.churn_table(t), "id", "label"))


def _fit_and_score(t, name):
    rows = split(t)
    model = MODELS[name](rows.filter("not is_test"))
    return L.probability(model.transform(rows.filter("is_test"))).select("id", "label", "score")


@query("churn_table", """WITH f AS (SELECT o_custkey, max(o_orderdate) FILTER (WHERE b) AS last, min(o_orderdate) FILTER (WHERE b) AS first, count(*) FILTER (WHERE b) AS n,
   COALESCE(sum(o_totalprice) FILTER (WHERE b), 0) AS total, count(*) FILTER (WHERE NOT b AND datediff('day', DATE '2000-08-01', CAST(o_orderdate AS DATE)) <= 180) AS aft
   FROM (SELECT *, CAST(o_orderdate AS DATE) <= DATE '2000-08-01' AS b FROM orders) GROUP BY 1)
SELECT c_custkey AS id, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS nation, CASE WHEN c_acctbal < 0 THEN 'yes' ELSE 'no' END AS in_debt,
 CAST(datediff('day', CAST(last AS DATE), DATE '2000-08-01') AS DOUBLE) AS recency, CAST(datediff('day', CAST(first AS DATE), DATE '2000-08-01') AS DOUBLE) AS tenure,
 CAST(n AS DOUBLE) AS n_orders, round(total, 2) AS total, round(total, 2) / n AS average, CAST(aft = 0 AS INTEGER) AS label FROM customer JOIN f ON c_custkey = o_custkey WHERE n > 0""")
def churn_table(t):
    return S.churn_table(t)


@query("stratified_split")
def stratified_split(t):
    return L.stratified_split(S.churn_table(t).select("id", "label"), "id", "label")


@query("stratified_folds")
def stratified_folds(t):
    return L.stratified_folds(S.churn_table(t).select("id", "label"), "id", "label", 5)


@query("feature_pipeline")
def feature_pipeline(t):
    """Width and non-zero count of the encoded rows, fitted on the training part."""
    rows = split(t)
    model = L.feature_pipeline(rows.filter("not is_test"), S.CHURN_NUMERIC, S.CHURN_CATEGORICAL)
    values = vector_to_array("features")
    return model.transform(rows).select("id", F.size(values).alias("width"), F.size(F.filter(values, lambda v: v != 0)).alias("non_zero"))


@query("clf_logreg")
def clf_logreg(t):
    return _fit_and_score(t, "logistic_regression")


@query("clf_forest")
def clf_forest(t):
    return _fit_and_score(t, "random_forest")


@query("clf_gbt")
def clf_gbt(t):
    return _fit_and_score(t, "gradient_boosting")


@query("cv_compare")
def cv_compare(t):
    """Three model families under stratified cross-validation on the training part, best first."""
    train = split(t).filter("not is_test").drop("is_test")
    folded = materialised(L.stratified_folds(train, "id", "label", FOLDS))
    return L.compare_models(L.cross_validate(folded, MODELS, ["label"], FOLDS, AT_ONCE))


@query("churn_economics")
def churn_economics(t):
    """Profit-optimal threshold found on validation folds, then applied once to the test part."""
    rows = split(t)
    folded = materialised(L.stratified_folds(rows.filter("not is_test").drop("is_test"), "id", "label", FOLDS))
    fit = {"logistic_regression": MODELS["logistic_regression"]}
    best = M.best_threshold(M.profit_sweep(L.cross_validate(folded, fit, ["label"], FOLDS))).first()["threshold"]
    test = L.probability(fit["logistic_regression"](rows.filter("not is_test")).transform(rows.filter("is_test")))
    table = M.confusion(test.select("label", "score"), float(best))
    return table.select(F.lit(float(best)).alias("threshold"), "*", (c("tp") * 240.0 - (c("tp") + c("fp")) * 50.0).alias("profit"))


@query("churn_champion")
def churn_champion(t):
    """The whole job as a report ``section, title, row_json``: families compared under cross-validation, the threshold taken
    from the winner's out-of-fold scores, the winner refitted on the training part and the test part scored once.
    """
    rows = split(t)
    train, test = rows.filter("not is_test").drop("is_test"), rows.filter("is_test").drop("is_test")
    folded = materialised(L.stratified_folds(train, "id", "label", FOLDS))
    unseen = L.cross_validate(folded, MODELS, ["label"], FOLDS, AT_ONCE)
    comparison = materialised(L.compare_models(unseen))
    name = L.champion_of(comparison)
    sweep = M.profit_sweep(unseen.filter(c("model") == name))
    threshold = float(M.best_threshold(sweep).first()["threshold"])
    model = MODELS[name](train)
    scored = materialised(L.probability(model.transform(test)).select("id", "label", "score"))
    profit = (c("tp") * 240.0 - (c("tp") + c("fp")) * 50.0).alias("profit")
    at = [M.confusion(scored, x).select(F.lit(x).alias("threshold"), "*", profit) for x in (threshold, 0.5)]
    importance = L.permutation_importance(model, test, "id", "label", S.CHURN_NUMERIC + S.CHURN_CATEGORICAL, repeats=15)
    return lineage.audit_export({
        "comparison": ("Families under cross-validation", comparison),
        "test": ("Winner on the test part", L.held_out_metrics(scored, name)),
        "sweep": ("Profit by threshold on validation folds", sweep),
        "decision": ("Confusion on the test part at the chosen and the usual threshold", at[0].unionByName(at[1])),
        "calibration": ("Calibration on the test part", M.calibration_bins(scored)),
        "importance": ("Loss of ROC-AUC on the test part when a column is shuffled", importance),
    })


@query("perm_importance")
def perm_importance(t):
    rows = split(t)
    model = MODELS["logistic_regression"](rows.filter("not is_test"))
    return L.permutation_importance(model, rows.filter("is_test"), "id", "label", S.CHURN_NUMERIC + S.CHURN_CATEGORICAL, repeats=15)


DEMAND_FEATURES = ["demand_lag1", "demand_lag2", "demand_lag3", "demand_ma3", "driver_lag1", "driver_lag2", "months_since_launch", "month_of_year"]


def _demand(t):
    rows = materialised(feature_table(t).withColumn("id", F.concat_ws("|", c("nation").cast("string"), c("month_start").cast("string"))))
    train, test = N.split_by_date(rows, "month_start", "2000-06-01")
    return rows, train, test, L.fit_demand(train, DEMAND_FEATURES, "target_next", rounds=ROUNDS, ident=["id"])


@query("demand_gbt")
def demand_gbt(t):
    """Boosted demand model against "next month = this month" on the later months."""
    _, _, test, model = _demand(t)
    return M.against_baseline(model.transform(test), "target_next", "prediction", "demand")


@query("demand_importance")
def demand_importance(t):
    _, _, test, model = _demand(t)
    return L.permutation_importance(model, test, "id", "target_next", DEMAND_FEATURES, repeats=30, regression=True)


@query("run_metadata")
def run_metadata(t):
    """One nested record: rows per split, parameters, metrics, frame hash."""
    rows, _, test, model = _demand(t)
    metrics = M.against_baseline(model.transform(test), "target_next", "prediction", "demand")
    tagged = rows.withColumn("part", F.when(c("month_start") < F.lit("2000-06-01").cast("date"), "train").otherwise("test"))
    record = lineage.run_record(tagged, DEMAND_FEATURES + ["target_next"], "part", {"rounds": ROUNDS, "rate": 0.06, "split": "2000-06-01"}, metrics)
    return record.select(F.to_json(F.struct("*")).alias("record"))
