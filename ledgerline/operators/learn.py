"""Splits, feature pipelines, classifiers, cross-validation, importance and calibration around MLlib."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (IDF, CountVectorizer, CountVectorizerModel, ElementwiseProduct, Normalizer, OneHotEncoder, SQLTransformer,
                                StandardScaler, StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoints, materialised
from .ordered import hash_rank, running_totals
from .textmodels import TermRows, TextVectors, fit_bayes, fit_linear, smooth_idf

# ---------------------------------------------------------------- splits


def stratified_split(df: DataFrame, ident: str, label: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: the same share of every class, to within one row, in a seeded random order."""
    ranked = hash_rank(df, [label], [ident], seed, "_rank", "_size")
    return ranked.withColumn("is_test", F.col("_rank") <= F.round(F.col("_size") * test_share)).drop("_rank", "_size")


def stratified_folds(df: DataFrame, ident: str, label: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Adds ``name`` 0..k-1 with every class spread evenly."""
    ranked = hash_rank(df, [label], [ident], seed, "_rank", "_size")
    return ranked.withColumn(name, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_size")


# ---------------------------------------------------------------- features and classifiers


def feature_pipeline(train: DataFrame, numeric: list[str], categorical: list[str], out: str = "features") -> PipelineModel:
    """Numerics standardised, categories one-hot, fitted on the given rows only.

    An unseen category becomes all zeros; a category with two values becomes one column.
    """
    index = StringIndexer(inputCols=categorical, outputCols=[f"{c}_ix" for c in categorical], handleInvalid="keep",
                          stringOrderType="alphabetAsc").fit(train)
    binary = [c for c, names in zip(categorical, index.labelsArray) if len(names) == 2]
    many = [c for c in categorical if c not in binary]
    stages: list = [index]
    if binary:
        cells = ", ".join(f"CAST({c}_ix = 1 AS DOUBLE) AS {c}_bin" for c in binary)
        stages.append(SQLTransformer(statement=f"SELECT *, {cells} FROM __THIS__"))
    if many:
        # The extra slot for unseen values is last and therefore the one that is dropped.
        stages.append(OneHotEncoder(inputCols=[f"{c}_ix" for c in many], outputCols=[f"{c}_hot" for c in many], dropLast=True))
    stages.append(VectorAssembler(inputCols=numeric, outputCol="_num", handleInvalid="error"))
    stages.append(StandardScaler(inputCol="_num", outputCol="_scaled", withMean=True, withStd=True))
    stages.append(VectorAssembler(inputCols=["_scaled"] + [f"{c}_bin" for c in binary] + [f"{c}_hot" for c in many], outputCol=out))
    return Pipeline(stages=stages).fit(train)


def balanced_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Adds n / (2 * class size)."""
    sizes = df.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(label) == 1).alias("_p"))
    own = F.when(F.col(label) == 1, F.col("_p")).otherwise(F.col("_n") - F.col("_p"))
    return df.join(F.broadcast(sizes)).withColumn(name, F.col("_n") / (2.0 * own)).drop("_n", "_p")


def fit_logreg(train: DataFrame, label: str = "label", features: str = "features", reg: float | None = None,
               balanced: bool = True, c_value: float = 1.0, max_iter: int = 100) -> Model:
    """L2 logistic regression; ``c_value`` is the inverse strength, turned into Spark's per-row average."""
    rows = balanced_weight(train, label) if balanced else train.withColumn("weight", F.lit(1.0))
    strength = reg if reg is not None else 1.0 / (c_value * max(1, train.count()))
    return LogisticRegression(labelCol=label, featuresCol=features, weightCol="weight", regParam=strength, maxIter=max_iter,
                              tol=1e-4, standardization=False).fit(rows)


def fit_forest(train: DataFrame, label: str = "label", features: str = "features", trees: int = 400, min_leaf: int = 8,
               depth: int = 12, seed: int = 42) -> Model:
    return RandomForestClassifier(labelCol=label, featuresCol=features, weightCol="weight", numTrees=trees, maxDepth=depth,
                                  minInstancesPerNode=min_leaf, seed=seed, subsamplingRate=1.0).fit(balanced_weight(train, label))


def fit_boosting(train: DataFrame, label: str = "label", features: str = "features", rounds: int = 400, rate: float = 0.06,
                 depth: int = 5, validation: float = 0.15, ident: str = "id", seed: int = 42) -> Model:
    """Boosted trees that stop early on a validation share picked by hash."""
    held = F.pmod(F.xxhash64(F.lit(seed), ident), F.lit(1000)) < int(validation * 1000)
    return GBTClassifier(labelCol=label, featuresCol=features, maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed,
                         validationIndicatorCol="_held", validationTol=0.0).fit(train.withColumn("_held", held))


def probability(df: DataFrame, name: str = "score") -> DataFrame:
    """Class-1 probability, or the margin for models without one, as a double."""
    source = "probability" if "probability" in df.columns else "rawPrediction"
    return df.withColumn(name, vector_to_array(source)[1])


Fit = Callable[[DataFrame], Transformer]


def side_by_side(work: Callable, items: list, at_once: int) -> list:
    """Results in the order of the items, ``at_once`` of which run at a time; their Spark jobs share the cores."""
    if at_once <= 1 or len(items) <= 1:
        return [work(x) for x in items]
    run = inheritable_thread_target(SparkSession.getActiveSession())(work)
    with ThreadPool(min(at_once, len(items))) as pool:
        return pool.map(run, items, 1)


def cross_validate(df: DataFrame, models: dict[str, Fit], keep: list[str], k: int = 5, at_once: int = 1) -> DataFrame:
    """Out-of-fold scores ``model, fold, keep..., score`` of a frame with a ``fold`` column.

    Everything a model fits, preprocessing included, sees the other folds only.  ``df`` should be a written table.  A fit
    of many short passes mostly waits for the driver, so ``at_once`` fits may run side by side, whichever model they are
    of; they start in the order of ``models``, so the slowest should come first.
    """
    def scores(name: str, fold: int) -> DataFrame:
        model = models[name](df.filter(F.col("fold") != fold))
        scored = probability(model.transform(df.filter(F.col("fold") == fold)))
        # Written at once: later metrics must not run the model again.
        return materialised(scored.select(F.lit(name).alias("model"), "fold", *keep, "score"))

    ensure_checkpoints(df.sparkSession)
    return reduce(DataFrame.unionByName, side_by_side(lambda fit: scores(*fit), [(name, fold) for name in models for fold in range(k)], at_once))


def grouped_ranking(scored: DataFrame, by: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC-AUC and average precision per group."""
    counts = scored.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    table = running_totals(counts, "score", {"tp": "pos", "fp": "neg"}, by=by, descending=True)
    better = (F.col("tp") - F.col("pos") / 2.0) * F.col("neg")
    gain = F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    p, n = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    return table.groupBy(*by).agg(F.try_divide(F.sum(better), p * n).alias("roc_auc"), F.try_divide(F.sum(gain), p).alias("pr_auc"))


def compare_models(scored: DataFrame, label: str = "label", by: str = "roc_auc") -> DataFrame:
    """Mean and spread over folds per model, best first by ``roc_auc`` or ``pr_auc``."""
    per_fold = grouped_ranking(scored, ["model", "fold"], label)
    return per_fold.groupBy("model").agg(
        F.avg("roc_auc").alias("roc_auc"), F.stddev_pop("roc_auc").alias("roc_auc_std"),
        F.avg("pr_auc").alias("pr_auc"), F.stddev_pop("pr_auc").alias("pr_auc_std"),
    ).orderBy(F.col(by).desc(), "model")


def champion_of(comparison: DataFrame) -> str:
    """Name of the first model of a comparison, which has one row per model."""
    return comparison.first()["model"]


def held_out_metrics(scored: DataFrame, name: str, label: str = "label") -> DataFrame:
    """One row ``model, rows, positives, roc_auc, pr_auc`` of scores on rows that no fit or choice has seen."""
    sizes = scored.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("positives"))
    return sizes.select(F.lit(name).alias("model"), "*").join(F.broadcast(grouped_ranking(scored.withColumn("_all", F.lit(0)), ["_all"], label).drop("_all")))


# ---------------------------------------------------------------- importance


def shuffled_partner(df: DataFrame, ident: str, columns: list[str], seed: int, repeats: int = 1, rows_per_block: int = 100_000) -> DataFrame:
    """``repeats`` copies of every row with ``repeat`` and ``_other``: the columns of another row, each row used once per repeat.

    Rows fall into random blocks; within a block two random orders are matched.
    The number of blocks follows the row count, so no task sorts everything.
    """
    blocks = max(1, df.count() // rows_per_block)
    base = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    base = base.withColumn("_blk", F.pmod(F.xxhash64(F.lit(seed), "repeat", ident), F.lit(blocks)))
    group, order = ["repeat", "_blk"], [ident, "repeat"]
    left = hash_rank(base, group, order, seed + 1, "_rank", "_size").drop("_size")
    other = base.select(*group, ident, F.struct(*columns).alias("_other"))
    right = hash_rank(other, group, order, seed + 2, "_rank", "_size")
    return left.join(right.select(*group, "_rank", "_other"), [*group, "_rank"]).drop("_blk", "_rank")


def permutation_importance(model: Transformer, df: DataFrame, ident: str, label: str, columns: list[str], repeats: int = 5,
                           seed: int = 0, regression: bool = False) -> DataFrame:
    """``feature, importance, spread``: loss of ROC-AUC (or rise of the mean absolute error) when a column is shuffled."""
    partner = shuffled_partner(df.select(ident, label, *columns), ident, columns, seed * 1000, repeats)
    each = partner.withColumn("feature", F.explode(F.array(*[F.lit(c) for c in columns])))
    permuted = each.select(ident, label, "feature", "repeat", *[
        F.when(F.col("feature") == c, F.col(f"_other.{c}")).otherwise(F.col(c)).alias(c) for c in columns])
    if regression:
        def loss(rows: DataFrame, by: list[str]) -> DataFrame:
            return model.transform(rows).groupBy(*by).agg(F.avg(F.abs(F.col(label) - F.col("prediction"))).alias("loss"))
    else:
        def loss(rows: DataFrame, by: list[str]) -> DataFrame:
            scored = materialised(probability(model.transform(rows)).select(*by, label, "score"))
            return grouped_ranking(scored, by, label).select(*by, (-F.col("roc_auc")).alias("loss"))
    base = loss(df.select(ident, label, *columns).withColumn("_k", F.lit(0)), ["_k"]).select(F.col("loss").alias("_base"))
    by_repeat = loss(permuted, ["feature", "repeat"]).join(F.broadcast(base))
    return by_repeat.groupBy("feature").agg(
        F.avg(F.col("loss") - F.col("_base")).alias("importance"), F.stddev_pop(F.col("loss") - F.col("_base")).alias("spread"),
    ).orderBy(F.col("importance").desc(), "feature")


# ---------------------------------------------------------------- regression


def fit_demand(train: DataFrame, features: list[str], target: str, rounds: int = 500, rate: float = 0.06, depth: int = 5,
               ident: list[str] | None = None, seed: int = 0) -> PipelineModel:
    """Boosted regression trees with early stopping on a hashed tenth of the rows."""
    held = F.pmod(F.xxhash64(F.lit(seed), *(ident or features)), F.lit(10)) == 0
    assemble = VectorAssembler(inputCols=features, outputCol="features")
    boost = GBTRegressor(labelCol=target, featuresCol="features", maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed,
                         validationIndicatorCol="_held", validationTol=0.0)
    fitted = boost.fit(assemble.transform(train.withColumn("_held", held)))
    return PipelineModel(stages=[assemble, fitted])


# ---------------------------------------------------------------- text models


def fit_text_features(train: DataFrame, terms: str, min_df: int = 2, vocabulary: int = 1 << 22, out: str = "features") -> PipelineModel:
    """Term counts over the exact vocabulary of the training rows, smooth idf, unit length, for vocabularies that fit the driver
    as texts; ``textmodels.TermRows`` is for others.

    A linear model holds one weight per term on the driver, so ``vocabulary`` bounds the terms: beyond it the most
    frequent ones are used.  MLlib's idf lacks the "+ 1" of the smooth form, so its values are raised by one here.
    """
    counting = CountVectorizer(inputCol=terms, outputCol="_tf", minDF=float(min_df), vocabSize=vocabulary).fit(train)
    model = IDF(inputCol="_tf", outputCol="_idf").fit(counting.transform(train))
    weigh = ElementwiseProduct(scalingVec=Vectors.dense(model.idf.toArray() + 1.0), inputCol="_tf", outputCol="_tfidf")
    unit = Normalizer(inputCol="_tfidf", outputCol=out, p=2.0)
    return PipelineModel(stages=[counting, weigh, unit])


def fit_text_bayes(train: DataFrame, terms: TermRows) -> Transformer:
    """Multinomial naive Bayes on the weighted terms, smoothing 1."""
    return fit_bayes(train, terms.size, terms.min_df)


def fit_text_logreg(train: DataFrame, terms: TermRows, c_value: float = 8.0) -> Transformer:
    """L2 logistic regression, ``c_value`` the inverse strength, the intercept free."""
    return fit_linear(train, terms.size, "logistic", c_value, terms.min_df)


def fit_text_svm(train: DataFrame, terms: TermRows, label: str = "label", c_value: float = 1.0, max_iter: int = 50) -> PipelineModel:
    """Linear SVM.  MLlib minimises the plain hinge loss, so its numbers differ from a squared-hinge solver's."""
    vectors = TextVectors(smooth_idf(train, terms.size, terms.min_df))
    svm = LinearSVC(labelCol=label, featuresCol="features", regParam=1.0 / (c_value * max(1, train.count())), maxIter=max_iter,
                    tol=1e-4, standardization=False).fit(vectors.transform(train).select(label, "features"))
    return PipelineModel(stages=[vectors, svm])


def fit_text_svm_squared(train: DataFrame, terms: TermRows, c_value: float = 1.0) -> Transformer:
    """Linear SVM with the squared hinge loss, the intercept regularised like the weights."""
    return fit_linear(train, terms.size, "squared_hinge", c_value, terms.min_df)


def platt_calibrated(train: DataFrame, test: DataFrame, fit: Fit, ident: str, label: str = "label", k: int = 3, seed: int = 42, fold_column: str | None = None,
                     at_once: int = 1) -> DataFrame:
    """Averaged calibrated probabilities: each fold's model is calibrated on the rows it did not see.

    Rows that were dealt out before carry 0..k-1 in ``fold_column``.
    """
    folded = train.withColumn("fold", F.col(fold_column)) if fold_column else materialised(stratified_folds(train, ident, label, k, seed))

    def calibrated(fold: int) -> DataFrame:
        model = fit(folded.filter(F.col("fold") != fold))
        margin = VectorAssembler(inputCols=["score"], outputCol="margin")
        held = margin.transform(probability(model.transform(folded.filter(F.col("fold") == fold))).select(ident, label, "score"))
        sigmoid = LogisticRegression(labelCol=label, featuresCol="margin", regParam=0.0, tol=1e-5).fit(held)
        scored = margin.transform(probability(model.transform(test)).select(ident, label, "score"))
        return materialised(sigmoid.transform(scored).select(ident, label, vector_to_array("probability")[1].alias("p")))

    ensure_checkpoints(train.sparkSession)
    parts = side_by_side(calibrated, list(range(k)), at_once)
    return reduce(DataFrame.unionByName, parts).groupBy(ident, label).agg(F.avg("p").alias("score"))


def term_slots(counting: CountVectorizerModel, spark) -> DataFrame:
    """``term, idx``: the place of every vocabulary term in the feature vectors."""
    return spark.createDataFrame([(term, i) for i, term in enumerate(counting.vocabulary)], "term string, idx int")


def top_signals(terms: DataFrame, weight: str, n: int = 15) -> DataFrame:
    """The n strongest terms for either class."""
    up = terms.orderBy(F.col(weight).desc(), "term").limit(n).withColumn("direction", F.lit("positive"))
    down = terms.orderBy(F.col(weight).asc(), "term").limit(n).withColumn("direction", F.lit("negative"))
    return up.unionByName(down)


