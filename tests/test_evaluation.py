import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import learn as L
from ledgerline.operators import metrics as M
from ledgerline.operators import textmine as X


def scored(spark, n=600, seed=2):
    rng = np.random.default_rng(seed)
    score = np.round(rng.uniform(0, 1, n), 2)
    score[: n // 3] = 0.5                     # a third of all rows tie
    label = (rng.uniform(0, 1, n) < score).astype(int)
    return score, label, spark.createDataFrame([(i, int(y), float(s)) for i, (y, s) in enumerate(zip(label, score))], "id int, label int, score double")


def test_auc_and_ap_against_brute_force(spark):
    s, y, df = scored(spark)
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert M.roc_auc(df).first()[0] == pytest.approx(auc, abs=1e-12)
    ap, before = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        hit = s >= t
        recall = y[hit].sum() / y.sum()
        ap += (recall - before) * y[hit].mean()
        before = recall
    assert M.average_precision(df).first()[0] == pytest.approx(ap, abs=1e-12)
    both = L.grouped_ranking(df.withColumn("g", F.lit("a")), ["g"]).first()
    assert both.roc_auc == pytest.approx(auc, abs=1e-12) and both.pr_auc == pytest.approx(ap, abs=1e-12)


def test_single_class_and_all_tied(spark):
    ones = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, score double")
    assert M.roc_auc(ones).first()[0] is None
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5)], "label int, score double")
    assert M.roc_auc(tied).first()[0] == 0.5


def test_profit_sweep_against_brute_force(spark):
    s, y, df = scored(spark)
    grid = [0.05, 0.5, 0.51, 0.9]
    got = {round(r.threshold, 9): (r.tp, r.fp, r.profit) for r in M.profit_sweep(df, thresholds=grid).collect()}
    for t in grid:
        tp, fp = int(((s >= t) & (y == 1)).sum()), int(((s >= t) & (y == 0)).sum())
        assert got[t] == (tp, fp, tp * 240.0 - (tp + fp) * 50.0)
    best = M.best_threshold(M.profit_sweep(df, thresholds=grid)).first()
    assert best.profit == max(v[2] for v in got.values())


def test_precision_threshold_and_fallback(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.6)], "label int, score double")
    r = M.precision_threshold(df, 0.99).first()
    assert (r.threshold, r.precision) == (0.8, 1.0) and r.recall == pytest.approx(2 / 3)
    none = spark.createDataFrame([(0, 0.9), (1, 0.1)], "label int, score double")
    assert M.precision_threshold(none, 0.99).first().threshold == 0.5


def test_adjusted_rand(spark):
    df = spark.createDataFrame([(i % 3, (i % 3 + 1) % 3, i % 2) for i in range(30)], "a int, b int, c int")
    assert M.adjusted_rand(df, "a", "b").first()[0] == pytest.approx(1.0)
    assert abs(M.adjusted_rand(df, "a", "c").first()[0]) < 0.1


TEXTS = ["a bb  ccc", "Été déjà vu, déjà dit", "", "x", "one two one", "  spaced\nout\tterms  "]


def py_char_grams(text, low=3, high=5):
    out = []
    for w in re.sub(r"\s+", " ", text.lower()).split():
        w = f" {w} "
        for n in range(low, high + 1):
            out += [w[i:i + n] for i in range(max(1, len(w) - n + 1))]
            if len(w) <= n:
                break
    return out


def test_char_grams_against_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    for r in df.select("t", X.char_gram_array("t").alias("g"), X.char_gram_set("t").alias("s")).collect():
        assert sorted(r.g) == sorted(py_char_grams(r.t))
        assert set(r.s) == set(r.g)


def test_words_and_pairs(spark):
    df = spark.createDataFrame([("One two, deux_3 é à bé",), ("x",), ("",)], "t string")
    got = [r[0] for r in df.select(X.with_bigrams(X.word_array("t"))).collect()]
    assert got == [["one", "two", "deux_3", "bé", "one two", "two deux_3", "deux_3 bé"], [], []]


def test_tfidf_against_brute_force(spark):
    docs = {1: "red red blue", 2: "blue green", 3: "red blue"}
    df = spark.createDataFrame(list(docs.items()), "doc int, t string")
    counts = X.term_counts(df, "doc", X.word_array("t"))
    got = {(r.doc, r.term): r.weight for r in X.tfidf(counts, "doc", X.vocabulary(counts), df.agg(F.count("*").alias("n"))).collect()}
    words = {d: t.split() for d, t in docs.items()}
    vocab = sorted({w for t in words.values() for w in t})
    idf = {w: math.log(4 / (1 + sum(w in t for t in words.values()))) + 1 for w in vocab}
    for d, t in words.items():
        raw = {w: t.count(w) * idf[w] for w in set(t)}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        for w, v in raw.items():
            assert got[(d, w)] == pytest.approx(v / norm)


def test_vector_features_equal_long_tfidf(spark):
    docs = [(1, "red red blue"), (2, "blue green"), (3, "red blue teal")]
    df = spark.createDataFrame(docs, "doc int, t string").withColumn("words", X.word_array("t"))
    model = L.fit_text_features(df, "words", min_df=1)
    entries = X.vector_entries(model.transform(df), "features", ["doc"])
    slots = L.term_slots(model.stages[0], spark)
    by_term = {(r.doc, r.term): r.value for r in entries.join(slots, "idx").collect()}
    counts = X.term_counts(df, "doc", F.col("words"))
    for r in X.tfidf(counts, "doc", X.vocabulary(counts), df.agg(F.count("*").alias("n"))).collect():
        assert by_term[(r.doc, r.term)] == pytest.approx(r.weight)


def test_split_and_folds_are_stratified(spark):
    df = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(1000)], "id int, label int")
    for r in L.stratified_split(df, "id", "label").groupBy("label").agg(F.sum(F.col("is_test").cast("int")).alias("t"), F.count("*").alias("n")).collect():
        assert abs(r.t - 0.2 * r.n) <= 1
    sizes = L.stratified_folds(df, "id", "label", 5).groupBy("label", "fold").count().collect()
    for label in (0, 1):
        own = [r["count"] for r in sizes if r.label == label]
        assert len(own) == 5 and max(own) - min(own) <= 1


def test_encoder_unknown_and_binary(spark):
    train = spark.createDataFrame([(1.0, "a", "y"), (2.0, "b", "n"), (3.0, "c", "y")], "x double, many string, two string")
    model = L.feature_pipeline(train, ["x"], ["many", "two"])
    new = spark.createDataFrame([(2.0, "zzz", "?")], "x double, many string, two string")
    assert model.transform(new).first().features.toArray().tolist() == [0.0] * 5


def test_importance_finds_the_signal(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), int(a + 0.3 * e > 0)) for i, (a, b, e) in enumerate(rng.normal(size=(400, 3)))]
    df = spark.createDataFrame(rows, "id int, good double, noise double, label int")
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler

    assemble = VectorAssembler(inputCols=["good", "noise"], outputCol="features")
    model = PipelineModel(stages=[assemble, L.fit_logreg(assemble.transform(df))])
    got = {r.feature: r.importance for r in L.permutation_importance(model, df, "id", "label", ["good", "noise"], 2).collect()}
    assert got["good"] > 0.3 and abs(got["noise"]) < 0.05
