"""Hashed terms and the linear text models: terms, weights and optimality against plain computations."""

import math
from collections import Counter

import numpy as np
import pytest

from ledgerline.operators import learn as L
from ledgerline.operators import textmine as X
from ledgerline.operators import textmodels as T
from ledgerline.plans import texts

TEXTS = ["Red red blue", "blue GREEN teal", "", "red  blue\tteal é_1 é_1", None, "x", "green teal red blue", "a bc déf ghijkl a"]
ARRAYS = {"unigrams": lambda: X.word_array("text"), "words": lambda: X.with_bigrams(X.word_array("text")), "chars": lambda: X.char_gram_array("text")}


def frame(spark):
    return spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(TEXTS)], "doc_id long, text string, label int").repartition(3, "doc_id")


def term_hash(kind, term):
    if kind == "words" and " " in term:
        a, b = (T.hash64([w.encode()]) for w in term.split(" "))
        return int(T.pair_hash(a, b)[0])
    return int(T.hash64([term.encode()])[0])


def counted(spark, kind):
    arrays = frame(spark).select("doc_id", "label", ARRAYS[kind]().alias("a")).collect()
    return {r.doc_id: Counter(r.a or []) for r in arrays}, {r.doc_id: r.label for r in arrays}


@pytest.mark.parametrize("kind", ["unigrams", "words", "chars"])
@pytest.mark.parametrize("min_df", [1, 2])
def test_terms_and_counts_equal_the_exploded_ones(spark, kind, min_df):
    want, _ = counted(spark, kind)
    df = Counter(t for c in want.values() for t in c)
    terms = T.TermRows(frame(spark), "true", kind, min_df)
    names = {term_hash(kind, t): t for t in df}
    assert sorted(names[h] for h in terms.terms.tolist()) == sorted(t for t, n in df.items() if n >= min_df)
    for r in terms.rows.collect():
        idx, tf = np.frombuffer(r.idx, np.int32), np.frombuffer(r.tf, np.int32)
        got = {names[int(terms.terms[i])]: int(n) for i, n in zip(idx, tf, strict=True)}
        assert got == {t: n for t, n in want[r.doc_id].items() if df[t] >= min_df}


def test_vocabulary_beyond_its_bound_takes_the_most_frequent(spark):
    raw = T.hashed(frame(spark), "words")
    full = T.vocabulary(raw, 1, 1 << 22)
    want, _ = counted(spark, "words")
    df = Counter(term_hash("words", t) for c in want.values() for t in c)
    few = T.vocabulary(raw, 1, 9).tolist()
    assert 0 < len(few) <= 9 < len(full)
    assert min(df[h] for h in few) >= max(n for h, n in df.items() if h not in few)
    assert T.vocabulary(raw.limit(0), 1, 9).tolist() == []


def dense(spark, kind):
    want, label = counted(spark, kind)
    df, n = Counter(t for c in want.values() for t in c), len(want)
    names = sorted((t for t in df if df[t] >= 2), key=lambda t: term_hash(kind, t))
    x = np.array([[want[d].get(t, 0) * (math.log((1 + n) / (1 + df[t])) + 1) for t in names] for d in sorted(want)])
    length = np.sqrt((x * x).sum(1, keepdims=True))
    return names, np.divide(x, length, out=np.zeros_like(x), where=length > 0), np.array([label[d] for d in sorted(want)])


@pytest.mark.parametrize("loss", ["logistic", "squared_hinge"])
def test_fitted_weights_are_optimal(spark, loss):
    _, x, y = dense(spark, "words")
    terms = T.TermRows(frame(spark), "true", "words")
    model = T.fit_linear(terms.rows, terms.size, loss, 3.0, tolerance=1e-6, flat=0.0)
    s, m = np.where(y == 1, 1.0, -1.0), x @ model.weights + model.intercept
    pull = -s / (1 + np.exp(s * m)) if loss == "logistic" else -2 * s * np.maximum(0, 1 - s * m)
    assert np.abs(model.weights + 3.0 * x.T @ pull).max() < 1e-3
    assert abs((model.intercept if loss == "squared_hinge" else 0.0) + 3.0 * pull.sum()) < 1e-3
    scored = {r.doc_id: r.score for r in L.probability(model.transform(terms.rows)).collect()}
    assert [scored[i] for i in range(len(y))] == pytest.approx(list(1 / (1 + np.exp(-m)) if loss == "logistic" else m))


def test_bayes_against_plain_sums(spark):
    _, x, y = dense(spark, "words")
    terms = T.TermRows(frame(spark), "true", "words")
    model = T.fit_bayes(terms.rows, terms.size, 2)
    logs = [np.log((x[y == k].sum(0) + 1) / (x[y == k].sum() + x.shape[1])) for k in (0, 1)]
    assert model.weights == pytest.approx(logs[1] - logs[0])
    assert model.intercept == pytest.approx(math.log((y.sum() + 1) / (len(y) - y.sum() + 1)))


def test_a_fold_drops_terms_too_rare_in_its_own_rows(spark):
    terms = T.TermRows(frame(spark), "true", "unigrams")
    part = terms.rows.filter("doc_id < 2")
    idf = T.smooth_idf(part, terms.size, 2)
    blue = terms.terms.tolist().index(term_hash("unigrams", "blue"))
    assert np.flatnonzero(idf).tolist() == [blue] and idf[blue] == pytest.approx(1.0)


def test_rebuilt_scores_and_signals_without_a_vocabulary_on_the_driver(tables, monkeypatch):
    from pyspark.ml.feature import CountVectorizer

    def refused(*_):
        raise AssertionError("the vocabulary's texts went to the driver")

    monkeypatch.setattr(CountVectorizer, "fit", refused)
    rows = texts.linear_score(tables).collect()
    assert rows and [r.rebuilt_score for r in rows] == pytest.approx([r.model_score for r in rows])
    signals = texts.top_signals(tables).collect()
    assert Counter(r.direction for r in signals) == {"positive": 15, "negative": 15}
    assert all(r.term for r in signals)


def test_word_counts_of_large_inputs_are_not_shuffled_pair_by_pair(tables, monkeypatch):
    from ledgerline.operators import joins

    monkeypatch.setattr(joins, "SMALL_BYTES", 0)
    plan = texts.word_tokens(tables)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and ", term" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_fits_side_by_side_equal_those_in_turn(spark):
    terms = T.TermRows(frame(spark), "true", "unigrams")
    parts = L.side_by_side(lambda k: T.fit_bayes(terms.rows.filter(f"doc_id <> {k}"), terms.size).weights.tolist(), [0, 1, 3], 3)
    assert parts == [pytest.approx(T.fit_bayes(terms.rows.filter(f"doc_id <> {k}"), terms.size).weights.tolist()) for k in (0, 1, 3)]


def test_folds_dealt_twice_stay_beside_each_other(spark):
    rows = spark.createDataFrame([(i, f"t{i}", i % 2, i % 5 == 0) for i in range(40)], "doc_id long, text string, label int, is_test boolean")
    both = texts.dealt(texts.dealt(rows, 5, "fold"), 3, "part").collect()
    assert len(both) == 40
    assert all((r.fold, r.part) == (-1, -1) if r.is_test else r.fold in range(5) and r.part in range(3) for r in both)
    assert len({(r.fold, r.part) for r in both}) > 5


def test_hashed_rows_go_once_they_are_indexed(spark):
    from ledgerline.session import owned

    before = set(owned(spark))
    terms = T.TermRows(frame(spark), "true", "unigrams")
    assert [p for p in owned(spark) if p not in before] == [terms.rows.stored_at]
