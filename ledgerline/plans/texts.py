"""Tokens, n-grams, TF-IDF, naive Bayes and text classifiers on documents and their labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import learn as L
from ..operators import metrics as M
from ..operators import termcounts as TC
from ..operators import textmine as X
from ..operators import textmodels as X2
from ..operators.joins import balanced
from ..session import materialised
from ..sources import lineage
from ..sources.feeds import messages
from .registry import query

c = F.col
FOLDS, PLATT, SIGNALS = 5, 3, 15
#: Terms of all fits that run side by side.
TERMS_AT_ONCE = 5 << 20
#: Kind of terms, least document frequency and fit of each family.
TEXT_MODELS = {
    "logreg_word12": ("words", 2, L.fit_text_logreg),
    "nb_word": ("unigrams", 1, L.fit_text_bayes),
    "svc_char35": ("chars", 2, L.fit_text_svm_squared),
}

WORDS = r"words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS w FROM documents)"
TF = WORDS + ", tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM words) GROUP BY 1, 2)"
IDF = TF + """, idf AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM tf GROUP BY 1),
weighed AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
tfidf AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM weighed)"""


def counts(t):
    return X.term_counts(X.beside_ident(t.documents.select("doc_id", "text"), "doc_id"), "doc_id", X.word_array("text"))


def doc_count(df):
    return df.agg(F.count(F.lit(1)).alias("n"))


@query("word_tokens", f"WITH {TF} SELECT * FROM tf")
def word_tokens(t):
    return counts(t)


@query("word_ngrams", f"""WITH {WORDS}, g AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM words),
tf AS (SELECT doc_id, term, count(*) AS n FROM g GROUP BY 1, 2)
SELECT term, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 2""")
def word_ngrams(t):
    """Words and word pairs occurring in at least two documents."""
    parted = F.regexp_replace(F.lower("text"), X.NO_WORD, " ")
    return TC.document_frequency(balanced(t.documents.select("doc_id", "text"), "doc_id"), parted, TC.word_gram_counts, 2)


@query("char_ngrams", r"""WITH w AS (SELECT doc_id, ' ' || word || ' ' AS p, count(*) AS n FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[ \t\n\x0B\f\r]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1, 2),
s AS (SELECT doc_id, p, n, unnest(range(3, least(5, greatest(3, length(p))) + 1)) AS k FROM w),
g AS (SELECT doc_id, n, substr(p, CAST(pos + 1 AS BIGINT), k) AS term FROM (SELECT *, unnest(range(0, greatest(length(p) - k, 0) + 1)) AS pos FROM s)),
tf AS (SELECT doc_id, term, sum(n) AS tf FROM g GROUP BY 1, 2)
SELECT term, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 2""")
def char_ngrams(t):
    """Character 3- to 5-grams within padded words, in at least two documents."""
    return TC.document_frequency(balanced(t.documents.select("doc_id", "text"), "doc_id"), F.lower("text"), TC.char_gram_counts, 2)


def document_weights(t):
    tf = counts(t)
    vocab = X.vocabulary(tf)
    return X.tfidf(tf, "doc_id", vocab, doc_count(t.documents)), vocab


@query("tfidf", f"WITH {IDF} SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf")
def tfidf(t):
    return document_weights(t)[0].withColumn("weight", F.round("weight", 6))


@query("nb_score", f"""WITH {IDF}, s AS (SELECT term, sum(CASE WHEN toxic = 1 THEN weight ELSE 0 END) AS s1, sum(CASE WHEN toxic = 0 THEN weight ELSE 0 END) AS s0 FROM tfidf JOIN labels USING (doc_id) GROUP BY 1),
tt AS (SELECT sum(s1) AS t1, sum(s0) AS t0, count(*) AS v FROM s),
r AS (SELECT term, ln((s1 + 1) / (t1 + v)) - ln((s0 + 1) / (t0 + v)) AS lr FROM s, tt),
prior AS (SELECT ln(CAST(count(*) FILTER (WHERE toxic = 1) AS DOUBLE)) - ln(CAST(count(*) FILTER (WHERE toxic = 0) AS DOUBLE)) AS lo FROM labels JOIN documents USING (doc_id)),
d AS (SELECT doc_id, sum(weight * lr) AS sc FROM tfidf JOIN r USING (term) GROUP BY 1)
SELECT documents.doc_id, round(COALESCE(sc, 0) + lo, 5) AS score FROM documents LEFT JOIN d USING (doc_id), prior""")
def nb_score(t):
    """Naive Bayes fitted on the labelled documents, log-odds for every document."""
    weights, vocab = document_weights(t)
    labelled = messages(t).select("doc_id", "label")
    terms, prior = X.naive_bayes(weights, labelled, "doc_id", "label")
    scored = X.linear_scores(weights, terms, "doc_id", "log_ratio", prior, "log_odds", t.documents, X.frequent_terms(vocab))
    return scored.withColumn("score", F.round("score", 5))


def split(t):
    """Labelled texts with a stratified 80/20 split."""
    return materialised(L.stratified_split(messages(t), "doc_id", "label"))


def prepared(t, kind):
    """Terms of the labelled texts, the vocabulary that of the training part."""
    return X2.TermRows(split(t), "not is_test", kind)


def parts(terms):
    return terms.rows.filter("not is_test"), terms.rows.filter("is_test")


@query("text_logreg")
def text_logreg(t):
    terms = prepared(t, "words")
    train, test = parts(terms)
    return L.probability(L.fit_text_logreg(train, terms).transform(test)).select("doc_id", "label", "score")


@query("text_svm")
def text_svm(t):
    terms = prepared(t, "chars")
    train, test = parts(terms)
    return L.probability(L.fit_text_svm(train, terms).transform(test)).select("doc_id", "label", "score")


def dealt(rows, folds, name):
    """Rows of the split with a fold for every training row, and -1 for the test part."""
    train = L.stratified_folds(rows.filter("not is_test"), "doc_id", "label", folds, name=name)
    return train.unionByName(rows.filter("is_test").withColumn(name, F.lit(-1)))


@query("platt_calibrate")
def platt_calibrate(t):
    terms = X2.TermRows(materialised(dealt(split(t), PLATT, "part")), "not is_test", "chars")
    return L.platt_calibrated(*parts(terms), lambda d: L.fit_text_svm(d, terms), "doc_id", k=PLATT, fold_column="part", at_once=at_once(terms))


def at_once(terms):
    """Folds whose fits may run side by side: the driver holds their vectors, some twenty numbers a term and fold."""
    return max(1, min(FOLDS, TERMS_AT_ONCE // max(1, terms.size)))


def family_terms(rows):
    """Terms per family; every fold's fit drops those too rare in its own rows."""
    return {name: X2.TermRows(rows, "not is_test", kind, min_df) for name, (kind, min_df, _) in TEXT_MODELS.items()}


def fold_scores(families):
    """Out-of-fold scores of all families on the training part."""
    found = [L.cross_validate(parts(terms)[0], {name: lambda d, n=name, x=terms: TEXT_MODELS[n][2](d, x)}, ["label"], FOLDS, at_once(terms))
             for name, terms in families.items()]
    return reduce(DataFrame.unionByName, found)


@query("text_cv_compare")
def text_cv_compare(t):
    """Three model families cross-validated on the training part only, best first."""
    return L.compare_models(fold_scores(family_terms(materialised(dealt(split(t).filter("not is_test"), FOLDS, "fold")))))


@query("text_svm_squared")
def text_svm_squared(t):
    terms = prepared(t, "chars")
    train, test = parts(terms)
    return L.probability(L.fit_text_svm_squared(train, terms).transform(test)).select("doc_id", "label", "score")


@query("message_champion")
def message_champion(t):
    """The whole job as a report ``section, title, row_json``: families compared by average precision, the winner refitted on the
    training part (margins calibrated), the test part scored once, a threshold for 99 % precision, and what it gets wrong there.
    """
    rows = split(t)
    families = family_terms(materialised(dealt(dealt(rows, FOLDS, "fold"), PLATT, "part")))
    comparison = materialised(L.compare_models(fold_scores(families), by="pr_auc"))
    name = L.champion_of(comparison)
    terms, fit = families[name], TEXT_MODELS[name][2]
    train, test = parts(terms)
    if name == "svc_char35":
        scores = L.platt_calibrated(train, test, lambda d: fit(d, terms), "doc_id", k=PLATT, fold_column="part", at_once=at_once(terms))
    else:
        scores = L.probability(fit(train, terms).transform(test)).select("doc_id", "label", "score")
    scored = materialised(scores.join(rows.filter("is_test").select("doc_id", "text"), "doc_id"))
    point = materialised(M.precision_threshold(scored, 0.99))
    threshold = float(point.first()["threshold"])
    return lineage.audit_export({
        "comparison": ("Families under cross-validation", comparison),
        "test": ("Winner on the test part", L.held_out_metrics(scored, name)),
        "threshold": ("Highest recall at a precision of 99 %", point),
        "classes": ("Both classes at that threshold", M.class_report(scored, threshold)),
        "errors": ("False alarms, and the misses scored lowest", M.error_listing(scored, threshold)),
    })


@query("linear_score")
def linear_score(t):
    """Scores rebuilt as weights x coefficients + intercept, next to the model's own margin."""
    terms = prepared(t, "words")
    train, test = parts(terms)
    model = L.fit_text_logreg(train, terms)
    scored = L.probability(model.transform(test).drop("probability"), "model_score")
    weighed = X2.entries(test, model.idf, "doc_id").join(X2.coefficients(t.spark, model.weights), "idx")
    sums = weighed.groupBy("doc_id").agg(F.sum(c("value") * c("coefficient")).alias("s"))
    return scored.select("doc_id", "model_score").join(sums, "doc_id", "left").select(
        "doc_id", "model_score", (F.coalesce("s", F.lit(0.0)) + model.intercept).alias("rebuilt_score"))


@query("top_signals")
def top_signals(t):
    """Strongest words and word pairs for either class in the interpretable model."""
    rows = split(t)
    terms = X2.TermRows(rows, "not is_test", "words")
    model = L.fit_text_logreg(parts(terms)[0], terms)
    # Places of the strongest weights, ties included; only their terms are looked up in the texts.
    places = X2.strongest(model.weights, SIGNALS)
    found = X2.named_terms(rows.filter("not is_test").select("text"), "words", terms.terms[places])
    weights = t.spark.createDataFrame([(int(terms.terms[i]), float(model.weights[i])) for i in places], "h long, coefficient double")
    return L.top_signals(found.join(F.broadcast(weights), "h").select("term", "coefficient"), "coefficient", SIGNALS)
