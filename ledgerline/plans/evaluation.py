"""Ranking, threshold and calibration metrics.

Scored frame: every order line, label = returned, score = price modulo a fixed
amount (many distinct values, with ties); texts use the document labels.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators.joins import lookup_join
from .registry import query
from .series import rnd

c = F.col

LINES = """scored AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, (CAST(round(l_extendedprice * 100) AS BIGINT) % 100000) / 100000.0::DOUBLE AS score FROM lineitem)"""
DOCS = """scored AS (SELECT doc_id, text, toxic AS label, (n_chars % 1000) / 1000.0::DOUBLE AS score FROM labels JOIN documents USING (doc_id))"""
CUM = """, cnt AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY 1),
cum AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM cnt)"""


def lines(t):
    cents = F.round(c("l_extendedprice") * 100).cast("bigint")
    return t.lineitem.select((c("l_returnflag") == "R").cast("int").alias("label"), ((cents % 100000) / 100000.0).alias("score"))


def docs(t):
    joined = lookup_join(t.documents.select("doc_id", "text", "n_chars"), t.labels, "doc_id")
    return joined.select("doc_id", "text", c("toxic").alias("label"), ((c("n_chars") % 1000) / 1000.0).alias("score"))


@query("roc_auc", f"WITH {LINES}{CUM} SELECT round(CAST(sum((tp - pos / 2.0) * neg) AS DOUBLE) / (CAST(any_value(p) AS DOUBLE) * any_value(n)), 6) AS roc_auc FROM cum")
def roc_auc(t):
    return rnd(M.roc_auc(lines(t)))


@query("roc_auc_docs", f"WITH {DOCS}{CUM} SELECT round(CAST(sum((tp - pos / 2.0) * neg) AS DOUBLE) / (CAST(any_value(p) AS DOUBLE) * any_value(n)), 6) AS roc_auc FROM cum")
def roc_auc_docs(t):
    return rnd(M.roc_auc(docs(t)))


@query("average_precision", f"WITH {LINES}{CUM} SELECT round(sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / any_value(p), 6) AS average_precision FROM cum")
def average_precision(t):
    return rnd(M.average_precision(lines(t)))


@query("pr_curve", f"""WITH {LINES}{CUM} SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision,
 round(CAST(tp AS DOUBLE) / p, 6) AS recall, round(CAST(fp AS DOUBLE) / n, 6) AS fpr FROM cum""")
def pr_curve(t):
    return rnd(M.curve_points(lines(t)))


@query("confusion", f"""WITH {LINES} SELECT count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn, count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
 count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp FROM scored""")
def confusion(t):
    return M.confusion(lines(t), 0.5)


GRID = ", ".join(repr(x) for x in M.threshold_grid())
SWEEP = f"""th AS (SELECT unnest([{GRID}])::DOUBLE AS threshold),
sweep AS (SELECT threshold, count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp, count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp FROM th, scored GROUP BY 1),
prof AS (SELECT *, CAST(tp AS DOUBLE) * 240.0 - CAST(tp + fp AS DOUBLE) * 50.0 AS profit FROM sweep)"""


@query("profit_sweep", f"WITH {LINES}, {SWEEP} SELECT round(threshold, 9) AS threshold, tp, fp, profit FROM prof")
def profit_sweep(t):
    return M.profit_sweep(lines(t)).withColumn("threshold", F.round("threshold", 9))


@query("profit_threshold", f"WITH {LINES}, {SWEEP} SELECT round(threshold, 9) AS threshold, tp, fp, profit FROM prof ORDER BY profit DESC, threshold LIMIT 1")
def profit_threshold(t):
    return M.best_threshold(M.profit_sweep(lines(t))).withColumn("threshold", F.round("threshold", 9))


@query("calibration_bins", f"""WITH {LINES} SELECT CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, count(*) AS rows, round(avg(score), 6) AS mean_predicted, round(avg(label), 6) AS observed FROM scored GROUP BY 1""")
def calibration_bins(t):
    return rnd(M.calibration_bins(lines(t)))


@query("precision_threshold", f"""WITH {DOCS}{CUM}, ok AS (SELECT score, CAST(tp AS DOUBLE) / (tp + fp) AS pr, CAST(tp AS DOUBLE) / p AS rc FROM cum WHERE CAST(tp AS DOUBLE) / (tp + fp) >= 0.13 ORDER BY rc DESC, score LIMIT 1)
SELECT COALESCE((SELECT score FROM ok), 0.5) AS threshold, (SELECT round(pr, 6) FROM ok) AS precision, (SELECT round(rc, 6) FROM ok) AS recall""")
def precision_threshold(t):
    return rnd(M.precision_threshold(docs(t), 0.13))


@query("class_report", f"""WITH {LINES}, k AS (SELECT count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn, count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
 count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp FROM scored)
SELECT 0::INTEGER AS class, round(CAST(tn AS DOUBLE) / (tn + fn), 6) AS precision, round(CAST(tn AS DOUBLE) / (tn + fp), 6) AS recall, round(2.0::DOUBLE * tn / (2 * tn + fn + fp), 6) AS f1, tn + fp AS support FROM k
UNION ALL SELECT 1, round(CAST(tp AS DOUBLE) / (tp + fp), 6), round(CAST(tp AS DOUBLE) / (tp + fn), 6), round(2.0::DOUBLE * tp / (2 * tp + fn + fp), 6), tp + fn FROM k""")
def class_report(t):
    return rnd(M.class_report(lines(t), 0.5))


PREVIEW = r"substr(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'), 1, 110) AS preview"


@query("error_listing", f"""WITH {DOCS} SELECT 'fp' AS kind, doc_id, score, {PREVIEW} FROM scored WHERE label = 0 AND score >= 0.9
UNION ALL (SELECT 'fn' AS kind, doc_id, score, {PREVIEW} FROM scored WHERE label = 1 AND score < 0.9 ORDER BY score, doc_id LIMIT 10)""")
def error_listing(t):
    return M.error_listing(docs(t), 0.9)


@query("adjusted_rand", """WITH k AS (SELECT p_type, p_brand, CAST(count(*) AS DOUBLE) AS n FROM part GROUP BY 1, 2),
s AS (SELECT sum(n * (n - 1) / 2) AS s, sum(n) AS n FROM k), ra AS (SELECT sum(n * (n - 1) / 2) AS v FROM (SELECT sum(n) AS n FROM k GROUP BY p_type)),
rb AS (SELECT sum(n * (n - 1) / 2) AS v FROM (SELECT sum(n) AS n FROM k GROUP BY p_brand))
SELECT round((s.s - ra.v * rb.v / (s.n * (s.n - 1) / 2)) / ((ra.v + rb.v) / 2 - ra.v * rb.v / (s.n * (s.n - 1) / 2)), 8) AS adjusted_rand FROM s, ra, rb""")
def adjusted_rand(t):
    return rnd(M.adjusted_rand(t.part, "p_type", "p_brand"), 8)
