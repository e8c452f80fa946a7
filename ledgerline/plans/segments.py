"""Customer segmentation: features, screen, PCA, clusters, cross-checks, personas."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import kmeans as KM
from ..operators import metrics as M
from ..operators import segment as G
from ..session import materialised
from ..sources.feeds import order_baskets
from .marts import segmented
from .registry import query
from .series import rnd

c = F.col
FEATURES = ["recency", "frequency", "monetary", "avg_basket", "promo_share", "category_breadth"]
LOGGED = ["frequency", "monetary", "avg_basket"]
#: Starts per K while K is chosen, for the clusters themselves, and for those held against the rule segments.
K_STARTS, STARTS, RULE_STARTS = 20, 50, 25
#: Standard deviations beyond which a customer is called extreme when the screen is judged.
FAR = 3.0

RFM = """
o AS (SELECT o_custkey AS customer_id, count(*) AS frequency, datediff('day', CAST(max(o_orderdate) AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS recency,
   CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS monetary FROM orders GROUP BY 1),
l AS (SELECT o_custkey AS customer_id, avg(CAST(l_discount > 0.05 AS INTEGER)) AS promo_share, count(DISTINCT p_type) AS category_breadth FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1),
rfm AS (SELECT customer_id, CAST(recency AS INTEGER) AS recency, frequency, monetary, monetary / frequency AS avg_basket, COALESCE(promo_share, 0) AS promo_share, COALESCE(category_breadth, 0) AS category_breadth FROM o LEFT JOIN l USING (customer_id))
"""


def rfm(t):
    return G.rfm_features(*order_baskets(t))


def scaled(t):
    """Standardised features, written once because every fit reads them repeatedly."""
    return materialised(G.standardize(rfm(t), FEATURES, LOGGED))


@query("rfm_features", f"WITH {RFM} SELECT customer_id, recency, frequency, monetary, avg_basket, round(promo_share, 6) AS promo_share, category_breadth FROM rfm")
def rfm_features(t):
    return rfm(t).withColumn("promo_share", F.round("promo_share", 6))


Z = ", ".join(f"round(COALESCE(({e} - avg({e}) OVER ()) / NULLIF(stddev_pop({e}) OVER (), 0), 0), 5) AS {f}" for f in FEATURES
              for e in [f"ln(1 + {f})" if f in LOGGED else f"CAST({f} AS DOUBLE)"])


@query("standardize", f"WITH {RFM} SELECT customer_id, {Z} FROM rfm")
def standardize(t):
    return rnd(G.standardize(rfm(t), FEATURES, LOGGED), 5)


MEDIANS = ", ".join(f"median(CAST({f} AS DOUBLE)) AS {f}_median" for f in FEATURES)
ROUNDED = ", ".join(f"round({f}_median, 4) AS {f}_median" for f in FEATURES)
SCORES = ", ".join(f"round(({f}_median - avg({f}_median) OVER ()) / NULLIF(stddev_samp({f}_median) OVER (), 0), 4) AS {f}_z" for f in FEATURES)


@query("personas", f"""WITH {RFM}, g AS (SELECT c_mktsegment, count(*) AS size, sum(monetary) AS rev, {MEDIANS} FROM rfm JOIN customer ON customer_id = c_custkey GROUP BY 1)
SELECT c_mktsegment, size, round(100 * rev / sum(rev) OVER (), 4) AS revenue_share, {ROUNDED}, {SCORES} FROM g""")
def personas(t):
    joined = rfm(t).join(t.customer.select(c("c_custkey").alias("customer_id"), "c_mktsegment"), "customer_id")
    return rnd(G.personas(materialised(joined), "c_mktsegment", FEATURES, "monetary"), 4)


@query("anomaly_screen")
def anomaly_screen(t):
    return G.screen_anomalies(materialised(G.isolation_scores(scaled(t), "customer_id", FEATURES))).select("customer_id", "anomaly_score", "is_anomaly")


def screened(t):
    """Scaled rows with ``is_anomaly``."""
    return materialised(G.screen_anomalies(materialised(G.isolation_scores(scaled(t), "customer_id", FEATURES))))


@query("anomaly_recall")
def anomaly_recall(t):
    """How many customers with a feature beyond ``FAR`` standard deviations does the screen find?"""
    far = F.exists(F.array(*FEATURES), lambda z: F.abs(z) > FAR)
    return G.recall_of(screened(t), far, c("is_anomaly"))


def core(t):
    """Scaled rows without the screened anomalies."""
    return materialised(screened(t).filter("not is_anomaly").select("customer_id", *FEATURES))


@query("pca")
def pca(t):
    return G.pca_ratios(core(t), FEATURES)


@query("pca_projection")
def pca_projection(t):
    return G.pca_project(core(t), FEATURES, 2).select("customer_id", "pc1", "pc2")


@query("choose_k")
def choose_k(t):
    return G.choose_k(core(t), FEATURES, starts=K_STARTS)


def chosen_k(rows, features):
    return G.choose_k(rows, features, starts=K_STARTS).filter("chosen").first()


def clustered(rows):
    """Rows with ``cluster``, the model and the row of ``choose_k`` for the K that the silhouette chose."""
    chosen = chosen_k(rows, FEATURES)
    return *G.kmeans_labels(rows, FEATURES, chosen.k, STARTS), chosen


@query("kmeans")
def kmeans(t):
    return clustered(core(t))[0].select("customer_id", "cluster")


@query("kmeans_inertia")
def kmeans_inertia(t):
    """The objective recomputed from the labels, next to the model's own."""
    labelled, model, _ = clustered(core(t))
    return G.inertia(labelled, FEATURES, list(model.centers)).withColumn("model_inertia", F.lit(model.cost))


ZS = ", ".join(f"COALESCE(({e} - avg({e}) OVER ()) / NULLIF(stddev_pop({e}) OVER (), 0), 0) AS {f}" for f in FEATURES
               for e in [f"ln(1 + {f})" if f in LOGGED else f"CAST({f} AS DOUBLE)"])
MOVES, MOVED_K = 3, range(2, 6)


def moves_sql():
    """The same moves, one after the other as subqueries."""
    far = " + ".join(f"(z.{f} - m.{f}) * (z.{f} - m.{f})" for f in FEATURES)
    parts = [f"z AS (SELECT customer_id, {ZS} FROM rfm)", "first AS (SELECT *, row_number() OVER (ORDER BY customer_id) - 1 AS i FROM z)",
             f"m0 AS (SELECT k, i, {', '.join(FEATURES)} FROM first JOIN (SELECT unnest([{', '.join(map(str, MOVED_K))}]) AS k) ON i < k)"]
    for n in range(MOVES + 1):
        parts.append(f"a{n} AS (SELECT m.k, customer_id, min({{'d': {far}, 'i': m.i}}) AS best FROM z, m{n} m GROUP BY m.k, customer_id)")
        means = ", ".join(f"coalesce(new.{f}, old.{f}) AS {f}" for f in FEATURES)
        parts.append(f"m{n + 1} AS (SELECT old.k, old.i, {means} FROM m{n} old LEFT JOIN (SELECT k, best.i AS i, {', '.join(f'avg({f}) AS {f}' for f in FEATURES)} FROM a{n} JOIN z USING (customer_id) GROUP BY 1, 2) new ON new.k = old.k AND new.i = old.i)")
    return f"WITH {RFM}, {', '.join(parts)} SELECT CAST(k AS INTEGER) AS k, CAST(best.i AS INTEGER) AS cluster, count(*) AS size, round(sum(best.d), 3) AS cost FROM a{MOVES} GROUP BY 1, 2"


@query("kmeans_moves", moves_sql())
def kmeans_moves(t):
    """Four models that start from the first customers, moved together: rows and cost per cluster after three moves."""
    rows = scaled(t)
    first = np.array([[r[f] for f in FEATURES] for r in rows.orderBy("customer_id").limit(max(MOVED_K)).collect()])
    models = [KM.Model(k, 0, first[:k]) for k in MOVED_K]
    read = KM.Rows(rows, FEATURES)
    KM.lloyd(read, models, MOVES, 0.0)
    n, cost, _, _ = read.sums([m.centers for m in models])
    names = [(m.k, i) for m in models for i in range(len(m.centers))]
    found = [(k, i, int(size), float(d)) for (k, i), size, d in zip(names, n, cost, strict=True) if size]
    return rnd(t.spark.createDataFrame(found, "k int, cluster int, size long, cost double"), 3)


@query("ward_micro")
def ward_micro(t):
    rows = core(t)
    return G.ward_labels(rows, FEATURES, chosen_k(rows, FEATURES).k).select("customer_id", "ward")


@query("cluster_agreement")
def cluster_agreement(t):
    rows, _, chosen = clustered(core(t))
    return M.adjusted_rand(G.ward_labels(rows, FEATURES, chosen.k), "cluster", "ward")


@query("cluster_personas")
def cluster_personas(t):
    """Personas of the K-means clusters, in the customers' own units."""
    labels = clustered(core(t))[0].select("customer_id", "cluster")
    return rnd(G.personas(materialised(rfm(t).join(labels, "customer_id")), "cluster", FEATURES, "monetary"), 4)


@query("cluster_crosstab")
def cluster_crosstab(t):
    """Customers by market segment and cluster."""
    labels = clustered(core(t))[0].select("customer_id", "cluster")
    return t.customer.withColumnRenamed("c_custkey", "customer_id").join(labels, "customer_id").groupBy("c_mktsegment", "cluster").agg(F.count(F.lit(1)).alias("n"))


@query("segmentation_summary")
def segmentation_summary(t):
    """One row for the whole job: screen, K, both clusterings with their silhouettes, their agreement, variance of two components."""
    rows = screened(t)
    kept = materialised(rows.filter("not is_anomaly").select("customer_id", *FEATURES))
    labelled, model, chosen = clustered(kept)
    both = materialised(G.ward_labels(labelled, FEATURES, chosen.k))
    held = both.join(t.customer.select(c("c_custkey").alias("customer_id"), "c_mktsegment"), "customer_id")
    found = {
        "n_customers": rows.count(), "n_anomalies": rows.filter("is_anomaly").count(), "chosen_k": chosen.k, "inertia": model.cost,
        "silhouette_kmeans": KM.silhouette(both, FEATURES, "cluster").first()[0], "silhouette_ward": KM.silhouette(both, FEATURES, "ward").first()[0],
        "kmeans_vs_ward": M.adjusted_rand(both, "cluster", "ward").first()[0], "kmeans_vs_segment": M.adjusted_rand(held, "cluster", "c_mktsegment").first()[0],
        "variance_of_two": G.pca_ratios(kept, FEATURES).filter("component = 2").first()["cumulative"],
    }
    kinds = {int: "long", float: "double"}
    return t.spark.createDataFrame([tuple(found.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in found.items()))


@query("segments_vs_kmeans")
def segments_vs_kmeans(t):
    """Rule segments against K-means on the same behaviour."""
    k = segmented(t).select("entity_id", "segment", c("market_l6m").cast("double").alias("volume"),
                            F.coalesce("own_share_l6m", F.lit(0.0)).alias("share"), F.coalesce("share_slope_pm", F.lit(0.0)).alias("slope"))
    rows = materialised(G.standardize(k, ["volume", "share", "slope"], ["volume"]))
    # Four clusters for the four rule segments; this K is not chosen.
    return M.adjusted_rand(G.kmeans_labels(rows, ["volume", "share", "slope"], 4, RULE_STARTS)[0], "segment", "cluster")
