"""The registered clustering queries: starts, and the K that the silhouette chooses."""

import numpy as np

from ledgerline.operators import kmeans as K
from ledgerline.operators import segment as G
from ledgerline.plans import segments as P

CENTERS = np.array([[0.0] * 6, [9.0] * 6, [0.0, 0, 0, 30, 30, 30]])


def blobs(spark, n=80):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(c, 0.5, (n, 6)) for c in CENTERS])
    return x, spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], ["customer_id", *P.FEATURES]).repartition(3).persist()


def test_queries_take_the_chosen_k_and_all_starts(spark, monkeypatch):
    _, rows = blobs(spark)
    seen, real = [], K.seeded

    def watched(read, tasks):
        seen.append([k for k, _ in tasks])
        return real(read, tasks)

    monkeypatch.setattr(P, "core", lambda t: rows)
    monkeypatch.setattr(K, "seeded", watched)
    assert [r.k for r in P.choose_k(None).collect() if r.chosen] == [3]
    assert seen == [[k for k in range(2, 9) for _ in range(20)]]
    assert P.kmeans(None).select("cluster").distinct().count() == 3
    assert seen[-1] == [3] * 50
    assert P.ward_micro(None).select("ward").distinct().count() == 3


def test_models_advance_together_in_bounded_passes(spark):
    x, rows = blobs(spark)
    read = K.Rows(rows, P.FEATURES)
    models = K.fit_many(read, [(k, s) for k in range(2, 9) for s in range(20)])
    stats = K.judged(read, models)
    assert read.passes <= 60 and len(models) == 140
    for m, (centers, n, _, _) in zip(models[::17], stats[::17]):
        near = ((x[:, None] - centers[None]) ** 2).sum(-1)
        assert np.isclose(m.cost, near.min(1).sum()) and n.sum() == len(x)
        # At rest: every centre is the mean of its rows.
        own = near.argmin(1)
        assert all(np.allclose(centers[i], x[own == i].mean(0), atol=1e-3) for i in range(len(centers)) if (own == i).any())
    best = min(m.cost for m in models if m.k == 3)
    assert np.isclose(best, sum(((x[i * 80 : i * 80 + 80] - x[i * 80 : i * 80 + 80].mean(0)) ** 2).sum() for i in range(3)))


def test_silhouette_by_all_pairs(spark):
    x, rows = blobs(spark, 15)
    own = np.array([0] * 10 + [1] * 20 + [2] * 14 + [3])
    pairs = ((x[:, None] - x[None]) ** 2).sum(-1)
    want = []
    for i in range(len(x)):
        mean = {c: pairs[i][(own == c) & (np.arange(len(x)) != i)].mean() if ((own == c) & (np.arange(len(x)) != i)).any() else None for c in range(4)}
        a, b = mean.pop(own[i]), min(v for v in mean.values() if v is not None)
        want.append(0.0 if a is None else (b - a) / max(a, b))
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(own)], "customer_id long, label int")
    got = K.silhouette(rows.join(labels, "customer_id"), P.FEATURES, "label").first().silhouette
    assert np.isclose(got, np.mean(want))


def test_few_distinct_rows_nulls_and_one_cluster(spark):
    rows = spark.createDataFrame([(i, float(i % 2), 1.0) for i in range(50)] + [(99, None, 1.0)], "ident long, a double, b double")
    model = K.best_of(rows, ["a", "b"], 5, 3)
    assert sorted(model.centers.tolist()) == [[0.0, 1.0], [1.0, 1.0]] and model.cost == 0.0 and model.sizes.sum() == 50
    labelled = {r.ident: r.cluster for r in G.kmeans_labels(rows, ["a", "b"], 5, 3)[0].collect()}
    assert labelled[99] is None and len({labelled[i] for i in range(50)}) == 2
    alone = K.Rows(rows, ["a", "b"])
    assert alone.silhouettes([K.judged(alone, [K.Model(1, 0, np.zeros((1, 2)))])[0]]) == [0.0]


def test_screen_finds_planted_outliers(spark):
    """A fiftieth of the rows turned into bulk buyers."""
    x, _ = blobs(spark, 200)
    x[::50] = x[::50] * 5 + 100
    rows = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], ["customer_id", *P.FEATURES])
    from pyspark.sql import functions as F

    flagged = G.screen_anomalies(G.isolation_scores(rows, "customer_id", P.FEATURES))
    assert G.recall_of(flagged, F.col("customer_id") % 50 == 0, F.col("is_anomaly")).first().recall == 1.0


def test_order_lines_are_shuffled_once_before_they_meet_customers(spark, tables):
    from pyspark.sql import functions as F

    from ledgerline.sources.feeds import order_baskets

    orders, lines = order_baskets(tables)
    assert "Aggregate" not in lines._jdf.queryExecution().optimizedPlan().toString()
    # The same features from lines counted per order and type before.
    counted = lines.groupBy("order_id", "category").agg(F.sum("n").alias("n"), F.sum("promo").alias("promo"))
    assert sorted(G.rfm_features(orders, lines).collect()) == sorted(G.rfm_features(orders, counted).collect())
