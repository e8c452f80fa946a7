"""Customer features, scaling, anomaly screen, PCA, clustering, cross-checks, personas."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kmeans import Model, Rows, best_of, fit_many, judged, labelled
from .ordered import exact_quantiles, with_quantiles


def rfm_features(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """``customer_id, recency, frequency, monetary, avg_basket, promo_share, category_breadth``.

    ``orders``: order_id, customer_id, day, cents.  ``lines``: order_id, category,
    n, promo (counts of lines, in any number of rows per order and category).  Lines are summed
    per (customer, category) before counting categories, so no customer's lines are gathered.
    """
    last = orders.agg(F.max("day").alias("_mx"))
    basket = orders.groupBy("customer_id").agg(
        F.max("day").alias("_day"), F.count(F.lit(1)).alias("frequency"), (F.sum("cents") / 100).alias("monetary"))
    per_category = (
        lines.join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id", "category").agg(F.sum("n").alias("n"), F.sum("promo").alias("promo")))
    mix = per_category.groupBy("customer_id").agg(
        F.try_divide(F.sum("promo").cast("double"), F.sum("n")).alias("promo_share"), F.count(F.lit(1)).alias("category_breadth"))
    return basket.join(F.broadcast(last)).join(mix, "customer_id", "left").select(
        "customer_id", F.date_diff("_mx", "_day").alias("recency"), "frequency", "monetary",
        (F.col("monetary") / F.col("frequency")).alias("avg_basket"), F.coalesce("promo_share", F.lit(0.0)).alias("promo_share"), F.coalesce("category_breadth", F.lit(0)).alias("category_breadth"))


def standardize(df: DataFrame, columns: list[str], log_columns: list[str]) -> DataFrame:
    """log1p of heavy tails, then population z-scores; a constant column becomes 0.  Bounds are one row."""
    values = df.select("*", *[(F.log1p(c) if c in log_columns else F.col(c).cast("double")).alias(f"_v_{c}") for c in columns])
    stats = values.agg(*[f for c in columns for f in (F.avg(f"_v_{c}").alias(f"_m_{c}"), F.stddev_pop(f"_v_{c}").alias(f"_s_{c}"))])
    keep = [c for c in df.columns if c not in columns]
    z = [F.coalesce(F.try_divide(F.col(f"_v_{c}") - F.col(f"_m_{c}"), F.col(f"_s_{c}")), F.lit(0.0)).alias(c) for c in columns]
    return values.join(F.broadcast(stats)).select(*keep, *z)


# ---------------------------------------------------------------- isolation forest


def _average_depth(n: float) -> float:
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def grow_tree(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple[int, float, int, int, float]]:
    """Random isolation tree as rows ``feature, cut, left, right, depth``; feature -1 marks a leaf."""
    nodes: list[tuple[int, float, int, int, float]] = []

    def grow(rows: np.ndarray, depth: int) -> int:
        place = len(nodes)
        nodes.append((-1, 0.0, -1, -1, depth + _average_depth(len(rows))))
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_axes = np.flatnonzero(high > low)
        if depth < limit and len(rows) > 1 and len(open_axes):
            f = int(rng.choice(open_axes))
            cut = float(rng.uniform(low[f], high[f]))
            mask = rows[:, f] < cut
            if mask.any() and not mask.all():
                left = grow(rows[mask], depth + 1)
                right = grow(rows[~mask], depth + 1)
                nodes[place] = (f, cut, left, right, 0.0)
        return place

    grow(x, 0)
    return nodes


def isolation_scores(df: DataFrame, ident: str, features: list[str], trees: int = 100, sample: int = 256, seed: int = 42) -> DataFrame:
    """Adds ``anomaly_score`` in (0, 1), higher being easier to isolate.

    Subsampling is part of the method: every tree draws ``sample`` rows of its own from all rows, those with the
    lowest hashes of tree and row.  A cut of the hashes, well above what is needed, leaves a few hundred rows a tree
    before they meet; each tree is then grown in a task, and every row of the data is scored in Arrow batches.
    """
    total = df.count()
    size = min(sample, total)
    limit = max(1, math.ceil(math.log2(max(2, size))))
    # Half as many again as wanted, and eight standard deviations: fewer than ``sample`` rows are out of the question.
    share = min(1.0, (1.5 * sample + 8 * math.sqrt(sample)) / max(1, total))
    number = F.pmod(F.xxhash64(F.lit(seed), F.col("tree"), F.col(ident)), F.lit(1 << 52))
    drawn = df.select(ident, *features, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).withColumn("_h", number)
    drawn = drawn.filter(F.col("_h") < int(share * (1 << 52))).select("tree", "_h", *features)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        picked = pdf.sort_values(["_h", *features]).head(size)[features].to_numpy(dtype=float)
        nodes = grow_tree(picked, np.random.default_rng([seed, tree]), limit)
        return pd.DataFrame(nodes, columns=["feature", "cut", "left", "right", "depth"]).assign(tree=tree, node=range(len(nodes)))

    schema = "feature int, cut double, left int, right int, depth double, tree long, node int"
    # At most trees x (2 x sample) nodes.
    grown = drawn.groupBy("tree").applyInPandas(build, schema).toPandas().sort_values(["tree", "node"])
    forest = [tuple(g[c].to_numpy() for c in ("feature", "cut", "left", "right", "depth")) for _, g in grown.groupby("tree")]
    scale = _average_depth(size) or 1.0

    @F.pandas_udf(T.DoubleType())
    def score(rows: pd.Series) -> pd.Series:
        x = np.vstack(rows.to_numpy())
        total = np.zeros(len(x))
        everyone = np.arange(len(x))
        for feature, cut, left, right, depth in forest:
            at = np.zeros(len(x), dtype=int)
            for _ in range(limit + 1):
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                go_left = x[everyone, np.maximum(f, 0)] < cut[at]
                at = np.where(inner, np.where(go_left, left[at], right[at]), at)
            total += depth[at]
        return pd.Series(2.0 ** (-(total / len(forest)) / scale))

    return df.withColumn("anomaly_score", score(F.array(*[F.col(f).cast("double") for f in features])))


def screen_anomalies(scored: DataFrame, contamination: float = 0.02) -> DataFrame:
    """Adds ``is_anomaly`` for scores above the exact (1 - contamination) quantile."""
    cut = exact_quantiles(scored, "anomaly_score", {"_cut": 1 - contamination})
    return scored.join(F.broadcast(cut)).withColumn("is_anomaly", F.col("anomaly_score") > F.col("_cut")).drop("_cut")


def recall_of(df: DataFrame, truth: Column, flag: Column) -> DataFrame:
    return df.agg(F.count_if(truth).alias("planted"), F.count_if(truth & flag).alias("found"),
                  F.try_divide(F.count_if(truth & flag).cast("double"), F.count_if(truth)).alias("recall"))


# ---------------------------------------------------------------- PCA and clusters


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out).transform(df)


def pca_ratios(df: DataFrame, features: list[str]) -> DataFrame:
    """``component, ratio, cumulative``."""
    model = PCA(k=len(features), inputCol="features", outputCol="_p").fit(assemble(df, features))
    ratios = model.explainedVariance.toArray()
    rows = [(i + 1, float(r), float(ratios[: i + 1].sum())) for i, r in enumerate(ratios)]
    return df.sparkSession.createDataFrame(rows, "component int, ratio double, cumulative double")


def pca_project(df: DataFrame, features: list[str], k: int = 2) -> DataFrame:
    """Adds ``pc1..pck`` of centred data."""
    model = PCA(k=k, inputCol="features", outputCol="_p").fit(assemble(df, features))
    parts = vector_to_array("_p")
    out = model.transform(assemble(df, features))
    centre = out.agg(*[F.avg(parts[i]).alias(f"_c{i}") for i in range(k)])
    return out.join(F.broadcast(centre)).select(*df.columns, *[(parts[i] - F.col(f"_c{i}")).alias(f"pc{i + 1}") for i in range(k)])


def inertia(labelled: DataFrame, features: list[str], centers: list[np.ndarray], label: str = "cluster") -> DataFrame:
    """Sum of squared distances to the own centre, recomputed as an aggregate; centres are k short rows."""
    rows = [(i, *[float(v) for v in c]) for i, c in enumerate(centers)]
    frame = labelled.sparkSession.createDataFrame(rows, f"{label} int, " + ", ".join(f"_c{i} double" for i in range(len(features))))
    joined = labelled.join(F.broadcast(frame), label)
    d2 = F.lit(0.0)
    for i, f in enumerate(features):
        d2 = d2 + (F.col(f) - F.col(f"_c{i}")) * (F.col(f) - F.col(f"_c{i}"))
    return joined.agg(F.sum(d2).alias("inertia"))


def choose_k(df: DataFrame, features: list[str], ks: range = range(2, 9), starts: int = 2, seed: int = 42) -> DataFrame:
    """``k, silhouette, inertia, chosen``: the best of all starts per K; the silhouette uses squared distances.

    All starts of all K advance together, so this takes as many passes as the slowest one (see ``kmeans``).
    """
    rows = Rows(df, features)
    models = fit_many(rows, [(k, seed + s) for k in ks for s in range(starts)])
    stats = judged(rows, models)
    best = [min((i for i, m in enumerate(models) if m.k == k), key=lambda i: models[i].cost) for k in ks]
    scores = rows.silhouettes([stats[i] for i in best])
    found = [(models[i].k, float(s), models[i].cost) for i, s in zip(best, scores, strict=True)]
    top = max(found, key=lambda r: (r[1], -r[0]))[0]
    return df.sparkSession.createDataFrame([(*r, r[0] == top) for r in found], "k int, silhouette double, inertia double, chosen boolean")


def kmeans_labels(df: DataFrame, features: list[str], k: int, starts: int = 5, seed: int = 42) -> tuple[DataFrame, Model]:
    """Adds ``cluster``, by the best of ``starts`` models that advance together."""
    model = best_of(df, features, k, starts, seed)
    return labelled(df, features, model.centers, "cluster"), model


def ward_merge(centers: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Merge weighted centres by least growth of within variance until k are left; returns a label per centre."""
    points, weight = centers.astype(float).copy(), sizes.astype(float).copy()
    label = np.arange(len(points))
    alive = list(range(len(points)))
    while len(alive) > k:
        p, w = points[alive], weight[alive]
        d2 = ((p[:, None, :] - p[None, :, :]) ** 2).sum(-1)
        cost = d2 * (w[:, None] * w[None, :]) / (w[:, None] + w[None, :])
        np.fill_diagonal(cost, np.inf)
        i, j = np.unravel_index(int(np.argmin(cost)), cost.shape)
        a, b = alive[min(i, j)], alive[max(i, j)]
        points[a] = (points[a] * weight[a] + points[b] * weight[b]) / (weight[a] + weight[b])
        weight[a] += weight[b]
        label[label == b] = a
        alive.remove(b)
    order = {a: i for i, a in enumerate(alive)}
    return np.array([order[v] for v in label])


def ward_labels(df: DataFrame, features: list[str], k: int, micro: int = 150, seed: int = 42) -> DataFrame:
    """Adds ``ward``: hierarchical clusters of micro-clusters.

    K-means reduces the rows to at most ``micro`` weighted centres; only those are merged.
    """
    model = best_of(df, features, micro, 1, seed, sweeps=20)
    merged = ward_merge(model.centers, np.maximum(model.sizes, 1), min(k, len(model.centers)))
    table = df.sparkSession.createDataFrame([(i, int(m)) for i, m in enumerate(merged)], "_micro int, ward int")
    return labelled(df, features, model.centers, "_micro").join(F.broadcast(table), "_micro", "left").drop("_micro")


def personas(df: DataFrame, segment: str, features: list[str], revenue: str) -> DataFrame:
    """Exact medians, size, revenue share and z-scores of the medians across segments.

    Medians come from the distributed rank search, so a segment holding most
    customers is fine; the windows run over one row per segment.
    """
    base = df.groupBy(segment).agg(F.count(F.lit(1)).alias("size"), F.sum(revenue).alias("_rev"))
    # All features in one search: each is a group beside the segment.
    long = df.select(segment, F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])))
    medians = exact_quantiles(long, "value", {"median": 0.5}, [segment, "feature"])
    wide = medians.groupBy(segment).pivot("feature", features).agg(F.first("median"))
    out = with_quantiles(base, wide.select(segment, *[F.col(f).alias(f"{f}_median") for f in features]), [segment])
    whole = Window.partitionBy()
    share = (100 * F.col("_rev") / F.sum("_rev").over(whole)).alias("revenue_share")
    z = [F.try_divide(F.col(f"{f}_median") - F.avg(f"{f}_median").over(whole), F.stddev_samp(f"{f}_median").over(whole)).alias(f"{f}_z") for f in features]
    return out.select(segment, "size", share, *[f"{f}_median" for f in features], *z)
