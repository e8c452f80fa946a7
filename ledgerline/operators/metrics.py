"""Exact ranking, threshold, calibration and agreement metrics on scored frames ``(label 0/1, score)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import preview
from ..session import materialised
from .ordered import bucket_of, running_totals


def score_counts(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``score, pos, neg``: one row per distinct score, so that ties are handled exactly."""
    return scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def cumulative_table(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``score, pos, neg, tp, fp, all_pos, all_neg``: counts at threshold ``score`` (predict 1 at or above it)."""
    # Read once per step of the search, so counted once and written.
    counts = materialised(score_counts(scored, label, score))
    ranked = running_totals(counts, "score", {"tp": "pos", "fp": "neg"}, descending=True)
    totals = counts.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    return ranked.join(F.broadcast(totals))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half; NULL with a single class."""
    table = cumulative_table(scored, label, score)
    better = (F.col("tp") - F.col("pos") / 2.0) * F.col("neg")
    return table.agg(
        F.try_divide(F.sum(better), F.max("all_pos").cast("double") * F.max("all_neg")).alias("roc_auc")
    )


def average_precision(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Step sum of precision over recall gains."""
    table = cumulative_table(scored, label, score)
    gain = F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return table.agg(F.try_divide(F.sum(gain), F.max("all_pos").cast("double")).alias("average_precision"))


def curve_points(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ROC and precision-recall points, one row per distinct threshold."""
    return cumulative_table(scored, label, score).select(
        F.col("score").alias("threshold"), "tp", "fp",
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("all_pos")).alias("recall"),
        F.try_divide(F.col("fp"), F.col("all_neg")).alias("fpr"),
    )


def confusion(scored: DataFrame, threshold: float | Column, label: str = "label", score: str = "score") -> DataFrame:
    y, hit = F.col(label), F.col(score) >= threshold
    return scored.agg(
        F.count_if((y == 0) & ~hit).alias("tn"), F.count_if((y == 0) & hit).alias("fp"),
        F.count_if((y == 1) & ~hit).alias("fn"), F.count_if((y == 1) & hit).alias("tp"),
    )


def class_report(scored: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """Precision, recall, F1 and support for both classes; 0 where undefined."""
    def safe(num: Column, den: Column) -> Column:
        return F.coalesce(F.try_divide(num.cast("double"), den), F.lit(0.0))

    m = confusion(scored, threshold, label, score)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))

    def line(name: int, right: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), safe(right, right + wrong).alias("precision"),
            safe(right, right + missed).alias("recall"), safe(2 * right, 2 * right + wrong + missed).alias("f1"),
            (right + missed).alias("support"),
        )

    return m.select(F.inline(F.array(line(0, tn, fn, fp), line(1, tp, fp, fn))))


def threshold_grid(low: float = 0.05, high: float = 0.9, steps: int = 172) -> list[float]:
    return [low + (high - low) * i / (steps - 1) for i in range(steps)]


def profit_sweep(scored: DataFrame, cost: float = 50.0, value: float = 800.0, success: float = 0.3,
                 thresholds: list[float] | None = None, label: str = "label", score: str = "score") -> DataFrame:
    """``threshold, tp, fp, profit`` for a fixed grid.

    Each row is counted once, in the cell between two neighbouring thresholds;
    the handful of cells is then summed from the top.
    """
    grid = sorted(threshold_grid() if thresholds is None else thresholds)
    # Number of thresholds at or below the score, minus one = index of the highest threshold passed.
    strict = bucket_of(-F.col(score), [-g for g in reversed(grid)])
    cell = F.lit(len(grid) - 1) - strict
    counts = scored.select(cell.alias("i"), F.col(label).alias("y")).groupBy("i").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )
    frame = scored.sparkSession.createDataFrame(list(enumerate(grid)), "i int, threshold double")
    top = Window.orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, 0)
    full = frame.join(counts, "i", "left").fillna(0, ["pos", "neg"])
    swept = full.select("threshold", F.sum("pos").over(top).alias("tp"), F.sum("neg").over(top).alias("fp"))
    return swept.withColumn("profit", F.col("tp") * (success * value) - (F.col("tp") + F.col("fp")) * cost)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Highest profit, the lowest threshold winning ties."""
    best = F.max(F.struct(F.col("profit"), (-F.col("threshold")).alias("neg"), F.col("tp"), F.col("fp"))).alias("b")
    return sweep.agg(best).select((-F.col("b.neg")).alias("threshold"), "b.tp", "b.fp", "b.profit")


def precision_threshold(scored: DataFrame, precision: float = 0.99, fallback: float = 0.5, label: str = "label",
                        score: str = "score") -> DataFrame:
    """Operating point with the highest recall among those reaching the precision; the lowest threshold on ties."""
    points = curve_points(scored, label, score).filter(F.col("precision") >= precision)
    best = points.agg(F.max(F.struct("recall", (-F.col("threshold")).alias("neg"), "precision")).alias("b"))
    return best.select(
        F.coalesce(-F.col("b.neg"), F.lit(fallback)).alias("threshold"), F.col("b.precision").alias("precision"),
        F.col("b.recall").alias("recall"),
    )


def calibration_bins(scored: DataFrame, bins: int = 10, label: str = "label", score: str = "score") -> DataFrame:
    """Mean predicted and observed rate per uniform score bin; a score of 1 belongs to the last bin."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(score).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("observed"),
    )


def error_listing(scored: DataFrame, threshold: float, text: str = "text", ident: str = "doc_id", worst: int = 10,
                  label: str = "label", score: str = "score") -> DataFrame:
    """Every false positive, and the ``worst`` lowest-scored false negatives, with a preview of the text."""
    shown = [ident, score, preview(text).alias("preview")]
    fp = scored.filter((F.col(label) == 0) & (F.col(score) >= threshold)).select(F.lit("fp").alias("kind"), *shown)
    fn = (
        scored.filter((F.col(label) == 1) & (F.col(score) < threshold))
        .select(ident, score, text).orderBy(F.col(score).asc_nulls_last(), ident).limit(worst)
        .select(F.lit("fn").alias("kind"), *shown)
    )
    return fp.unionByName(fn)


def against_baseline(df: DataFrame, actual: str, model: str, naive: str) -> DataFrame:
    """MAE and MAPE of a forecast and of the naive one, and the relative improvement."""
    a = F.col(actual)
    out = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(a - F.col(naive))).alias("_n"), F.avg(F.try_divide(F.abs(a - F.col(naive)), F.abs(a))).alias("_np"),
        F.avg(F.abs(a - F.col(model))).alias("_m"), F.avg(F.try_divide(F.abs(a - F.col(model)), F.abs(a))).alias("_mp"),
    )
    return out.select(
        "rows", F.round("_n", 6).alias("mae_naive"), F.round("_np", 6).alias("mape_naive"),
        F.round("_m", 6).alias("mae_model"), F.round("_mp", 6).alias("mape_model"),
        F.round(1 - F.try_divide(F.col("_m"), F.col("_n")), 6).alias("improvement"),
    )


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labelings; the contingency table is aggregated, pairs are only counted."""
    def pairs(x: Column) -> Column:
        n = x.cast("double")
        return n * (n - 1) / 2

    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    together = cells.agg(F.sum(pairs(F.col("n"))).alias("s"), F.sum("n").alias("n"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("ra"))
    cols = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("rb"))
    expected = F.try_divide(F.col("ra") * F.col("rb"), pairs(F.col("n")))
    top = (F.col("ra") + F.col("rb")) / 2
    # Identical trivial partitions give 0/0 and count as full agreement.
    index = F.when(top == expected, 1.0).otherwise((F.col("s") - expected) / (top - expected))
    return together.join(F.broadcast(rows)).join(F.broadcast(cols)).select(index.alias("adjusted_rand"))
