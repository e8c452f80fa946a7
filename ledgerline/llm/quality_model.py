"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every text are computed once and written.  The trees are fitted by numpy on a bounded sample of
labelled rows, on features cut into at most ``BINS`` quantile bins, and flattened into arrays: each tree is a full
binary tree of fixed depth, so a batch of documents walks all trees at once with a few indexed reads per level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import per_row, raw_text, text_key, unused
from .quality_rules import NAMES, statistics

BINS, DEPTH, TREES, RATE, LEAST = 64, 4, 80, 0.15, 3.0
#: Labelled rows that the fit uses; with more, a hash of the ident picks about as many.
SAMPLE_ROWS = 20_000

FEATURES = [
    "log_words", "log_bytes", "word_length", "symbols", "symbol_words", "plain_words", "duplicate_lines", "repeated", "variety",
    "capitals", "marks", "ended_lines", "line_words", "digits", "beyond_ascii", "blanks", "punctuation", "controls",
    "entropy", "top_byte", "bars", "quotes", "braces",
]


def features(raw: bytes) -> tuple[list[float]]:
    """The FEATURES of one text, over all of it; zeros for an empty one."""
    s = dict(zip(NAMES, statistics(raw), strict=True))
    words, lines, size = max(s["n_words"], 1), max(s["n_lines"], 1), max(len(raw), 1)
    bytes_ = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    share = bytes_[bytes_ > 0] / size
    quiet = np.array(bytes_, copy=True)
    quiet[[9, 10, 11, 12, 13, 32]] = 0
    return ([
        float(np.log1p(s["n_words"])), float(np.log1p(len(raw))), s["word_chars"] / words, s["n_symbols"] / words,
        s["n_symbol_words"] / words, s["n_plain_words"] / words, s["n_dup_lines"] / lines, s["n_repeat_words"] / words,
        s["n_distinct_words"] / words**0.5, s["n_upper"] / max(s["n_letters"], 1), s["n_marks"] / words,
        s["n_ended_lines"] / lines, s["n_words"] / lines,
        float(bytes_[48:58].sum()) / size, float(bytes_[128:].sum()) / size, 1.0 - float(quiet.sum()) / size,
        float(bytes_[[33, 44, 45, 46, 58, 59, 63]].sum()) / words, float(quiet[:32].sum()) / size,
        float(-(share * np.log2(share)).sum()) if raw else 0.0, float(quiet.max()) / size, bytes_[124] / words,
        (bytes_[34] + bytes_[39]) / words, float(bytes_[[40, 41, 91, 93, 123, 125]].sum()) / words,
    ],)


@dataclass
class Trees:
    """Flattened trees: nodes of tree t at level d are 2**d - 1 ...; a row goes right where its value is over the threshold."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        trees, depth = self.feature.shape[0], int(np.log2(self.leaf.shape[1])) if self.leaf.size else 0
        if not trees:
            return np.full(len(x), self.base)
        which, rows = np.arange(trees)[None, :], np.arange(len(x))[:, None]
        at = np.zeros((len(x), trees), dtype=np.int64)
        for _ in range(depth):
            right = x[rows, self.feature[which, at]] > self.threshold[which, at]
            at = 2 * at + 1 + right
        return self.base + self.leaf[which, at - (2**depth - 1)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, penalty: float = 1.0) -> Trees:
    """Boosted trees for the logistic loss.  Without rows or with one class only, a constant."""
    n, width = x.shape
    mean = (y.sum() + 0.5) / (n + 1.0)
    base = float(np.log(mean / (1 - mean)))
    if not n or y.min() == y.max():
        return Trees(base, np.zeros((0, 2**depth - 1), int), np.zeros((0, 2**depth - 1)), np.zeros((0, 2**depth)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    slot = binned + np.arange(width) * BINS
    feature = np.zeros((trees, 2**depth - 1), dtype=np.int64)
    threshold = np.full((trees, 2**depth - 1), np.inf)
    leaf = np.zeros((trees, 2**depth))
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            keys = ((node - first)[:, None] * (width * BINS) + slot).ravel()
            size = count * width * BINS
            g = np.bincount(keys, np.repeat(grad, width), size).reshape(count, width, BINS).cumsum(axis=2)
            h = np.bincount(keys, np.repeat(hess, width), size).reshape(count, width, BINS).cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + penalty) + (g_all - g) ** 2 / (h_all - h + penalty) - g_all**2 / (h_all + penalty)
            gain[(h < LEAST) | (h_all - h < LEAST)] = 0
            for j, c in enumerate(cuts):
                gain[:, j, len(c) :] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            top = gain.reshape(count, -1)[np.arange(count), best]
            for k in range(count):
                if top[k] > 1e-6:
                    j, b = divmod(int(best[k]), BINS)
                    feature[t, first + k], threshold[t, first + k] = j, cuts[j][b]
            right = x[np.arange(n), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + right
        place = node - (2**depth - 1)
        leaf[t] = rate * np.bincount(place, grad, 2**depth) / (np.bincount(place, hess, 2**depth) + penalty)
        margin += leaf[t][place]
    return Trees(base, feature, threshold, leaf)


def held_out(ident: str, parts: int, part: int) -> Column:
    """Whether a row's label must not be learnt from: crc32 of the ident as text, null as empty."""
    return F.crc32(F.coalesce(F.col(ident).cast("string"), F.lit("")).cast("binary")) % parts == part


def training_labels(labels: DataFrame, label: str, ident: str, parts: int, part: int, rows: int) -> DataFrame:
    """(ident, label) of about ``rows`` labelled rows at most, one per ident, none held out; by a hash of the ident."""
    usable = labels.filter(F.col(label).isNotNull() & F.col(ident).isNotNull() & ~held_out(ident, parts, part))
    usable = usable.groupBy(ident).agg(F.max(label).cast("double").alias("label"))
    total = usable.count()
    if total > rows:
        usable = usable.filter(F.pmod(F.xxhash64(ident), F.lit(1 << 20)) < int((1 << 20) * rows / total))
    return usable


def quality_scores(
    docs: DataFrame, labels: DataFrame, ident: str = "doc_id", parts: int = 4, part: int = 2, threshold: float = 0.7,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(ident, held_out, score, predicted): one row per input row; a score near 1 means quality label 1.

    Labels are learnt only from rows that aren't held out (crc32 of the ident modulo ``parts`` is ``part``), from about
    ``sample_rows`` at most.  Several labels of one ident count as the largest; null labels don't count.  Null and empty
    texts have all statistics zero and a score as well.  Without labels every score is 0.5; an empty table gives no
    rows.  Ident, language and source are never inputs; other columns are ignored.
    """
    keyed = docs.select(ident, "text", text_key().alias(unused([ident], "key")))
    table = stored(per_row(keyed, [raw_text()], lambda: features, "x array<double>", [ident, keyed.columns[2]]), "quality-features")
    chosen = training_labels(labels, "quality", ident, parts, part, sample_rows)
    # Bounded by sample_rows; sorted, so that the sums of the fit don't depend on the order of arrival.
    # Of the rows of one ident, that with the smallest hash of its text.
    one = table.join(chosen, ident).groupBy(ident).agg(F.max("label").alias("label"), F.min_by("x", keyed.columns[2]).alias("x"))
    rows = sorted((r["x"], r["label"]) for r in one.select("x", "label").collect())
    model = fit(np.array([r[0] for r in rows]).reshape(-1, len(FEATURES)), np.array([r[1] for r in rows]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            score = np.concatenate([shared.value.score(x[i : i + 4096]) for i in range(0, len(x), 4096)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=[ident, "score"])

    kind = docs.schema[ident].dataType.simpleString()
    scored = table.mapInArrow(run, f"`{ident}` {kind}, score double")
    return scored.select(
        ident, held_out(ident, parts, part).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
