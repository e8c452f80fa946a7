"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation finds how far to trust each.

No rule decides alone.  Each looks at one statistic of the text and votes good, bad or not at all.  With votes taken
as independent given the true class, EM over all documents estimates the share of good documents and two
accuracies of each rule: how often its votes are right on good documents, and on bad ones.  (A rule against capitals
is right on nearly every good text, but says good of most bad ones too, which are bad in other ways: its good votes
then weigh little and its bad votes much.)  The posterior probability of "good" is a sum of log odds, one column expression.

What EM needs of the corpus is how often each pattern of votes occurs: at most 3 ** len(RULES) rows, counted by
Spark over all documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import per_row, raw_text, text_key, unused

STATISTICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_distinct_words long, n_upper long, n_letters long, n_marks long, n_plain_words long, n_symbol_words long, n_lines long, n_ended_lines long"
)
SYMBOLS = b"#*$%&|<>"
SYMBOL_BYTES = [bytes([c]) for c in SYMBOLS]
#: A word of letters (any script), with at most one closing mark.
PLAIN_WORD = re.compile(rb"(?<![^\x20\x09-\x0D])[\"'(]?[A-Za-z\x80-\xff'-]+[.,;:!?)\"']?(?![^\x20\x09-\x0D])")
BLANK = b" \t\n\r\x0b\x0c"
#: Rules: name, statistic, votes bad from this value on, votes good up to this value (in between it abstains).
#: Where bad < good the statistic is one of which more is better.
RULES = [
    ("few_words", "n_words", 60.0, 100.0),
    ("symbols", "n_symbols / greatest(n_words, 1)", 0.10, 0.02),
    ("symbol_words", "n_symbol_words / greatest(n_words, 1)", 0.10, 0.02),
    ("plain_words", "n_plain_words / greatest(n_words, 1)", 0.75, 0.88),
    ("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", 0.30, 0.10),
    ("repeated_words", "n_repeat_words / greatest(n_words, 1)", 0.30, 0.12),
    ("variety", "n_distinct_words / sqrt(greatest(n_words, 1))", 2.5, 4.0),
    ("capitals", "n_upper / greatest(n_letters, 1)", 0.30, 0.12),
    ("marks", "n_marks / greatest(n_words, 1)", 0.25, 0.05),
    ("ended_lines", "n_ended_lines / greatest(n_lines, 1)", 0.20, 0.60),
    ("long_words", "word_chars / greatest(n_words, 1)", 14.0, 10.0),
    ("short_words", "word_chars / greatest(n_words, 1)", 2.0, 3.0),
]
#: Bounds of the estimates.  ``EDGE``: on bad documents a rule says bad at least this much more often than on good ones.
ON_GOOD, ON_BAD, EDGE, PRIOR = (0.5, 0.9999), (0.01, 0.9999), 0.01, (0.02, 0.98)
Model = tuple[float, list[float], list[float]]


def repeated(words: list[bytes]) -> int:
    """Words inside a three-word window that occurs at least twice, every occurrence included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    total, upto = 0, 0
    for start, window in enumerate(windows):
        if window in often:
            total += start + 3 - max(upto, start)
            upto = start + 3
    return total


def statistics(raw: bytes) -> tuple:
    """The columns of STATISTICS for one text, over all of it."""
    words = raw.split()
    blank = sum(raw.count(c) for c in BLANK)
    points = len(raw) if raw.isascii() else len(raw.decode(errors="replace"))
    lines = [x for x in raw.split(b"\n") if x.strip(BLANK)]
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = len(raw) - len(raw.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return (
        len(words), points - blank, n_symbols, len(lines) - len(set(lines)), repeated(words),
        len(set(words)), upper, upper + lower, raw.count(b"!") + raw.count(b"?"), len(PLAIN_WORD.findall(raw)),
        sum(1 for w in words if any(c in w for c in SYMBOL_BYTES)) if n_symbols else 0, len(lines),
        sum(1 for x in lines if x.rstrip(BLANK)[-1:] in (b".", b"!", b"?", b":", b'"')),
    )


def text_statistics(docs: DataFrame, ident: str = "doc_id") -> DataFrame:
    """(ident, key, statistics): one row per input row.  Null counts as empty."""
    keyed = docs.select(F.col(ident), "text", text_key().alias("key"))
    return per_row(keyed, [raw_text()], lambda: statistics, STATISTICS, [ident, "key"])


NAMES = [part.split()[0] for part in STATISTICS.split(", ")]
VOTES = [f"v_{r[0]}" for r in RULES]


def votes(place: str = "") -> list[Column]:
    """A column per rule: 1 good, -1 bad, 0 abstains.  ``place`` leads the statistics' names, if they are in a struct."""
    out = []
    for name, value, bad, good in RULES:
        v = F.expr(re.sub(rf"\b({'|'.join(NAMES)})\b", rf"{place}\1", value))
        is_bad, is_good = (v < bad, v >= good) if bad < good else (v >= bad, v <= good)
        out.append(F.when(is_bad, -1).when(is_good, 1).otherwise(0).alias(f"v_{name}"))
    return out


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 500) -> Model:
    """Share of good documents, and accuracies of each rule on good and on bad ones, by EM from counted vote patterns."""
    size = len(RULES)
    model: Model = 0.8, [0.95] * size, [0.4] * size
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        share, right_good, cast_good, right_bad, cast_bad = 0.0, *([0.0] * size for _ in range(4))
        for pattern, n in patterns:
            p = posterior(pattern, model)
            share += n * p
            for j, v in enumerate(pattern):
                if v:
                    cast_good[j] += n * p
                    cast_bad[j] += n * (1 - p)
                    right_good[j] += n * p * (v > 0)
                    right_bad[j] += n * (1 - p) * (v < 0)
        before = model
        on_good = [clamp((r + 0.95) / (c + 1), *ON_GOOD) for r, c in zip(right_good, cast_good)]
        on_bad = [clamp((r + 0.4) / (c + 1), max(ON_BAD[0], 1 - g + EDGE), ON_BAD[1]) for r, c, g in zip(right_bad, cast_bad, on_good)]
        model = clamp(share / total, *PRIOR), on_good, on_bad
        if max(abs(a - b) for a, b in zip([model[0], *on_good, *on_bad], [before[0], *before[1], *before[2]])) < 1e-9:
            break
    return model


def clamp(x: float, low: float, high: float) -> float:
    return min(max(x, low), high)


def weights(model: Model) -> list[tuple[float, float]]:
    """What a good and a bad vote of each rule add to the log odds of "good"."""
    return [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in zip(model[1], model[2])]


def posterior(pattern: tuple[int, ...], model: Model) -> float:
    odds = math.log(model[0] / (1 - model[0])) + sum(w[0] if v > 0 else w[1] for v, w in zip(pattern, weights(model)) if v)
    return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


def quality(docs: DataFrame, ident: str = "doc_id", threshold: float = 0.5, min_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """(ident, key, statistics, base_failed, p_good, kept): one row per input row.

    ``base_failed``: under ``min_words`` words, or over ``most_repeated`` percent of them in repeated three-word windows;
    such rows are never kept, others are if the posterior ``p_good`` is at least ``threshold``.  The model is fitted to
    all rows that pass the base rules.  Null and empty texts have no words and fail.  Repeated rows and idents keep a
    row each; an empty table gives no rows; other columns are ignored.
    """
    stats = stored(text_statistics(docs, ident), "text-statistics")
    voted = stats.withColumn("base_failed", base_failed(min_words, most_repeated)).select("*", *votes())
    odds = log_odds(fitted(voted), [F.col(c) for c in VOTES])
    judged = voted.withColumn("p_good", 1 / (1 + F.exp(-odds))).drop(*VOTES)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))


def base_failed(min_words: int, most_repeated: int, place: str = "") -> Column:
    words, repeats = F.col(f"{place}n_words"), F.col(f"{place}n_repeat_words")
    return (words < min_words) | (100 * repeats > most_repeated * words)


def fitted(voted: DataFrame) -> Model:
    """The model for rows with votes and ``base_failed``.  At most 3 ** len(RULES) counts reach the driver, whatever the corpus."""
    counted = voted.filter("not base_failed").groupBy(*VOTES).agg(F.count(F.lit(1)).alias("n")).collect()
    return estimate(sorted((tuple(r[c] for c in VOTES), r["n"]) for r in counted))


def log_odds(model: Model, cast: list[Column]) -> Column:
    odds = F.lit(math.log(model[0] / (1 - model[0])))
    for vote, (good, bad) in zip(cast, weights(model)):
        odds = odds + F.when(vote > 0, good).when(vote < 0, bad).otherwise(0.0)
    return odds


def keep_good(docs: DataFrame, threshold: float = 0.5, min_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns unchanged, whatever their names.

    Null and empty texts have no words and go.  Repeated rows stay or go together; an empty table gives no rows.

    The verdict is a function of the row's own text once the model is fitted, so statistics are computed a second
    time beside the rows rather than joined to them: no text is shuffled.
    """
    stats = per_row(docs, [raw_text()], lambda: statistics, STATISTICS)
    model = fitted(stats.withColumn("base_failed", base_failed(min_words, most_repeated)).select("base_failed", *votes()))
    kind = ", ".join(x.replace(" ", ":") for x in STATISTICS.split(", "))

    def make():
        return lambda raw: (dict(zip(NAMES, statistics(raw), strict=True)),)

    name = unused(docs.columns, "_quality")
    beside = per_row(docs, [raw_text()], make, f"`{name}` struct<{kind}>", docs.columns)
    good = log_odds(model, votes(f"{name}.")) >= math.log(threshold / (1 - threshold))
    return beside.filter(~base_failed(min_words, most_repeated, f"{name}.") & good).drop(name)
