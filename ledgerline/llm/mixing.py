"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Documents are counted into cells (source, language, topic) with their tokens.  Raking scales the cells' token weights
to the target share of each source, then of each language, then of each topic, again and again, until all three
marginals hold; the scaled weight of a cell over its tokens is the rate at which its documents are drawn (over one:
some come more than once).  Drawing is by a hash of the document, so it does not depend on partitions and can be repeated.

Cells are few: targets name the sources, languages and topics that count by themselves, all others share one
rest class per dimension.  Scaling is one window sum per dimension over the cells, several sweeps per written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

REST = "(rest)"
DIMENSIONS = ("source", "lang", "topic")


BLANK = " \t\n\x0b\x0c\r"


def signs_in(text: Column, signs: str) -> Column:
    """How often some ASCII signs stand in a text: what its bytes lose without them."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(s), F.lit(""))) for s in signs), F.lit(0))


def token_weight(text: Column) -> Column:
    """Tokens of a text for weighing: its words, cut at white space (space, 0x09-0x0D); null has none.

    Each word with the blanks behind it becomes one sign, so no list of words is made.
    """
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK))
    starts = F.regexp_replace(inner, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")
    return F.octet_length(starts).cast("long")


def form_topic(text: Column) -> Column:
    """A topic by the form of a text, for corpora without topics: tables and lists, numbers, talk, short or long prose."""
    whole = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(whole), F.lit(1))

    def share(signs: str) -> Column:
        return signs_in(whole, signs) / size

    return (
        F.when(share("|\t") > 0.01, "table").when(share("0123456789") > 0.05, "numbers").when(share("!?") > 0.02, "talk")
        .when(F.length(whole) < 1000, "short").when(F.length(whole) < 6000, "article").otherwise("long")
    )


def classes(docs: DataFrame, targets: dict[str, dict[str, float]], topic: Column | None = None) -> DataFrame:
    """(row, _source, _lang, _topic, _tokens): the whole row as one value, its classes (one a target names, or REST) and its tokens."""
    made = {"source": F.col("source"), "lang": F.col("lang"), "topic": form_topic(F.col("text")) if topic is None else topic}
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    raw = docs.select(row, token_weight(F.col("text")).alias("_tokens"), *[made[d].alias(f"_{d}") for d in DIMENSIONS])
    named = {d: [k for k in targets.get(d, {}) if k != REST] for d in DIMENSIONS}
    kept = [(F.when(F.col(f"_{d}").isin(named[d]), F.col(f"_{d}")).otherwise(REST) if named[d] else F.lit(REST)).alias(f"_{d}") for d in DIMENSIONS]
    return raw.select("row", "_tokens", *kept)


def cell_counts(classed: DataFrame) -> DataFrame:
    """(_source, _lang, _topic, tokens, documents) per cell that has tokens; at most one row per combination of classes."""
    keys = [f"_{d}" for d in DIMENSIONS]
    cells = classed.groupBy(*keys).agg(F.sum("_tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    return cells.filter("tokens > 0")


def shares(cells: DataFrame, targets: dict[str, dict[str, float]]) -> DataFrame:
    """Adds the target share of each cell's class per dimension, scaled to the classes that occur.

    A dimension without targets keeps its shares of tokens.  REST gets what its own target says, or else what the others leave of 1;
    if they leave nothing, it keeps its own share of tokens and the others share what is left by their targets.
    """
    total = Window.partitionBy(F.lit(1))
    whole = F.sum("tokens").over(total)
    out = cells
    for name in DIMENSIONS:
        own = F.sum("tokens").over(Window.partitionBy(f"_{name}")) / whole
        goal = own
        if targets.get(name):
            left = 1.0 - sum(v for k, v in targets[name].items() if k != REST)
            goal = F.when(F.col(f"_{name}") == REST, F.lit(float(targets[name].get(REST, max(0.0, left)))))
            for key, value in targets[name].items():
                if key != REST:
                    goal = goal.when(F.col(f"_{name}") == key, F.lit(float(value)))
        out = out.withColumn(f"goal_{name}", goal.cast("double"))
    for name in DIMENSIONS:
        # Once per class that occurs: each cell counts with the inverse of its class's cells.
        each = F.col(f"goal_{name}") / F.count(F.lit(1)).over(Window.partitionBy(f"_{name}"))
        out = out.withColumn(f"_part_{name}", each)
    for name in DIMENSIONS:
        goal = F.try_divide(F.col(f"goal_{name}"), F.sum(f"_part_{name}").over(total))
        if targets.get(name) and REST not in targets[name] and sum(targets[name].values()) > 1.0 - 1e-9:
            rest = F.coalesce(F.sum(F.when(F.col(f"_{name}") == REST, F.col("tokens"))).over(total), F.lit(0)) / whole
            goal = F.when(F.col(f"_{name}") == REST, rest).otherwise(goal * (1.0 - rest))
        out = out.withColumn(f"goal_{name}", goal)
    return out.drop(*[f"_part_{d}" for d in DIMENSIONS])


def rake(cells: DataFrame, targets: dict[str, dict[str, float]], tolerance: float = 1e-6, sweeps: int = 4, rounds: int = 12) -> DataFrame:
    """(cells, goal per dimension, weight, miss): weights sum to 1 and meet the goals of every dimension, up to ``miss``.

    Runs rounds of ``sweeps`` sweeps until the largest relative miss of a marginal is under ``tolerance``, or ``rounds`` are over
    (goals that contradict each other, as when a source has one language only).
    """
    # One partition: cells are at most the combinations of named classes, and the sweeps then need no shuffle.
    now = shares(cells.coalesce(1), targets).withColumn("weight", F.col("tokens") / F.sum("tokens").over(Window.partitionBy(F.lit(1))))
    for _ in range(rounds):
        for _ in range(sweeps):
            for name in DIMENSIONS:
                sums = F.sum("weight").over(Window.partitionBy(f"_{name}"))
                now = now.withColumn("weight", F.when(sums > 0, F.col("weight") * F.col(f"goal_{name}") / sums).otherwise(0.0))
        now = stored(now, "raked-cells").coalesce(1)
        miss = worst_miss(now)
        if miss < tolerance:
            break
    return now.withColumn("miss", F.lit(miss))


def worst_miss(cells: DataFrame) -> float:
    """The largest relative difference between a marginal and its goal; one number."""
    misses = [
        cells.groupBy(f"_{d}").agg(F.sum("weight").alias("w"), F.max(f"goal_{d}").alias("g")).select((F.abs(F.col("w") - F.col("g")) / F.greatest("g", F.lit(1e-12))).alias("miss"))
        for d in DIMENSIONS
    ]
    return misses[0].union(misses[1]).union(misses[2]).agg(F.max("miss")).first()[0] or 0.0


def rates(cells: DataFrame, share: float) -> DataFrame:
    """Adds ``rate`` per cell: how often each of its documents is wanted, so that the tokens drawn are ``share`` of all."""
    whole = F.sum("tokens").over(Window.partitionBy(F.lit(1)))
    return cells.withColumn("rate", F.col("weight") * whole * share / F.col("tokens"))


def draw(ident: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from a hash of the document."""
    return F.pmod(F.xxhash64(F.lit(seed), ident, F.coalesce(text, F.lit(""))), F.lit(1 << 52)) / F.lit(float(1 << 52))


def mix(
    docs: DataFrame, targets: dict[str, dict[str, float]], share: float = 1.0, seed: int = 17, topic: Column | None = None, ident: str = "doc_id"
) -> DataFrame:
    """``docs`` with weight (of the document's cell in the mix), probability and copies: one row per input row.

    ``targets`` maps source, lang and topic to shares of tokens.  Classes without a target share REST, and what the targets leave.  A document is wanted
    as often as its cell's rate says: the whole part always, one copy more with the rest as probability; ``probability`` is
    that of at least one copy.  So the expected tokens over all copies are ``share`` of the input's and meet every marginal.
    Documents without words (null and empty texts) have weight and probability 0 and no copies.  Repeated rows are drawn or
    left together; null sources and languages belong to REST.  An empty table gives no rows.  Columns that clash with
    the three added ones are replaced.
    """
    names = ("weight", "probability", "copies")
    plain = [c for c in docs.columns if c not in names]
    classed = classes(docs, targets, topic)
    cells = stored(cell_counts(classed), "cells")
    keys = [f"_{d}" for d in DIMENSIONS]
    # At most one row per combination of named classes: bounded by the targets.
    table = F.broadcast(rates(rake(cells, targets), share).select(*keys, F.col("weight").alias("_weight"), F.col("rate").alias("_rate")))
    weighed = classed.join(table, keys, "left")
    rate = F.when(F.col("_tokens") > 0, F.col("_rate")).otherwise(0.0)
    more = (draw(F.col("row").getField(ident), F.col("row.text"), seed) < rate - F.floor(rate)).cast("int")
    return weighed.select(
        *[F.col("row").getField(c).alias(c) for c in plain], F.when(F.col("_tokens") > 0, F.col("_weight")).otherwise(0.0).alias("weight"),
        F.least(rate, F.lit(1.0)).alias("probability"), (F.floor(rate).cast("int") + more).alias("copies"),
    )
