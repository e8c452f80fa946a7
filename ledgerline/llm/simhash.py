"""Near copies by SimHash fingerprints.

Every text gets a 64-bit fingerprint: a bit is set where over half of the hashes of its word shingles set it.
Two fingerprints at Hamming distance d have per-segment bit counts at Manhattan distance at most d, because a
differing bit changes one count by one.  So fingerprints are placed on the grid of their 16 four-bit segment
counts (each 0 to 4), and a range join on that grid gives every pair within the wanted distance and some more;
the bits themselves decide.

The range join needs no neighbour search on one side only: two grid points at Manhattan distance 2 or less have
a common point one step or less from each.  Each fingerprint is therefore sent to its own cell and to the cells one
step away (at most 33), and equal cells meet.  The steps both sides took tell which of several meeting cells is the
one that counts, so a pair comes out once.  Distinct fingerprints are joined, never documents: a group of exact
copies of any size is one row here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import owned, release, stored
from .common import per_row, raw_text, text_key, word_pieces

SEGMENTS = 16
MAX_DISTANCE = 2
BLOCK = 1 << 15


def shingle_hashes(raw: bytes, words: int, seed: int = 42) -> Iterator[np.ndarray]:
    """Hashes of a text's word shingles, repeats included, in blocks; a shorter text is one shingle, no words are none."""
    tail, any_full = [], False
    for piece in word_pieces(raw.lower()):
        tokens = tail + piece
        shingles = [b" ".join(s) for s in zip(*(tokens[i:] for i in range(words)), strict=False)]
        for start in range(0, len(shingles), BLOCK):
            part = shingles[start : start + BLOCK]
            yield np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in part), dtype="<u8", count=len(part))
        any_full = any_full or bool(shingles)
        tail = tokens[-(words - 1) :] if words > 1 else []
    if tail and not any_full:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), seed)], dtype="<u8")


def fingerprint(raw: bytes, words: int = 3, seed: int = 42) -> int:
    """Signed 64-bit fingerprint of a text; 0 for a text without words."""
    counts, total = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(raw, words, seed):
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0]) if total else 0


def fingerprints(
    docs: DataFrame, words: int = 3, seed: int = 42, ident: str = "doc_id", keep: list[str] | None = None
) -> DataFrame:
    """One row per input row: ``ident``, the columns in ``keep`` and ``fp`` (signed 64-bit)."""
    columns = [ident, *(keep or [])]
    return per_row(docs, [raw_text()], lambda: lambda raw: (fingerprint(raw, words, seed),), "fp long", columns)


def segment_counts(fp: Column) -> Column:
    """The 16 segment counts packed into one long, four bits each."""
    packed = F.lit(0).cast("long")
    for i in range(SEGMENTS):
        mask = 0xF << (4 * i)
        mask -= (1 << 64) if mask >= (1 << 63) else 0
        packed = packed.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseAND(F.lit(mask))).cast("long"), 4 * i))
    return packed


def cells(nodes: DataFrame) -> DataFrame:
    """(fp, cell, move): the own cell (move 0) and those one step up (move i) or down (move -i) in segment i."""
    at = F.expr("shiftright(spot, 4 * (abs(move) - 1)) & 15")
    step = F.expr("shiftleft(1L, 4 * (abs(move) - 1))")
    cell = (
        F.when(F.col("move") == 0, F.col("spot"))
        .when((F.col("move") > 0) & (at < 4), F.col("spot") + step)
        .when((F.col("move") < 0) & (at > 0), F.col("spot") - step)
    )
    moves = F.explode(F.sequence(F.lit(-SEGMENTS), F.lit(SEGMENTS)))
    return (
        nodes.select("fp", segment_counts(F.col("fp")).alias("spot"))
        .select("fp", "spot", moves.alias("move"))
        .select("fp", cell.alias("cell"), F.col("move").cast("byte").alias("move"))
        .filter(F.col("cell").isNotNull())
    )


def near_pairs(nodes: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Pairs a < b of distinct fingerprints at most ``distance`` bits apart, each once.  ``nodes`` has distinct ``fp``."""
    if not 0 <= distance <= 2:
        raise ValueError("cells one step away cover distances up to 2")
    a, b = cells(nodes).alias("a"), cells(nodes).alias("b")
    low, high = F.col("a.move"), F.col("b.move")
    # Counts equal: own cells meet.  Apart by 1: a's own cell.  Apart by 2: the lower segment is a's step, or both
    # step towards each other in one segment.
    counted = (low == 0) | ((high != 0) & ((F.abs(low) < F.abs(high)) | (low == -high)))
    close = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    # Spark sizes cells as it does the fingerprints they are made of, a thirtieth of what they are, and would send them to all executors.
    return a.join(b.hint("merge"), (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fp") < F.col("b.fp")) & close & counted).select(
        F.col("a.fp").alias("a"), F.col("b.fp").alias("b")
    )


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node it is connected to, itself included.

    Alternating star contraction: each round hangs neighbours under the smallest node next to them, until every
    component is one star.  Frames are written each round; only two numbers per round reach the driver.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        lows = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low")), "lows")
        wide = both.join(lows, "u").filter(F.col("v") > F.col("u"))
        large = stored(wide.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct(), "edges")
        lows = stored(large.groupBy("u").agg(F.min("v").alias("low")), "lows")
        small = large.join(lows, "u").filter(F.col("v") != F.col("low")).select(F.col("v").alias("u"), "low")
        edges = stored(small.union(lows).select("u", F.col("low").alias("v")).distinct(), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(tops)


def near_copies(
    docs: DataFrame, words: int = 3, distance: int = MAX_DISTANCE, seed: int = 42, ident: str = "doc_id"
) -> DataFrame:
    """(ident, fingerprint as 16 hex digits, component_id): one row per input row.

    ``component_id`` is the smallest ``ident`` among all rows whose fingerprints are connected by links of at most
    ``distance`` bits.  Null and empty texts have fingerprint zero and link like any other.  Texts shorter than a
    shingle count as one.  Repeated rows and ties keep a row each.  A null ident never names a component unless
    all of its component's idents are null; then the id is null.  An empty table gives no rows; other columns are ignored.
    """
    marks = stored(fingerprints(docs, words, seed, ident), "fingerprints")
    names = component_names(marks, distance, ident)
    # A fingerprint shared by a large share of the rows is one row of ``names``; the skewed join is split by Spark.
    return marks.join(names, "fp").select(
        ident, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def component_names(marks: DataFrame, distance: int, ident: str, more: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of ``marks``; root is a fingerprint.

    ``more`` may add links (a, b) to those within ``distance``.
    """
    nodes = stored(marks.groupBy("fp").agg(F.min(ident).alias("first")), "fingerprint-nodes")
    links = near_pairs(nodes, distance)
    if more is not None:
        links = more(stored(links, "fingerprint-links"))
    top = stored(roots(links), "fingerprint-roots")
    placed = nodes.join(top.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = stored(placed, "fingerprint-places")
    names = stored(placed.groupBy("root").agg(F.min("first").alias("component_id")), "fingerprint-firsts")
    return stored(placed.select("fp", "root").join(names, "root").select("fp", "root", "component_id"), "fingerprint-names")


def keep_one(
    docs: DataFrame, words: int = 3, distance: int = MAX_DISTANCE, seed: int = 42, ident: str = "doc_id", similar: float | None = None
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged: one of each component of near copies.

    With ``similar``, texts whose five-word shingles have that Jaccard similarity are linked as well (see shingle_links).

    It is the row with the smallest ident (null last), then the smallest hash of the text.  Rows that share both
    are repeated rows; of those the smallest by all columns stays.
    """
    spark, since = docs.sparkSession, len(owned(docs.sparkSession))
    if similar is None:
        keyed = docs.select(F.col(ident), "text", text_key().alias("_key"))
        marks, more = stored(fingerprints(keyed, words, seed, ident, ["_key"]), "fingerprints"), None
    else:
        from .shingle_links import fingerprinted, with_similar

        marks, counts = fingerprinted(docs, ident, words, seed)

        def more(links: DataFrame) -> DataFrame:
            return with_similar(docs, marks, counts, links, similar)

    names = component_names(marks, distance, ident, more)
    order = F.struct(F.col(ident).isNull().alias("no"), F.col(ident).alias("id"), F.col("_key").alias("key"))
    rows = marks.groupBy(ident, "_key", "fp").agg(F.count(F.lit(1)).alias("n")).join(names.select("fp", "root"), "fp")
    rows = stored(rows, "fingerprint-rows")
    best = stored(rows.groupBy("root").agg(F.min(order).alias("best")), "fingerprint-best")
    judged = rows.join(best, "root").withColumn("stays", order.eqNullSafe(F.col("best")))
    judged = stored(judged.select(F.col(ident).alias("id"), F.col("_key").alias("key"), "n", "stays"), "fingerprint-judged")
    release(spark, since, [judged])
    # The row is one value here, so no column of it can clash with those of the judgement.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row.text")
    whole = whole.select("row", F.col("row").getField(ident).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"))

    def same(other: DataFrame) -> Column:
        return whole["id"].eqNullSafe(other["id"]) & (whole["key"] == other["key"])

    columns = [F.col("row").getField(c).alias(c) for c in docs.columns]
    gone, repeated = judged.filter("not stays"), judged.filter("stays and n > 1").select("id", "key")
    if repeated.isEmpty():
        return whole.join(gone, same(gone), "left_anti").select(*columns)
    # Repeated rows are few: what stays of them is found apart, the rest is passed through.
    other = judged.filter("not stays or n > 1")
    once = whole.join(repeated, same(repeated), "left_semi").groupBy("id", "key").agg(F.min("row").alias("row"))
    return whole.join(other, same(other), "left_anti").select(*columns).unionByName(once.select(*columns))
