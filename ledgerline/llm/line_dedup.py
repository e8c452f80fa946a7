"""Lines that repeat across documents are dropped, in DataFrame operations only.

Lines are exploded and normalised, each is known by a 128-bit hash, documents are counted per hash, and a hash
at or over the threshold loses its lines everywhere but in the smallest document that holds it.  Each text is
reassembled from the positions that stay.

Only hashes and positions are shuffled to find them; the text goes through one exchange, to meet its own list of
dropped positions.  Counting combines before its exchange.  Looking a hash up would bring all lines with it to one
task: hashes with more than one line in ``HOT`` are at most ``HOT``, so they are sent to the lines instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import text_key

BLANKS = " \t\n\x0b\x0c\r"
UPPER = "".join(chr(c) for c in range(65, 91))
#: A hash is hot from one line in so many; so at most so many are.
HOT = 1000


def lines_of(text: Column) -> Column:
    """A text's lines, cut at every newline; null or empty is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return F.btrim(F.translate(line, UPPER, UPPER.lower()), F.lit(BLANKS))


def line_entries(docs: DataFrame, ident: str, shortest: int) -> DataFrame:
    """(doc, key, h1, h2, places): each distinct line of ``shortest`` code points or more in a row of ``docs``, and where it stands."""
    lines = docs.select(F.col(f"`{ident}`").alias("doc"), text_key().alias("key"), F.posexplode(lines_of(F.col("text"))).alias("place", "line"))
    keyed = lines.select("doc", "key", "place", line_key(F.col("line")).alias("line")).filter(F.length("line") >= shortest)
    return keyed.select("doc", "key", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"), "place")


def common_lines(entries: DataFrame, threshold: int) -> DataFrame:
    """(h1, h2, owner, lines): hashes found in ``threshold`` or more documents, with the smallest of these and the number of lines.

    A null ident is a document after all others.
    """
    seen = entries.groupBy("h1", "h2").agg(
        F.min("doc").alias("owner"), F.max("doc").alias("last"), F.max(F.col("doc").isNull()).alias("unnamed"), F.count(F.lit(1)).alias("lines")
    )
    shared = seen.filter((F.col("owner") < F.col("last")) | (F.col("owner").isNotNull() & F.col("unnamed")))
    if threshold > 2:
        # Two documents are told by the smallest and the largest; more have to be counted.
        shared = stored(shared, "shared-lines")
        held = looked_up(entries, shared.select("h1", "h2", "lines"), entries.count()).select("h1", "h2", "doc").distinct()
        counts = held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") >= threshold)
        shared = shared.join(counts.select("h1", "h2"), ["h1", "h2"], "left_semi")
    return shared.select("h1", "h2", "owner", "lines")


def looked_up(entries: DataFrame, common: DataFrame, total: int) -> DataFrame:
    """``entries`` whose hash is in ``common``, with its columns; those of hot hashes stay where they are."""
    hot = F.col("lines") * HOT > total
    few = F.broadcast(common.filter(hot))
    rest = entries.join(few.select("h1", "h2"), ["h1", "h2"], "left_anti").join(common.filter(~hot), ["h1", "h2"])
    return rest.unionByName(entries.join(few, ["h1", "h2"]))


def repeated_places(docs: DataFrame, ident: str = "doc_id", shortest: int = 10, threshold: int = 2) -> DataFrame:
    """(doc, key, places): per row of ``docs`` with lines to drop, their positions in ascending order."""
    entries = stored(line_entries(docs, ident, shortest), "line-entries")
    common = stored(common_lines(entries, threshold), "common-lines")
    found = looked_up(entries, common, entries.count())
    gone = found.filter(F.col("doc").isNull() | (F.col("doc") > F.col("owner")))
    return gone.groupBy("doc", "key").agg(F.array_sort(F.collect_set("place")).alias("places"))


def dedup_lines(docs: DataFrame, ident: str = "doc_id", shortest: int = 10, threshold: int = 2) -> DataFrame:
    """``docs`` with ``text`` reassembled from the lines that stay, and n_lines (before dropping) and n_dropped added.

    A line's key is the line without white space (space, 0x09-0x0D) at its ends, A-Z lower-cased.  Keys of at least
    ``shortest`` code points in ``threshold`` or more documents lose their lines but in the document with the smallest
    ident.  Documents are told apart by ident: rows of one ident are one document and keep or lose a line alike; a null
    ident is a document after all others.  Lines that stay keep their text, order and repeats within a document.  A null
    or empty text is one empty line; null becomes empty.  An empty table gives no rows.  Other columns stay, but for
    columns named n_lines or n_dropped, which are replaced.
    """
    gone = stored(repeated_places(docs, ident, shortest, threshold), "repeated-places")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row.text")
    a, b = row.withColumn("key", F.xxhash64(F.coalesce(text, F.lit("")))).alias("a"), gone.alias("b")
    own = F.col("a.row").getField(ident)
    both = a.join(b, (F.col("a.key") == F.col("b.key")) & own.eqNullSafe(F.col("b.doc")), "left")
    lines, places = lines_of(text), F.coalesce("places", F.array().cast("array<int>"))
    # Dropped lines are cut out by turning the list of positions into the stretches between them.
    starts = F.concat(F.array(F.lit(0)), F.transform(places, lambda p: p + 1))
    ends = F.concat(places, F.array(F.size("lines")))
    stretches = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda x: F.slice("lines", x["s"] + 1, x["e"] - x["s"]))
    kept = F.when(F.size("places") == 0, F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.flatten(stretches), "\n"))
    made = both.select("row", text.alias("text"), lines.alias("lines"), places.alias("places"))
    made = made.select("row", F.struct(kept.alias("text"), F.size("lines").alias("lines"), F.size("places").alias("places")).alias("made"))
    columns = [F.col("made.text") if c == "text" else F.col("row").getField(c) for c in docs.columns]
    rest = [column.alias(c) for column, c in zip(columns, docs.columns, strict=True) if c not in ("n_lines", "n_dropped")]
    return made.select(*rest, F.col("made.lines").cast("long").alias("n_lines"), F.col("made.places").cast("long").alias("n_dropped"))
