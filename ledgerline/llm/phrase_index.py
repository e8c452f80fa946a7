"""Benchmark decontamination with a distributed positional inverted index, in DataFrame operations only.

The index is a stored table of postings (term, document, position), each part sorted by term, for every term that
a test item uses; other terms can never be looked up.  A phrase is searched as in any positional index: the lists
of its rarest terms are intersected after shifting each by the term's offset in the phrase, and only alignments that
survive are compared word by word, again through the index.

Windows of an item that slide over the same two rarest terms share their lists, so an item costs a few list
reads, not one per window.  Alignments of one document with one item are diagonals (document position minus item
position); a run of equal words along a diagonal, at least a window long, is exactly a set of occurring windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import owned, release, stored
from .common import text_key

WINDOW = 13
SIEVE = 1 << 18
LETTERS = "".join(chr(c) for c in range(65, 91))
BREAKS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
#: Stands for the end of a document in the index; no word is empty.  Its position is the number of words.
END = ""


def words_of(text: Column) -> Column:
    """Words of a text, lower-cased A-Z, cut at every ASCII character that is no letter or digit; null has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), LETTERS + BREAKS, LETTERS.lower() + " " * len(BREAKS))
    return F.array_remove(F.split(plain, " "), "")


def build_index(docs: DataFrame, terms: DataFrame, ident: str = "doc_id") -> DataFrame:
    """Postings (doc, key, pos, term) of the words in ``terms`` (column term), and one ``END`` row per document.

    Rows of one ident are told apart by ``key``, a hash of the text.  Written as Parquet, sorted by term in each part.
    """
    # Written first: Spark then knows its size, and sends a small vocabulary to the tasks instead of shuffling every word.
    wanted = stored(terms.select("term").union(terms.select(F.lit(END))).distinct(), "index-terms")
    if wanted.isEmpty():
        wanted = terms.sparkSession.createDataFrame([(END,)], "term string")
    words = F.concat(words_of(F.col("text")), F.array(F.lit(END)))
    postings = docs.select(F.col(ident).alias("doc"), text_key().alias("key"), F.posexplode(words).alias("pos", "term"))
    return stored(postings.join(wanted, "term", "left_semi").sortWithinPartitions("term", "doc", "key", "pos"), "postings")


def phrase_terms(items: DataFrame, ident: str = "item_id") -> DataFrame:
    """(item, name, n, at, term): the words of each distinct item by position.  ``item`` tells rows of one ident apart."""
    worded = items.select(F.col(ident).alias("name"), words_of(F.col("text")).alias("words")).distinct()
    worded = worded.filter(F.size("words") > 0).withColumn("item", F.xxhash64("name", "words"))
    return worded.select("item", "name", F.size("words").alias("n"), F.posexplode("words").alias("at", "term"))


def rare_pairs(terms: DataFrame, index: DataFrame, window: int = WINDOW) -> DataFrame:
    """The two rarest words of every window that can occur, windows with the same two taken together.

    (item, low_at, low, next_at, next, first, last): the words and their places, and the range of places that the
    windows cover.  A window with a word that the corpus lacks is left out.  One-word windows have the word twice.
    """
    seen = index.filter(F.col("term") != END).groupBy("term").agg(F.count(F.lit(1)).alias("seen"))
    counted = terms.join(seen, "term", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    length = F.least(F.lit(window), F.col("n"))
    ahead = Window.partitionBy("item").orderBy("at").rowsBetween(0, window - 1)
    inside = F.array_sort(F.collect_list(F.struct("seen", "term", "at")).over(ahead))
    windows = counted.select("item", "at", length.alias("length"), "n", inside.alias("rare")).filter(
        (F.col("at") <= F.col("n") - F.col("length")) & (F.col("rare")[0]["seen"] > 0)
    )
    second = F.when(F.size("rare") > 1, F.get("rare", F.lit(1))).otherwise(F.col("rare")[0])
    picked = windows.select("item", "at", "length", F.col("rare")[0].alias("a"), second.alias("b"))
    return picked.groupBy(
        "item", F.col("a.at").alias("low_at"), F.col("a.term").alias("low"), F.col("b.at").alias("next_at"), F.col("b.term").alias("next")
    ).agg(F.min("at").alias("first"), F.max(F.col("at") + F.col("length") - 1).alias("last"))


def alignments(pairs: DataFrame, index: DataFrame) -> DataFrame:
    """(item, doc, key, shift, first, last): where both rarest words of a window stand at the right distance."""
    place = ["item", "first", "last", "low_at", "next_at"]
    found = None
    for which, (at, term) in enumerate((("low_at", "low"), ("next_at", "next"))):
        lookups = pairs.select(*place, F.col(term).alias("term"))
        part = index.join(lookups, "term").select(
            *place, "doc", "key", (F.col("pos") - F.col(at)).alias("shift"), F.lit(1 << which).alias("list")
        )
        found = part if found is None else found.union(part)
    both = found.groupBy(*place, "doc", "key", "shift").agg(F.bit_or("list").alias("lists"))
    # Places before the document's first word can't match; the range starts after them.
    first = F.greatest(F.col("first"), -F.col("shift"))
    return both.filter("lists = 3").select("item", "doc", "key", "shift", first.alias("first"), "last").filter("first <= last")


def occurrences(terms: DataFrame, index: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, doc, key, pos): every document word inside an occurring window of an item, exactly."""
    pairs = stored(rare_pairs(terms, index, window), "rare-pairs")
    found = alignments(pairs, index)
    places = found.select("item", "doc", "key", "shift", F.explode(F.sequence("first", "last")).alias("at")).distinct()
    asked = places.join(terms.select("item", "at", "term", "n"), ["item", "at"])
    asked = stored(asked.withColumn("pos", F.col("shift") + F.col("at")), "asked-places")
    # A sieve of documents that are asked for: at most SIEVE numbers, so it may go to every task.
    mesh = F.pmod("key", F.lit(SIEVE)).alias("mesh")
    sieve = F.broadcast(asked.select(mesh).distinct())
    sifted = index.filter(F.col("term") != END).withColumn("mesh", mesh).join(sieve, "mesh", "left_semi")
    a, b = asked.alias("a"), sifted.alias("b")
    same = (F.col("a.key") == F.col("b.key")) & F.col("a.doc").eqNullSafe(F.col("b.doc"))
    same = same & (F.col("a.pos") == F.col("b.pos")) & (F.col("a.term") == F.col("b.term"))
    equal = a.join(b, same, "left_semi")
    line = Window.partitionBy("item", "doc", "key", "shift")
    runs = equal.withColumn("run", F.col("at") - F.row_number().over(line.orderBy("at")))
    whole = Window.partitionBy("item", "doc", "key", "shift", "run")
    long = runs.withColumn("size", F.count(F.lit(1)).over(whole)).filter(F.col("size") >= F.least(F.lit(window), F.col("n")))
    return long.select("item", "doc", "key", "pos")


def proximity(terms: DataFrame, index: DataFrame, reach: int) -> DataFrame:
    """(item, doc, key, pos): places of an item's rarest word with all its other words at most ``reach`` words away.

    Order and gaps don't matter.  Items with a word that the corpus lacks match nowhere.
    """
    seen = index.filter(F.col("term") != END).groupBy("term").agg(F.count(F.lit(1)).alias("seen"))
    counted = terms.select("item", "term").distinct().join(seen, "term", "left")
    rare = counted.groupBy("item").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "term")).alias("low"), F.count(F.lit(1)).alias("wanted")
    )
    anchors = index.join(rare.select("item", "wanted", F.col("low.term").alias("term")), "term").select("item", "wanted", "doc", "key", "pos")
    asked = anchors.join(terms.select("item", "term").distinct(), "item").alias("a")
    b = index.alias("b")
    near = (F.col("a.key") == F.col("b.key")) & F.col("a.doc").eqNullSafe(F.col("b.doc")) & (F.col("a.term") == F.col("b.term"))
    near = near & (F.abs(F.col("a.pos") - F.col("b.pos")) <= reach)
    place = [F.col(f"a.{c}").alias(c) for c in ("item", "doc", "key", "pos")]
    met = asked.join(b, near).select(*place, "a.wanted", "a.term").distinct()
    return met.groupBy("item", "doc", "key", "pos").agg(F.count(F.lit(1)).alias("met"), F.max("wanted").alias("wanted")).filter("met = wanted").drop("met", "wanted")


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, ident: str = "doc_id", item: str = "item_id"
) -> DataFrame:
    """(ident, key, n_words, n_hit, n_items, items_sha256, contaminated): one row per input row.

    A document word is hit if it lies in any occurrence of ``window`` consecutive item words (all words of a shorter
    item).  Contaminated: some word is hit, and at least one in ``share``.  Null and empty texts have no words and
    are clean; items without words match nowhere.  Repeated rows keep a row each; a null ident is an ident.  Items
    of one ident count once; a null item ident is written as empty text.  Empty tables on either side give clean rows or none;
    other columns are ignored.
    """
    terms = stored(phrase_terms(benchmark, item), "item-terms")
    index = build_index(docs, terms, ident)
    hits = stored(occurrences(terms, index, window), "occurrences")
    words = hits.groupBy("doc", "key", "pos").agg(F.lit(1)).groupBy("doc", "key").agg(F.count(F.lit(1)).alias("n_hit"))
    names = hits.select("doc", "key", "item").distinct().join(terms.select("item", "name").distinct(), "item")
    names = names.groupBy("doc", "key").agg(F.array_sort(F.collect_set(F.coalesce(F.col("name").cast("string"), F.lit("")))).alias("names"))
    found = words.join(names, (words.key == names.key) & words.doc.eqNullSafe(names.doc)).select(words.doc, words.key, "n_hit", "names")
    found = stored(found, "contamination")
    ends = index.filter(F.col("term") == END).select("doc", "key", F.col("pos").cast("long").alias("n_words"))
    rows = ends.join(found, (ends.key == found.key) & ends.doc.eqNullSafe(found.doc), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("names", F.array().cast("array<string>"))
    return rows.select(
        ends.doc.alias(ident), ends.key.alias("key"), "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, ident: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, all columns unchanged, whatever their names.

    Null and empty texts are clean.  Repeated rows stay or go together; an empty table on either side drops nothing.
    """
    since = len(owned(docs.sparkSession))
    found = contamination(docs.select(ident, "text"), benchmark, window, share, ident).filter("contaminated")
    gone = stored(found.select(F.col(ident).alias("id"), "key").distinct(), "contaminated")
    release(docs.sparkSession, since, [gone])
    # The row is one value here, so no column of it can clash with those of the judgement.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(ident).alias("id"), text_key().alias("key"))
    clean = whole.join(gone, whole["id"].eqNullSafe(gone["id"]) & (whole["key"] == gone["key"]), "left_anti")
    return clean.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
