"""Links between fingerprints whose texts share most of their five-word shingles.

One changed word in a few hundred already moves a SimHash fingerprint by about three bits, so near copies in the usual
sense (Jaccard similarity of the five-word shingles at 0.8 or more) are mostly beyond the two bits that fingerprints
link at.  A corpus that keeps one of each group needs them as well.

The search is exact.  Shingles are put in one order for the whole corpus, rarest first by a table of counts over all texts.
Two texts at 0.8 share one of the first fifth (plus one) of each, so only texts that meet in such a shingle are looked at;
most of these shingles stand in one text and are sifted out before anything is joined.

Texts that meet are not all paired.  Turn by turn, everyone in a shingle's bucket who is of another component is compared
with one leader, the text with the fewest shingles of its own, which joins large groups of copies in as many comparisons as
they have members.  When a turn finds nothing more, what still meets in buckets of several components is compared block by
block, inside tasks; only pairs that may be near come out.  A parity of the shingle set, a bit or more per shingle, tells
how many shingles two texts differ in at least; whole sets are fetched only for pairs that this doesn't rule out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import owned, release, stored
from .common import per_row, raw_text, text_key
from .simhash import fingerprint, roots, shingle_hashes

WORDS = 5
SIMILAR = 0.8
#: Cells of the table of counts; it sets the order of shingles, so costs, not results.  Counts move in pieces.
CELLS, PIECE = 1 << 18, 1 << 12
#: Bits of the sieves that drop what surely isn't asked for: so many per number, at least and at most so many in all; they move in pieces of bytes.
SIEVE_RATE, SIEVE, SIEVE_PIECE = 16, (1 << 16, 1 << 26), 1 << 12
#: Bits of the short parity that members of a bucket carry, and the largest parity of a text.
SHORT, WIDE = 1024, 1 << 16
#: A shingle is hot if it has more than one entry in so many; members that meet in one block; turns with one leader.
HOT, BLOCK, TURNS = 1000, 512, 8


def shingle_set(raw: bytes, words: int = WORDS) -> np.ndarray:
    parts = list(shingle_hashes(raw, words))
    return np.unique(np.concatenate(parts)) if parts else np.array([], dtype="<u8")


def similarity(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two sets of shingles, given as the bytes of their sorted hashes; 1 if both have none."""
    one, two = np.frombuffer(a, dtype="<u8"), np.frombuffer(b, dtype="<u8")
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both / (len(one) + len(two) - both) if len(one) or len(two) else 1.0


def least_shared(n: int, similar: float) -> int:
    """How many of its ``n`` shingles a text shares at least with one as similar as that."""
    return math.ceil(similar * n - 1e-9)


def most_apart(n: int, m: int, similar: float) -> float:
    """In how many shingles two sets of these sizes differ at most, if they are as similar as that."""
    return (n + m) * (1 - similar) / (1 + similar) + 1e-6


def parity(own: np.ndarray, bits: int) -> np.ndarray:
    """A bit per cell: whether an odd number of shingles falls there.  Two sets differ in at least as many shingles as bits."""
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def parity_bits(n: int) -> int:
    return min(WIDE, max(SHORT, 1 << max(0, n - 1).bit_length()))


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The parity over fewer cells, ``size`` bytes."""
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def differ_at_least(a: bytes, b: bytes) -> int:
    one, two = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    size = min(len(one), len(two))
    return int(np.bitwise_count(folded(one, size) ^ folded(two, size)).sum())


def cell_of(own: np.ndarray) -> np.ndarray:
    return (own >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def prefix(own: np.ndarray, counts: np.ndarray, similar: float) -> np.ndarray:
    """The rarest shingles of a set, one of which any set at ``similar`` has among its own."""
    first = np.lexsort((own, counts[cell_of(own)]))[: len(own) - least_shared(len(own), similar) + 1]
    return own[first]


# ---------------------------------------------------------------- passes over the texts


def fingerprinted(docs: DataFrame, ident: str, words: int, seed: int) -> tuple[DataFrame, np.ndarray]:
    """(ident, _key, fp) per row of ``docs`` (ident, text), and how many shingles of the corpus fall into each cell.

    One pass: each task adds its counts up and hands them out in pieces behind its rows.
    """
    source = docs.select(F.col(f"`{ident}`").alias("ident"), text_key().alias("key"), raw_text())
    kind = source.schema["ident"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, idents = np.zeros(CELLS, dtype=np.uint32), None
        for batch in batches:
            if not batch.num_rows:
                continue
            idents, marks = batch.column(0).type, []
            for value in batch.column(2):
                raw = value.as_py()
                np.add.at(counts, cell_of(shingle_set(raw)), 1)
                marks.append(fingerprint(raw, words, seed))
            empty = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.int64()), empty, pa.nulls(batch.num_rows, pa.binary())],
                                             names=["ident", "key", "fp", "piece", "counts"])
        if idents is not None:
            pieces = [counts[at : at + PIECE].tobytes() for at in range(0, CELLS, PIECE)]
            n = len(pieces)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, idents), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(pieces, pa.binary())],
                                             names=["ident", "key", "fp", "piece", "counts"])

    both = stored(source.mapInArrow(run, f"ident {kind}, key long, fp long, piece long, counts binary"), "shingle-counts")
    counts = merged(both.filter("piece is not null").select("piece", "counts"), CELLS // PIECE, PIECE, np.uint32, np.int64, np.add)
    marks = both.filter("piece is null").select(F.col("ident").alias(ident), F.col("key").alias("_key"), "fp")
    return marks, counts


def merged(pieces: DataFrame, n: int, size: int, kind: type, wide: type, add: np.ufunc) -> np.ndarray:
    """Arrays of ``kind`` that tasks have handed out in pieces (piece, bytes), added up as ``wide``; the driver gets ``n`` pieces of ``size`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = sums.setdefault(piece, np.zeros(size, dtype=wide))
                add(held, np.frombuffer(data.as_buffer(), dtype=kind), out=held)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["piece", "data"])

    out = np.zeros((n, size), dtype=wide)
    for row in pieces.repartition(pieces.columns[0]).mapInArrow(run, "piece long, data binary").collect():
        out[row["piece"]] = np.frombuffer(row["data"], dtype=wide)
    return out.ravel()


def sieve_of(df: DataFrame, column: str) -> np.ndarray:
    """A packed bit per number modulo the sieve's size: set where ``column`` (long) has such a number.

    The size follows the rows of ``df`` up to a fixed one, beyond which the sieve lets more through.
    """
    least, most = SIEVE
    size = min(most, max(least, 1 << (SIEVE_RATE * df.count()).bit_length()))
    piece = min(SIEVE_PIECE, size // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = None
        for batch in batches:
            packed = np.zeros(size // 8, dtype=np.uint8) if packed is None else packed
            at = batch.column(0).to_numpy().view(np.uint64) % np.uint64(size)
            np.bitwise_or.at(packed, (at >> np.uint64(3)).astype(np.int64), np.uint8(128) >> (at & np.uint64(7)).astype(np.uint8))
        if packed is not None:
            packed = packed.reshape(-1, piece)
            used = np.flatnonzero(packed.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([packed[i].tobytes() for i in used], pa.binary())], names=["piece", "data"])

    return merged(df.select(column).mapInArrow(run, "piece long, data binary"), size // 8 // piece, piece, np.uint8, np.uint8, np.bitwise_or)


def held_by(sieve: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    at = numbers.view(np.uint64) % np.uint64(8 * len(sieve))
    return (sieve[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1


def prefixes(docs: DataFrame, counts: np.ndarray, similar: float) -> DataFrame:
    """(key, n, tokens, parity) of every text with words; a task hands out equal texts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            out: list[tuple] = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key in seen:
                    continue
                seen.add(key)
                own = shingle_set(value.as_py())
                if len(own):
                    out.append((key, len(own), prefix(own, counts, similar).view("<i8"), parity(own, parity_bits(len(own))).tobytes()))
            if out:
                keys, sizes, tokens, parities = zip(*out, strict=True)
                ends = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(tokens)))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sizes, pa.int32()), lists, pa.array(parities, pa.binary())], names=["key", "n", "tokens", "parity"])

    return docs.select(text_key().alias("key"), raw_text()).mapInArrow(run, "key long, n int, tokens array<long>, parity binary")


def sifted(texts: DataFrame, sieve: np.ndarray) -> DataFrame:
    """(token, key, n, short): the entries of ``texts`` whose token may be in the sieve, with the short parity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = batch.column(2)
            sizes, each = np.diff(tokens.offsets.to_numpy()), tokens.flatten().to_numpy()
            stay = held_by(sieve, each)
            row = np.repeat(np.arange(batch.num_rows), sizes)[stay]
            short = np.array([folded(np.frombuffer(p, dtype=np.uint8), SHORT // 8).tobytes() for p in batch.column(3).to_pylist()], dtype=object)
            yield pa.RecordBatch.from_arrays(
                [pa.array(each[stay]), pa.array(batch.column(0).to_numpy()[row]), pa.array(batch.column(1).to_numpy()[row]), pa.array(short[row].tolist(), pa.binary())],
                names=["token", "key", "n", "short"])

    return texts.select("key", "n", "tokens", "parity").mapInArrow(run, "token long, key long, n int, short binary")


def shingle_sets(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(key, shingles) of the texts whose key is in ``asked``: read beside a sieve, so that no other text is moved."""
    sieve = sieve_of(asked, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            for i in np.flatnonzero(held_by(sieve, keys)).tolist():
                if int(keys[i]) not in seen:
                    seen.add(int(keys[i]))
                    yield pa.RecordBatch.from_arrays([pa.array([keys[i]]), pa.array([shingle_set(batch.column(1)[i].as_py()).tobytes()], pa.binary())], names=["key", "shingles"])

    found = docs.select(text_key().alias("key"), raw_text()).mapInArrow(run, "key long, shingles binary")
    return found.join(asked.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("shingles").alias("shingles"))


# ---------------------------------------------------------------- pairs


def by_token(entries: DataFrame, table: DataFrame, total: int) -> DataFrame:
    """``entries`` beside the rows of ``table`` (token, c entries each, more); hot tokens, at most ``HOT``, are sent to the entries."""
    hot = F.col("c") * HOT > total
    few = F.broadcast(table.filter(hot).drop("c"))
    rest = entries.join(few.select("token"), "token", "left_anti").join(table.filter(~hot).drop("c"), "token")
    return rest.unionByName(entries.join(few, "token"))


def members_of(docs: DataFrame, places: DataFrame, counts: np.ndarray, similar: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(token, key, fp, n, short, rank), (token, c) and (key, parity): who meets in which shingle.  ``places`` has key and fp."""
    texts = stored(prefixes(docs, counts, similar), "prefixes")
    tokens = texts.select("key", F.explode("tokens").alias("token"))
    seen = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("key").alias("low"), F.max("key").alias("high"))
    shared = stored(seen.filter("low < high").select("token", "c"), "shared-tokens")
    total = shared.agg(F.sum("c").alias("n")).first()["n"] or 0
    met = by_token(sifted(texts, sieve_of(shared, "token")), shared, total).dropDuplicates(["token", "key"])
    met = stored(met, "met-tokens")
    # The fewer of its shingles are its own, the likelier a text is what others were copied from.
    alone = F.col("n") - F.ceil(similar * F.col("n") - 1e-9) + 1 - F.col("found")
    ranked = met.groupBy("key", "n").agg(F.count(F.lit(1)).alias("found")).select("key", (alone * 1000 / F.col("n")).cast("int").alias("rank"))
    members = stored(met.join(ranked, "key").join(places, "key"), "members")
    known = ranked.select("key")
    widest = stored(texts.join(known, "key", "left_semi").groupBy("key").agg(F.first("parity").alias("parity")), "parities")
    return members, shared, widest


def placed(rows: DataFrame, top: DataFrame, column: str = "fp", name: str = "root") -> DataFrame:
    """``rows`` with the component of a fingerprint column; one without links is its own."""
    tops = top.select(F.col("node").alias(column), F.col("root").alias(name))
    return rows.join(tops, column, "left").withColumn(name, F.coalesce(name, column))


def near_enough(n: str, m: str, similar: float) -> Column:
    return F.least(n, m) >= similar * F.greatest(n, m) - 1e-9


def led(members: DataFrame, shared: DataFrame, total: int, similar: float) -> DataFrame:
    """(key, fp, n, other, other_fp, other_n): members (with root) against the leader of each bucket of several components."""
    lead = F.min(F.struct("rank", "key", "fp", "n", "root")).alias("lead")
    buckets = members.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("c"), lead).filter("low < high")
    buckets = stored(buckets.select("token", "c", "lead"), "buckets")
    asked = by_token(members, buckets, total).filter(F.col("root") != F.col("lead.root"))
    pairs = asked.select("key", "fp", "n", F.col("lead.key").alias("other"), F.col("lead.fp").alias("other_fp"), F.col("lead.n").alias("other_n"))
    return pairs.filter(near_enough("n", "other_n", similar)).distinct()


def block_pairs(members: DataFrame, similar: float) -> DataFrame:
    """(key, fp, n, other, other_fp, other_n): pairs of a bucket in different components that their short parities don't rule out.

    ``members`` has c, the size of the bucket.  A bucket is cut into blocks by a hash of the key; every two blocks of a
    bucket, and each with itself, are one piece of work, so a bucket of any size is spread out.  No pair is handed out
    but those that may be near.
    """
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("key"), blocks.cast("long")).cast("int")
    spread = members.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    spread = spread.select("token", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "key", "fp", "root", "n", "short")
    dealt = spread.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")

    def pairs(block: list[tuple]) -> Iterator[tuple]:
        own = np.array([r[3] for r in block])
        key, fp, root, n = (np.array([r[c] for r in block], dtype=np.int64) for c in (4, 5, 6, 7))
        bits = np.frombuffer(b"".join(r[8] for r in block), dtype=np.uint64).reshape(len(block), -1)
        across = block[0][1] != block[0][2]
        for x in range(len(block) - 1):
            rest = slice(x + 1, None)
            apart = np.bitwise_count(bits[rest] ^ bits[x]).sum(axis=1)
            size = n[rest] + n[x]
            near = (root[rest] != root[x]) & (np.minimum(n[rest], n[x]) >= similar * np.maximum(n[rest], n[x]) - 1e-9) & (apart <= size * (1 - similar) / (1 + similar) + 1e-6)
            if across:
                near &= own[rest] != own[x]
            for y in (np.flatnonzero(near) + x + 1).tolist():
                a, b = (x, y) if key[x] < key[y] else (y, x)
                yield int(key[a]), int(fp[a]), int(n[a]), int(key[b]), int(fp[b]), int(n[b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "fp", "n", "other", "other_fp", "other_n"]
        kinds = [pa.int64(), pa.int64(), pa.int32()] * 2

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        block: list[tuple] = []
        found: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if block and row[:3] != block[0][:3]:
                    found += pairs(block)
                    block = []
                block.append(row)
            if len(found) > 1 << 14:
                yield out(found)
                found = []
        if block:
            found += pairs(block)
        if found:
            yield out(found)

    return dealt.mapInArrow(run, "key long, fp long, n int, other long, other_fp long, other_n int").distinct()


def ruled_in(pairs: DataFrame, parities: DataFrame, similar: float) -> DataFrame:
    """``pairs`` whose parities leave it open that they are near."""
    others = parities.select(F.col("key").alias("other"), F.col("parity").alias("other_parity"))
    both = pairs.join(parities, "key").join(others, "other")
    judge = per_row(both, [F.col("parity"), F.col("other_parity")], lambda: lambda a, b: (differ_at_least(a, b),), "apart int", pairs.columns)
    return judge.filter(F.col("apart") <= (F.col("n") + F.col("other_n")) * ((1 - similar) / (1 + similar)) + 1e-6).drop("apart")


def compared(docs: DataFrame, pairs: DataFrame, similar: float) -> DataFrame:
    """(a, b): the fingerprints of those pairs whose texts reach ``similar``, by their whole sets."""
    asked = stored(pairs.select("key").union(pairs.select("other")).distinct(), "asked-texts")
    sets = stored(shingle_sets(docs, asked), "asked-shingles")
    others = sets.select(F.col("key").alias("other"), F.col("shingles").alias("other_shingles"))
    both = pairs.select("key", "fp", "other", "other_fp").join(sets, "key").join(others, "other")
    judged = per_row(both, [F.col("shingles"), F.col("other_shingles")], lambda: lambda a, b: (similarity(a, b),), "same double", ["fp", "other_fp"])
    links = judged.filter(F.col("same") >= similar).select(F.least("fp", "other_fp").alias("a"), F.greatest("fp", "other_fp").alias("b")).filter("a < b").distinct()
    return stored(links, "shingle-links")


def with_similar(docs: DataFrame, marks: DataFrame, counts: np.ndarray, links: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``links`` (a, b) between fingerprints, and those that join all texts at ``similar`` or more into one component.

    ``marks`` has _key (of the text) and fp, one row per document of ``docs``; exact copies are one text here.
    Null and empty texts have no shingles (their fingerprints are equal).  Different texts under one 64-bit key and one
    fingerprint would be taken as one.  ``counts`` (from ``fingerprinted``) sets the order of shingles.
    """
    spark, since = docs.sparkSession, len(owned(docs.sparkSession))
    places = stored(marks.select(F.col("_key").alias("key"), "fp").distinct(), "text-places")
    members, shared, parities = members_of(docs, places, counts, similar)
    total = shared.agg(F.sum("c").alias("n")).first()["n"] or 0
    release(spark, since, [members, shared, parities, links])
    links, done = links.select("a", "b"), None
    for turn in range(TURNS + 1):
        mark = len(owned(spark))
        top = stored(roots(links), "link-roots")
        now = placed(members, top)
        if turn < TURNS:
            pairs = led(now, shared, total, similar)
            if done is not None:
                pairs = pairs.join(done, ["key", "other"], "left_anti")
            asked = stored(pairs, "led-pairs")
            done = stored(asked.select("key", "other") if done is None else done.union(asked.select("key", "other")), "led-so-far")
            found = compared(docs, stored(ruled_in(asked, parities, similar), "open-pairs"), similar)
            fresh = found.count()
            links = stored(links.union(found), "all-links")
            release(spark, mark, [links, done])
            if not fresh:
                break
    mark = len(owned(spark))
    now = placed(members, stored(roots(links), "link-roots"))
    split = now.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("c")).filter("low < high").select("token", "c")
    split = stored(split, "split-buckets")
    rest = by_token(now, split.withColumn("size", F.col("c")), total).withColumnRenamed("size", "c")
    open_pairs = stored(ruled_in(block_pairs(rest, similar), parities, similar), "open-pairs")
    links = stored(links.union(judged_in_rounds(docs, open_pairs, links, similar)), "all-links")
    release(spark, mark, [links])
    return links


def judged_in_rounds(docs: DataFrame, pairs: DataFrame, links: DataFrame, similar: float) -> DataFrame:
    """The links among ``pairs`` that are needed: each text meets four partners of other components first, then sixteen times as many, and so on.

    Texts that have become one component in the meantime are not compared any more.
    """
    found, share = links, 4
    while True:
        top = stored(roots(found), "link-roots")
        apart = placed(placed(pairs, top), top, "other_fp", "other_root").filter("root <> other_root").drop("root", "other_root")
        apart = stored(apart, "pairs-left")
        if apart.isEmpty():
            return found
        turn = F.row_number().over(Window.partitionBy("key").orderBy("other"))
        now = stored(apart.withColumn("turn", turn).filter(F.col("turn") <= share).drop("turn"), "pairs-now")
        found = stored(found.union(compared(docs, now, similar)), "links-so-far")
        pairs = stored(apart.join(now.select("key", "other"), ["key", "other"], "left_anti"), "pairs-open")
        share *= 16
