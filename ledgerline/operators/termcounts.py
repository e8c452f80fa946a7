"""Documents per term, counted inside tasks by numbers: terms become integers, texts become strings again only once per slice.

Every function takes a list of texts and returns ``(terms, counts)``: in how many of the texts each term occurs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: UTF-8 bytes (of texts for grams of characters and of words) and texts that are counted together; one larger text is a slice of its own.
SLICE_BYTES, WORD_SLICE_BYTES, SLICE_TEXTS = 1 << 18, 1 << 24, 1 << 14
LOW, HIGH = 3, 5


def texts_per_key(doc: np.ndarray, key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (below ``2**bits``) and in how many texts each occurs."""
    pairs = np.sort((doc << np.uint64(bits)) | key)
    new = np.ones(len(pairs), bool)
    new[1:] = pairs[1:] != pairs[:-1]
    return np.unique(pairs[new] & np.uint64((1 << bits) - 1), return_counts=True)


def char_gram_counts(texts: list[str]) -> tuple[list[str], list[int]]:
    """Character 3- to 5-grams within words padded with a blank on each side.

    Runs of blanks become one, so the grams are the windows without a blank between their ends.
    """
    a = np.frombuffer((" " + "".join(t + " " for t in texts)).encode("utf-32-le"), "<u4")
    doc = np.concatenate([[0], np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])]).astype(np.uint64)
    inside = ~((a == 32) | ((a >= 9) & (a <= 13)))
    keep = inside.copy()
    keep[0] = True
    keep[1:] |= inside[:-1]
    a, doc, inside = np.where(inside, a, np.uint32(32))[keep], doc[keep], inside[keep]
    seen = np.zeros(int(a.max()) + 1, bool)
    seen[a] = True
    alphabet = np.flatnonzero(seen).astype("<u4")
    bits = len(alphabet).bit_length()
    windows = {}
    for k in range(LOW, HIGH + 1):
        good = np.ones(max(0, len(a) - k + 1), bool)
        for j in range(1, k - 1):
            good &= inside[j:j + len(good)]
        windows[k] = np.flatnonzero(good)
    if bits * HIGH + (len(texts) - 1).bit_length() > 64:
        # More kinds of characters than an integer of five has room for: half as many texts, at last one as plain strings.
        if len(texts) > 1:
            half = len(texts) // 2
            parts = [char_gram_counts(texts[:half]), char_gram_counts(texts[half:])]
            return [t for p in parts for t in p[0]], [n for p in parts for n in p[1]]
        whole = a.tobytes().decode("utf-32-le")
        found = list({whole[i:i + k] for k, at in windows.items() for i in at.tolist()})
        return found, [1] * len(found)
    rank = np.zeros(len(seen), np.uint64)
    rank[alphabet] = np.arange(1, len(alphabet) + 1)
    code, keys, docs, shift = rank[a], [], [], np.uint64(bits)
    for k, at in windows.items():
        key = code[at]
        for j in range(1, k):
            key = (key << shift) | code[at + j]
        keys.append(key)
        docs.append(doc[at + 1])
    key, n = texts_per_key(np.concatenate(docs), np.concatenate(keys), bits * HIGH)
    # No character has the rank 0, so shorter grams are smaller numbers.
    terms, ends = [], np.searchsorted(key, np.array([1 << (bits * k) for k in range(LOW - 1, HIGH)] + [(1 << (bits * HIGH)) - 1], np.uint64), "left")
    ends[-1] = len(key)
    for k in range(LOW, HIGH + 1):
        part = key[ends[k - LOW]:ends[k - LOW + 1]]
        chars = np.empty((len(part), k), "<u4")
        for j in range(k):
            chars[:, j] = alphabet[((part >> np.uint64(bits * (k - 1 - j))) & np.uint64((1 << bits) - 1)).astype(np.int64) - 1]
        flat = chars.tobytes().decode("utf-32-le")
        terms += [flat[i:i + k] for i in range(0, len(flat), k)]
    return terms, n


def word_gram_counts(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Words of two or more characters and pairs of neighbours; words are already parted by single blanks."""
    lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    words, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    long = pc.greater_equal(pc.utf8_length(words), 2)
    words, doc = words.filter(long).dictionary_encode(), doc.filter(long).to_numpy().astype(np.uint64)
    if not len(words):
        return pa.array([], pa.large_string()), np.array([], np.int64)
    names, ids = words.dictionary, words.indices.to_numpy().astype(np.uint64)
    bits = len(names).bit_length()
    one, n_one = texts_per_key(doc, ids, bits)
    same = doc[1:] == doc[:-1]
    two, n_two = texts_per_key(doc[1:][same], (ids[:-1][same] << np.uint64(bits)) | ids[1:][same], 2 * bits)
    left, right = (names.take(pa.array(i.astype(np.int64))) for i in (two >> np.uint64(bits), two & np.uint64((1 << bits) - 1)))
    pairs = pc.binary_join_element_wise(left, right, pa.scalar(" ", pa.large_string()))
    return pa.concat_arrays([names.take(pa.array(one.astype(np.int64))), pairs]), np.concatenate([n_one, n_two])


def slices(texts: pa.Array, limit: int) -> Iterator[list[str]]:
    """The texts in lists of bounded size."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and (size + n > limit or i - start >= SLICE_TEXTS):
            yield [t or "" for t in texts.slice(start, i - start).to_pylist()]
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield [t or "" for t in texts.slice(start).to_pylist()]


def document_frequency(df: DataFrame, text: Column, count: Callable, min_df: int = 1) -> DataFrame:
    """``term, df`` with ``count`` for every slice of each task's texts; counts of a term meet in one combined shuffle."""
    limit = WORD_SLICE_BYTES if count is word_gram_counts else SLICE_BYTES

    def counted(batches):
        for batch in batches:
            for texts in slices(batch.column(0), limit):
                terms, n = count(texts)
                if len(terms):
                    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()) if isinstance(terms, list) else terms.cast(pa.string()), pa.array(n, pa.int64())], ["term", "n"])

    v = df.select(text.alias("text")).mapInArrow(counted, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("df"))
    return v.filter(F.col("df") >= min_df) if min_df > 1 else v
