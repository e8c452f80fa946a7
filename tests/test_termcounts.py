"""Terms counted by numbers against plain sets, also with many kinds of characters, zeros and odd blanks."""

import random
from collections import Counter

from ledgerline.operators import termcounts as TC
from ledgerline.operators import textmine as X
from pyspark.sql import functions as F


def plain_char_counts(texts):
    out = Counter()
    for text in texts:
        padded = [" " + w + " " for w in text.translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
        out.update({p[i:i + k] for p in padded for k in (3, 4, 5) for i in range(len(p) - k + 1)})
    return out


def summed(terms, n):
    out = Counter()
    for term, m in zip(terms if isinstance(terms, list) else terms.to_pylist(), list(n), strict=True):
        out[term] += int(m)
    return out


def odd_texts(kinds, n, length, seed=3):
    rng = random.Random(seed)
    letters = [chr(0x4E00 + i) for i in range(kinds)] + [" ", "\t", "\n\r", "\x0b", "\x00", "\x85", " ", " ", "a", "b", "\U0001f600"]
    return ["".join(rng.choices(letters, k=rng.randrange(length))) for _ in range(n)] + ["", " ", "x", "\x00", "ab\x00", "a b", "\U0010ffff"]


def test_char_grams_of_odd_texts():
    for kinds, n, length in ((3, 60, 40), (300, 40, 500), (6000, 3, 40_000), (1, 1, 2)):
        texts = odd_texts(kinds, n, length)
        assert summed(*TC.char_gram_counts(texts)) == plain_char_counts(texts)
    for texts in ([""], ["", " \n"], []):
        assert summed(*TC.char_gram_counts(texts)) == Counter()


def test_char_grams_equal_the_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(TC, "SLICE_BYTES", 500)
    texts = odd_texts(40, 200, 60) + [None, "İstanbul ΣΑΣ ẞ"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3, "doc_id")
    old = {r.term: r.df for r in X.document_frequency(df, X.char_gram_set("text"), 2).collect()}
    assert {r.term: r.df for r in TC.document_frequency(df, F.lower("text"), TC.char_gram_counts, 2).collect()} == old


def test_word_grams_equal_the_plain_ones(spark, monkeypatch):
    rng = random.Random(5)
    words = ["a", "bb", "Ä", "ÄÖ", "x_1", "\u00b2\u00b3", "\U0001f600", "\U00020000\U00020001", "\x00", "--", "don't", "中文", "٣٤", "BB"]
    texts = [rng.choice([" ", ", ", "\n", "\u00a0"]).join(rng.choices(words, k=rng.randrange(12))) for _ in range(300)] + [None, "", "bb", "a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3, "doc_id")
    old = {r.term: r.df for r in X.document_frequency(df, X.with_bigrams(X.word_array("text")), 2).collect()}
    for size in (1, 400, 1 << 18):
        monkeypatch.setattr(TC, "WORD_SLICE_BYTES", size)
        got = TC.document_frequency(df, F.regexp_replace(F.lower("text"), X.NO_WORD, " "), TC.word_gram_counts, 2).collect()
        assert {r.term: r.df for r in got} == old and len(got) == len(old)


def test_texts_are_not_exploded_into_rows(spark, tables):
    import __spark_entry__ as entry

    for name in ("char_ngrams", "word_ngrams"):
        plan = entry.queries()[name](spark, tables.root)._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "explode" not in plan, name
