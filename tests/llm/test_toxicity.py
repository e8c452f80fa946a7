"""Lexicon automata against edit distances, quotation, held-out accuracy."""

import random
import zlib

from conftest import SF
from ledgerline.llm import toxicity as T
from ledgerline.sources.tables import SourceRegistry


def edits(a, b):
    """Restricted edit distance with swaps of neighbours."""
    d = {(-1, -1): 0}
    for i in range(len(a)):
        d[i, -1] = i + 1
    for j in range(len(b)):
        d[-1, j] = j + 1
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def slow_find(terms, word):
    best = None
    for text, is_open, weight in terms:
        for k in range(1, len(word) + 1) if is_open else [len(word)]:
            n = edits(text, word[:k])
            if n <= (1 if len(text) >= T.FUZZY_FROM else 0) and word[0] == text[0]:
                if best is None or (n, -weight) < (best[1], -best[0]):
                    best = (weight, n)
    return best


def test_automaton_against_edit_distance():
    pick = random.Random(6)
    for remembered in (1 << 18, 8):
        terms = [("".join(pick.choices("abc", k=pick.randint(3, 7))), pick.random() < 0.4, pick.randint(1, 9) / 2) for _ in range(12)]
        lexicon = T.Lexicon(terms, remembered)
        for _ in range(3000):
            word = "".join(pick.choices("abcd", k=pick.randint(1, 9)))
            assert lexicon.find(word) == slow_find(terms, word), (terms, word)


def test_quotation_and_misspelling():
    lexicon = T.Lexicon([("moron", False, 5.0)])
    names = dict(zip(T.INPUTS, range(len(T.INPUTS))))
    plain, wrong = lexicon.inputs("you are a moron today"), lexicon.inputs("you are a mroon today")
    quoted, said = lexicon.inputs('he used "moron" as an insult'), lexicon.inputs("she wrote the term moron there")
    assert plain[names["exact"]] > 0 and plain[names["addressed"]] > 0
    assert wrong[names["misspelled"]] > 0 and not wrong[names["exact"]]
    assert quoted[names["quoted_exact"]] > 0 and not quoted[names["exact"]]
    assert said[names["quoted_exact"]] > 0 and lexicon.inputs("")[:-1] == [0.0] * 7


def test_held_out(spark):
    t = SourceRegistry(spark, SF.replace("0.001", "0.01"))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "x"), (-1, None)], "doc_id long, text string")
    docs = t.documents.select("doc_id", "text").union(odd)
    rows = T.toxicity(docs.selectExpr("*", "1 AS label", "2 AS score"), t.labels).join(t.labels, "doc_id", "left").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    held = [r for r in rows if r.held_out and r.toxic is not None]
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.93
    assert all(r.score == 0.5 for r in T.toxicity(docs, t.labels.limit(0)).collect())
    assert T.toxicity(docs.limit(0), t.labels).count() == 0
