"""The positional index against brute force."""

import hashlib
import random
import re

from ledgerline.llm import phrase_index as P

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def cut(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def slow(docs, items, window):
    for doc, text in docs:
        words, hit, names = cut(text), set(), set()
        for name, item in items:
            w = cut(item)
            n = min(window, len(w))
            parts = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
            for i in range(len(words) - n + 1 if n else 0):
                if tuple(words[i : i + n]) in parts:
                    hit.update(range(i, i + n))
                    names.add("" if name is None else str(name))
        yield (doc, len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
               bool(hit) and 20 * len(hit) >= len(words))


def rows(seed, letters, size):
    pick = random.Random(seed)
    text = lambda n: pick.choice([" ", "  ", "_", "-\n"]).join(pick.choice(letters) for _ in range(n))
    items = [(i % 7, text(pick.randint(0, 9))) for i in range(12)] + [(None, text(5)), (3, None), (4, "É é"), (4, "É é"), (100, "a")]
    docs = [(i, text(pick.randint(0, size))) for i in range(30)]
    docs += [(40 + i, text(4) + " " + (items[i][1] or "") + " " + text(3)) for i in range(12)]
    docs += [(None, "a b a"), (None, None), (5, ""), (6, "x É É é y"), docs[0], docs[0], (docs[1][0], docs[2][1])]
    return docs, items


def test_against_brute_force(spark):
    for seed, letters, size in ((1, "ab", 12), (2, "abcdefgh", 40), (3, ["aa", "bB", "cc", "Ä", "d9"], 60)):
        docs, items = rows(seed, letters, size)
        d = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, term string, pos int")
        b = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")
        got = P.contamination(d, b, window=4).drop("key").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, slow(docs, items, 4)))


def test_empty_sides(spark):
    docs, items = rows(2, "abc", 20)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    clean = P.contamination(d, b.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r.contaminated or r.n_hit for r in clean)
    assert P.contamination(d.limit(0), b).count() == 0


def test_contaminated_rows_go(spark):
    docs, items = rows(2, "abcdefgh", 40)
    d = spark.createDataFrame([(i, t, "kept") for i, t in docs], "doc_id long, text string, pos string")
    b = spark.createDataFrame(items, "item_id long, text string")
    bad = [r[5] for r in slow(docs, items, 13)]
    got = P.drop_contaminated(d, b)
    assert got.columns == d.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((*r, "kept")) for r, x in zip(docs, bad) if not x)


def test_proximity(spark):
    docs = [(1, "red one two fox three dog"), (2, "dog fox red"), (3, "red x x x x x x x x fox dog"), (4, "fox dog"), (None, "fox red dog")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(7, "Red fox dog"), (8, "missing fox")], "item_id long, text string")
    terms = P.phrase_terms(b)
    index = P.build_index(d, terms)
    got = {(r.doc, r.pos) for r in P.proximity(terms, index, 3).collect()}
    words = {i: cut(t) for i, t in docs}
    rare = "red"
    want = {(i, p) for i, w in words.items() for p, x in enumerate(w) if x == rare
            and all(any(y == z and abs(p - q) <= 3 for q, y in enumerate(w)) for z in ("red", "fox", "dog"))}
    assert got == want
