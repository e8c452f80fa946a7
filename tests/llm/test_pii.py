"""Personal data: base patterns against plain regular expressions, the field's programme against enumeration."""

import random
import re
import time

import numpy as np

from ledgerline.llm import pii as P

MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def slow_base(t):
    out = [("email", *m.span()) for m in MAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(t):
        d = [int(c) for c in m.group() if c.isdigit()]
        total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1]))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]


def test_base_spans():
    pick = random.Random(8)
    for _ in range(8000):
        t = "".join(pick.choices(["a", ".", "@", "-", "1", " ", "9", "+", "é", "(", ")", "4111111111111111", "255", "0"], k=pick.randint(0, 25)))
        assert P.base_spans(t) == slow_base(t), t


def test_long_runs_take_linear_time():
    for t in ("x" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000):
        P.base_spans(t)


def all_segmentations(size, marks, scores, at=0):
    if at == size:
        yield 0.0, ()
        return
    for total, rest in all_segmentations(size, marks, scores, at + 1):
        yield total, rest
    for c, (i, j) in enumerate(marks):
        if i == at:
            for kind in range(scores.shape[1]):
                for total, rest in all_segmentations(size, marks, scores, j):
                    yield total + scores[c, kind], ((c, kind), *rest)


def test_programme_against_all_segmentations():
    rng = np.random.default_rng(3)
    for _ in range(20):
        marks = [(0, 2), (1, 3), (2, 3), (1, 5), (3, 5), (4, 6)]
        scores = rng.normal(size=(len(marks), 2))
        every = list(all_segmentations(6, marks, scores))
        best = max(every)
        got = P.best_segments(6, marks, scores)
        assert np.isclose(sum(scores[c, k] for c, k in got), best[0])
        whole, p = P.expected(6, marks, scores)
        z = np.logaddexp.reduce([t for t, _ in every])
        assert np.isclose(whole, z)
        for c in range(len(marks)):
            for k in range(2):
                assert np.isclose(p[c, k], sum(np.exp(t - z) for t, s in every if (c, k) in s))


def test_field_finds_disguised_spans_and_leaves_look_alikes():
    found = total = false = 0
    pick = random.Random(77)
    for _ in range(200):
        text, spans = P.example(pick)
        base = P.base_spans(text)
        got = set(base) | set(P.added_spans(text, base, P.trained(), P.LEAST_SCORE))
        found, total, false = found + len(got & set(spans)), total + len(spans), false + len(got - set(spans))
    assert found / total > 0.9 and false / total < 0.1
    clean = "Version 2.0 of 12 May 2021, page 14, $3,200.50, room 12-345, commit 9f8e7d6c5b4a39281706. We met at noon. Then left."
    assert P.added_spans(clean, [], P.trained(), P.LEAST_SCORE) == []
    two = "x 7536784127813050 4845168114407329 y"
    assert [two[a:b] for _, a, b in P.added_spans(two, P.base_spans(two), P.trained(), P.LEAST_SCORE)] == ["7536784127813050", "4845168114407329"]


def test_quick_features_equal_the_general_ones():
    pick = random.Random(5)
    seen = 0
    for _ in range(20000):
        t = "".join(pick.choices(["12", "7", "4111", "00", "255", ".", "-", " ", "(", ")", "+", "/", "_", "[", "]", "tel ", "x", "$", "·", "{"], k=pick.randint(1, 14)))
        a = pick.randrange(len(t))
        b = pick.randrange(a, len(t)) + 1
        quick = P.number_features(t, a, b, *P.start_facts(t, a)) if any(c.isdigit() for c in t[a:b]) else None
        if quick is not None:
            seen += 1
            assert dict(zip(P.SHAPES, quick)) == dict(zip(P.SHAPES, P.segment_features(t, a, b))), (t, a, b)
    assert seen > 5000


def test_field_on_sentences_written_by_hand():
    found = lambda t: [(k, t[a:b]) for k, a, b in P.base_spans(t) + P.added_spans(t, P.base_spans(t), P.trained(), P.LEAST_SCORE)]
    for plain in ("we met at noon.Then went home", "see it at page.html dot", "it broke at line 14.We saw", "look at file.txt please", "sold at 3.50 each",
                  "between 1990 and 2005, in 12 of 34 towns", "the game ended 21-14, 7-3 and 6-2", "call it a day at last. Then rest"):
        assert found(plain) == [], plain
    for text, span in (("write to john dot smith at example dot com today", "john dot smith at example dot com"), ("ask mary at mail.org now", "mary at mail.org"),
                       ("send to bob [at] shop [dot] net please", "bob [at] shop [dot] net")):
        assert found(text) == [("email", span)], text


def test_runs_of_short_numbers_are_quick():
    text = "12 34 56 78 " * 5000
    start = time.perf_counter()
    P.added_spans(text, P.base_spans(text), P.trained(), P.LEAST_SCORE)
    assert time.perf_counter() - start < 6


def test_rows_and_masking(spark):
    rows = [(1, "mail a.b@c.example or +1 (415) 555-1234"), (1, "mail a.b@c.example or +1 (415) 555-1234"), (2, None), (None, ""), (3, "10.0.0.1 é 4111111111111111")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, base int")
    got = sorted(((r.doc_id, [tuple(s) for s in r.base]) for r in P.find_spans(df).collect()), key=str)
    order = {k: i for i, k in enumerate(P.KINDS)}
    assert got == sorted(((i, sorted(slow_base(t or ""), key=lambda s: (order[s[0]], s[1]))) for i, t in rows), key=str)
    masked = P.mask(df)
    assert masked.columns == df.columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts == {1: "mail [EMAIL] or [PHONE]", 2: None, None: "", 3: "[IP] é [CARD]"}
    assert P.find_spans(df.limit(0)).count() == 0 and P.mask(df.limit(0)).count() == 0
    assert P.masked("abcdef", [("ip", 1, 4), ("card", 2, 5)]) == "a[IP]f"
