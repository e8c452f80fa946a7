"""Near copies by shared shingles against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import shingle_links as L
from ledgerline.llm import simhash as S


def slow_shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or ({" ".join(words)} if words else set())


def slow_similarity(a, b):
    one, two = slow_shingles(a), slow_shingles(b)
    return len(one & two) / len(one | two) if one | two else 1.0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abA \n", max_size=60), st.text(alphabet="abA \n", max_size=60))
def test_similarity(a, b):
    assert L.similarity(L.shingle_set(a.encode()).tobytes(), L.shingle_set(b.encode()).tobytes()) == slow_similarity(a, b)


def rows_with_copies():
    pick = random.Random(9)
    rows = []
    for g in range(25):
        words = [pick.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(pick.randint(0, 50)) for _ in range(pick.choice([60, 200, 900]))]
        for k in range(6):
            copy = list(words)
            for _ in range(k * len(words) // 200):
                copy[pick.randrange(len(words))] = f"changed{pick.randint(0, 99)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(900, None), (901, ""), (902, "one two"), (903, "one two three four"), (904, "ONE two"), (904, "ONE two"), (None, "one two")]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("turns", [8, 0])
def test_one_of_each_group_stays(spark, monkeypatch, turns):
    """With and without leaders: what they leave is found block by block."""
    monkeypatch.setattr(L, "TURNS", turns)
    monkeypatch.setattr(L, "BLOCK", 3)
    rows = rows_with_copies()
    marks = [S.fingerprint((t or "").encode()) % (1 << 64) for _, t in rows]
    linked = [[(marks[i] ^ marks[j]).bit_count() <= 2 or slow_similarity(rows[i][1], rows[j][1]) >= 0.8 for j in range(len(rows))] for i in range(len(rows))]
    group, changed = list(range(len(rows))), True
    while changed:
        low = [min(group[j] for j in range(len(rows)) if linked[i][j]) for i in range(len(rows))]
        changed, group = low != group, low
    want = sorted(min((rows[i][0] is None, rows[i][0] or 0) for i in range(len(rows)) if group[i] == g) for g in set(group))
    df = spark.createDataFrame([(d, t, "x", 1.5) for d, t in rows], "doc_id long, text string, key string, _id double")
    kept = S.keep_one(df, similar=0.8)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == want


def test_parity_never_overstates():
    pick = np.random.default_rng(2)
    for _ in range(300):
        both = pick.integers(0, 2**63, pick.integers(0, 400), dtype=np.uint64)
        a = np.unique(np.concatenate([both, pick.integers(0, 2**63, pick.integers(0, 300), dtype=np.uint64)]))
        b = np.unique(np.concatenate([both, pick.integers(0, 2**63, pick.integers(0, 3000), dtype=np.uint64)]))
        apart = len(np.setxor1d(a, b))
        found = L.differ_at_least(*[L.parity(x, L.parity_bits(len(x))).tobytes() for x in (a, b)])
        short = L.differ_at_least(*[L.folded(L.parity(x, L.parity_bits(len(x))), L.SHORT // 8).tobytes() for x in (a, b)])
        assert short <= found <= apart


def test_sieve_holds_all_its_numbers(spark, monkeypatch):
    pick = np.random.default_rng(7)
    own = pick.integers(-(2**63), 2**63 - 1, 3000)
    df = spark.createDataFrame([(int(x),) for x in own], "n long").repartition(5)
    for limits in (L.SIEVE, (1 << 16, 1 << 16)):
        monkeypatch.setattr(L, "SIEVE", limits)
        sieve = L.sieve_of(df, "n")
        others = pick.integers(-(2**63), 2**63 - 1, 3000)
        assert L.held_by(sieve, own).all() and L.held_by(sieve, others).mean() < 0.1
    assert not L.held_by(L.sieve_of(df.limit(0), "n"), own).any()


def test_prefixes_of_near_sets_meet():
    pick = np.random.default_rng(3)
    counts = pick.integers(0, 5, L.CELLS)
    for _ in range(300):
        a = np.unique(pick.integers(0, 2**64, pick.integers(1, 200), dtype=np.uint64))
        b = np.unique(np.concatenate([a[pick.random(len(a)) < 0.9], pick.integers(0, 2**64, pick.integers(0, 10), dtype=np.uint64)]))
        if len(b) and L.similarity(a.tobytes(), b.tobytes()) >= 0.8:
            assert set(L.prefix(a, counts, 0.8).tolist()) & set(L.prefix(b, counts, 0.8).tolist())


def kept_by_brute_force(rows):
    marks = [S.fingerprint(t.encode()) % (1 << 64) for _, t in rows]
    sets = [slow_shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            near = len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
            if (near or (marks[i] ^ marks[j]).bit_count() <= 2) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    return sorted(min(rows[i][0] for i in range(len(rows)) if group[i] == g) for g in set(group))


@pytest.mark.parametrize("order", ["by counts", "passage first"])
def test_pairs_among_texts_that_share_a_passage(spark, monkeypatch, order):
    """120 pairs of copies and 60 single texts, all with one passage; once in an order that puts all into the same buckets."""
    pick = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(120))
    rows = []
    for g in range(180):
        own = [f"own{g}x{i}" for i in range(40)]
        for k in range(2 if g < 120 else 1):
            copy = list(own)
            if k:
                copy[pick.randrange(36)] = f"changed{g}"
            rows.append((len(rows), passage + " " + " ".join(copy)))
    pick.shuffle(rows)
    if order == "passage first":
        common = set(L.cell_of(L.shingle_set(passage.encode())).tolist())
        first = np.array([0 if i in common else 1 for i in range(L.CELLS)])
        monkeypatch.setattr(L, "merged", lambda *how, real=L.merged: first if how[3] is np.uint32 else real(*how))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in S.keep_one(df, similar=0.8).collect()) == kept_by_brute_force(rows)


def test_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, " ")], "doc_id long, text string")
    assert [r.doc_id for r in S.keep_one(df, similar=0.8).collect()] == [1]
