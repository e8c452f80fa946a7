"""Near copies against brute force over all pairs."""

import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import simhash as S


def slow_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    rows = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abAB É\t\n\x0b\x1c ß", max_size=60))
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) % (1 << 64) == slow_fingerprint(text)


def test_long_text_in_pieces(monkeypatch):
    from ledgerline.llm import common

    text = " ".join(f"w{i % 977}" for i in range(70_000))
    whole = S.fingerprint(text.encode())
    for raw in (b"", b" ", b"a", b" a  b\n", b"ab" * 30 + b" c ", text.encode()):
        for size in (1, 2, 7, 1 << 20):
            pieces = list(common.word_pieces(raw, size))
            assert pieces and [w for p in pieces for w in p] == raw.split()
    monkeypatch.setattr(S, "word_pieces", lambda raw: common.word_pieces(raw, 10))
    assert S.fingerprint(text.encode()) == whole == slow_fingerprint(text) - (1 << 64) * (slow_fingerprint(text) >> 63)


def test_near_pairs_against_all_pairs(spark):
    import random

    pick = random.Random(5)
    base = [pick.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    marks = set(base)
    for b in base:
        for _ in range(12):
            marks.add(b ^ sum(1 << i for i in pick.sample(range(64), pick.randint(1, 4))))
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    for distance in (0, 1, 2):
        want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) % (1 << 64)).bit_count() <= distance}
        got = S.near_pairs(spark.createDataFrame([(m,) for m in signed], "fp long"), distance).collect()
        assert len(got) == len(want) and {(r.a, r.b) for r in got} == want
    with pytest.raises(ValueError):
        S.near_pairs(spark.createDataFrame([], "fp long"), 3)


def test_roots_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 30)] + [(201, 200), (201, 202), (202, 200)]
    got = {r.node: r.root for r in S.roots(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200, 202: 200}
    assert S.roots(spark.createDataFrame([], "a long, b long")).count() == 0


def corpus():
    import random

    pick = random.Random(3)
    rows = []
    for g in range(12):
        words = [pick.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(pick.randint(0, 50)) for _ in range(300)]
        for k in range(5):
            copy = list(words)
            for _ in range(k // 2):
                copy[pick.randrange(300)] = "changed"
            rows.append((pick.randint(0, 10_000), " ".join(copy)))
    rows += [(7, None), (8, ""), (9, " \n"), (None, "one two"), (11, "one two"), (11, "ONE two"), (None, "alone here now")]
    return rows + rows[:2]


def test_components_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "clash", d) for d, t in rows], "doc_id long, text string, fp string, component_id long")
    key = lambda r: tuple((x is None, x) for x in r)
    got = [tuple(r) for r in S.near_copies(df).collect()]
    assert sorted(got, key=key) == sorted((x for x in slow_rows(rows)), key=key)


def slow_rows(rows):
    safe = [(d, t) for d, t in rows]
    marks = [slow_fingerprint(t) for _, t in safe]
    group = list(range(len(safe)))
    changed = True
    while changed:
        changed = False
        for i in range(len(safe)):
            for j in range(len(safe)):
                if group[j] < group[i] and (marks[i] ^ marks[j]).bit_count() <= 2:
                    group[i], changed = group[j], True
    for i, (d, _) in enumerate(safe):
        ids = [x for (x, _), g in zip(safe, group) if g == group[i] and x is not None]
        yield d, f"{marks[i]:016x}", min(ids, default=None)


def test_one_of_each_stays(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x", "root") for d, t in rows], "doc_id long, text string, source string, root string")
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    groups = {}
    for (d, t), g in zip(rows, components(rows)):
        groups.setdefault(g, []).append((d, t))
    assert len(got) == len(groups)
    for g, members in groups.items():
        best = min(members, key=lambda r: (r[0] is None, r[0]))[0]
        assert sum(1 for r in got if r in members and r[0] == best) == 1


def components(rows):
    marks = [slow_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for _ in range(len(rows)):
        for i in range(len(rows)):
            group[i] = min(group[j] for j in range(len(rows)) if (marks[i] ^ marks[j]).bit_count() <= 2)
    return group


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_copies(df).count() == 0 and S.keep_one(df).count() == 0


def test_cells_of_few_fingerprints_are_not_broadcast(spark, tmp_path):
    # A table of fingerprints below Spark's broadcast size, whose cells are thirty times as large.
    spark.range(2000).selectExpr("xxhash64(id) AS fp", "id AS first").write.parquet(str(tmp_path / "nodes"))
    plan = S.near_pairs(spark.read.parquet(str(tmp_path / "nodes")))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
