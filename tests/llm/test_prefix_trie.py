"""The prefix trie against a plain Python version."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerline.llm import prefix_trie as T
from ledgerline.llm import queries as Q
from ledgerline.llm.queries import rebuilt

TABLE = "conv_id long, turn long, role string, text string"


def slow(conversations):
    """Rows of ``trie_nodes`` for a dict of lists of (role, text); a None ident is smaller than all others."""
    order = lambda c: (c is not None, c or 0)
    members = defaultdict(list)
    for c in sorted(conversations, key=order):
        for d in range(len(conversations[c]) + 1):
            members[tuple(conversations[c][:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join("" if c is None else str(c) for c in m if len(conversations[c]) == len(p))
        out.append((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, conversations):
    rows = [(c, i, *turn) for c, turns in conversations.items() for i, turn in enumerate(turns)]
    return spark.createDataFrame(rows, TABLE)


def made(seed, n, deep=6, words=3):
    pick = random.Random(seed)
    out = {}
    for c in range(n):
        out[c * 7 - 50 if c else None] = [(pick.choice("ua"), "x" * pick.randint(0, words)) for _ in range(pick.choice([1, 1, 2, deep]))]
    return out


@pytest.mark.parametrize("width", [1, 7, 60])
def test_against_brute_force(spark, width):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        for seed, deep in ((1, 6), (2, 30)):
            some = made(seed, 150, deep)
            got = [tuple(r) for r in T.prefix_trie(table(spark, some)).collect()]
            assert sorted(got, key=repr) == slow(some)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_equal_conversations_in_many_shards(spark):
    some = {c: [("u", "hi"), ("a", "there")] for c in range(400)} | {1000 + c: [("u", "hi")] for c in range(300)}
    some |= {5000: [("u", "hi"), ("a", "there"), ("u", str(1))], 5001: [("u", "hi"), ("a", "there"), ("u", str(2))], 5002: [("a", "")]}
    rows = T.conversation_rows(table(spark, some))
    got = [tuple(r) for r in T.trie_nodes(rows, shard_turns=60).collect()]
    assert sorted(got, key=repr) == slow(some)


def test_blocks_of_a_shard_and_a_long_conversation(spark):
    long = [("u", str(i)) for i in range(700)]
    some = {1: long, 2: long[:699], 3: long[:8], 4: long[:16] + [("a", "z")], 5: long[:8], 6: long + long, 7: [("u", "é" * 5000)]}
    assert sorted([tuple(r) for r in T.prefix_trie(table(spark, some)).collect()], key=repr) == slow(some)


def test_turnless_empty_and_other_columns(spark):
    none = spark.createDataFrame([], TABLE)
    assert T.prefix_trie(none).collect() == []
    rows = spark.createDataFrame([(3, None), (None, []), (2, [])], f"conv_id long, turns {T.TURNS}")
    ends = hashlib.sha256(b",2,3").hexdigest()
    assert [tuple(r) for r in T.trie_nodes(rows).collect()] == [(None, 0, None, 3, 0, 1, 0, ends)]
    odd = spark.createDataFrame([(1, 0, None, None, 9, "k"), (1, None, "b", "first", 9, "k"), (1, 0, None, None, 9, "k")], f"{TABLE}, depth int, key string")
    assert sorted([tuple(r) for r in T.prefix_trie(odd).collect()], key=repr) == slow({1: [("b", "first"), ("", ""), ("", "")]})


def test_rebuilt_openings(spark):
    some = made(5, 90) | {200: [("u", "base")] * 7, 299: [("a", "own")], 0: [("u", str(i)) for i in range(3)], 300: [], 401: [("u", "alone")] * 6}
    some = {c: t for c, t in some.items() if t}
    cut = {}
    for c, turns in some.items():
        h = zlib.crc32(b"" if c is None else str(c).encode()) % 6
        base = [] if c is None else some.get(c - (abs(c) % 100) * (1 if c > 0 else -1), [])
        cut[c] = base[:h] + turns[h:]
    got = T.trie_nodes(rebuilt(T.conversation_rows(table(spark, some))))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == slow(cut)


def test_checksum_of_the_twin():
    import duckdb

    for text in ("0", "12:3", "987654321:-1"):
        assert duckdb.sql(f"SELECT {Q.crc32_sql(repr(text))}").fetchall()[0][0] == zlib.crc32(text.encode())
