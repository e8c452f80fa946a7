"""Conversation repair against a plain Python version."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

from ledgerline.llm import chat_repair as R
from ledgerline.llm.queries import damaged

TABLE = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")
SIGNS = "suaoSUAOx"


def slow_best(signature):
    """Cheapest (cost, audit) by trying all edits, with the roles so far checked by the grammar's pattern."""

    def opens(roles):
        return any(GRAMMAR.fullmatch(roles + rest) for rest in ("", "a", "ua"))

    @lru_cache(None)
    def go(i, last, n):
        # Only the last sign and whether anything stands before it matter.
        roles = {"": "", "s": "s", "u": "u", "a": "ua"}[last]
        found = [(0, "")] if i == len(signature) and GRAMMAR.fullmatch(roles) else []
        if n < 2:
            for new in "ua":
                if opens(roles + new):
                    c, x = go(i, new, n + 1)
                    found.append((c + 3, "I" + x))
        if i < len(signature):
            sign, cut = signature[i].lower(), 3 * signature[i].isupper()
            c, x = go(i + 1, last, 0)
            found.append((c + 4, "D" + x))
            if sign != "x":
                for new, letter, cost in [("u", "R", 3), ("a", "R", 3)] + ([(sign, "K", 0)] if sign != "o" else []):
                    if opens(roles + new):
                        c, x = go(i + 1, new, 0)
                        found.append((c + cost + cut, letter + x))
        return min(found, default=(10**9, ""))

    return go(0, "", 0)


def test_every_short_signature():
    automaton = R.Automaton()
    for n in range(5):
        for signs in itertools.product(SIGNS, repeat=n):
            assert automaton.audit("".join(signs)) == slow_best("".join(signs))
    # One node per distinct suffix.
    assert len(automaton.best) == sum(9**n for n in range(5))


def test_long_signatures():
    pick = random.Random(3)
    automaton = R.Automaton()
    for _ in range(200):
        word = "".join(pick.choices(SIGNS, k=pick.randint(5, 60)))
        assert automaton.audit(word) == slow_best(word)
    long = "uaUsx" * 40_000
    cost, audit = automaton.audit(long)
    assert len(audit.replace("I", "")) == len(long) and cost > 0


def slow(turns):
    """turns: (turn, role, text) as they lie; the report of one conversation."""
    blanks = " \t\n\x0b\x0c\r"
    seen, signs, counts = set(), "", [0, 0, 0]
    for _, role, text in turns:
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not text.strip(blanks):
            signs, counts[0] = signs + "x", counts[0] + 1
        elif (role, text) in seen:
            signs, counts[1] = signs + "x", counts[1] + 1
        elif text.rstrip(blanks)[-1] not in ".!?":
            signs, counts[2] = signs + initial.upper(), counts[2] + 1
        else:
            signs += initial
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    numbers = {t[0] for t in turns if t[0] is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    cost, audit = slow_best(signs)
    lines, at, state = [], 0, R.START
    for letter in audit:
        role, text = (None, "") if letter == "I" else turns[at][1:]
        at += letter != "I"
        if letter in "RI":
            role = "assistant" if state == R.AFTER_U else "user"
        if letter != "D":
            state = {"s": R.AFTER_S, "u": R.AFTER_U, "a": R.AFTER_A}[role[0]]
            lines.append(f"{role}:{text}")
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def made(seed, n):
    pick = random.Random(seed)
    out = []
    for c in range(n):
        for turn in sorted(pick.sample(range(12), pick.choice([1, 2, 4, 6, 9]))):
            role = pick.choice(["user", "assistant", "system", "tool", "ux", "", None]) if pick.random() < 0.3 else ["user", "assistant"][turn % 2]
            out.append((c or None, turn if turn else None, role, pick.choice(["Yes.", "No!\n ", "cut off", "", None, " \x0b", "a. b", "é?", "　", f"own {c} {turn}."])))
    return out


def by_hand(rows, breaks=False):
    convs = {r[0]: [] for r in rows}
    for c, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if breaks else 9
        role, text = (" " if breaks else "") if role is None else role, (" " if breaks else "") if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        convs[c] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted([(c, *slow(sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0)))) for c, turns in convs.items()], key=repr)


def test_against_brute_force(spark):
    rows = made(1, 400)
    df = spark.createDataFrame(rows, TABLE)
    assert sorted([tuple(r) for r in R.repair_report(df).collect()], key=repr) == by_hand(rows)
    assert sorted([tuple(r) for r in R.repair_report(damaged(df)).collect()], key=repr) == by_hand(rows, breaks=True)


def test_repaired_turns_follow_the_grammar(spark):
    df = spark.createDataFrame(made(2, 200), TABLE)
    turns = {}
    for r in R.repaired_turns(df, R.audits(df)).collect():
        turns.setdefault(r.conv_id, {})[r.place] = r.role[0]
    for roles in turns.values():
        assert sorted(roles) == list(range(len(roles))) and GRAMMAR.fullmatch("".join(roles[i] for i in range(len(roles))))


def test_hot_signature_repeats_and_empty(spark):
    rows = [(c, t, ["user", "assistant"][t], f"{c} {t}.") for c in range(3000) for t in range(2)] + [(-1, None, "user", "twice.")] * 3
    got = {r.conv_id: r for r in R.repair_report(spark.createDataFrame(rows, TABLE)).collect()}
    assert len(got) == 3001 and all(r.audit == "KK" and r.cost == 0 for c, r in got.items() if c >= 0)
    assert (got[-1].duplicate, got[-1].gaps, got[-1].audit) == (2, 0, "KDDI")
    assert R.repair_report(spark.createDataFrame([], TABLE)).collect() == []
    odd = spark.createDataFrame([(1, 0, "user", "x." * 200_000, "k", 1), (2, 5, "user", "", "k", 1)], f"{TABLE}, audit string, a int")
    got = {r.conv_id: r.audit for r in R.repair_report(odd).collect()}
    assert got == {1: "KI", 2: "D"}
