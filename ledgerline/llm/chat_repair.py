"""Repair of conversation structure: the cheapest edits that make roles alternate, shared between all conversations.

A conversation is a signature, one sign per turn: must go (blank or repeated), or its role's initial, capital if the turn
is cut off.  Signatures are merged from the end: a node of the automaton is a sign and the node behind it, so
conversations that end alike share their nodes.  Per node and state of the role grammar the cost to go and the first
edit of the best audit are found once; the edit leads on to the best audit of a node behind it, which is shared, too.

Distinct signatures are dealt by their reversed text, so those that end alike meet in one task.  The texts are moved once,
to be read in order beside their audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, CUT_COST = 3, 4, 3, 3
#: States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEP = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
#: What an inserted or re-roled turn becomes in a state, and where that leads.
WANTED = [("user", AFTER_U), ("user", AFTER_U), ("assistant", AFTER_A), ("user", AFTER_U)]
#: Signs: a turn that must go; another initial.  A turn whose text is cut off has the capital sign.
GONE, OTHER = "x", "o"
SHARD_SIGNS, HOT = 1 << 20, 1000
BLANKS = "\\x20\\x09-\\x0D"
MARK = "struct<turn:bigint,a:bigint,b:bigint,sign:string,blank:boolean,initial:string>"


class Automaton:
    """Nodes, each a sign and the node behind it; node 0 is the end.  Equal suffixes are one node."""

    def __init__(self) -> None:
        self.register: dict[tuple[str, int], int] = {}
        self.behind = [0]
        self.best = [self.closed([(0, ""), None, None, (0, "")])]

    @staticmethod
    def closed(best: list[tuple[int, str] | None]) -> list[tuple[int, str]]:
        """Best (cost, edit) per state, when turns may be inserted before the node; at equal cost the smaller letter."""
        for _ in range(3):
            for state in (AFTER_A, AFTER_U, AFTER_S, START):
                onward = best[WANTED[state][1]]
                if onward is not None:
                    found = (onward[0] + INSERT_COST, INSERT)
                    best[state] = found if best[state] is None else min(best[state], found)
        return best

    def node(self, sign: str, behind: int) -> int:
        known = self.register.get((sign, behind))
        if known is not None:
            return known
        onward, out = self.best[behind], []
        cut = CUT_COST if sign.isupper() else 0
        for state in range(4):
            options = [(onward[state][0] + DELETE_COST, DELETE)]
            if sign != GONE:
                options.append((onward[WANTED[state][1]][0] + REROLE_COST + cut, REROLE))
                kept = STEP.get(sign.lower(), {}).get(state)
                if kept is not None:
                    options.append((onward[kept][0] + cut, KEEP))
            out.append(min(options))
        # Two options never share a letter, so the smaller letter decides between audits of one cost.
        self.best.append(self.closed(out))
        self.behind.append(behind)
        self.register[sign, behind] = len(self.best) - 1
        return len(self.best) - 1

    def add(self, signature: str) -> int:
        node = 0
        for sign in reversed(signature):
            node = self.node(sign, node)
        return node

    def audit(self, signature: str) -> tuple[int, str]:
        """Cost of the cheapest edits of a signature, and their letters in order."""
        node = self.add(signature)
        cost, edits, state, at = self.best[node][START][0], [], START, 0
        while True:
            edit = self.best[node][state][1]
            if not edit:
                return cost, "".join(edits)
            edits.append(edit)
            if edit == INSERT:
                state = WANTED[state][1]
                continue
            if edit == REROLE:
                state = WANTED[state][1]
            elif edit == KEEP:
                state = STEP[signature[at].lower()][state]
            node, at = self.behind[node], at + 1


def turn_hash(role: Column, text: Column) -> list[Column]:
    return [F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b")]


def turn_mark(turn: Column, role: Column, text: Column) -> Column:
    """What the repair has to know of a turn, without its text (``MARK``)."""
    initial = F.substring(role, 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit(OTHER))
    # The last sign that isn't blank ends a sentence: nothing is left of the text but its end.
    cut = ~text.rlike(f"[.!?][{BLANKS}]*\\z")
    return F.struct(
        turn.cast("long").alias("turn"), *turn_hash(role, text), F.when(cut, F.upper(known)).otherwise(known).alias("sign"),
        (~text.rlike(f"[^{BLANKS}]")).alias("blank"), initial.alias("initial"),
    ).cast(MARK)


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, signature) from (conv_id, marks), a batch at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = batch.column(1)
        sizes = np.diff(marks.offsets.to_numpy())
        each = marks.flatten()
        turn, a, b = each.field(0), each.field(1).to_numpy(), each.field(2).to_numpy()
        conv = np.repeat(np.arange(batch.num_rows), sizes)
        dated, turn = turn.is_valid().to_numpy(zero_copy_only=False), turn.fill_null(0).to_numpy()
        order = np.lexsort((b, a, turn, dated, conv))
        conv, a, b, turn, dated = conv[order], a[order], b[order], turn[order], dated[order]
        sign = np.array(each.field(3).to_pylist(), dtype="U1")[order]
        blank = each.field(4).to_numpy(zero_copy_only=False)[order]
        initial = np.array(each.field(5).to_pylist(), dtype="U1")[order]
        # Among equal turns of a conversation all but the first are repeated.
        alike = np.lexsort((np.arange(len(conv)), b, a, conv))
        same = np.zeros(len(conv), dtype=bool)
        same[1:] = (conv[alike][1:] == conv[alike][:-1]) & (a[alike][1:] == a[alike][:-1]) & (b[alike][1:] == b[alike][:-1])
        repeated = np.zeros(len(conv), dtype=bool)
        repeated[alike] = same
        repeated &= ~blank
        cut = np.char.isupper(sign) & ~blank & ~repeated
        sign = np.where(blank | repeated, GONE, sign)
        pair = np.char.add(initial[:-1], initial[1:])
        illegal = np.zeros(len(conv), dtype=bool)
        illegal[1:] = (conv[1:] == conv[:-1]) & ~np.isin(pair, ["su", "ua", "au"])
        new = np.ones(len(conv), dtype=bool)
        new[1:] = (conv[1:] != conv[:-1]) | (turn[1:] != turn[:-1]) | ~dated[:-1]
        n = batch.num_rows
        counts = [np.bincount(conv, weights=x, minlength=n).astype(np.int64) for x in (blank, repeated, cut, illegal, new & dated)]
        ends = np.cumsum(sizes)
        text = "".join(sign.tolist())
        words = [text[e - m : e] for e, m in zip(ends.tolist(), sizes.tolist(), strict=True)]
        gaps = []
        for i, (e, m) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
            kinds = int(counts[4][i])
            # Turns without a number come first; the last one is the largest.
            first = e - m + int(m - dated[e - m : e].sum())
            gaps.append(int(turn[e - 1]) - int(turn[first]) + 1 - kinds if kinds else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(gaps, pa.int64()), *[pa.array(x) for x in counts[:4]], pa.array(words, pa.string())],
            names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "signature"],
        )


def audits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(signature, cost, audit) of distinct signatures; one automaton per task."""
    automaton = Automaton()
    for batch in batches:
        words = batch.column(0).to_pylist()
        found = [automaton.audit(w) for w in words]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([c for c, _ in found], pa.int64()), pa.array([x for _, x in found], pa.string())],
            names=["signature", "cost", "audit"],
        )


def audits(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): one row per conversation, nulls included.

    ``turns`` has columns ``conv``, turn, role and text, one row per turn.  A column named ``present``, if there, tells
    rows that only name their conversation (false) from turns.  See ``repaired_turns`` for order and nulls.
    """
    there = F.col("present") if "present" in turns.columns else F.lit(True)
    mark = F.when(there, turn_mark(F.col("turn"), filled("role"), filled("text")))
    listed = turns.select(F.col(conv).cast("long").alias("conv_id"), mark.alias("mark")).groupBy("conv_id").agg(F.collect_list("mark").alias("marks"))
    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"
    signed = stored(listed.mapInArrow(signatures, schema), "chat-signatures")
    kinds = stored(signed.groupBy("signature").agg(F.count(F.lit(1)).alias("n")), "distinct-signatures")
    size = kinds.agg(F.sum(F.length("signature") + 1).alias("n"), F.sum("n").alias("convs")).first()
    width = max(1, -(-(size["n"] or 0) // SHARD_SIGNS))
    dealt = kinds.select("signature").repartitionByRange(width, F.reverse("signature"))
    solved = stored(dealt.mapInArrow(audits_of, "signature string, cost long, audit string"), "chat-audits")
    # A signature that more than one conversation in HOT has would be one hot key; there are at most HOT of them.
    hot = F.broadcast(kinds.filter(F.col("n") * HOT > (size["convs"] or 0)).select("signature").join(solved, "signature"))
    rest = signed.join(hot.select("signature"), "signature", "left_anti").join(solved, "signature")
    return rest.unionByName(signed.join(hot, "signature")).drop("signature")


def filled(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def apply_audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, place, role, text, edit) from (conv_id, audit, role, text), each conversation's audit first, then its turns."""
    conv, audit, state, at, place = None, "", START, 0, 0
    for batch in batches:
        out: list[tuple] = []

        def put(role: str, text: str, edit: str) -> None:
            nonlocal place, out
            out.append((conv, place, role, text, edit))
            place += 1

        def insert() -> None:
            nonlocal state, at
            while at < len(audit) and audit[at] == INSERT:
                role, state = WANTED[state]
                put(role, "", INSERT)
                at += 1

        for c, now, role, text in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if now is not None:
                conv, audit, state, at, place = c, now, START, 0, 0
            else:
                edit, at = audit[at], at + 1
                if edit == KEEP:
                    state = STEP[role[0]][state]
                    put(role, text, KEEP)
                elif edit == REROLE:
                    role, state = WANTED[state]
                    put(role, text, REROLE)
            insert()
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)],
                names=["conv_id", "place", "role", "text", "edit"],
            )


def repaired_turns(turns: DataFrame, judged: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv_id, place, role, text, edit): the turns left after the edits of ``judged`` (from ``audits``), in order.

    Each conversation lies in one partition, its turns in order.  Turns are ordered by turn, null first, rows of one turn by
    a hash of role and text, so equal rows stand together.  Null roles and texts are empty; rows with a null ``conv``
    are one conversation.  A blank turn, or one whose role and text stood earlier, goes; the others are kept, re-roled or
    deleted, and empty ones inserted, so that the initials of the roles are (s?(ua)+)? at the least cost, and at equal
    cost with the smallest audit.  A conversation without turns stays empty; an empty table gives no rows; other columns are
    ignored.
    """
    there = F.col("present") if "present" in turns.columns else F.lit(True)
    own = turns.filter(there).select(
        F.col(conv).cast("long").alias("conv_id"), F.lit(None).cast("string").alias("audit"), F.col("turn").cast("long").alias("turn"),
        *turn_hash(filled("role"), filled("text")), filled("role").alias("role"), filled("text").alias("text"),
    )
    no = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("a", "long"), ("b", "long"), ("role", "string"), ("text", "string"))]
    both = own.unionByName(judged.select("conv_id", "audit", *no))
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "a", "b")
    return dealt.select("conv_id", "audit", "role", "text").mapInArrow(apply_audits, "conv_id long, place long, role string, text string, edit string")


def conversation_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, repaired_sha256) of turns that come conversation by conversation, in order."""
    conv, seen = None, None
    for batch in batches:
        out: list[tuple] = []
        for c, place, role, text in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "place", "role", "text")], strict=True):
            if place == 0:
                if seen is not None:
                    out.append((conv, seen.hexdigest()))
                conv, seen = c, hashlib.sha256(f"{role}:{text}".encode())
            else:
                seen.update(f"\n{role}:{text}".encode())
        if out:
            yield digest_batch(out)
    if seen is not None:
        yield digest_batch([(conv, seen.hexdigest())])


def digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int64()), pa.array([x for _, x in rows])], names=["conv_id", "repaired_sha256"])


def repair_report(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): one row per conversation.

    repaired_sha256 is over ``role:text`` of the repaired turns, joined by newlines; over nothing if none is left.
    """
    judged = stored(audits(turns, conv), "chat-judged")
    digests = repaired_turns(turns, judged, conv).mapInArrow(conversation_digests, "conv_id long, repaired_sha256 string")
    digests = digests.withColumnRenamed("conv_id", "other")
    both = judged.join(digests, F.col("conv_id").eqNullSafe(F.col("other")), "left").drop("other")
    return both.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)))
