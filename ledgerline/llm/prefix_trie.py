"""Trie of conversation prefixes: how many conversations share each opening, and what a cache of it would save.

Conversations become rows of turn ids (128 bits of role and text).  Rows are dealt into range shards by their ids, ties by
conversation, so the members of a node lie next to each other and equal conversations may fill several shards.  In a
shard, padded matrices of ids, a block of depths at a time, are sorted with ``lexsort``; changes between neighbouring rows,
OR-accumulated along the columns, show at which depth each row starts new nodes; ``reduceat`` over these starts gives
the figures of all nodes of a depth.

A node inside a shard is complete.  Nodes on the path of a shard's first or last row may go on in the next shard: their
figures are parts, joined by the digest of their ids.  Two neighbouring shards share exactly the path down to their
deepest common node, so what they both counted is known from that node alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

#: Columns of a padded matrix, turns a shard should hold, conversation ids in one piece of a node's list.
BLOCK, SHARD_TURNS, PIECE = 8, 1 << 19, 1 << 14
#: Sorts before every id; shorter conversations come first.
PAD = np.iinfo(np.int64).min
NOTHING = hashlib.sha256(b"").hexdigest()
TURNS = "array<struct<a:bigint,b:bigint,chars:int>>"
#: ``kind`` of a piece: a whole node, a whole node below an edge node, a part of an edge node, a piece of its members' ids.
WHOLE, BELOW_EDGE, EDGE, ENDS = range(4)
FIGURES = ["depth", "n_convs", "n_children", "n_leaves", "saved", "member_chars", "node_chars", "path_chars", "chars"]
PIECES = (
    "kind int, shard int, number long, parent long, conv_id long, parent_conv_id long, " + ", ".join(f"{c} long" for c in FIGURES)
    + ", stops boolean, key binary, parent_key binary, part long, ends string"
)


def turn_id(role: Column, text: Column) -> Column:
    """struct (a, b, chars) that stands for a turn; null counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b"), F.length(text).alias("chars"))


def conversation_rows(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv_id, turns): the turn ids of each conversation, by turn, null first, rows of one turn by their ids.

    Only ids are moved, no texts.  The ids of one conversation are one value.
    """
    row = F.struct(F.col("turn"), turn_id(F.col("role"), F.col("text")).alias("id"))
    listed = turns.select(F.col(conv).cast("long").alias("conv_id"), row.alias("row")).groupBy("conv_id").agg(F.collect_list("row").alias("rows"))
    return listed.select("conv_id", F.transform(F.array_sort("rows"), lambda r: r["id"]).cast(TURNS).alias("turns"))


class Shard:
    """The rows of one shard in trie order, and the depth from which each starts new nodes."""

    def __init__(self, conv: np.ndarray, unnamed: np.ndarray, starts: np.ndarray, ids: np.ndarray, chars: np.ndarray) -> None:
        by_conv = np.lexsort((conv, ~unnamed))
        self.sizes, self.ids = np.diff(starts), ids
        order, self.fresh = self.sorted_rows(by_conv, starts[:-1])
        self.conv, self.unnamed, self.length, self.at = conv[order], unnamed[order], self.sizes[order], starts[:-1][order]
        self.total = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])

    def sorted_rows(self, order: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows in trie order (equal ones as given), and for each the first depth not shared with the row before it."""
        order, n = order.copy(), len(order)
        more = self.sizes > 0
        order = order[np.argsort(more[order], kind="stable")]
        fresh = np.full(n, -1, dtype=np.int64)
        places, group, depth = np.flatnonzero(more[order]), np.zeros(int(more.sum()), dtype=np.int64), 0
        while len(places):
            rows = order[places]
            columns = at[rows, None] + depth + np.arange(BLOCK)
            inside = depth + np.arange(BLOCK) < self.sizes[rows, None]
            matrix = np.where(inside[:, :, None], self.ids[np.where(inside, columns, 0)], PAD)
            flat = matrix.reshape(len(rows), 2 * BLOCK)
            longer = self.sizes[rows] > depth + BLOCK
            turned = np.lexsort((longer, *flat.T[::-1], group))
            order[places], matrix, inside, group, longer = rows[turned], matrix[turned], inside[turned], group[turned], longer[turned]
            rows = rows[turned]
            changed = np.ones((len(rows), BLOCK), dtype=bool)
            changed[1:] = (matrix[1:] != matrix[:-1]).any(axis=2)
            changed[1:, 0] |= group[1:] != group[:-1]
            changed = np.logical_or.accumulate(changed, axis=1)
            begins = changed & inside
            first = np.where(begins.any(axis=1) & (fresh[rows] < 0), begins.argmax(axis=1) + depth + 1, fresh[rows])
            fresh[rows] = first
            group, depth = np.cumsum(changed[:, -1])[longer], depth + BLOCK
            places = places[longer]
        # A row equal to the one before it starts nothing.
        fresh = np.where(fresh < 0, self.sizes + 1, fresh)
        return order, fresh[order]

    def path(self, row: int) -> list[bytes]:
        """Digest of the first d turn ids of a row, for every d from 0."""
        seen, ids = hashlib.sha256(), self.ids[self.at[row] : self.at[row] + self.length[row]]
        out = [seen.digest()]
        for one in ids:
            seen.update(one.tobytes())
            out.append(seen.digest())
        return out

    def named(self, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest conversation of each node, and whether that is the one without an id."""
        return np.minimum.reduceat(self.conv[rows], starts), np.logical_or.reduceat(self.unnamed[rows], starts)

    def levels(self) -> Iterator[dict[str, np.ndarray]]:
        """The nodes of every depth, with arrays of their figures.  ``first`` and ``last``: on the path of that row."""
        n, final = len(self.conv), self.at + self.length
        whole = self.total[final] - self.total[np.minimum(self.at + self.fresh - 1, final)]
        leaf = np.append(self.fresh[1:] <= self.length[:-1], True)
        rows, depth, given = np.arange(n), 0, 0
        node = np.full(n, -1, dtype=np.int64)
        above = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool))
        while len(rows):
            starts = np.flatnonzero(self.fresh[rows] <= depth) if depth else np.array([0])
            head = rows[starts]
            conv, unnamed = self.named(starts, rows)
            rest = self.total[final[rows]] - self.total[self.at[rows] + max(depth - 1, 0)]
            members, chars = np.add.reduceat(rest, starts), self.total[self.at[head] + depth] - self.total[self.at[head] + max(depth - 1, 0)]
            nodes = np.add.reduceat(whole[rows], starts) - whole[head] + rest[starts]
            ends = np.add.reduceat((self.length[rows] == depth).astype(np.int64), starts)
            parent = node[head]
            number = given + np.arange(len(starts))
            yield {
                "number": number, "parent": parent, "head": head, "first": head == 0, "last": (np.arange(len(starts)) == len(starts) - 1) & (rows[-1] == n - 1),
                "conv_id": conv, "unnamed": unnamed, "ends": ends, "parent_conv": above[0][parent - given + len(above[0])] if depth else np.zeros(1, dtype=np.int64),
                "parent_unnamed": above[1][parent - given + len(above[1])] if depth else np.ones(1, dtype=bool),
                "depth": np.full(len(starts), depth), "n_convs": np.diff(np.append(starts, len(rows))),
                "n_children": np.add.reduceat(((self.fresh[rows] <= depth + 1) & (self.length[rows] > depth)).astype(np.int64), starts),
                "n_leaves": np.add.reduceat(leaf[rows].astype(np.int64), starts), "member_chars": members, "node_chars": nodes,
                "saved": members - nodes, "path_chars": self.total[self.at[head] + depth] - self.total[self.at[head]], "chars": chars,
            }
            marks = np.zeros(len(rows), dtype=np.int64)
            marks[starts] = 1
            node[rows] = given + np.cumsum(marks) - 1
            above, given, depth = (conv, unnamed), given + len(starts), depth + 1
            rows = rows[self.length[rows] >= depth]

    def ids_of(self, head: int, n: int) -> str:
        """Decimal ids of ``n`` conversations from a row on, with commas; the one without an id is empty."""
        return ",".join("" if no else str(c) for c, no in zip(self.conv[head : head + n].tolist(), self.unnamed[head : head + n].tolist(), strict=True))


def shard_pieces(shard: Shard, which: int) -> Iterator[dict[str, list]]:
    """Rows of ``PIECES``, as lists by column, one set per depth."""
    n = len(shard.conv)
    first, last = shard.path(0), shard.path(n - 1)
    edges: set[int] = set()
    for level in shard.levels():
        depth, m = int(level["depth"][0]), len(level["head"])
        edge = level["first"] | level["last"]
        edges_above, edges = edges, set(level["number"][edge].tolist())
        below = np.isin(level["parent"], list(edges_above))
        digests = [hashlib.sha256(shard.ids_of(h, e).encode()).hexdigest() if e else NOTHING for h, e in zip(level["head"].tolist(), np.where(edge, 0, level["ends"]).tolist(), strict=True)]
        keys = [(first if f else last)[depth] if e else None for f, e in zip(level["first"].tolist(), edge.tolist(), strict=True)]
        above = [(first if f else last)[depth - 1] if e and depth else None for f, e in zip(level["first"].tolist(), edge.tolist(), strict=True)]
        out = {c: level[c].tolist() for c in ("number", "parent", *FIGURES)}
        out["kind"] = np.where(edge, EDGE, np.where(below, BELOW_EDGE, WHOLE)).tolist()
        out["conv_id"] = [None if no else c for c, no in zip(level["conv_id"].tolist(), level["unnamed"].tolist(), strict=True)]
        out["parent_conv_id"] = [None if no else c for c, no in zip(level["parent_conv"].tolist(), level["parent_unnamed"].tolist(), strict=True)]
        out |= {"stops": (level["last"] & (shard.length[n - 1] == depth)).tolist(), "key": keys, "parent_key": above, "part": [0] * m, "ends": digests, "shard": [which] * m}
        yield out
        for i in np.flatnonzero(edge & (level["ends"] > 0)).tolist():
            head, count = int(level["head"][i]), int(level["ends"][i])
            for part, at in enumerate(range(0, count, PIECE)):
                some = shard.ids_of(head + at, min(PIECE, count - at))
                yield {"kind": [ENDS], "shard": [which], "key": [keys[i]], "part": [part], "ends": [some]}


def cut_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the nodes of one partition of (conv_id, turns)."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    conv = pa.concat_arrays([b.column(0) for b in held])
    turns = pa.concat_arrays([b.column(1) for b in held])
    each = turns.flatten()
    sizes = np.array([len(x) if x is not None else 0 for x in turns]) if turns.null_count else np.diff(turns.offsets.to_numpy())
    ids = np.stack([each.field(0).to_numpy(), each.field(1).to_numpy()], axis=1)
    unnamed = conv.is_null().to_numpy(zero_copy_only=False)
    shard = Shard(conv.fill_null(0).to_numpy(), unnamed, np.concatenate([[0], np.cumsum(sizes)]), ids, each.field(2).to_numpy())
    del held, conv, turns, each
    names = [f.name for f in ARROW]
    rows: dict[str, list] = {c: [] for c in names}
    for piece in shard_pieces(shard, TaskContext.get().partitionId()):
        n = len(piece["kind"])
        for c in names:
            rows[c] += piece.get(c) or [None] * n
        if len(rows["kind"]) >= 1 << 14:
            yield pa.RecordBatch.from_pydict(rows, schema=ARROW)
            rows = {c: [] for c in names}
    yield pa.RecordBatch.from_pydict(rows, schema=ARROW)


_TYPES = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
ARROW = pa.schema([(x.split()[0], _TYPES[x.split()[1]]) for x in PIECES.split(", ")])


def joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends): SHA-256 of the pieces of a key, in the order they come; one digest is held at a time."""
    key, seen = None, None
    for batch in batches:
        out: list[tuple[bytes, str]] = []
        for k, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key:
                if seen is not None:
                    out.append((key, seen.hexdigest()))
                key, seen = k, hashlib.sha256(piece.encode())
            else:
                seen.update(b"," + piece.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([e for _, e in out])], names=["key", "ends"])
    if seen is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([seen.hexdigest()])], names=["key", "ends"])


def recombined(pieces: DataFrame) -> DataFrame:
    """(key, conv_id, parent_key, figures, ends): edge nodes put together from the parts of all shards."""
    edges = pieces.filter(F.col("kind") == EDGE)
    # The shards of a node follow one another; neighbours share the path down to the deepest node that both have.
    spans = edges.withColumn("twice", F.lead("shard").over(Window.partitionBy("key").orderBy("shard")).isNotNull())
    meet = spans.filter("twice").groupBy("shard").agg(F.max(F.struct("depth", "path_chars", "stops")).alias("meet"))
    parts = spans.join(meet, "shard", "left")
    both = F.col("twice") & F.col("meet").isNotNull()
    again = both & (F.col("meet.depth") > F.col("depth"))
    shared = F.when(both, F.col("meet.path_chars") - F.col("path_chars") + F.col("chars")).otherwise(0)
    nodes = parts.groupBy("key").agg(
        F.when(F.max(F.col("conv_id").isNull()), F.lit(None)).otherwise(F.min("conv_id")).alias("conv_id"), F.max("parent_key").alias("parent_key"),
        F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"), F.sum(F.col("n_children") - again.cast("long")).alias("n_children"),
        F.sum(F.col("n_leaves") - (both & F.col("meet.stops")).cast("long")).alias("n_leaves"),
        F.sum(F.col("member_chars") - F.col("node_chars") + shared).alias("saved"),
    )
    listed = pieces.filter(F.col("kind") == ENDS).select("key", "shard", "part", "ends").repartition("key").sortWithinPartitions("key", "shard", "part")
    ends = listed.select("key", "ends").mapInArrow(joined_digests, "key binary, ends string")
    return nodes.join(ends, "key", "left").withColumn("ends", F.coalesce("ends", F.lit(NOTHING)))


def trie_nodes(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): every node of the trie.

    ``rows`` has conv_id (integer, one row each) and turns (``TURNS``, as ``conversation_rows`` gives them; empty or null:
    no turns).  The root has depth 0 and all conversations, also those without turns.  A node is named by its smallest
    conversation and its depth; a null conv_id is smaller than all others and empty in the digested list.  Parent of
    the root: null.  An empty table gives no rows; other columns are ignored.
    """
    rows = stored(rows.select("conv_id", F.coalesce(F.col("turns"), F.array().cast(TURNS)).alias("turns")), "conversation-rows")
    size = rows.agg(F.sum(F.size("turns") + 1).alias("n")).first()["n"] or 0
    width = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_turns), 1)
    dealt = rows.repartitionByRange(width, "turns", "conv_id")
    pieces = stored(dealt.mapInArrow(cut_shards, PIECES), "trie-pieces")
    edges = stored(recombined(pieces), "trie-edges")
    figures = ["depth", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    whole = pieces.filter(F.col("kind") == WHOLE).select("conv_id", "parent_conv_id", *figures)
    names = edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    # Nodes below an edge node ask for it by shard and number, so a node with many children isn't one hot key.
    places = pieces.filter(F.col("kind") == EDGE).select("shard", F.col("number").alias("parent"), F.col("key").alias("parent_key")).join(names, "parent_key")
    below = pieces.filter(F.col("kind") == BELOW_EDGE).drop("parent_conv_id", "parent_key").join(places, ["shard", "parent"])
    above = edges.join(names, "parent_key", "left")
    out = whole.unionByName(below.select("conv_id", "parent_conv_id", *figures)).unionByName(above.select("conv_id", "parent_conv_id", *figures))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The nodes (see ``trie_nodes``) of a table with columns ``conv``, turn, role and text, one row per turn.

    Turns are ordered by turn, null first; rows of one turn by their ids, repeated rows are repeated turns.  Null roles and
    texts are empty; rows with a null ``conv`` are one conversation; other columns are ignored.
    """
    return trie_nodes(conversation_rows(turns, conv))
