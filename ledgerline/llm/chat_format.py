"""Chat templates over typed content parts.

A turn is a list of parts: text, image, audio, document.  A visitor flattens them in order: text is escaped, every
other part becomes a numbered placeholder whose attachment reference and expanded token count (the tokens the model
will see in its place) are recorded.  Turns of a conversation are then put together under a template, with a loss
mask over what assistants say.

Escaping is reversible: ``%`` and the first sign of any control string become a percent code, so no text can
open or close a turn, and ``read`` gives back every role, text and part.
"""

from __future__ import annotations

import hashlib
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_row

OPEN, CLOSE, HOLD = "<|turn|>", "<|end|>", "<|{kind}:{n}|>"
#: Control strings of this template and of common others; their first sign is escaped inside texts.
CONTROL = re.compile(r"%|<(?=\||/?s>)|\[(?=/?INST\])")
ROLE = re.compile(r"%|[<\n\[]")
CODES = re.compile(r"%(25|3C|5B|0A)")
PLACE = re.compile(r"<\|(image|audio|document):([0-9]+)\|>")
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<n:int,kind:string,ref:string,tokens:bigint>"
#: Expanded tokens: an image by tiles, audio by time, a document by pages.
TILE, TILE_TOKENS, AUDIO_RATE, PAGE_TOKENS = 336, 576, 25.0, 1024


def escape(text: str, what: re.Pattern = CONTROL) -> str:
    return what.sub(lambda m: f"%{ord(m.group()):02X}", text)


def unescape(text: str) -> str:
    return CODES.sub(lambda m: chr(int(m.group(1), 16)), text)


class Flattener:
    """Visits the parts of one turn in order: the pieces of text and the attachments."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown kind of part: {kind}")
        method(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        tiles = math.ceil(max(part.get("width") or 1, 1) / TILE) * math.ceil(max(part.get("height") or 1, 1) / TILE)
        self.attach("image", part, tiles * TILE_TOKENS)

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, math.ceil(max(part.get("seconds") or 0.0, 0.0) * AUDIO_RATE))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, max(part.get("pages") or 1, 1) * PAGE_TOKENS)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        n = len(self.attachments)
        self.pieces.append(HOLD.format(kind=kind, n=n))
        self.attachments.append({"n": n, "kind": kind, "ref": part.get("ref"), "tokens": tokens})


def flatten_turn(role: str | None, parts: list[dict] | None) -> tuple[str, str, list[dict]]:
    """Head of the turn, its flattened body, its attachments."""
    visitor = Flattener()
    for part in parts or []:
        visitor.visit(part or {})
    return f"{OPEN}{escape(role or '', ROLE)}\n", "".join(visitor.pieces), visitor.attachments


def text_part(text: Column) -> Column:
    """A turn's parts where it is plain text."""
    rest = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *rest))


def format_chats(turns: DataFrame, conv: str = "conv_id", masked_role: str = "assistant") -> DataFrame:
    """(conv, formatted, loss, attachments, expanded_tokens): one row per conversation.

    ``turns`` has columns ``conv``, turn, role and parts (array of PART), or text instead of parts.  Turns are ordered by
    turn, null first, then role, text and parts; repeated rows are repeated turns.  ``loss`` holds (start, end) of the escaped bodies of
    ``masked_role`` turns, in code points.  Attachments are numbered within their turn and carry the turn's place;
    expanded_tokens is their sum.  Null roles and texts are empty; a null ``conv`` is a conversation.  An empty table
    gives no rows; other columns are ignored.  A conversation is put together in one task, as its row is one value.
    """
    parts = F.col("parts") if "parts" in turns.columns else text_part(F.coalesce(F.col("text"), F.lit("")))
    shaped = turns.select(F.col(conv), "turn", F.coalesce("role", F.lit("")).alias("role"), parts.cast(f"array<{PART}>").alias("parts"))
    made = f"head string, body string, attachments array<{ATTACHMENT}>"
    flat = per_row(shaped, [F.col("role"), F.col("parts")], lambda: flatten_turn, made, [conv, "turn", "role"])
    row = F.struct("turn", "role", "head", "body", "attachments")
    chats = flat.groupBy(conv).agg(F.array_sort(F.collect_list(row)).alias("turns"))
    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE + "\n")))
    # Where each turn's body starts: the lengths before it, and its own head.
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        body = state["at"] + F.length(t["head"])
        end = body + F.length(t["body"])
        span = F.array(F.struct(body.alias("start"), end.alias("end")))
        spans = F.when(t["role"] == masked_role, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((end + len(CLOSE) + 1).alias("at"), spans.alias("spans"))

    places = F.flatten(F.transform("turns", lambda t, i: F.transform(t["attachments"], lambda a: F.struct(
        i.alias("place"), a["n"].alias("n"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    out = chats.select(
        conv, F.array_join(pieces, "").alias("formatted"), F.aggregate("turns", start, step)["spans"].alias("loss"), places.alias("attachments")
    )
    return out.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))


def read(formatted: str) -> list[tuple[str, str]]:
    """Role and body, unescaped, of every turn; placeholders stay as they are.  The reverse of formatting."""
    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"no turn at {at}")
        line = formatted.index("\n", at)
        end = formatted.index(CLOSE, line + 1)
        out.append((unescape(formatted[at + len(OPEN) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(CLOSE) + 1
    return out


def read_back(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from ``formatted`` and ``loss`` alone.

    turns_sha256 is over role, newline, text, newline per turn; the loss columns over the unescaped text under the mask.
    """

    def digest(formatted: str, loss: list[dict]) -> tuple:
        turns, seen, chars = read(formatted), hashlib.sha256(), 0
        whole = hashlib.sha256()
        for role, text in turns:
            whole.update(f"{role}\n{text}\n".encode())
        for span in loss:
            text = unescape(formatted[span["start"] : span["end"]])
            seen.update(text.encode())
            chars += len(text)
        return len(turns), whole.hexdigest(), chars, seen.hexdigest(), len(formatted)

    schema = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return per_row(chats, [F.col("formatted"), F.col("loss")], lambda: digest, schema, [conv])
