"""Token counts without running the whole encoder.

A pre-token that the vocabulary holds as one whole entry does not always encode as one token: the merge order may
never build it.  ``prove_whole`` encodes each vocabulary entry alone, once, on the driver, and keeps those that
come out as a single token; a pre-token encodes by itself, so what is proven there holds in every text.  Counting
a text is then: cut it at special tokens, normalise, cut into pre-tokens, count those proven whole directly, and run
the merges for the rest only (remembered in a bounded table per task).
"""

from __future__ import annotations

import json
import re

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clear_text, per_row

#: Pre-tokens whose count a task remembers besides the proven ones.
MEMORY = 1 << 19
#: Beyond these Latin letters texts go through the library's normaliser.  Up to them, composing changes nothing, lower
#: case is the same letter by letter, and runs of white space are dropped by the cut anyway.
BEYOND_LATIN = re.compile("[^\x00-\u024f]")


class Tokens:
    """Counts tokens as the library does for a tokenizer file of the word-end BPE kind, by its own parts."""

    def __init__(self, spec: str, whole: frozenset[str] | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        layout = json.loads(spec)
        cuts = [x["pattern"]["Regex"] for x in layout["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"]
        if len(cuts) != 1 or layout["model"]["type"] != "BPE":
            raise ValueError("a tokenizer with one splitting pattern and a BPE model is needed")
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in layout["added_tokens"]):
            raise ValueError("special tokens that strip, match words or match normalised text are not supported")
        self.cut = regex.compile(cuts[0])
        self.suffix = layout["model"]["end_of_word_suffix"] or ""
        names = sorted((x["content"] for x in layout["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        steps = [x["type"] for x in layout["normalizer"].get("normalizers", [])]
        self.simple = steps == ["NFC", "Replace", "Lowercase"] and layout["normalizer"]["normalizers"][1]["content"] == " "
        self.letters = byte_letters()
        self.counts: dict[str, int] = dict.fromkeys(whole or (), 1)
        self.proven = len(self.counts)

    def merged(self, pretoken: str) -> int:
        """Tokens of one pre-token, by the merges."""
        return len(self.tokenizer.model.tokenize("".join(self.letters[b] for b in pretoken.encode())))

    def prove_whole(self) -> frozenset[str]:
        """Pre-tokens, as text, whose vocabulary entry encodes alone as one token."""
        back = {c: b for b, c in self.letters.items()}
        found = set()
        for entry in self.tokenizer.get_vocab(with_added_tokens=False):
            name = entry[: -len(self.suffix)] if self.suffix and entry.endswith(self.suffix) else entry
            if (self.suffix and not entry.endswith(self.suffix)) or not all(c in back for c in name):
                continue
            try:
                text = bytes(back[c] for c in name).decode()
            except UnicodeDecodeError:
                continue
            if text and self.merged(text) == 1:
                found.add(text)
        return frozenset(found)

    def count(self, text: str) -> int:
        if self.special is None:
            return self.count_plain(text)
        total, at = 0, 0
        for found in self.special.finditer(text):
            total += self.count_plain(text[at : found.start()]) + 1
            at = found.end()
        return total + self.count_plain(text[at:] if at else text)

    def count_plain(self, text: str) -> int:
        if not text:
            return 0
        known = self.counts
        latin = self.simple and not BEYOND_LATIN.search(text)
        pretokens = self.cut.findall(text.lower() if latin else self.tokenizer.normalizer.normalize_str(text))
        direct = list(map(known.get, pretokens))
        if None not in direct:
            return sum(direct)
        total = 0
        for pretoken, n in zip(pretokens, direct, strict=True):
            if n is None:
                n = known.get(pretoken)
            if n is None:
                n = self.merged(pretoken)
                if len(known) < self.proven + MEMORY and len(pretoken) <= 64:
                    known[pretoken] = n
            total += n
        return total


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def read_spec(path: str) -> str:
    """The tokenizer file's text, read on the driver; tasks get it by broadcast (a vocabulary file, under 2 MB)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def token_counts(docs: DataFrame, path: str, limit: int = 2048, ident: str = "doc_id") -> DataFrame:
    """(ident, n_bytes, n_tokens, over_limit) for every row; ``over_limit`` is n_tokens > ``limit``.

    Whole texts, no truncation, no begin or end token; special strings inside a text count as their one token, the
    library's default.  Null and empty texts have 0 bytes and tokens.  Repeated rows and idents keep a row each; an
    empty table gives no rows; other columns are ignored.
    """
    spec = read_spec(path)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((spec, Tokens(spec).prove_whole()))

    def make():
        counter = Tokens(*shared.value)
        return lambda text: (counter.count(text),)

    counted = per_row(docs.withColumn("_bytes", F.octet_length(clear_text()).cast("long")), [clear_text()], make, "n_tokens long", [ident, "_bytes"])
    return counted.select(ident, F.col("_bytes").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
