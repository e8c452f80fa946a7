"""Token counts against the library itself."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from ledgerline.llm import token_counts as C

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts():
    pick = random.Random(1)
    letters = list("abC é́İßǅ'sΣςẞ​　\x1c\x85\xad½²٣中日ok!?…\U0001f600ำ\n\t12") + [
        "<|endoftext|>", "<|startoftext|>", "<|endoftext", "'ll", "'S", " ", "worthless", "hello"]
    out = ["".join(pick.choices(letters, k=pick.randint(0, 40))) for _ in range(4000)]
    return out + ["", "a" * 5000, "x" + "<|endoftext|>" * 3, "hello world " * 3000]


def test_counts_against_the_library():
    spec = C.read_spec(PATH)
    counter, library = C.Tokens(spec, C.Tokens(spec).prove_whole()), Tokenizer.from_file(PATH)
    rows = texts()
    want = [len(e.ids) for e in library.encode_batch(rows, add_special_tokens=False)]
    assert [counter.count(t) for t in rows] == want


def test_proof_covers_each_entry():
    library = Tokenizer.from_file(PATH)
    proven = C.Tokens(C.read_spec(PATH)).prove_whole()
    assert len(proven) > 30_000
    sample = sorted(proven)[::97]
    cut = C.Tokens(C.read_spec(PATH)).cut
    for text in sample:
        if cut.findall(text.lower()) == [text]:
            assert len(library.encode(text, add_special_tokens=False).ids) == 1


def test_full_table_of_remembered_counts(monkeypatch):
    monkeypatch.setattr(C, "MEMORY", 2)
    spec = C.read_spec(PATH)
    counter, library = C.Tokens(spec, frozenset()), Tokenizer.from_file(PATH)
    rows = texts()[:300]
    assert [counter.count(t) for t in rows] == [len(e.ids) for e in library.encode_batch(rows, add_special_tokens=False)]
    assert len(counter.counts) <= 2


def test_rows(spark):
    library = Tokenizer.from_file(PATH)
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (None, "É!"), (3, ""), (4, "word " * 2049)]
    df = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, C.token_counts(df, PATH).collect()), key=str)
    want = []
    for d, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want, key=str)
    assert C.token_counts(df.limit(0), PATH).count() == 0
