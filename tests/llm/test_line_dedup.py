"""Line dedup against a plain Python version."""

import random

from ledgerline.llm import line_dedup as D

LOW = {c: c + 32 for c in range(65, 91)}
BIG = 1 << 70


def slow(rows, shortest=10, threshold=2):
    """Sorted (doc_id, text, n_lines, n_dropped)."""
    cut = [(doc, (text or "").split("\n")) for doc, text in rows]
    key = lambda line: line.strip(D.BLANKS).translate(LOW)
    rank = lambda doc: BIG if doc is None else doc
    held = {}
    for doc, lines in cut:
        for line in lines:
            held.setdefault(key(line), set()).add(rank(doc))
    out = []
    for doc, lines in cut:
        keep = [x for x in lines if len(key(x)) < shortest or len(held[key(x)]) < threshold or rank(doc) == min(held[key(x)])]
        out.append((doc, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=repr)


def check(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = D.dedup_lines(df, **how)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == slow(rows, **how)


def test_against_brute_force(spark):
    pick = random.Random(5)
    lines = ["", " ", "short", "exactly te", "nine char", "A line that Repeats", "a line that repeats\t", "\x0ba line THAT repeats\r", "ÉÀ É ligne répétée",
             "éà é ligne répétée", "　wide blanks are no blanks　", "x" * 10, "\x1cseparators stay", "\x00zero bytes stay"]
    rows = [(i if i % 9 else None, pick.choice([None, "", "\n", "\n\n"]) if pick.random() < 0.1 else "\n".join(pick.choices([*lines, f"only here {i} {i}"], k=pick.randint(1, 9))))
            for i in range(150)]
    rows += rows[:20] + [(3, "a line that repeats\nanother text under one id"), (3, "another text under one id"), (-5, "a line that repeats")]
    check(spark, rows)
    check(spark, rows, threshold=4, shortest=5)


def test_hot_line_and_long_text(spark):
    rows = [(i, f"a very common line\nown line number {i}\na very common line") for i in range(3000)]
    rows += [(9001, "\n".join(f"line {i % 4000} of a long text" for i in range(20_000))), (9000, "line 17 of a long text\nx")]
    check(spark, rows)


def test_empty_table_and_other_columns(spark):
    assert D.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    names = "doc_id long, text string, n_lines string, key int, row int, place int, h1 int, lines int, places int, `a.b` int, owner int"
    rows = [(1, "the same long line", "old", *[i] * 8) for i in range(2)] + [(2, "the same long line\nrest", None, *[None] * 8)]
    got = D.dedup_lines(spark.createDataFrame(rows, names))
    assert got.columns == [c.strip("`").split("`")[0] if "`" in c else c.split()[0] for c in names.split(", ") if not c.startswith("n_lines")] + ["n_lines", "n_dropped"]
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_dropped, r.key) for r in got.collect() if r.doc_id == 1) == [(1, "the same long line", 1, 0, i) for i in range(2)]
    assert [(r.text, r.n_dropped, r["a.b"]) for r in got.collect() if r.doc_id == 2] == [("rest", 1, None)]
