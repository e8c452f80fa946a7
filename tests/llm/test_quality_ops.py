"""Quality rules and the quality classifier."""

import random
import re

import numpy as np
import pytest

from conftest import SF
from ledgerline.llm import quality_model as M
from ledgerline.llm import quality_rules as Q
from ledgerline.sources.tables import SourceRegistry


def slow_base(text):
    t = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", t)
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


def texts():
    pick = random.Random(4)
    out = ["".join(pick.choices("aé b\n\t\x0b\x1c|#　", k=pick.randint(0, 60))) for _ in range(300)]
    return out + ["", None, "a b c a b c a b", " \n \n", "x x x x x x", "one\none\n\none"]


def test_statistics():
    for t in texts():
        assert Q.statistics((t or "").encode())[:5] == slow_base(t)


def test_em_finds_planted_accuracies():
    pick, counts = random.Random(2), {}
    good = [0.97, 0.9, 0.95, 0.9] + [0.95] * (len(Q.RULES) - 4)
    bad = [0.8, 0.7, 0.3, 0.6] + [0.2] * (len(Q.RULES) - 4)
    for _ in range(20_000):
        y = pick.random() < 0.8
        pattern = tuple(0 if pick.random() < 0.2 else (1 if pick.random() < g else -1) if y else (-1 if pick.random() < b else 1) for g, b in zip(good, bad))
        counts[pattern] = counts.get(pattern, 0) + 1
    prior, on_good, on_bad = Q.estimate(sorted(counts.items()))
    assert abs(prior - 0.8) < 0.03
    assert np.abs(np.array(on_good) - good).max() < 0.05 and np.abs(np.array(on_bad) - bad).max() < 0.08


def test_verdicts(spark):
    t = SourceRegistry(spark, SF)
    extra = spark.createDataFrame([(-1, None), (-2, ""), (None, "a b"), (-3, "word " * 60), (-3, "word " * 60)], "doc_id long, text string")
    docs = t.documents.select("doc_id", "text").union(extra)
    rows = Q.quality(docs).collect()
    assert len(rows) == docs.count()
    by_text = {(r.doc_id, r.key): r for r in rows}
    for r in docs.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) AS key").collect():
        got, base = by_text[(r.doc_id, r.key)], slow_base(r.text)
        assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == base
        assert got.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert got.kept == (not got.base_failed and got.p_good >= 0.5)
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    want = [r for r in rows if r.kept]
    got = kept.selectExpr("doc_id", "xxhash64(coalesce(text, '')) AS key").collect()
    assert sorted((r.doc_id, r.key) for r in got) == sorted((r.doc_id, r.key) for r in want)
    clash = Q.keep_good(docs.selectExpr("doc_id", "text", "'x' AS n_words", "1 AS base_failed"))
    assert clash.columns == ["doc_id", "text", "n_words", "base_failed"] and clash.count() == len(want)
    assert Q.quality(docs.limit(0)).count() == 0


def test_posterior_as_in_plain_python(spark):
    docs = SourceRegistry(spark, SF).documents.select("doc_id", "text")
    rows = Q.quality(docs).select("*", *Q.votes()).collect()
    names = [f"v_{r[0]}" for r in Q.RULES]
    counts = {}
    for r in rows:
        if not r.base_failed:
            key = tuple(r[n] for n in names)
            counts[key] = counts.get(key, 0) + 1
    model = Q.estimate(sorted(counts.items()))
    for r in rows:
        assert r.p_good == pytest.approx(Q.posterior(tuple(r[n] for n in names), model), abs=1e-9)


def test_flat_trees_walk_as_written():
    pick = np.random.default_rng(1)
    x = pick.normal(size=(500, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = M.fit(x, y, trees=30, depth=3)
    slow = np.full(len(x), model.base)
    for i, row in enumerate(x):
        for t in range(30):
            at = 0
            for _ in range(3):
                at = 2 * at + 1 + int(row[model.feature[t, at]] > model.threshold[t, at])
            slow[i] += model.leaf[t, at - 7]
    assert np.allclose(slow, model.margin(x))
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    assert np.allclose(M.fit(x[:0], y[:0]).score(x), 0.5)
    assert (M.fit(x, np.ones(500)).score(x) > 0.9).all()


def test_held_out_quality(spark):
    sf = SF.replace("0.001", "0.01")
    t = SourceRegistry(spark, sf)
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "x"), (-1, None)], "doc_id long, text string")
    docs = t.documents.select("doc_id", "text").union(odd)
    rows = M.quality_scores(docs, t.labels).join(t.labels, "doc_id", "left").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    held = [r for r in rows if r.held_out and r.quality is not None]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.93
    none = M.quality_scores(docs, t.labels.limit(0)).collect()
    assert all(r.score == 0.5 for r in none)
    assert M.quality_scores(docs.limit(0), t.labels).count() == 0


def test_models_do_not_depend_on_order_or_repeats_of_an_ident(spark):
    from ledgerline.llm import toxicity as T

    pick = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["vile", "rotten"]
    rows, labels = [], []
    for i in range(240):
        bad = i % 3 == 0
        rows += [(i % 120, " ".join(pick.choices(words[:60], k=30)) + (" vile rotten" if bad else ""))] * (1 + i % 2)
        labels += [(i % 120, int(bad), int(bad)), (i % 120, None, None)]
    rows += [(5, None), (None, "vile")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    for run in (lambda d: M.quality_scores(d, marks.drop("toxic"), sample_rows=50), lambda d: T.toxicity(d, marks.drop("quality"), sample_rows=50)):
        first = sorted(map(repr, run(docs).collect()))
        assert len(first) == len(rows) and first == sorted(map(repr, run(docs.repartition(7, "text")).collect()))
