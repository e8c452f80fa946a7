"""Raking against plain Python; the pipeline's stages together."""

import random
import re

import pytest

import corpus_pipeline
from conftest import SF
from ledgerline.llm import mixing as M
from ledgerline.llm.queries import MIX
from ledgerline.sources.tables import SourceRegistry


def slow_rake(cells, targets, sweeps=400):
    weight = {k: float(v) for k, v in cells.items()}
    goals = []
    for d, name in enumerate(M.DIMENSIONS):
        present = {k[d] for k in cells}
        if targets.get(name):
            left = 1 - sum(v for k, v in targets[name].items() if k != M.REST)
            goal = {c: targets[name].get(c, max(0.0, left) if c == M.REST else 0.0) for c in present}
        else:
            goal = {c: sum(v for k, v in cells.items() if k[d] == c) for c in present}
        whole = sum(goal.values())
        goals.append({c: g / whole for c, g in goal.items()})
    for _ in range(sweeps):
        for d, goal in enumerate(goals):
            sums = {}
            for k, w in weight.items():
                sums[k[d]] = sums.get(k[d], 0.0) + w
            weight = {k: w * goal[k[d]] / sums[k[d]] if sums[k[d]] else 0.0 for k, w in weight.items()}
    return weight


def test_raking_against_plain_python(spark):
    docs = SourceRegistry(spark, SF.replace("0.001", "0.01")).documents
    classed = M.classes(docs, MIX)
    cells = M.cell_counts(classed)
    rows = cells.collect()
    want = slow_rake({(r._source, r._lang, r._topic): r.tokens for r in rows}, MIX)
    got = M.rake(cells, MIX).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.weight == pytest.approx(want[(r._source, r._lang, r._topic)], abs=2e-6)
    assert sum(r.weight for r in got) == pytest.approx(1.0)


def test_draw_meets_the_mix(spark):
    docs = SourceRegistry(spark, SF.replace("0.001", "0.1")).documents
    drawn = M.mix(docs, {"lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}}).withColumn("n", M.token_weight(M.F.col("text")))
    rows = drawn.groupBy("lang").agg(M.F.expr("sum(copies * n)").alias("got")).collect()
    total = sum(r.got for r in rows)
    for r in rows:
        assert r.got / total == pytest.approx(0.4 if r.lang == "en" else 0.2, abs=0.03)
    again = M.mix(docs.repartition(5), {"lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}})
    assert again.select("doc_id", "copies").exceptAll(drawn.select("doc_id", "copies")).count() == 0


def test_odd_rows(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", None), (None, "one two", None, "a"), (3, "x\ny z", "de", "b"), (3, "x\ny z", "de", "b"), (4, " \n", "en", "a")]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, text string, lang string, source string, copies int, tokens string")
    got = M.mix(df, {"lang": {"en": 0.5}})
    assert got.count() == 6 and got.columns == ["doc_id", "text", "lang", "source", "tokens", "weight", "probability", "copies"]
    for r in got.collect():
        if not (r.text or "").strip():
            assert (r.weight, r.probability, r.copies) == (0.0, 0.0, 0)
    assert M.mix(df.limit(0), MIX).count() == 0
    counted = df.select(M.token_weight(M.F.col("text")).alias("n"), "text").collect()
    for r in counted:
        assert r.n == len(re.findall("[^\x20\x09-\x0d]+", r.text or ""))


def slow_topic(text):
    t = text or ""
    size = max(len(t), 1)
    for name, signs, least in (("table", "|\t", 0.01), ("numbers", "0123456789", 0.05), ("talk", "!?", 0.02)):
        if sum(c in signs for c in t) / size > least:
            return name
    return "short" if len(t) < 1000 else "article" if len(t) < 6000 else "long"


def test_words_and_topics_by_hand(spark):
    pick = random.Random(6)
    texts = ["".join(pick.choices("aé　 \t\n\x0b\x0c\r\x1c|!?0123 ", k=pick.randint(0, 40))) for _ in range(400)]
    texts += ["a  b", "a\tb\tc", None, "", " \r ", "é" * 999, "é" * 1000, "é" * 6000, "x " * 200_000, "a|" + "b" * 198, "a|" + "b" * 97, "5" * 6 + "w" * 100, "?" * 3 + "w" * 100]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", M.token_weight(M.F.col("text")).alias("n"), M.form_topic(M.F.col("text")).alias("topic")).collect():
        assert r.n == len(re.findall("[^\x20\x09-\x0d]+", r.text or "")), r.text
        assert r.topic == slow_topic(r.text), r.text


def test_columns_of_any_name_pass_through_all_stages(spark):
    """Names that operators use inside, on documents that all stages keep."""
    names = ["_source", "_lang", "_topic", "_tokens", "_weight", "_rate", "_id", "_k", "_key", "_quality", "_in0", "row", "id", "key", "fp", "n"]
    docs = SourceRegistry(spark, SF).documents
    odd = docs.select("*", *[M.F.concat(M.F.lit(f"{c} "), M.F.col("doc_id").cast("string")).alias(c) for c in names])
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, odd, SF)
        assert after.columns[: len(odd.columns)] == odd.columns, name
        rows = after.collect()
        assert rows and all(r[c] == f"{c} {r.doc_id}" for r in rows for c in names), name


def test_miss_is_told_when_goals_contradict(spark):
    rows = [(i, "word " * 20, "en" if i % 2 else "de", "a" if i % 2 else "b") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for lang, met in (({"en": 0.5, "de": 0.5}, True), ({"en": 0.9, "de": 0.1}, False)):
        targets = {"source": {"a": 0.5, "b": 0.5}, "lang": lang}
        assert (M.rake(M.cell_counts(M.classes(df, targets)), targets).first().miss < 1e-6) == met


def test_pipeline_stages(spark):
    docs = SourceRegistry(spark, SF).documents
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "decontaminate", "personal_data", "mixed"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        after = spark.createDataFrame(after.collect(), after.schema)
        assert after.columns[: len(docs.columns)] == docs.columns
        assert 0 < after.count() <= before.count()
        assert after.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
        before = after
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(r.doc_id for r in before.collect())
