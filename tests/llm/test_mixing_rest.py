"""Classes without a target where the targets leave nothing of 1."""

import pytest

from ledgerline.llm import mixing as X
from ledgerline.llm.queries import MIX


def test_other_and_null_languages_keep_their_share(spark):
    langs = ["en"] * 40 + ["de"] * 20 + ["fr"] * 10 + ["es"] * 10 + ["it"] * 15 + [None] * 5
    rows = [(i, "word " * 99 + "word", lang, "src0") for i, lang in enumerate(langs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    cells = X.cell_counts(X.classes(df, {"lang": MIX["lang"]}))
    goals = {r._lang: r.goal_lang for r in X.shares(cells, {"lang": MIX["lang"]}).collect()}
    assert goals == pytest.approx({"en": 0.44, "de": 0.12, "fr": 0.12, "es": 0.12, X.REST: 0.2})
    got = X.mix(df, {"lang": MIX["lang"]}).collect()
    assert all(r.probability > 0 for r in got)
