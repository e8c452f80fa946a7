"""What the physical plans must look like: pruned scans, limits before shuffles, no products of large frames."""

import contextlib
import io

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF
from ledgerline.operators.clean import keep_first
from ledgerline.operators.joins import lookup_join


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_keep_first_limits_before_the_shuffle(tables):
    text = plan(keep_first(tables.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_scans_read_needed_columns_only(tables):
    text = plan(tables.orders.filter("o_totalprice > 10").groupBy("o_orderstatus").agg(F.sum("o_totalprice")))
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in text
    assert "GreaterThan(o_totalprice,10.0)" in text


def test_small_lookup_is_broadcast(tables):
    dim = tables.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    assert "BroadcastHashJoin" in plan(lookup_join(tables.lineitem, dim, "l_partkey"))


def test_no_cartesian_products(spark):
    for name in ("clean_fact", "rule_ledger", "entity_kpis", "panel_features", "tfidf", "acf", "aa_replay", "rfm_features"):
        assert "CartesianProduct" not in plan(entry.queries()[name](spark, SF)), name
