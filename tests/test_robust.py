"""Odd but valid rows: values that are typed once, NULL keys, moved NULLs, the storage census."""

from pyspark.sql import functions as F

from feed_rows import GOOD
from ledgerline.functions.dates import CENSUS_SHAPES
from ledgerline.operators import clean as C
from ledgerline.operators import joins as J
from ledgerline.operators import ledger as L
from ledgerline.operators import profile as P
from ledgerline.sources.feeds import FEED_COLUMNS
from ledgerline.sources.lineage import frame_fingerprint


def test_values_that_pass_a_rule_never_fail_the_clean_fact(spark):
    rows = [{**GOOD, "claim_id": f"X{i}", "prescriber_npi": f"N{i}", **change} for i, change in enumerate([
        {"quantity_dispensed": "30.6"}, {"quantity_dispensed": "3e1"}, {"unit_price": "1e1"}, {"patient_age": "n/a"}, {"ndc": None}, {"pharmacy_id": None}])]
    feed = spark.createDataFrame([tuple(r[c] for c in FEED_COLUMNS) for r in rows], ", ".join(f"{c} string" for c in FEED_COLUMNS))
    products = spark.createDataFrame([("00001-0001-01", "Drug One", "A", "10.00")], "ndc string, drug_name string, therapeutic_class string, wac_unit_price string")
    sites = spark.createDataFrame([("P1",)], "pharmacy_id string")
    fact = C.clean_fact(L.annotate(feed, products, sites), products).collect()
    got = {r.claim_id: r for r in fact}
    assert set(got) == {"X0", "X1", "X2", "X3"}
    assert got["X0"].quantity_dispensed == 31 and got["X1"].quantity_dispensed == 30
    assert float(got["X2"].unit_price) == 10.0 and got["X3"].patient_age is None


def test_null_keys_are_spread(spark):
    fact = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("k"), "id")
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = J.salted_join(fact, dim, ["k"], J.hot_keys(fact.dropna(subset=["k"]), ["k"]), "left")
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / 4
        assert out.filter("v IS NULL").count() == 10_000 and out.filter("v != k * 10").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fingerprint_sees_where_a_null_is(spark):
    a = spark.createDataFrame([(None, 5)], "x int, y int")
    b = spark.createDataFrame([(5, None)], "x int, y int")
    assert frame_fingerprint(a, ["x", "y"]).first() != frame_fingerprint(b, ["x", "y"]).first()
    assert frame_fingerprint(a, ["x", "y"]).first() == frame_fingerprint(a.union(b).filter("y = 5"), ["x", "y"]).first()


def test_census_wants_full_width(spark):
    rows = [("2025-01-05",), ("2025-1-5",), ("01/05/2025",), ("1/5/2025",), ("05-Jan-2025",), ("5-Jan-2025",)]
    got = {r.format: r.rows for r in P.format_census(spark.createDataFrame(rows, "d string"), "d", list(CENSUS_SHAPES)).collect()}
    assert got == {"ISO (YYYY-MM-DD)": 1, "US (MM/DD/YYYY)": 1, "Text (DD-Mon-YYYY)": 1, "Unrecognized": 3}
