"""Rejected claims without a shuffle of whole rows, counts by digest, and dates put together from their parts."""

import itertools

from conftest import SF
from ledgerline.functions import dates as D
from ledgerline.operators import clean as C
from ledgerline.operators import ledger as L
from ledgerline.plans import quality as Q
from ledgerline.sources.feeds import FEED_COLUMNS, product_master
from ledgerline.sources.tables import SourceRegistry
from pyspark.sql import functions as F

OLD_FORMATS = ((r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"))


def test_dates_equal_those_of_pattern_parsers(spark):
    numbers = ["0", "1", "01", "9", "02", "12", "13", "29", "30", "31", "00", "32"]
    years = ["0000", "0001", "1582", "1900", "2000", "2023", "9999", "999", "12345"]
    texts = [f"{y}-{m}-{d}" for y, m, d in itertools.product(years, numbers, numbers)] + [f"{m}/{d}/{y}" for y, m, d in itertools.product(years, numbers, numbers)]
    texts += [f"{d}-{m}-{y}" for y, m, d in itertools.product(years, ["Jan", "feb", "MAR", "sEP", "Dec", "anF", "xyz", "Se", "Sept", "Mai"], numbers)]
    texts += ["", None, " 2020-01-01", "2020-01-01 ", "2020-01-01\n", "1/2/2020\n", "1-Jan-2020\n", "2020-01-01T00", "٢٠٢٠-01-01", "+2020-01-01", "1-2-2020", "1//2020"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    old = F.coalesce(*[F.when(F.col("t").rlike(shape), F.try_to_date(F.initcap("t") if "MMM" in pattern else F.col("t"), pattern)) for shape, pattern in OLD_FORMATS])
    assert df.filter(~old.eqNullSafe(D.parse_date("t"))).select("t", old.cast("string"), D.parse_date("t").cast("string")).collect() == []


def test_date_texts_equal_those_of_formatters(spark):
    df = spark.sql("SELECT timestamp_ntz'0001-01-01 00:00:00' + make_interval(0, n, 0, n) AS t FROM range(0, 40000, 37) r(n) UNION ALL SELECT NULL")
    for style, pattern in (("ISO", "yyyy-MM-dd"), ("US", "MM/dd/yyyy"), ("TEXT", "dd-MMM-yyyy")):
        assert df.filter(~D.date_text("t", style).eqNullSafe(F.date_format("t", pattern))).isEmpty(), style


def annotated_rows(spark):
    feed = Q.stored(Q.annotated(SourceRegistry(spark, SF)), "annotated-feed")
    spoilt = feed.filter("_qty > 0").limit(40).withColumns({"_qty": F.lit(-1), "quantity_dispensed": F.lit("-1")})
    nameless = feed.limit(30).withColumn("claim_id", F.lit(None).cast("string"))
    return Q.stored(feed.unionByName(spoilt).unionByName(nameless), "annotated-feed")


def test_survivors_and_quarantine_equal_the_plain_joins(spark, monkeypatch):
    rows = annotated_rows(spark)
    reasons = L.reject_reasons(rows)
    alive = rows.join(reasons.select("claim_id"), "claim_id", "left_anti").select(rows.columns)
    held = rows.select(*FEED_COLUMNS).join(reasons, "claim_id").select(*FEED_COLUMNS, "rejection_reasons")
    assert L.mixed_claims(rows).count() > 0
    for limit in (1 << 16, 0):
        monkeypatch.setattr(L, "SENT_CLAIMS", limit)
        for got, want in ((C.survivors(rows).select(rows.columns), alive), (L.quarantine(rows, FEED_COLUMNS), held)):
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and want.count() > 0


def test_reconciliation_counts_as_before(spark):
    rows, products = annotated_rows(spark), product_master(SourceRegistry(spark, SF))
    alive = C.survivors(rows)
    distinct = alive.distinct()
    got = C.reconciliation(rows, C.clean_fact(rows, products), L.quarantine(rows, FEED_COLUMNS), products).first()
    typed = C.standardise(distinct, products)
    assert got.exact_copies == alive.count() - distinct.count() > 0
    assert got.resubmissions == typed.count() - typed.groupBy(*C.BUSINESS_KEY).count().count() > 0
    assert got.unexplained_rows == alive.count() - got.exact_copies - typed.count()


def test_digests_tell_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("", "a"), (None, None)], "x string, y string")
    assert df.select(*C.digests(["x", "y"], ("a", "b"))).distinct().count() == 4


def test_whole_rows_are_not_shuffled_to_drop_rejects(spark):
    rows = Q.annotated_once(SourceRegistry(spark, SF))
    plan = C.survivors(rows)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
