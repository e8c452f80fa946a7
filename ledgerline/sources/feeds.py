"""Working inputs derived from the star-schema tables: messy feed, masters, panel, series, spine, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_text, month_of
from ..operators.joins import balanced, lookup_join

FEED_COLUMNS = [
    "claim_id", "ndc", "drug_name_raw", "pharmacy_id", "state_raw", "patient_gender", "patient_age",
    "prescriber_npi", "date_written", "date_filled", "quantity_dispensed", "days_supply", "unit_price", "total_paid",
]
RAW_STATES = ["New York", "NY", " california ", "CA", "Texas", "TX", "florida", "FL"]
RAW_GENDERS = ["M", "male", "F", " female", "", "f", "X"]


def product_code(key: Column) -> Column:
    digits = F.lpad(key.cast("string"), 11, "0")
    return F.concat_ws("-", F.substring(digits, 1, 5), F.substring(digits, 6, 4), F.substring(digits, 10, 2))


def _cents_text(cents: Column) -> Column:
    return F.concat(
        F.floor(cents / 100).cast("bigint").cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")
    )


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _date_text(day: Column, style: Column) -> Column:
    return F.when(style == 0, date_text(day, "ISO")).when(style == 1, date_text(day, "US")).otherwise(date_text(day, "TEXT"))


def messy_feed(t) -> DataFrame:
    """All-text claims feed: every order line as a claim, with defects planted by a fixed arithmetic rule.

    Defect class ``_d`` (0..96) decides: 0-2 product code, 3 site, 4-5 quantity,
    6 and 9 dates, 7 duration, 8 prescriber, 11 price shift, 20 exact copy, 21 resubmission.
    """
    c = F.col
    line = balanced(t.lineitem.drop("l_discount", "l_tax", "l_returnflag", "l_linestatus"), "l_orderkey", "l_linenumber").join(
        t.orders.select(c("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_custkey"), "l_orderkey"
    ).select(
        "*",
        ((c("l_orderkey") * 7 + c("l_linenumber") * 13 + c("l_partkey")) % 97).alias("_d"),
        F.round(c("l_extendedprice") * 100).cast("bigint").alias("_ext"),
        c("l_quantity").cast("bigint").alias("_q"),
    )
    d = c("_d")
    unit = F.floor((c("_ext") * 2 + c("_q")) / (c("_q") * 2)).cast("bigint")
    priced = F.when(d == 11, unit * 100).otherwise(unit)
    # Suffixes of the rows made from a line: one row, an exact copy, or a second row under a new id.  Half of the texts are made
    # before the rows are, half after: one method with all of them is too long for the JVM to compile.
    suffixes = F.when(d == 20, F.array(F.lit(""), F.lit(""))).when(d == 21, F.array(F.lit(""), F.lit("-R"))).otherwise(F.array(F.lit("")))
    base = line.select(
        "_d", "_q", "_ext", "l_partkey", "l_linenumber", "l_shipdate", "o_custkey", priced.alias("_unit"),
        F.concat_ws("-", *[c(k).cast("string") for k in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
        .alias("claim_id"),
        F.when(d == 0, "").when(d == 1, F.concat(F.lit("BAD-"), c("l_partkey").cast("string")))
        .when(d == 2, "99999-9999-99").otherwise(product_code(c("l_partkey"))).alias("ndc"),
        F.when(c("l_partkey") % 3 == 0, F.concat(F.lit(" ITEM "), c("l_partkey").cast("string"), F.lit(" ")))
        .otherwise(F.concat(F.lit("item "), c("l_partkey").cast("string"))).alias("drug_name_raw"),
        F.when(d == 3, "PH-ORPHAN").otherwise(F.concat(F.lit("PH-"), c("l_suppkey").cast("string")))
        .alias("pharmacy_id"),
        _pick(c("l_suppkey") % 8, RAW_STATES).alias("state_raw"),
        _date_text(c("o_orderdate"), c("l_linenumber") % 3).alias("date_written"),
        suffixes.alias("_rows"),
    )
    spread = base.select("*", F.explode_outer("_rows").alias("_suffix"))
    made = {
        "claim_id": F.concat("claim_id", "_suffix"),
        "patient_gender": _pick(c("l_linenumber") % 7, RAW_GENDERS),
        "patient_age": (c("l_partkey") % 90).cast("string"),
        "prescriber_npi": F.when(d == 8, "").otherwise(c("o_custkey").cast("string")),
        "date_filled": F.when(d == 6, "02/30/2025").when(d == 9, "2099-01-15")
        .otherwise(_date_text(c("l_shipdate"), c("l_partkey") % 3)),
        "quantity_dispensed": F.when(d == 4, "-5").when(d == 5, "abc").otherwise(c("_q").cast("string")),
        "days_supply": F.when(d == 7, " ").otherwise(c("_q").cast("string")),
        "unit_price": _cents_text(c("_unit")),
        "total_paid": _cents_text(c("_ext")),
    }
    return spread.select(*[made[name].alias(name) if name in made else c(name) for name in FEED_COLUMNS])


def product_master(t) -> DataFrame:
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    return t.part.select(
        product_code(F.col("p_partkey")).alias("ndc"), F.col("p_name").alias("drug_name"),
        F.col("p_type").alias("therapeutic_class"), _cents_text(cents).alias("wac_unit_price"),
    )


def site_master(t) -> DataFrame:
    return t.supplier.select(
        F.concat(F.lit("PH-"), F.col("s_suppkey").cast("string")).alias("pharmacy_id"), F.col("s_name").alias("site_name")
    )


def nation_panel(t) -> DataFrame:
    """Nation x month: orders as demand, value / 100,000 as driver.  Orders are summed per customer first."""
    per_customer = t.orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), month_of("o_orderdate").alias("month_start")
    ).agg(F.count(F.lit(1)).alias("demand"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    per_nation = (
        per_customer.join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
        .groupBy("c_nationkey", "month_start")
        .agg(F.sum("demand").alias("demand"), (F.sum("cents") / 1e7).alias("driver"))
    )
    return per_nation.withColumnRenamed("c_nationkey", "nation")


def annual_sources(t) -> tuple[DataFrame, DataFrame]:
    """Annual value per nation with region totals mixed in (as public sources do), and an annual rate per nation."""
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")).agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    per_nation = (
        per_customer.join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"), "year")
        .agg(F.sum("cents").alias("cents"), F.sum("n").alias("n"), F.sum("urgent").alias("urgent"))
    )
    # nation and region are fixed lists of 25 and 5 rows.
    named = per_nation.join(F.broadcast(t.nation), "n_nationkey")
    code = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    nations = named.select(F.col("n_name").alias("country"), code.alias("country_code"), "year", (F.col("cents") / 100).alias("gdp"))
    regions = (
        named.groupBy(F.col("n_regionkey").alias("r_regionkey"), "year").agg(F.sum("cents").alias("cents"))
        .join(F.broadcast(t.region), "r_regionkey")
        .select(F.col("r_name").alias("country"), F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("country_code"),
                "year", (F.col("cents") / 100).alias("gdp"))
    )
    rates = named.select(F.col("n_name").alias("country"), code.alias("country_code"), "year",
                         F.round(100.0 * F.col("urgent") / F.col("n"), 6).alias("rate"))
    return nations.unionByName(regions), rates


REGION_CODES = ("R0", "R1", "R2", "R3", "R4")


def monthly_prices(t) -> DataFrame:
    """Monthly value per market segment as a price series, with placeholder zeros in the last quarter."""
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), month_of("o_orderdate").alias("month")).agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"), F.count(F.lit(1)).alias("n")
    )
    series = (
        per_customer.join(t.customer.select("c_custkey", F.col("c_mktsegment").alias("series_id")), "c_custkey")
        .groupBy("series_id", "month").agg(F.sum("cents").alias("cents"), F.sum("n").alias("n"))
    )
    recent = F.col("month") >= F.lit("2001-06-01").cast("date")
    return series.select(
        "series_id", "month", (F.col("cents") / 100).alias("price"),
        F.when(recent, 0.0).otherwise(F.col("n").cast("double")).alias("cpi"),
        F.when(recent, 0.0).otherwise(F.col("cents") / 100 / F.col("n")).alias("real_price"),
    )


def entity_months(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Spine of customers, their monthly market and own volumes, and monthly contact counts."""
    spine = t.customer.select(F.col("c_custkey").alias("entity_id"), "c_mktsegment", "c_nationkey")
    monthly = t.orders.groupBy(F.col("o_custkey").alias("entity_id"), month_of("o_orderdate").alias("month_start")).agg(
        F.count(F.lit(1)).alias("market"),
        F.count_if(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("own"),
    )
    calls = t.events.groupBy(F.col("user_id").alias("entity_id"), month_of("ts").alias("month_start")).agg(
        F.count(F.lit(1)).alias("calls")
    )
    return spine, monthly, calls


def daily_values(t) -> DataFrame:
    """Daily value per order status; days without orders are missing."""
    return t.orders.groupBy(F.col("o_orderstatus").alias("series_id"), F.col("o_orderdate").cast("date").alias("day")).agg(
        (F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")) / 100).alias("value")
    )


def order_baskets(t) -> tuple[DataFrame, DataFrame]:
    """Orders as transactions, and their lines with part types; few lines of an order share a type, so they are not counted before they are shuffled."""
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("day"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    types = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category"))
    lines = lookup_join(t.lineitem.select("l_orderkey", "l_partkey", "l_discount"), types, "l_partkey").select(
        F.col("l_orderkey").alias("order_id"), "category", F.lit(1).alias("n"), F.coalesce((F.col("l_discount") > 0.05).cast("int"), F.lit(0)).alias("promo"))
    return orders, lines


CHURN_CUT = "2000-08-01"
CHURN_NUMERIC = ["recency", "tenure", "n_orders", "total", "average"]
CHURN_CATEGORICAL = ["c_mktsegment", "nation", "in_debt"]


def churn_table(t) -> DataFrame:
    """Customer features up to a cut-off date; label 1 = no order in the 180 days after it."""
    cut = F.lit(CHURN_CUT).cast("date")
    day = F.col("o_orderdate").cast("date")
    before = day <= cut
    after = (day > cut) & (F.date_diff(day, cut) <= 180)
    facts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max(F.when(before, day)).alias("_last"), F.min(F.when(before, day)).alias("_first"),
        F.count_if(before).cast("double").alias("n_orders"),
        F.coalesce(F.sum(F.when(before, F.col("o_totalprice"))), F.lit(0.0)).alias("total"), F.count_if(after).alias("_after"))
    joined = t.customer.join(facts, "c_custkey").filter("n_orders > 0")
    return joined.select(
        F.col("c_custkey").alias("id"), "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation"),
        F.when(F.col("c_acctbal") < 0, "yes").otherwise("no").alias("in_debt"),
        F.date_diff(cut, "_last").cast("double").alias("recency"), F.date_diff(cut, "_first").cast("double").alias("tenure"),
        "n_orders", F.round("total", 2).alias("total"), (F.round("total", 2) / F.col("n_orders")).alias("average"),
        (F.col("_after") == 0).cast("int").alias("label"))


def messages(t) -> DataFrame:
    """Labelled texts: ``doc_id, text, label`` (1 = toxic)."""
    return lookup_join(balanced(t.documents.select("doc_id", "text"), "doc_id"), t.labels.select("doc_id", F.col("toxic").alias("label")), "doc_id")
