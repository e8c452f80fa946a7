"""Scans, sinks, projections, scalar functions, joins and set operations on the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numbers as N
from ..functions import text as X
from ..operators import clean as C
from ..operators import gates as G
from ..operators import ledger as L
from ..operators import profile as P
from ..operators.joins import lookup_join
from ..operators.series import guarded_corr
from ..session import fresh_path, materialised, stored
from ..sources import files, lineage
from ..sources.blocks import read_quoted_csv
from ..sources.feeds import FEED_COLUMNS, messy_feed, product_master, site_master
from .feed_sql import CLEAN, FEED, LEDGER
from .pipelines import PROFILED
from .quality import annotated, annotated_once
from .registry import query

c = F.col
ORDER_TEXT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def order_text(t) -> DataFrame:
    """Orders as text; the price as whole cents so that both engines print the same digits."""
    return t.orders.select(
        c("o_orderkey").cast("string"), c("o_custkey").cast("string"), "o_orderstatus",
        F.round(c("o_totalprice") * 100).cast("bigint").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
    )


ORDER_TEXT_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
  CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders"""


# ---------------------------------------------------------------- scans and sinks


@query("scan_text", ORDER_TEXT_SQL)
def scan_text(t):
    path = files.write_csv(order_text(t), fresh_path(t.spark, "orders-text"))
    return read_quoted_csv(t.spark, path, ORDER_TEXT)


@query("scan_typed_csv", """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS o_totalprice,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""")
def scan_typed_csv(t):
    path = files.write_csv(order_text(t), fresh_path(t.spark, "orders-typed"))
    return files.read_typed_csv(
        t.spark, path,
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice bigint, o_orderdate date, o_orderpriority string",
    )


@query("scan_tsv", r"""SELECT CASE WHEN toxic = 1 THEN 'spam' ELSE 'ham' END AS label,
  trim(regexp_replace(text, '[\t\r\n" ]+', ' ', 'g')) AS text FROM labels JOIN documents USING (doc_id)""")
def scan_tsv(t):
    """Labelled messages through a header-less, quote-less TSV (tabs and line ends flattened before writing)."""
    flat = F.trim(F.regexp_replace("text", r'[\t\r\n" ]+', " "))
    rows = lookup_join(t.documents, t.labels, "doc_id").select(
        F.when(c("toxic") == 1, "spam").otherwise("ham").alias("label"), flat.alias("text")
    )
    path = files.write_csv(rows, fresh_path(t.spark, "messages"), sep="\t", header=False, quote="")
    return files.read_bare_tsv(t.spark, path, ["label", "text"])


@query("sink_parquet", f"""WITH {CLEAN}
SELECT * REPLACE (CAST(date_written AS VARCHAR) AS date_written, CAST(date_filled AS VARCHAR) AS date_filled) FROM clean""")
def sink_parquet(t):
    """Clean fact written as Parquet, partitioned by state, and read back."""
    fact = C.clean_fact(annotated_once(t), product_master(t))
    path = files.write_parquet(fact, fresh_path(t.spark, "clean-fact"), ["state"])
    return t.spark.read.schema(fact.schema).parquet(path)


@query("sink_csv", f"WITH {LEDGER} SELECT * FROM held")
def sink_csv(t):
    """Quarantine written as CSV and read back; blanks and NULLs stay apart."""
    held = L.quarantine(annotated_once(t), FEED_COLUMNS)
    path = files.write_csv(held, fresh_path(t.spark, "quarantine"))
    return read_quoted_csv(t.spark, path, held.columns)


@query("source_registry", " UNION ALL ".join(
    f"SELECT '{n}' AS source, count(*) AS rows FROM {n}" for n in
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()))
def source_registry(t):
    """Every named source resolved through the registry as a view and counted."""
    t.register_views("src_")
    return t.spark.sql(" UNION ALL ".join(f"SELECT '{n}' AS source, count(*) AS rows FROM src_{n}" for n in t.schemas))


@query("staging_view", """SELECT o_orderkey AS order_key, CAST(date_trunc('month', o_orderdate) AS DATE)::VARCHAR AS month_start,
  trim(o_orderpriority) AS priority, CAST(o_totalprice AS DOUBLE) AS total FROM orders""")
def staging_view(t):
    """Typing and light cleaning only, as a named view other models read."""
    t.orders.select(
        c("o_orderkey").alias("order_key"), D.month_start(F.date_format("o_orderdate", "yyyy-MM")).alias("month_start"),
        F.trim("o_orderpriority").alias("priority"), c("o_totalprice").cast("double").alias("total"),
    ).createOrReplaceTempView("stg_orders")
    return t.spark.table("stg_orders")


@query("file_lineage")
def file_lineage(t):
    return lineage.file_fingerprints(t.spark, [t.location(n) for n in ("orders", "lineitem", "part", "supplier")])


@query("frame_fingerprint")
def frame_fingerprint(t):
    frame = t.lineitem
    return lineage.frame_fingerprint(frame, frame.columns)


@query("audit_export")
def audit_export(t):
    # One feed for all nine tables, the surviving rows for the fact and its reconciliation, and the fact once for the two that
    # test it: tables by column, of which each of the nine reads the few columns that it needs.
    rows, products = annotated_once(t), product_master(t)
    mixed = L.mixed_claims(rows)
    alive = stored(C.survivors(rows, mixed=mixed), "survivors")
    clean = stored(C.clean_fact(rows, products, alive=alive), "clean-fact")
    # Two narrow columns, written once: the rank search reads them several times.
    priced = materialised(lookup_join(rows.select("ndc", "_price"), products.select("ndc", "therapeutic_class"), "ndc").select("therapeutic_class", "_price"))
    tables = {
        "column_profile": ("Column profile", P.column_profile(rows, PROFILED)),
        "format_census": ("Date formats", P.format_census(rows, "date_filled", list(D.CENSUS_SHAPES))),
        "state_census": ("State values", P.value_census(rows, "state_raw")),
        "gender_census": ("Gender values", P.value_census(rows, "patient_gender")),
        "price_profile": ("Price by class", P.quantile_profile(priced, "therapeutic_class", "_price")),
        "surplus_same_id": ("Surplus rows, same id", P.surplus_on_key(rows, ["claim_id"])),
        "rule_summary": ("Rules", L.rule_summary(L.build_ledger(rows))),
        "reconciliation": ("Reconciliation", C.reconciliation(rows, clean, L.quarantine(rows, FEED_COLUMNS, mixed=mixed), products, alive=alive)),
        "acceptance_tests": ("Acceptance tests", G.acceptance_tests(clean, site_master(t))),
    }
    path = fresh_path(t.spark, "audit")
    lineage.audit_export(tables).write.json(path)
    return t.spark.read.schema("section string, title string, row_json string").json(path)


# ---------------------------------------------------------------- projections and filters


@query("normalize_headers", """SELECT o_orderkey AS order_key, o_totalprice AS total_price, o_orderpriority AS priority FROM orders""")
def normalize_headers(t):
    """Headers stripped, lower-cased, blanks to underscores; then one explicit rename."""
    raw = t.orders.select(
        c("o_orderkey").alias(" Order Key"), c("o_totalprice").alias("Total Price "), c("o_orderpriority").alias("Order Priority")
    )
    tidy = raw.toDF(*[n.strip().lower().replace(" ", "_") for n in raw.columns])
    return tidy.withColumnsRenamed({"order_priority": "priority"})


@query("placeholder_null", """SELECT l_orderkey, l_linenumber, l_partkey, NULLIF(l_discount, 0.0) AS l_discount,
  NULLIF(l_tax, 0.0) AS l_tax FROM lineitem""")
def placeholder_null(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             *[N.placeholder_to_null(k).alias(k) for k in ("l_discount", "l_tax")])


@query("blank_to_null", f"WITH {FEED} SELECT claim_id, NULLIF(trim(days_supply), '') AS days_supply, NULLIF(trim(patient_gender), '') AS patient_gender FROM feed")
def blank_to_null(t):
    return messy_feed(t).select("claim_id", *[X.blank_to_null(k).alias(k) for k in ("days_supply", "patient_gender")])


@query("missing_predicate", f"WITH {FEED} SELECT claim_id, days_supply IS NULL OR trim(days_supply) = '' AS no_days, prescriber_npi IS NULL OR trim(prescriber_npi) = '' AS no_prescriber FROM feed")
def missing_predicate(t):
    return messy_feed(t).select("claim_id", X.is_missing("days_supply").alias("no_days"),
                                X.is_missing("prescriber_npi").alias("no_prescriber"))


@query("format_check", r"""SELECT p_partkey, regexp_matches(p_brand, '^Brand#\d+$') AS brand_ok, regexp_matches(p_brand, '^Brand#\d$') AS one_digit FROM part""")
def format_check(t):
    return t.part.select("p_partkey", X.matches("p_brand", r"^Brand#\d+$").alias("brand_ok"),
                         X.matches("p_brand", r"^Brand#\d$").alias("one_digit"))


@query("category_map", """SELECT o_orderkey, CASE upper(trim(o_orderpriority)) WHEN '1-URGENT' THEN 'P1' WHEN '2-HIGH' THEN 'P2'
  WHEN '3-MEDIUM' THEN 'P3' ELSE upper(trim(o_orderpriority)) END AS priority FROM orders""")
def category_map(t):
    mapping = {"1-URGENT": "P1", "2-HIGH": "P2", "3-MEDIUM": "P3"}
    return t.orders.select("o_orderkey", X.map_category("o_orderpriority", mapping).alias("priority"))


@query("code_standardize", f"""WITH {FEED} SELECT claim_id, CASE upper(left(trim(patient_gender), 1)) WHEN 'M' THEN 'M' WHEN 'F' THEN 'F'
  ELSE 'U' END AS gender FROM feed""")
def code_standardize(t):
    return messy_feed(t).select("claim_id", X.first_letter_code("patient_gender", ("M", "F"), "U").alias("gender"))


@query("project_except", "SELECT * EXCLUDE (o_orderdate, o_orderpriority) FROM orders")
def project_except(t):
    return t.orders.drop("o_orderdate", "o_orderpriority")


@query("membership_flag", "SELECT n_nationkey, n_name, n_nationkey IN (1, 3, 5, 24) AS is_aggregate FROM nation")
def membership_flag(t):
    return t.nation.select("n_nationkey", "n_name", c("n_nationkey").isin(1, 3, 5, 24).alias("is_aggregate"))


@query("valid_rows", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal IS NOT NULL AND c_acctbal > 0")
def valid_rows(t):
    return t.customer.select("c_custkey", "c_acctbal").dropna(subset=["c_acctbal"]).filter("c_acctbal > 0")


@query("bin_intervals", """SELECT c_custkey, CASE WHEN c_acctbal <= 0 THEN 'debt' WHEN c_acctbal <= 2000 THEN '0-2k'
  WHEN c_acctbal <= 5000 THEN '2-5k' ELSE '>5k' END AS band FROM customer""")
def bin_intervals(t):
    return t.customer.select("c_custkey", N.right_closed_bin("c_acctbal", [0, 2000, 5000], ["debt", "0-2k", "2-5k", ">5k"]).alias("band"))


BLANK_TOTAL = "CASE WHEN tenure = 0 THEN ' ' ELSE CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) END"


@query("conditional_repair", f"""SELECT o_orderkey, tenure, CASE WHEN trim(total_text) = '' THEN 0.0 ELSE CAST(total_text AS DOUBLE) END AS total,
  trim(total_text) = '' AS was_blank
FROM (SELECT *, {BLANK_TOTAL} AS total_text FROM (SELECT *, datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) // 30 AS tenure FROM orders))""")
def conditional_repair(t):
    """A blank total is 0 only for tenure 0; the gate stops the job if a blank occurs anywhere else."""
    day = c("o_orderdate").cast("date")
    tenure = F.floor(F.date_diff(day, F.lit("1995-01-01").cast("date")) / 30).cast("bigint")
    rows = t.orders.select("o_orderkey", tenure.alias("tenure"), "o_totalprice").select(
        "o_orderkey", "tenure",
        F.when(c("tenure") == 0, " ").otherwise(F.round("o_totalprice").cast("bigint").cast("string")).alias("total_text"),
    )
    blank = F.trim("total_text") == ""
    G.assert_gate(G.count_checks(rows, {"blank total only at tenure 0": blank & (c("tenure") != 0)}))
    return rows.select("o_orderkey", "tenure", F.when(blank, F.lit(0.0)).otherwise(N.safe_double("total_text")).alias("total"),
                       blank.alias("was_blank"))


PRICE_CENTS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  (CAST(round(l_extendedprice * 100) AS BIGINT) * 2 + CAST(l_quantity AS BIGINT)) // (CAST(l_quantity AS BIGINT) * 2) AS price_c,
  CAST(round(p_retailprice * 100) AS BIGINT) AS ref_c FROM lineitem JOIN part ON l_partkey = p_partkey"""


@query("price_repair", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(CASE WHEN price_c > 20 * ref_c THEN (price_c + 50) // 100 ELSE price_c END AS DOUBLE) / 100 AS unit_price,
  price_c > 20 * ref_c AS was_repaired FROM ({PRICE_CENTS})""")
def price_repair(t):
    cents = F.round(c("l_extendedprice") * 100).cast("bigint")
    qty = c("l_quantity").cast("bigint")
    priced = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.floor((cents * 2 + qty) / (qty * 2)).cast("decimal(14,0)") / 100).cast("decimal(12,2)").alias("price"),
    )
    refs = t.part.select(c("p_partkey").alias("l_partkey"), c("p_retailprice").cast("decimal(12,2)").alias("ref"))
    price, repaired = C.repair_price(c("price"), c("ref"))
    return lookup_join(priced, refs, "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", price.alias("unit_price"), repaired.alias("was_repaired"))


@query("impute_flag", f"""WITH {FEED} SELECT claim_id, COALESCE(TRY_CAST(NULLIF(trim(days_supply), '') AS INTEGER), TRY_CAST(quantity_dispensed AS INTEGER)) AS days,
  TRY_CAST(NULLIF(trim(days_supply), '') AS INTEGER) IS NULL AS was_imputed FROM feed""")
def impute_flag(t):
    days = N.safe_int(X.blank_to_null("days_supply"))
    return messy_feed(t).select("claim_id", F.coalesce(days, N.safe_int("quantity_dispensed")).alias("days"), days.isNull().alias("was_imputed"))


@query("recompute_total", f"""WITH {FEED} SELECT claim_id, CAST(CAST(quantity_dispensed AS INTEGER) * CAST(CAST(unit_price AS DECIMAL(12,2)) * 100 AS BIGINT) AS DOUBLE) / 100 AS total
FROM feed WHERE TRY_CAST(quantity_dispensed AS INTEGER) IS NOT NULL""")
def recompute_total(t):
    rows = messy_feed(t).select("claim_id", N.safe_int("quantity_dispensed").alias("qty"), c("unit_price").cast("decimal(12,2)").alias("price"))
    return rows.filter("qty is not null").select("claim_id", (c("qty") * c("price")).alias("total"))


# ---------------------------------------------------------------- scalar functions


@query("date_cascade", f"""WITH {FEED} SELECT claim_id, date_filled, CAST(COALESCE(try_strptime(date_filled, '%Y-%m-%d'),
  try_strptime(date_filled, '%m/%d/%Y'), try_strptime(date_filled, '%d-%b-%Y'))::DATE AS VARCHAR) AS parsed FROM feed""")
def date_cascade(t):
    return messy_feed(t).select("claim_id", "date_filled", D.parse_date("date_filled").alias("parsed"))


@query("safe_numeric", """SELECT event_id, TRY_CAST(regexp_extract(props, ':\\s*([^}]*)', 1) AS DOUBLE) AS k_double,
  TRY_CAST(TRY_CAST(event_type || regexp_extract(props, ':\\s*([^}]*)', 1) AS DOUBLE) AS INTEGER) AS junk,
  TRY_CAST(round(TRY_CAST(regexp_extract(props, ':\\s*([^}]*)', 1) || '.6' AS DOUBLE)) AS INTEGER) AS k_rounded FROM events""")
def safe_numeric(t):
    raw = F.get_json_object("props", "$.k")
    return t.events.select("event_id", N.safe_double(raw).alias("k_double"), N.safe_int(F.concat("event_type", raw)).alias("junk"),
                           N.safe_int(F.concat(raw, F.lit(".6"))).alias("k_rounded"))


@query("strict_cast", """SELECT CAST(p_partkey AS INTEGER) AS part_int, CAST(p_size AS SMALLINT) AS size_small,
  CAST(CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS DOUBLE) / 100 AS DOUBLE) AS price FROM part""")
def strict_cast(t):
    """ANSI casts: a value out of range stops the job instead of wrapping round."""
    return t.part.select(c("p_partkey").cast("int").alias("part_int"), c("p_size").cast("smallint").alias("size_small"),
                         c("p_retailprice").cast("decimal(12,2)").alias("price"))


@query("month_parse", """SELECT o_orderkey, CAST(CAST(strftime(o_orderdate, '%Y-%m') || '-01' AS DATE) AS VARCHAR) AS month_start FROM orders""")
def month_parse(t):
    return t.orders.select("o_orderkey", D.month_start(F.date_format("o_orderdate", "yyyy-MM")).alias("month_start"))


@query("date_parts", """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(year(o_orderdate) // 10 * 10 AS INTEGER) AS decade,
  CAST(month(o_orderdate) AS INTEGER) AS m, CAST(dayofyear(o_orderdate) AS INTEGER) AS doy FROM orders""")
def date_parts(t):
    day = c("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", F.year(day).alias("y"), D.decade(day).alias("decade"), F.month(day).alias("m"), F.dayofyear(day).alias("doy"))


@query("string_ops", """SELECT p_partkey, upper(trim(p_name)) AS up, left(p_type, 3) AS head, p_brand || ' | ' || p_type AS joined,
  concat_ws('-', p_brand, CAST(p_size AS VARCHAR)) AS tag FROM part""")
def string_ops(t):
    return t.part.select("p_partkey", F.upper(F.trim("p_name")).alias("up"), F.left("p_type", F.lit(3)).alias("head"),
                         F.concat("p_brand", F.lit(" | "), "p_type").alias("joined"), F.concat_ws("-", "p_brand", c("p_size").cast("string")).alias("tag"))


@query("math_ops", """SELECT o_orderkey, round(ln(o_totalprice), 6) AS lg, round(ln(1 + o_totalprice), 6) AS lg1, round(exp(-o_totalprice / 100000), 6) AS ex,
  round(sqrt(o_totalprice), 6) AS sq, abs(o_totalprice - 200000) AS dist, round(power(o_totalprice / 1000, 1.5), 4) AS pw FROM orders WHERE o_totalprice > 0""")
def math_ops(t):
    p = c("o_totalprice")
    return t.orders.filter(p > 0).select("o_orderkey", F.round(F.log(p), 6).alias("lg"), F.round(F.log1p(p), 6).alias("lg1"),
        F.round(F.exp(-p / 100000), 6).alias("ex"), F.round(F.sqrt(p), 6).alias("sq"), F.abs(p - 200000).alias("dist"), F.round(F.pow(p / 1000, F.lit(1.5)), 4).alias("pw"))


@query("text_preview", r"""SELECT doc_id, substr(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'), 1, 110) AS preview FROM documents""")
def text_preview(t):
    return t.documents.select("doc_id", X.preview("text").alias("preview"))


@query("fourier_terms", """SELECT o_orderkey, t, round(sin(2 * pi() * t / 365.25), 6) AS sin1, round(cos(2 * pi() * t / 365.25), 6) AS cos1,
  round(sin(4 * pi() * t / 365.25), 6) AS sin2, round(cos(4 * pi() * t / 365.25), 6) AS cos2,
  round(sin(6 * pi() * t / 365.25), 6) AS sin3, round(cos(6 * pi() * t / 365.25), 6) AS cos3
FROM (SELECT o_orderkey, CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS t FROM orders)""")
def fourier_terms(t):
    index = F.date_diff(c("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    rows = t.orders.select("o_orderkey", index.alias("t"))
    return rows.select("o_orderkey", "t", *[F.round(v, 6).alias(k) for k, v in N.fourier_columns("t").items()])


# ---------------------------------------------------------------- joins


@query("join_inner", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand, p_type FROM lineitem JOIN part ON l_partkey = p_partkey""")
def join_inner(t):
    dim = t.part.select(c("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return lookup_join(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), dim, "l_partkey")


@query("orphans", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)")
def orphans(t):
    """Customers without any event; event keys are made distinct before the join."""
    seen = t.events.select(c("user_id").alias("c_custkey")).distinct()
    return t.customer.select("c_custkey", "c_name").join(seen, "c_custkey", "left_anti")


@query("anti_join", f"WITH {LEDGER} SELECT claim_id, ndc, unit_price FROM feed ANTI JOIN rejected USING (claim_id)")
def anti_join(t):
    return C.survivors(annotated(t)).select("claim_id", "ndc", "unit_price")


@query("bounds_join", """SELECT o_orderkey, datediff('day', CAST(o_orderdate AS DATE), mx) AS age_days
FROM orders, (SELECT CAST(max(o_orderdate) AS DATE) AS mx FROM orders)""")
def bounds_join(t):
    """Rows against a one-row table of bounds; the bound is one row whatever the data's size."""
    mx = t.orders.agg(F.max(c("o_orderdate").cast("date")).alias("mx"))
    return t.orders.join(F.broadcast(mx)).select("o_orderkey", F.date_diff("mx", c("o_orderdate").cast("date")).cast("bigint").alias("age_days"))


@query("key_lookup", """SELECT o_orderkey, k.nation_key FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT n_nationkey, CAST(row_number() OVER (ORDER BY n_name) AS INTEGER) AS nation_key FROM nation) k ON c_nationkey = n_nationkey""")
def key_lookup(t):
    """Natural key to surrogate key; nations are a fixed list of 25, so numbering and broadcast are bounded."""
    keys = t.nation.select(c("n_nationkey").alias("c_nationkey"), F.row_number().over(Window.orderBy("n_name")).alias("nation_key"))
    customers = t.customer.select(c("c_custkey").alias("o_custkey"), "c_nationkey").join(F.broadcast(keys), "c_nationkey", "left")
    return lookup_join(t.orders.select("o_orderkey", "o_custkey"), customers, "o_custkey").select("o_orderkey", "nation_key")


@query("cross_source_corr", """SELECT count(*) AS months, round(corr(a.v, b.v), 6) AS corr FROM
 (SELECT date_trunc('month', o_orderdate) AS m, sum(o_totalprice) AS v FROM orders GROUP BY 1) a JOIN
 (SELECT date_trunc('month', l_shipdate) AS m, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1) b USING (m)""")
def cross_source_corr(t):
    """Two sources aggregated on their own to the common grain, then joined and correlated."""
    a = t.orders.groupBy(D.month_of("o_orderdate").alias("m")).agg(F.sum("o_totalprice").alias("a"))
    b = t.lineitem.groupBy(D.month_of("l_shipdate").alias("m")).agg(F.sum("l_extendedprice").alias("b"))
    return a.join(b, "m").agg(F.count(F.lit(1)).alias("months"), F.round(guarded_corr("a", "b"), 6).alias("corr"))


@query("join_residual", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(price_c AS DOUBLE) / 100 AS price FROM ({PRICE_CENTS}) WHERE price_c > 20 * ref_c""")
def join_residual(t):
    """Equi-join with an inequality on top: price more than 20 times the reference."""
    cents = F.round(c("l_extendedprice") * 100).cast("bigint")
    qty = c("l_quantity").cast("bigint")
    priced = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                               F.floor((cents * 2 + qty) / (qty * 2)).cast("bigint").alias("price_c"))
    refs = t.part.select(c("p_partkey").alias("l_partkey"), F.round(c("p_retailprice") * 100).cast("bigint").alias("ref_c"))
    return lookup_join(priced, refs, "l_partkey").filter(c("price_c") > 20 * c("ref_c")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (c("price_c") / 100).alias("price"))


@query("scalar_counts", """SELECT (SELECT count(*) FROM orders) AS orders_rows, (SELECT count(*) FROM lineitem) AS line_rows,
 (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders) AS difference""")
def scalar_counts(t):
    """Scalar subqueries in a projection."""
    t.orders.createOrReplaceTempView("sc_orders")
    t.lineitem.createOrReplaceTempView("sc_lines")
    return t.spark.sql("""SELECT (SELECT count(*) FROM sc_orders) AS orders_rows, (SELECT count(*) FROM sc_lines) AS line_rows,
      (SELECT count(*) FROM sc_lines) - (SELECT count(*) FROM sc_orders) AS difference""")


# ---------------------------------------------------------------- small aggregates and set operations


@query("filtered_agg", """SELECT l_returnflag, sum(l_quantity) FILTER (WHERE l_discount > 0.05) AS qty_disc, count(*) FILTER (WHERE l_tax = 0) AS untaxed,
  count(*) AS rows FROM lineitem GROUP BY 1""")
def filtered_agg(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.sum(F.when(c("l_discount") > 0.05, c("l_quantity"))).alias("qty_disc"),
        F.count_if(c("l_tax") == 0).alias("untaxed"), F.count(F.lit(1)).alias("rows"))


@query("crosstab", """SELECT p_type, count(*) FILTER (WHERE b = 0) AS b0, count(*) FILTER (WHERE b = 1) AS b1, count(*) FILTER (WHERE b = 2) AS b2
FROM (SELECT p_type, p_size % 3 AS b FROM part) GROUP BY 1""")
def crosstab(t):
    rows = t.part.select("p_type", F.concat(F.lit("b"), (c("p_size") % 3).cast("string")).alias("b"))
    return rows.groupBy("p_type").pivot("b", ["b0", "b1", "b2"]).agg(F.count(F.lit(1))).fillna(0)


@query("distinct_rows", "SELECT DISTINCT * FROM (SELECT l_returnflag, l_linestatus, l_linenumber, l_quantity FROM lineitem)")
def distinct_rows(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity").distinct()


@query("dedup_first", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) = 1""")
def dedup_first(t):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return C.keep_first(t.lineitem.select(*cols), cols[:2], cols[2:])


@query("dedup_subset", """SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) = 1""")
def dedup_subset(t):
    """Keep-first on a subset of columns, by a stated order (the smallest order key)."""
    return t.orders.groupBy("o_custkey", c("o_orderdate").cast("date").alias("day")).agg(F.min("o_orderkey").alias("o_orderkey"))
