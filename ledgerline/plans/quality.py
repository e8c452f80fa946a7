"""Profiling, rule ledger, quarantine, clean fact, gates."""

from __future__ import annotations


from ..functions.dates import CENSUS_SHAPES
from ..functions.numbers import safe_double
from ..operators import clean as C
from ..operators import gates as G
from ..operators import ledger as L
from ..operators import profile as P
from ..session import materialised, stored
from ..sources.feeds import messy_feed, product_master, site_master, FEED_COLUMNS
from .feed_sql import CLEAN, FEED, LEDGER
from .registry import query

PROFILED = ["claim_id", "ndc", "pharmacy_id", "state_raw", "patient_gender", "prescriber_npi", "days_supply",
            "date_written", "date_filled"]


def annotated(t):
    return L.annotate(messy_feed(t), product_master(t), site_master(t))


def annotated_once(t):
    """The annotated feed as a written table, for queries that read it more than once: the feed is built a single time."""
    return stored(annotated(t), "annotated-feed")


def _profile_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total_rows,
        count(*) FILTER (WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS null_or_blank_rows,
        round(100.0 * count(*) FILTER (WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') / count(*), 2)
          AS pct_missing,
        count(DISTINCT {c}) AS distinct_values FROM {source}"""
        for c in columns
    )


@query("column_profile", f"WITH {FEED} {_profile_sql('feed', PROFILED)}")
def column_profile(t):
    return P.column_profile(messy_feed(t), PROFILED)


@query("document_profile", _profile_sql("documents", ["doc_id", "text", "lang", "source", "n_chars"]))
def document_profile(t):
    return P.column_profile(t.documents, ["doc_id", "text", "lang", "source", "n_chars"])


@query("column_profile_approx")
def column_profile_approx(t):
    """Approximate distinct counts in a single pass, for when the exact shuffle is not wanted."""
    return P.column_profile(messy_feed(t), PROFILED, approximate=True)


@query("format_census", rf"""WITH {FEED}
SELECT CASE WHEN regexp_matches(date_filled, '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN 'ISO (YYYY-MM-DD)'
            WHEN regexp_matches(date_filled, '^\d{{2}}/\d{{2}}/\d{{4}}$') THEN 'US (MM/DD/YYYY)'
            WHEN regexp_matches(date_filled, '^\d{{2}}-[A-Za-z]{{3}}-\d{{4}}$') THEN 'Text (DD-Mon-YYYY)'
            ELSE 'Unrecognized' END AS format,
       count(*) AS rows, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct
FROM feed GROUP BY 1""")
def format_census(t):
    return P.format_census(messy_feed(t), "date_filled", list(CENSUS_SHAPES))


@query("value_census", f"""WITH {FEED}
SELECT COALESCE(NULLIF(trim(patient_gender), ''), '<blank>') AS value, count(*) AS rows FROM feed GROUP BY 1""")
def value_census(t):
    return P.value_census(messy_feed(t), "patient_gender")


@query("quantile_profile", f"""WITH {FEED}
SELECT therapeutic_class, count(*) AS rows, round(min(unit_price::DOUBLE), 2) AS min_value,
       round(quantile_cont(unit_price::DOUBLE, 0.25), 2) AS p25, round(quantile_cont(unit_price::DOUBLE, 0.5), 2) AS median,
       round(quantile_cont(unit_price::DOUBLE, 0.75), 2) AS p75, round(max(unit_price::DOUBLE), 2) AS max_value
FROM feed JOIN products USING (ndc) GROUP BY 1""")
def quantile_profile(t):
    priced = messy_feed(t).select("ndc", safe_double("unit_price").alias("price"))
    master = product_master(t).select("ndc", "therapeutic_class")
    # Two narrow columns, written once: the rank search reads them several times.
    rows = materialised(L.lookup_join(priced, master, "ndc").select("therapeutic_class", "price"))
    return P.quantile_profile(rows, "therapeutic_class", "price")


@query("dup_surplus_key", """SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS surplus_rows FROM lineitem""")
def dup_surplus_key(t):
    return P.surplus_on_key(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("dup_surplus_content", """SELECT COALESCE(CAST(sum(n - 1) AS BIGINT), 0) AS surplus_rows
FROM (SELECT count(*) AS n FROM documents GROUP BY text)""")
def dup_surplus_content(t):
    return P.surplus_on_content(t.documents, ["text"])


@query("dup_surplus_resubmitted", f"""WITH {FEED}
SELECT COALESCE(CAST(sum(n - 1) AS BIGINT), 0) AS surplus_rows FROM (
  SELECT count(*) AS n FROM (SELECT DISTINCT * FROM feed)
  GROUP BY ndc, pharmacy_id, prescriber_npi, date_written, date_filled, quantity_dispensed, unit_price, total_paid,
           patient_age, patient_gender)""")
def dup_surplus_resubmitted(t):
    content = [c for c in FEED_COLUMNS if c not in ("claim_id", "drug_name_raw", "state_raw", "days_supply")]
    return P.surplus_on_content(messy_feed(t).distinct(), content)


@query("grain_duplicates", """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def grain_duplicates(t):
    return P.grain_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("rule_ledger", f"WITH {LEDGER} SELECT * FROM ledger")
def rule_ledger(t):
    return L.build_ledger(annotated_once(t))


@query("copied_rows", f"WITH {FEED} SELECT claim_id, count(*) AS n FROM feed GROUP BY ALL HAVING count(*) > 1"
       .replace("GROUP BY ALL", "GROUP BY " + ", ".join(FEED_COLUMNS)))
def copied_rows(t):
    return L.copied_rows(messy_feed(t))


@query("rule_summary", f"""WITH {LEDGER}
SELECT rule_id, any_value(rule_desc) AS rule_desc, any_value(severity) AS severity, count(*) AS violations,
       count(DISTINCT claim_id) AS distinct_claims FROM ledger GROUP BY rule_id""")
def rule_summary(t):
    return L.rule_summary(L.build_ledger(annotated_once(t)))


@query("reason_rollup", f"WITH {LEDGER} SELECT * FROM rejected")
def reason_rollup(t):
    return L.reject_reasons(annotated(t))


@query("quarantine", f"WITH {LEDGER} SELECT * FROM held")
def quarantine(t):
    return L.quarantine(annotated_once(t), FEED_COLUMNS)


@query("clean_fact", f"""WITH {CLEAN}
SELECT * REPLACE (CAST(date_written AS VARCHAR) AS date_written, CAST(date_filled AS VARCHAR) AS date_filled) FROM clean""")
def clean_fact(t):
    return C.clean_fact(annotated_once(t), product_master(t))


@query("acceptance_tests", rf"""WITH {CLEAN}
SELECT 'claim ids unique' AS test, count(*) - count(DISTINCT claim_id) AS failures FROM clean
UNION ALL SELECT 'product codes well formed', count(*) FILTER (WHERE NOT regexp_matches(ndc, '^\d{{5}}-\d{{4}}-\d{{2}}$')) FROM clean
UNION ALL SELECT 'quantities positive', count(*) FILTER (WHERE quantity_dispensed <= 0) FROM clean
UNION ALL SELECT 'end date not before start date', count(*) FILTER (WHERE date_filled < date_written) FROM clean
UNION ALL SELECT 'no end date after snapshot', count(*) FILTER (WHERE date_filled > DATE '2026-02-01') FROM clean
UNION ALL SELECT 'states are two-letter codes', count(*) FILTER (WHERE NOT regexp_matches(state, '^[A-Z]{{2}}$')) FROM clean
UNION ALL SELECT 'gender is M, F or U', count(*) FILTER (WHERE patient_gender NOT IN ('M', 'F', 'U')) FROM clean
UNION ALL SELECT 'total is quantity times price', count(*) FILTER (WHERE abs(total_paid - quantity_dispensed * unit_price) > 0.01) FROM clean
UNION ALL SELECT 'every site in site master', (SELECT count(*) FROM clean ANTI JOIN sites USING (pharmacy_id))""")
def acceptance_tests(t):
    fact = stored(C.clean_fact(annotated_once(t), product_master(t)), "clean-fact")
    return G.acceptance_tests(fact, site_master(t))


@query("reconciliation", f"""WITH {CLEAN},
counts AS (SELECT (SELECT count(*) FROM feed) AS raw_rows, (SELECT count(*) FROM clean) AS clean_rows,
  (SELECT count(*) FROM held) AS quarantined_rows,
  (SELECT count(*) FROM parsed ANTI JOIN rejected USING (claim_id)) - (SELECT count(*) FROM alive) AS exact_copies,
  (SELECT count(*) FROM repaired) - (SELECT count(*) FROM clean) AS resubmissions)
SELECT *, exact_copies + resubmissions AS rows_removed_as_duplicates,
  raw_rows - clean_rows - quarantined_rows - exact_copies - resubmissions AS unexplained_rows FROM counts""")
def reconciliation(t):
    rows, products = annotated_once(t), product_master(t)
    mixed = L.mixed_claims(rows)
    alive = C.survivors(rows, mixed=mixed)
    return C.reconciliation(rows, C.clean_fact(rows, products, alive=alive), L.quarantine(rows, FEED_COLUMNS, mixed=mixed), products, alive=alive)
