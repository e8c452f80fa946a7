"""The messy feed, its ledger and its clean fact as SQL text, for the check queries."""


def _date_text(day: str, style: str) -> str:
    return (
        f"CASE {style} WHEN 0 THEN strftime({day}, '%Y-%m-%d') WHEN 1 THEN strftime({day}, '%m/%d/%Y') "
        f"ELSE strftime({day}, '%d-%b-%Y') END"
    )


def _cents(x: str) -> str:
    return f"(CAST(({x}) // 100 AS VARCHAR) || '.' || lpad(CAST(({x}) % 100 AS VARCHAR), 2, '0'))"


def _code(key: str) -> str:
    d = f"lpad(CAST({key} AS VARCHAR), 11, '0')"
    return f"(substr({d}, 1, 5) || '-' || substr({d}, 6, 4) || '-' || substr({d}, 10, 2))"


FEED = f"""
feed_lines AS (
  SELECT l.*, o_orderdate, o_custkey,
         (l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 97 AS d,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS ext,
         CAST(l_quantity AS BIGINT) AS q
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey),
feed_base AS (
  SELECT d,
    l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS claim_id,
    CASE d WHEN 0 THEN '' WHEN 1 THEN 'BAD-' || l_partkey WHEN 2 THEN '99999-9999-99'
           ELSE {_code('l_partkey')} END AS ndc,
    CASE WHEN l_partkey % 3 = 0 THEN ' ITEM ' || l_partkey || ' ' ELSE 'item ' || l_partkey END AS drug_name_raw,
    CASE d WHEN 3 THEN 'PH-ORPHAN' ELSE 'PH-' || l_suppkey END AS pharmacy_id,
    ['New York', 'NY', ' california ', 'CA', 'Texas', 'TX', 'florida', 'FL'][l_suppkey % 8 + 1] AS state_raw,
    ['M', 'male', 'F', ' female', '', 'f', 'X'][l_linenumber % 7 + 1] AS patient_gender,
    CAST(l_partkey % 90 AS VARCHAR) AS patient_age,
    CASE d WHEN 8 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS prescriber_npi,
    {_date_text('o_orderdate', 'l_linenumber % 3')} AS date_written,
    CASE d WHEN 6 THEN '02/30/2025' WHEN 9 THEN '2099-01-15' ELSE {_date_text('l_shipdate', 'l_partkey % 3')} END
      AS date_filled,
    CASE d WHEN 4 THEN '-5' WHEN 5 THEN 'abc' ELSE CAST(q AS VARCHAR) END AS quantity_dispensed,
    CASE d WHEN 7 THEN ' ' ELSE CAST(q AS VARCHAR) END AS days_supply,
    {_cents("((ext * 2 + q) // (q * 2)) * (CASE d WHEN 11 THEN 100 ELSE 1 END)")} AS unit_price,
    {_cents("ext")} AS total_paid
  FROM feed_lines),
feed AS (
  SELECT * EXCLUDE (d) FROM feed_base
  UNION ALL SELECT * EXCLUDE (d) FROM feed_base WHERE d = 20
  UNION ALL SELECT * EXCLUDE (d) REPLACE (claim_id || '-R' AS claim_id) FROM feed_base WHERE d = 21),
products AS (
  SELECT {_code('p_partkey')} AS ndc, p_name AS drug_name, p_type AS therapeutic_class,
         {_cents("CAST(round(p_retailprice * 100) AS BIGINT)")} AS wac_unit_price
  FROM part),
sites AS (SELECT 'PH-' || s_suppkey AS pharmacy_id, s_name AS site_name FROM supplier)
"""


def _parsed(c: str) -> str:
    return (
        f"COALESCE(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%m/%d/%Y'), "
        f"try_strptime({c}, '%d-%b-%Y'))::DATE"
    )


WELL_FORMED = r"regexp_matches(f.ndc, '^\d{5}-\d{4}-\d{2}$')"

LEDGER = FEED + f"""
, parsed AS (
  SELECT f.*, {_parsed('date_written')} AS s, {_parsed('date_filled')} AS e,
         TRY_CAST(quantity_dispensed AS INTEGER) AS qn, TRY_CAST(unit_price AS DOUBLE) AS pr,
         TRY_CAST(p.wac_unit_price AS DOUBLE) AS wac, p.ndc IS NOT NULL AS has_p, si.pharmacy_id IS NOT NULL AS has_s
  FROM feed f LEFT JOIN products p ON f.ndc = p.ndc LEFT JOIN sites si ON f.pharmacy_id = si.pharmacy_id),
rules(rule_id, rule_desc, severity) AS (VALUES
  ('R01', 'product code missing or malformed', 'REJECT'),
  ('R02', 'well-formed product code not in product master', 'REJECT'),
  ('R03', 'site not in site master', 'REJECT'),
  ('R04', 'quantity not a positive number', 'REJECT'),
  ('R05', 'start or end date cannot be parsed', 'REJECT'),
  ('R06', 'end date before start date', 'REJECT'),
  ('R07', 'end date after feed snapshot', 'REJECT'),
  ('R08', 'unit price far above reference (decimal shift)', 'REPAIR'),
  ('R09', 'duration missing (imputed from quantity)', 'REPAIR'),
  ('R10', 'prescriber missing', 'FLAG'),
  ('R11', 'claim id repeated', 'REPAIR')),
hits AS (
  SELECT claim_id, 'R01' AS rule_id, ndc AS bad_value FROM parsed f
    WHERE ndc IS NULL OR trim(ndc) = '' OR NOT {WELL_FORMED}
  UNION ALL SELECT claim_id, 'R02', ndc FROM parsed f WHERE {WELL_FORMED} AND NOT has_p
  UNION ALL SELECT claim_id, 'R03', pharmacy_id FROM parsed WHERE NOT has_s
  UNION ALL SELECT claim_id, 'R04', quantity_dispensed FROM parsed WHERE qn IS NULL OR qn <= 0
  UNION ALL SELECT claim_id, 'R05', date_written || ' | ' || date_filled FROM parsed WHERE s IS NULL OR e IS NULL
  UNION ALL SELECT claim_id, 'R06', CAST(s AS VARCHAR) || ' -> ' || CAST(e AS VARCHAR) FROM parsed WHERE e < s
  UNION ALL SELECT claim_id, 'R07', CAST(e AS VARCHAR) FROM parsed WHERE e > DATE '2026-02-01'
  UNION ALL SELECT claim_id, 'R08', unit_price FROM parsed WHERE pr > 20 * wac
  UNION ALL SELECT claim_id, 'R09', days_supply FROM parsed WHERE days_supply IS NULL OR trim(days_supply) = ''
  UNION ALL SELECT claim_id, 'R10', prescriber_npi FROM parsed WHERE prescriber_npi IS NULL OR trim(prescriber_npi) = ''
  UNION ALL SELECT claim_id, 'R11', count(*) || ' copies' FROM feed GROUP BY claim_id HAVING count(*) > 1),
ledger AS (SELECT claim_id, rule_id, rule_desc, severity, bad_value FROM hits JOIN rules USING (rule_id)),
rejected AS (
  SELECT claim_id, string_agg(DISTINCT rule_id, ',' ORDER BY rule_id) AS rejection_reasons
  FROM ledger WHERE severity = 'REJECT' GROUP BY claim_id),
held AS (SELECT f.*, rejection_reasons FROM feed f JOIN rejected USING (claim_id))
"""

CLEAN = LEDGER + """
, alive AS (SELECT DISTINCT p.* FROM parsed p ANTI JOIN rejected USING (claim_id)),
cents AS (
  SELECT a.claim_id, a.ndc, a.pharmacy_id, CAST(patient_age AS SMALLINT) AS patient_age,
         NULLIF(trim(prescriber_npi), '') AS prescriber_npi, s AS date_written, e AS date_filled,
         CAST(quantity_dispensed AS INTEGER) AS quantity_dispensed,
         CASE upper(trim(state_raw)) WHEN 'NEW YORK' THEN 'NY' WHEN 'CALIFORNIA' THEN 'CA' WHEN 'TEXAS' THEN 'TX'
              WHEN 'FLORIDA' THEN 'FL' ELSE upper(trim(state_raw)) END AS state,
         CASE upper(left(trim(patient_gender), 1)) WHEN 'M' THEN 'M' WHEN 'F' THEN 'F' ELSE 'U' END AS patient_gender,
         m.drug_name, m.therapeutic_class,
         CAST(CAST(unit_price AS DECIMAL(12,2)) * 100 AS BIGINT) AS price_c,
         CAST(CAST(m.wac_unit_price AS DECIMAL(12,2)) * 100 AS BIGINT) AS wac_c,
         TRY_CAST(NULLIF(trim(days_supply), '') AS INTEGER) AS days
  FROM alive a JOIN products m ON a.ndc = m.ndc),
repaired AS (
  SELECT * EXCLUDE (price_c, wac_c, days),
         CASE WHEN price_c > 20 * wac_c THEN (price_c + 50) // 100 ELSE price_c END AS unit_c,
         price_c > 20 * wac_c AS price_was_repaired,
         COALESCE(days, quantity_dispensed) AS days_supply, days IS NULL AS days_supply_was_imputed,
         prescriber_npi IS NULL AS npi_is_missing
  FROM cents),
clean AS (
  SELECT * EXCLUDE (unit_c), CAST(unit_c AS DOUBLE) / 100 AS unit_price,
         CAST(quantity_dispensed * unit_c AS DOUBLE) / 100 AS total_paid
  FROM repaired
  QUALIFY row_number() OVER (
    PARTITION BY ndc, pharmacy_id, prescriber_npi, date_written, date_filled, quantity_dispensed, unit_c,
                 patient_age, patient_gender ORDER BY claim_id) = 1)
"""
