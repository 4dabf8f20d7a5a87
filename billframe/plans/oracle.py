"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code: the truth of every rendered invoice
is stated per render style straight from the clean driver columns (integer
cents, integer half-up FX), never by re-parsing text.
"""

from __future__ import annotations

_TRUTH = """
WITH base AS (
  SELECT o.o_orderkey AS k,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS c,
         CAST(o.o_orderdate AS DATE) AS d,
         cu.c_nationkey % 6 AS ns
  FROM orders o JOIN customer cu ON o.o_custkey = cu.c_custkey
), t1 AS (
  SELECT *, (c * 85) // 100 AS p, k % 13 AS ts, (k // 13) % 5 AS ps, k % 11 AS ds,
         CASE WHEN (k // 2) % 3 = 0 THEN 0 ELSE (k // 2) % 200 END AS vend,
         CASE ns WHEN 0 THEN 'GBP' WHEN 1 THEN 'INR' WHEN 2 THEN 'USD' WHEN 3 THEN 'EUR'
                 WHEN 4 THEN 'INR' ELSE 'JPY' END AS ccy,
         CASE ns WHEN 0 THEN 100 WHEN 1 THEN 12500 WHEN 2 THEN 127 WHEN 3 THEN 117
                 WHEN 4 THEN 12500 ELSE NULL END AS r100
  FROM base
), t2 AS (
  SELECT *,
    CASE WHEN ts IN (5, 6) THEN -c WHEN ts IN (7, 8, 9) THEN 0 WHEN ts = 10 THEN NULL ELSE c END AS total_c,
    CASE WHEN ps IN (2, 3) THEN 0 ELSE p END AS prod_c,
    CASE WHEN k % 17 = 0 THEN 0 ELSE c - p END AS vat_c,
    CASE WHEN k % 19 = 0 THEN 5250 ELSE 0 END AS coupon_c,
    CASE WHEN ds = 10 THEN NULL
         WHEN ds = 9 AND day(d) <= 12 THEN make_date(year(d), day(d), month(d))
         ELSE d END AS date_t,
    (ds IN (0, 1, 8, 9) AND day(d) <= 12) AS ambiguous,
    (k % 7 IN (0, 1, 6)) AS rate_nz,
    ((30 + (k * 37) % 70) < 60 OR (50 + (k * 13) % 50) < 60) AS low_conf,
    (k % 9 = 0) AS multi,
    CASE WHEN k % 2 = 0 THEN 'Acme Trading ' || lpad(CAST(CASE WHEN (k // 2) % 3 = 0 THEN 0 ELSE (k // 2) % 200 END AS VARCHAR), 3, '0') || ' Ltd'
         ELSE 'ACME  tráding-' || lpad(CAST(CASE WHEN (k // 2) % 3 = 0 THEN 0 ELSE (k // 2) % 200 END AS VARCHAR), 3, '0') || ' ltd.' END AS company,
    CASE WHEN k % 2 = 0 THEN 'INV/' || CAST(k // 2 AS VARCHAR) ELSE 'inv  - ' || CAST(k // 2 AS VARCHAR) END AS reference,
    'ACMETRADING' || lpad(CAST(CASE WHEN (k // 2) % 3 = 0 THEN 0 ELSE (k // 2) % 200 END AS VARCHAR), 3, '0') || 'LTD' AS vendor_key,
    'ACMETRADING' || lpad(CAST(CASE WHEN (k // 2) % 3 = 0 THEN 0 ELSE (k // 2) % 200 END AS VARCHAR), 3, '0') || 'LTD|INV'
      || CAST(k // 2 AS VARCHAR) AS dedup_key
  FROM t1
), t3 AS (
  SELECT *,
    CASE WHEN k % 61 = 5 THEN 'EXTRACTION_FAILED'
         WHEN r100 IS NULL THEN 'EXTRACTION_FAILED'
         WHEN ds = 10 THEN 'UNPARSEABLE_DATE'
         WHEN k % 53 = 7 OR k % 59 = 3 THEN 'MISSING_MANDATORY_FIELD'
         WHEN ts = 10 THEN 'UNPARSEABLE_DECIMAL'
         WHEN ts IN (5, 6) THEN 'NEGATIVE_MONEY_VALUE' END AS hard_rule,
    CASE WHEN k % 61 = 5 THEN 'BedrockMappingError'
         WHEN r100 IS NULL THEN 'UnhandledException'
         WHEN ds = 10 OR k % 53 = 7 OR k % 59 = 3 OR ts IN (5, 6, 10) THEN 'ValidationError' END AS error_type,
    CASE WHEN k % 61 = 5 THEN 'mapping'
         WHEN r100 IS NULL THEN 'unknown'
         WHEN ds = 10 OR k % 53 = 7 OR k % 59 = 3 OR ts IN (5, 6, 10) THEN 'pydantic_validation' END AS failed_at_stage
  FROM t2
), t4 AS (
  SELECT *,
    CASE WHEN hard_rule IS NOT NULL THEN NULL WHEN ccy = 'GBP' THEN total_c
         ELSE (2 * total_c * 100 + r100) // (2 * r100) END AS total_g,
    CASE WHEN hard_rule IS NOT NULL THEN NULL WHEN ccy = 'GBP' THEN prod_c
         ELSE (2 * prod_c * 100 + r100) // (2 * r100) END AS prod_g,
    CASE WHEN hard_rule IS NOT NULL THEN NULL WHEN ccy = 'GBP' THEN vat_c
         ELSE (2 * vat_c * 100 + r100) // (2 * r100) END AS vat_g
  FROM t3
), truth AS (
  SELECT *,
    CASE WHEN hard_rule IS NOT NULL THEN '' ELSE concat_ws(',',
      CASE WHEN total_g = 0 THEN 'ZERO_TOTAL_AMOUNT' END,
      CASE WHEN prod_g = 0 THEN 'ZERO_PRODUCT_AMOUNT' END,
      CASE WHEN vat_g = 0 AND rate_nz THEN 'ZERO_TAX_WITH_NONZERO_RATE' END,
      CASE WHEN low_conf THEN 'LOW_FIELD_CONFIDENCE' END,
      CASE WHEN ambiguous THEN 'AMBIGUOUS_DATE_FORMAT' END,
      CASE WHEN multi THEN 'MULTIPLE_TOTAL_CANDIDATES' END) END AS flags,
    CAST(CAST(total_g AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS total_gbp,
    strftime(date_t, '%Y-%m') AS month
  FROM t4
), rec AS (
  SELECT *, CASE WHEN hard_rule IS NOT NULL THEN 'QUARANTINED'
                 WHEN flags = '' THEN 'LOADED' ELSE 'LOADED_WITH_WARNINGS' END AS status
  FROM truth
), cls AS (
  SELECT *, CASE WHEN hard_rule IS NULL
                  AND row_number() OVER (PARTITION BY CASE WHEN hard_rule IS NULL THEN dedup_key END ORDER BY k) > 1
                 THEN 'DUPLICATE_SKIPPED' ELSE status END AS final_status
  FROM rec
), gold AS (
  SELECT * FROM cls WHERE hard_rule IS NULL AND final_status <> 'DUPLICATE_SKIPPED'
), stones AS (
  SELECT * FROM cls WHERE hard_rule IS NOT NULL
)
"""


def _m2(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18, 2))"


def _cents(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2))"


_LINES = """
WITH l AS (
  SELECT l.l_orderkey AS k, l.l_linenumber AS n, p.p_name AS item,
         CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) AS qty,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS ac,
         CAST(30 + (l.l_orderkey + l.l_linenumber * 7) % 70 AS DOUBLE) AS qty_conf,
         row_number() OVER (PARTITION BY l.l_orderkey
           ORDER BY l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice) - 1 AS row_index
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
), o AS (
  SELECT o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS c, CAST(o_orderdate AS DATE) AS d,
         (o_orderkey % 7 = 0) AS low
  FROM orders
), cells AS (
  SELECT k, row_index, 0 AS col_pos, 'ITEM' AS col, item AS value, CAST(90 AS DOUBLE) AS confidence FROM l
  UNION ALL SELECT k, row_index, 1, 'Qty', CASE WHEN n % 5 = 0 THEN 'dup' ELSE qty END, qty_conf FROM l
  UNION ALL SELECT k, row_index, 2, 'Amount', printf('%d.%02d', ac // 100, ac % 100), CAST(60 + n AS DOUBLE) FROM l
  UNION ALL SELECT k, row_index, 3, 'COL3', 'note', NULL FROM l WHERE n % 4 = 0
), summ AS (
  SELECT k, 0 AS item, 'VENDOR_NAME' AS type, 'Vendor:' AS label, 'Acme Trading ' || CAST(k % 200 AS VARCHAR) AS value,
         CAST(CASE WHEN low THEN 10 ELSE 50 + k % 50 END AS DOUBLE) AS confidence, 1 AS page FROM o
  UNION ALL SELECT k, 1, 'TOTAL', 'TOTAL', printf('%d.%02d', c // 100, c % 100),
         CAST(CASE WHEN low THEN 20 ELSE 40 + (k * 3) % 60 END AS DOUBLE), 1 FROM o
  UNION ALL SELECT k, 2, 'INVOICE_RECEIPT_DATE', 'Invoice' || chr(10) || ' Date:', strftime(d, '%d-%m-%Y'),
         CAST(CASE WHEN low THEN 30 ELSE 99 END AS DOUBLE), 1 FROM o
)
"""

ORACLE = {
    "dq_status": _TRUTH + f"""
SELECT status, CAST(count(*) AS BIGINT) AS n,
       CAST(coalesce(sum(total_gbp), 0) AS DECIMAL(18, 2)) AS total_gbp
FROM rec GROUP BY status""",
    "coerce_money": """
WITH o AS (SELECT o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)
SELECT k AS o_orderkey,
  """ + _cents("CASE WHEN k % 13 IN (5, 6) THEN -c WHEN k % 13 IN (7, 8, 9) THEN 0 WHEN k % 13 = 10 THEN NULL ELSE c END") + """ AS total_value,
  (k % 13 = 10) AS total_error,
  """ + _cents("CASE WHEN (k // 13) % 5 IN (2, 3) THEN 0 ELSE (c * 85) // 100 END") + """ AS product_value
FROM o""",
    "coerce_date": _TRUTH + """
SELECT k AS o_orderkey, date_t AS invoice_date, ambiguous FROM truth""",
    "nullish_fields": """
SELECT c_custkey,
  CASE WHEN c_custkey % 6 < 5 THEN 'N/A' ELSE c_name END AS optional_value,
  CASE WHEN c_custkey % 6 < 5 THEN NULL ELSE c_name END AS mandatory_value,
  (c_custkey % 6 < 5) AS mandatory_error
FROM customer""",
    "fx_convert": """
WITH o AS (
  SELECT o.o_orderkey AS k, CAST(round(o.o_totalprice * 100) AS BIGINT) AS c, cu.c_nationkey % 6 AS ns
  FROM orders o JOIN customer cu ON o.o_custkey = cu.c_custkey
), r AS (
  SELECT *, CASE ns WHEN 0 THEN 'GBP' WHEN 1 THEN 'INR' WHEN 2 THEN 'USD' WHEN 3 THEN 'EUR'
                    WHEN 4 THEN 'INR' ELSE 'JPY' END AS currency,
            CASE ns WHEN 0 THEN 100 WHEN 1 THEN 12500 WHEN 2 THEN 127 WHEN 3 THEN 117
                    WHEN 4 THEN 12500 ELSE NULL END AS r100
  FROM o
)
SELECT k AS o_orderkey, currency,
  """ + _cents("CASE WHEN currency = 'GBP' THEN c ELSE (2 * c * 100 + r100) // (2 * r100) END") + """ AS amount_gbp,
  CASE WHEN r100 IS NULL THEN NULL ELSE TRUE END AS fx_reversible
FROM r""",
    "hard_rules": _TRUTH + """
SELECT k AS o_orderkey, status, hard_rule, error_type, failed_at_stage FROM rec""",
    "dq_flags": _TRUTH + """
SELECT k AS o_orderkey, flags, status, total_gbp FROM rec""",
    "flag_counts": _TRUTH + """
, f AS (SELECT unnest(string_split(flags, ',')) AS rule FROM rec WHERE flags <> '')
, rules AS (SELECT * FROM (VALUES ('ZERO_TOTAL_AMOUNT'), ('ZERO_PRODUCT_AMOUNT'), ('ZERO_TAX_WITH_NONZERO_RATE'),
    ('LOW_FIELD_CONFIDENCE'), ('AMBIGUOUS_DATE_FORMAT'), ('MULTIPLE_TOTAL_CANDIDATES')) v(rule))
SELECT rules.rule, CAST(count(f.rule) AS BIGINT) AS n FROM rules LEFT JOIN f ON rules.rule = f.rule GROUP BY rules.rule""",
    "key_fold": """
SELECT 'supplier' AS src, s_suppkey AS id,
  upper(regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g')) || CASE WHEN s_suppkey % 4 = 3 THEN 'LTD' ELSE '' END AS key
FROM supplier
UNION ALL
SELECT 'part' AS src, p_partkey AS id,
  upper(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g')) || CASE WHEN p_partkey % 4 = 3 THEN 'LTD' ELSE '' END AS key
FROM part""",
    "load_first_wins": _TRUTH + """
SELECT final_status AS status, CAST(count(*) AS BIGINT) AS n FROM cls GROUP BY final_status""",
    "load_duplicates": _TRUTH + """
SELECT k AS o_orderkey, dedup_key FROM cls WHERE final_status = 'DUPLICATE_SKIPPED'""",
    "quarantine_tombstones": _TRUTH + """
SELECT hard_rule AS dq_rule, error_type,
  CASE WHEN failed_at_stage = 'unknown' THEN 'pydantic_validation' ELSE failed_at_stage END AS failed_at_stage,
  CAST(count(*) AS BIGINT) AS n
FROM stones GROUP BY 1, 2, 3""",
    "query_month": _TRUTH + """
SELECT CAST(count(*) AS BIGINT) AS matched, CAST(coalesce(sum(total_gbp), 0) AS DECIMAL(18, 2)) AS total_gbp
FROM gold WHERE month = '1996-03'""",
    "query_status": _TRUTH + """
SELECT 'LOADED_WITH_WARNINGS' AS asked, CAST(count(*) AS BIGINT) AS matched FROM gold WHERE final_status = 'LOADED_WITH_WARNINGS'
UNION ALL SELECT 'QUARANTINED', CAST(count(*) AS BIGINT) FROM stones
UNION ALL SELECT 'scan_all', CAST(count(*) AS BIGINT) FROM gold""",
    "vendor_sum": _TRUTH + """
SELECT CAST(count(*) AS BIGINT) AS matched, CAST(coalesce(sum(total_gbp), 0) AS DECIMAL(18, 2)) AS total_gbp
FROM gold WHERE strpos(lower(company), 'trading 01') > 0""",
    "vendor_list": _TRUTH + """
SELECT company AS company_name, reference AS invoice_reference_number, total_gbp AS total_amount,
       'GBP' AS currency, final_status AS status, date_t AS date
FROM gold WHERE final_status = 'LOADED' AND strpos(lower(company), 'trading 00') > 0""",
    "batch_stats": _TRUTH + """
, s AS (SELECT
    (SELECT count(*) FROM gold) + (SELECT count(*) FROM stones) AS items_scanned,
    (SELECT count(*) FROM gold) AS invoice_records,
    (SELECT count(*) FROM stones) AS quarantine_tombstones,
    (SELECT coalesce(sum(total_gbp), 0) FROM gold) AS total_gbp,
    (SELECT count(*) FROM gold WHERE final_status = 'LOADED') AS loaded)
SELECT CAST(items_scanned AS BIGINT) AS items_scanned, CAST(invoice_records AS BIGINT) AS invoice_records,
       CAST(quarantine_tombstones AS BIGINT) AS quarantine_tombstones, CAST(total_gbp AS DECIMAL(18, 2)) AS total_gbp,
       CAST(CAST(CASE WHEN invoice_records = 0 THEN 0
            ELSE (2 * loaded * 10000 + invoice_records) // (2 * invoice_records) END AS DECIMAL(18, 0))
            * CAST(0.0001 AS DECIMAL(5, 4)) AS DECIMAL(10, 4)) AS clean_rate,
       items_scanned >= 1000000 AS exceeds_migration_threshold
FROM s""",
    "by_vendor": _TRUTH + """
SELECT vendor_key AS key, CAST(count(*) AS BIGINT) AS n FROM gold GROUP BY vendor_key""",
    "by_month": _TRUTH + """
SELECT month AS key, CAST(count(*) AS BIGINT) AS n FROM gold GROUP BY month""",
    "by_currency": _TRUTH + """
SELECT ccy AS key, CAST(count(*) AS BIGINT) AS n FROM gold GROUP BY ccy""",
    "by_status_items": _TRUTH + """
SELECT final_status AS key, CAST(count(*) AS BIGINT) AS n FROM gold GROUP BY final_status
UNION ALL SELECT 'QUARANTINED', CAST(count(*) AS BIGINT) FROM stones""",
    "quarantine_reasons": _TRUTH + """
SELECT error_type AS key, CAST(count(*) AS BIGINT) AS n FROM stones GROUP BY error_type""",
    "expense_summary": _LINES + """
SELECT k AS o_orderkey, item, type, label, value, confidence, page FROM summ""",
    "expense_line_items": _LINES + """
SELECT k AS o_orderkey, row_index, col_pos, col, value, confidence FROM cells""",
    "label_confidence": _LINES + """
SELECT k AS o_orderkey, 'summary_max' AS kind, CASE WHEN label = 'Invoice' || chr(10) || ' Date:' THEN 'Invoice Date:' ELSE label END AS label,
       CAST(confidence AS DECIMAL(10, 4)) AS confidence FROM summ
UNION ALL
SELECT k, 'line_min', col, CAST(min(confidence) AS DECIMAL(10, 4)) FROM cells WHERE confidence IS NOT NULL GROUP BY k, col
UNION ALL
SELECT k, 'mean', '', CAST(round(avg(confidence), 4) AS DECIMAL(10, 4)) FROM summ GROUP BY k""",
    "block_pairs": _LINES + """
SELECT k AS o_orderkey, 'OTHER' AS type, 'Order ID' AS label, CAST(k AS VARCHAR) AS value,
       CAST(40 + k % 60 AS DOUBLE) AS confidence, 1 AS page FROM o
UNION ALL
SELECT k, 'OTHER', 'Grand Total', printf('%d.%02d', c // 100, c % 100), CAST(90 AS DOUBLE), 1 FROM o""",
    "block_tables": _LINES + """
SELECT k AS o_orderkey, row_index, 'Description' AS col, item AS value, (88 + qty_conf) / 2 AS row_confidence FROM l
UNION ALL
SELECT k, row_index, 'Qty', qty, (88 + qty_conf) / 2 FROM l""",
    "fallback_merge": _LINES + """
, nl AS (SELECT k, count(*) AS n FROM l GROUP BY k)
SELECT o.k AS o_orderkey, CASE WHEN low THEN 'AnalyzeDocument' ELSE 'AnalyzeExpense' END AS api,
       CASE WHEN low THEN 2 ELSE 0 END AS n_warnings, TRUE AS extraction_ok,
       CAST(CASE WHEN low THEN 5 ELSE 3 END AS BIGINT) AS n_summary_fields,
       CAST(coalesce(CASE WHEN low THEN 2 * nl.n ELSE nl.n END, 0) AS BIGINT) AS n_line_items
FROM o LEFT JOIN nl ON o.k = nl.k""",
    "product_name_join": _LINES + """
SELECT k AS o_orderkey, string_agg(item, '; ' ORDER BY row_index) AS product_name FROM l GROUP BY k""",
    "resolve_confidence": _LINES + """
SELECT k AS o_orderkey, 'company_name' AS field, confidence FROM summ WHERE item = 0
UNION ALL SELECT k, 'total_amount', confidence FROM summ WHERE item = 1
UNION ALL SELECT k, 'date', confidence FROM summ WHERE item = 2
UNION ALL SELECT DISTINCT k, 'product_name', CAST(90 AS DOUBLE) FROM l""",
    "attempt_select": """
SELECT o_orderkey,
  (o_orderkey % 9 <> 0) AS mapping_ok,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS attempts,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'Acme Trading ' || CAST(o_orderkey % 200 AS VARCHAR) END AS company_name,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE printf('%.2f', o_totalprice) END AS total_amount,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'N/A' END AS product_name,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 8 ELSE 2 END AS n_labels,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(1000 + o_orderkey % 500 AS BIGINT) END AS input_tokens,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN CAST(202 AS BIGINT) ELSE CAST(201 AS BIGINT) END AS output_tokens
FROM orders""",
    "alias_learn": """
WITH w AS (
  SELECT o_orderkey AS k, 'ACMETRADING' || CAST(o_orderkey % 200 AS VARCHAR) AS vendor_key,
         CASE WHEN o_orderkey % 2 = 0 THEN 9 ELSE 3 END AS covered,
         CASE WHEN o_orderkey % 2 = 0 THEN 8 ELSE 2 END AS n_aliases
  FROM orders WHERE o_orderkey % 9 <> 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY vendor_key ORDER BY covered DESC, k DESC) AS rn FROM w
)
SELECT vendor_key, CAST(round(covered / 13.0, 4) AS DECIMAL(10, 4)) AS coverage, k AS learned_from,
       CAST(n_aliases AS BIGINT) AS n_aliases, 'INR' AS constant_currency
FROM r WHERE rn = 1""",
    "manifest_diff": """
SELECT doc_id, printf('doc_%d.pdf', doc_id) AS filename, n_chars AS size_bytes
FROM documents WHERE doc_id % 3 = 0 OR doc_id % 5 = 0""",
    "batch_partition": """
SELECT CAST(ts AS DATE) AS batch_date, strftime(CAST(ts AS DATE), '%Y/%m/%d/') AS prefix,
       CAST(year(ts) AS VARCHAR) || '/' || CAST(month(ts) AS VARCHAR) || '/' || CAST(day(ts) AS VARCHAR) || '/' AS unpadded_prefix,
       CAST(count(*) AS BIGINT) AS n_files
FROM events GROUP BY 1, 2, 3""",
}
