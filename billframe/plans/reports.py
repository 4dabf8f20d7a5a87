"""Registered queries over the driver tables: look-ups, reports, provenance, history, aliases, gates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billframe.config import DUPLICATE_SKIPPED, MAX_DOCUMENT_SIZE_BYTES, QUARANTINED
from billframe.operators import extract as X
from billframe.operators import load as L
from billframe.operators import mapping as M
from billframe.operators import query as Q
from billframe.operators import stats as T
from billframe.operators.records import fx_audit as audited
from billframe.plans import rendered as R
from billframe.plans.catalog import M2, _attempts, _blocks, _expense, _okey
from billframe.plans.oracle import _LINES, _TRUTH
from billframe.plans.stages import materialize, stage_root
from billframe.session import configure
from billframe.sources.envelopes import rendered_expense
from billframe.sources.manifest import gate_rule
from billframe.sources.tables import dealt, table

MONTH = "1996-03"


def get_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Q4: one invoice by a vendor and reference printed in another way than it was stored."""
    gold, _ = R.gold_and_tombstones(spark, sf)
    found = Q.get_by_key(gold, "acme   TRÁDING 005 (ltd)", "Inv # 5")
    return found.select("dedup_key", "month", F.col("total_amount").cast(M2).alias("total_gbp"))


def answer_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Q9: the first matches of a list answer and whether there are more."""
    gold, stones = R.gold_and_tombstones(spark, sf)
    sample = Q.answer_sample(Q.fetch(gold, stones, {"operation": "query_status", "status": "LOADED"}))
    return sample.select(
        "company_name", "invoice_reference_number", F.col("total_amount").cast(M2).alias("total_gbp"), "status", "truncated"
    )


def month_stats(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics of one month, without tombstones."""
    s = T.summary(T.month_scope(Q.scan_all(*R.gold_and_tombstones(spark, sf)), MONTH))
    return s.select("items_scanned", "invoice_records", "quarantine_tombstones",
                    F.col("total_gbp").cast(M2).alias("total_gbp"), "clean_rate")


def flag_report(spark: SparkSession, sf: str) -> DataFrame:
    """Every soft rule with its count over the stored items, zeroes included."""
    return T.flag_report(T.breakdown(Q.scan_all(*R.gold_and_tombstones(spark, sf)))).select("rule", "n")


def batch_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome and flag counts of the batch."""
    out = L.outcomes(R.classified(spark, sf))
    return T.batch_counts(out).select(F.lit("outcome").alias("kind"), F.col("outcome").alias("key"), "n").unionByName(
        T.batch_flag_counts(out).select(F.lit("flag").alias("kind"), F.col("flag").alias("key"), "n"))


def rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    """F16: the rule catalogue with how often each rule decided or flagged an invoice."""
    c = R.classified(spark, sf)
    kept = c.where(~F.col("status").isin(DUPLICATE_SKIPPED, QUARANTINED))
    seen = kept.select(F.explode("dq_flags").alias("name")).unionByName(
        c.where(F.col("status") == QUARANTINED).select(F.col("hard_rule").alias("name"))).unionByName(
        c.where(F.col("status") == DUPLICATE_SKIPPED).select(F.lit(DUPLICATE_SKIPPED).alias("name")))
    n = seen.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return T.rule_catalogue(spark).join(n, "name", "left").select(
        "name", "severity", "stage", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def provenance(spark: SparkSession, sf: str) -> DataFrame:
    """What every valid record keeps of its original amounts and rate."""
    r = R.records(spark, sf).where(F.col("hard_rule").isNull())
    return r.select(
        F.col("load_order").alias("o_orderkey"), "original_currency",
        F.col("original_total_amount").cast(M2).alias("original_total"),
        F.col("original_product_amount").cast(M2).alias("original_product"),
        F.col("fx_rate_applied").cast(M2).alias("fx_rate"), "fx_rate_date",
    )


def fx_audit(spark: SparkSession, sf: str) -> DataFrame:
    """E5: the audit of stored totals, a tenth of which were changed by two pence."""
    r = R.records(spark, sf)
    changed = F.col("total_amount") + F.when(F.col("load_order") % 10 == 0, F.lit("0.02").cast(M2)).otherwise(F.lit("0").cast(M2))
    return audited(r.withColumn("total_amount", changed)).where(F.col("hard_rule").isNull()).select(
        F.col("load_order").alias("o_orderkey"), "fx_reversible")


def load_history(spark: SparkSession, sf: str) -> DataFrame:
    """K5: invoices ordered from 1998 on, loaded after the earlier ones."""
    dates = table(spark, sf, "orders").select(F.col("o_orderkey").alias("load_order"), "o_orderdate")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("date")
    r = R.records(spark, sf).join(dates.hint("shuffle_hash"), "load_order")
    earlier = L.first_write_wins(r.where(~late).drop("o_orderdate"))
    history = earlier.where("is_new").select("dedup_key")
    return L.first_write_wins(r.where(late).drop("o_orderdate"), history).select(
        F.col("load_order").alias("o_orderkey"), "status")


def page_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of both kinds of result."""
    cols = ["source_file", "api", "page_count", "job_status"]
    both = X.expense_headers(_expense(spark, sf)).select(*cols).unionByName(X.block_headers(_blocks(spark, sf)).select(*cols))
    return both.select(_okey(), "api", "page_count", "job_status")


def label_value_view(spark: SparkSession, sf: str) -> DataFrame:
    """The compact view of summary fields."""
    v = X.label_value_pairs(X.expense_summary_fields(_expense(spark, sf)))
    return v.select(_okey(), "type", "label", "value", "confidence", "page")


def malformed_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies that are whole, cut off, preceded by a byte order mark or no JSON; jobs not finished."""
    configure(spark)
    k, body = F.col("load_order"), F.col("body")
    status = F.when(k % 5 == 0, F.regexp_replace(body, '"SUCCEEDED"', '"IN_PROGRESS"')).when(
        k % 5 == 1, F.regexp_replace(body, '"SUCCEEDED"', '"PARTIAL_SUCCESS"')).otherwise(body)
    bodies = rendered_expense(spark, sf).withColumn("body", status).withColumn(
        "body",
        F.when(k % 4 == 1, F.substring(body, F.lit(1), (F.length(body) / 2).cast("int")))
        .when(k % 4 == 2, F.concat(F.lit("﻿"), body))
        .when(k % 4 == 3, F.lit("{oops"))
        .otherwise(body),
    )
    parsed = X.parse_envelopes(bodies)
    n = X.expense_summary_fields(parsed).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_fields"))
    return parsed.select("source_file", F.col("env").isNull().alias("malformed"), X.job_succeeded(F.col("env")).alias("job_ok")).join(
        n, "source_file", "left").select(_okey(), "malformed", "job_ok", F.coalesce("n_fields", F.lit(0)).alias("n_fields"))


def _printed(spark: SparkSession, sf: str) -> DataFrame:
    """Summary fields as the vendors of ``_attempts`` print them. Every sixth invoice has no typed
    vendor, every fifth no number."""
    o = dealt(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), "o_orderkey")
    k = F.col("o_orderkey")
    f = lambda typ, label, value: F.struct(typ.alias("type"), F.lit(label).alias("label"), value.alias("value"))
    other = F.lit("OTHER")
    fields = F.array(
        f(F.when(k % 6 == 0, other).otherwise(F.lit("VENDOR_NAME")), "Vendor:", F.concat(F.lit("Acme Trading "), (k % 200).cast("string"))),
        f(other, " Invoice Date:", F.date_format("o_orderdate", "dd-MM-yyyy")),
        f(other, "Bill To", F.concat(F.lit("Buyer "), F.col("o_custkey").cast("string"))),
        F.when(k % 5 != 0, f(other, "Invoice No", F.concat(F.lit("INV/"), k.cast("string")))),
        f(other, "TOTAL", F.format_string("%.2f", F.col("o_totalprice"))),
    )
    rows = o.select(F.format_string("invoice_%d.pdf", k).alias("source_file"),
                    F.posexplode(F.filter(fields, lambda x: x.isNotNull())).alias("i", "f"))
    return rows.select("source_file", F.struct(F.lit(0).alias("branch"), F.lit(0).alias("doc"), F.col("i").alias("item")).alias("pos"), "f.*")


def vendor_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The vendor of every invoice, by type or else by label."""
    configure(spark)
    return M.vendor_keys(_printed(spark, sf)).select(_okey(), "vendor_key")


def _learned(spark: SparkSession, sf: str) -> DataFrame:
    """The model's payloads with the order of their invoices, written once."""
    order = F.regexp_extract("source_file", r"invoice_(\d+)\.pdf", 1).cast("long")
    return materialize(lambda: M.select_attempt(_attempts(spark, sf)).withColumn("load_order", order), "alias_learned", (sf,), spark=spark)


def alias_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Invoices whose payload is rebuilt from labels learned before. Vendors known too little and
    invoices without a required field are left to the model."""
    configure(spark)
    hits = M.apply_entries(_printed(spark, sf), M.learn_entries(_learned(spark, sf).where("mapping_ok")))
    return hits.select(
        _okey(), F.col("fields.company_name").alias("company_name"), F.col("fields.date").alias("date"),
        F.col("fields.invoice_reference_number").alias("reference"), F.col("fields.total_amount").alias("total_amount"),
        F.col("fields.currency").alias("currency"), "source",
    )


def alias_apply_in_batch(spark: SparkSession, sf: str) -> DataFrame:
    """One batch in which an invoice sees what the invoices before it taught; who went to the model."""
    configure(spark)
    learned = _learned(spark, sf)
    routed = M.map_in_order(_printed(spark, sf), learned.drop("load_order"), learned.select("source_file", "load_order"))
    return routed.select(_okey(), "mapping_ok", "source", "attempts", F.col("fields.invoice_reference_number").alias("reference"))


def size_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The gates over a manifest with empty, oversized and headless files."""
    configure(spark)
    i = F.col("doc_id")
    size = F.when(i % 10 == 0, F.lit(0)).when(i % 10 == 1, F.lit(MAX_DOCUMENT_SIZE_BYTES + 1)).when(
        i % 10 == 2, F.lit(MAX_DOCUMENT_SIZE_BYTES)).otherwise(F.octet_length("text")).cast("bigint")
    manifest = table(spark, sf, "documents").select(
        "doc_id", size.alias("size_bytes"), F.when(i % 10 != 1, i % 7 != 0).alias("has_pdf_magic"))
    return gate_rule(manifest).select("doc_id", "size_bytes", "hard_rule", "failed_at_stage")


def size_gate_contents(spark: SparkSession, sf: str) -> DataFrame:
    """The gates over the measured size and first five bytes of every text, as it is and under a PDF header."""
    configure(spark)
    text = F.coalesce("text", F.lit(""))
    files = table(spark, sf, "documents").select("doc_id", F.explode(F.array(
        F.struct(F.lit("plain").alias("kind"), text.cast("binary").alias("content")),
        F.struct(F.lit("headed").alias("kind"), F.concat(F.lit("%PDF-1.7 "), text).cast("binary").alias("content")),
    )).alias("f")).select("doc_id", "f.*")
    manifest = files.select(
        "doc_id", "kind", F.octet_length("content").cast("bigint").alias("size_bytes"),
        (F.substring("content", 1, 5) == F.lit(bytearray(b"%PDF-"))).alias("has_pdf_magic"))
    return gate_rule(manifest).select("doc_id", "kind", "size_bytes", "has_pdf_magic", "hard_rule", "failed_at_stage")


def document_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON given to the mapping model, by some of its members."""
    p = _expense(spark, sf)
    headers = X.expense_headers(p).withColumn("warnings", F.array().cast("array<string>"))
    m = M.document_messages(headers, X.expense_summary_fields(p), X.expense_line_items(p))
    get = lambda path: F.get_json_object("message", path)
    return m.select(
        _okey(), get("$.extracted_by").alias("extracted_by"), get("$.page_count").cast("int").alias("page_count"),
        get("$.label_value_pairs[1].value").alias("total"), get("$.label_value_pairs[3]").isNull().alias("three_pairs"),
        get("$.line_items[0].Amount").alias("first_amount"),
    )


def gold_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    """Gold written as JSON lines with money as text and read back, by status."""
    gold, _ = R.gold_and_tombstones(spark, sf)
    path = f"{stage_root(spark)}/gold-jsonl-{uuid.uuid4().hex[:12]}"
    L.write_gold_jsonl(gold, path)
    return L.read_gold_jsonl(spark, path, gold.schema).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").cast(M2).alias("total_gbp"))


def assembled_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Results captured in two pages, out of order; jobs that failed or had not ended."""
    configure(spark)
    k = F.col("load_order")
    status = F.when(k % 11 == 0, "FAILED").when(k % 13 == 0, "IN_PROGRESS").when(k % 3 == 0, "PARTIAL_SUCCESS").otherwise("SUCCEEDED")
    pages = rendered_expense(spark, sf).select(
        "source_file", F.explode(F.array(F.lit(2), F.lit(1))).alias("page_no"), status.alias("status"), "body")
    whole = X.assemble_pages(pages, "ExpenseDocuments")
    parsed = materialize(X.parse_envelopes(whole.select("source_file", "job_ok", "body")).drop("body"), "assembled_pages",
                         (uuid.uuid4().hex,), spark=spark)
    n = X.expense_summary_fields(parsed).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_fields"))
    return parsed.join(n, "source_file", "left").select(_okey(), "job_ok", F.coalesce("n_fields", F.lit(0)).alias("n_fields"))


QUERIES = {
    f.__name__: f
    for f in (
        get_by_key, answer_sample, month_stats, flag_report, batch_outcomes, rule_counts, provenance, fx_audit,
        load_history, page_counts, label_value_view, malformed_envelopes, vendor_keys, alias_apply, alias_apply_in_batch, size_gate,
        size_gate_contents,
        document_messages, gold_jsonl, assembled_pages,
    )
}

_RULES = """
rules(name, severity, stage) AS (VALUES
  ('MISSING_MANDATORY_FIELD', 'hard_fail', 'pydantic_validation'), ('NEGATIVE_MONEY_VALUE', 'hard_fail', 'pydantic_validation'),
  ('UNPARSEABLE_DATE', 'hard_fail', 'pydantic_validation'), ('UNPARSEABLE_DECIMAL', 'hard_fail', 'pydantic_validation'),
  ('EXTRACTION_FAILED', 'hard_fail', 'extraction_or_mapping'), ('ZERO_TOTAL_AMOUNT', 'soft_warn', 'pydantic_validation'),
  ('ZERO_PRODUCT_AMOUNT', 'soft_warn', 'pydantic_validation'), ('ZERO_TAX_WITH_NONZERO_RATE', 'soft_warn', 'pydantic_validation'),
  ('LOW_FIELD_CONFIDENCE', 'soft_warn', 'post_validation'), ('AMBIGUOUS_DATE_FORMAT', 'soft_warn', 'post_validation'),
  ('MULTIPLE_TOTAL_CANDIDATES', 'soft_warn', 'post_validation'), ('DUPLICATE_SKIPPED', 'special', 'storage')),
flagged AS (SELECT unnest(string_split(flags, ',')) AS name FROM gold WHERE flags <> ''),
seen AS (
  SELECT name FROM flagged UNION ALL SELECT hard_rule FROM stones
  UNION ALL SELECT final_status FROM cls WHERE final_status = 'DUPLICATE_SKIPPED'
)"""

ORACLE = {
    "get_by_key": _TRUTH + """
SELECT dedup_key, month, total_gbp FROM gold WHERE dedup_key = 'ACMETRADING005LTD|INV5'""",
    "answer_sample": _TRUTH + """
SELECT company AS company_name, reference AS invoice_reference_number, total_gbp, final_status AS status,
  (SELECT count(*) > 5 FROM gold WHERE final_status = 'LOADED') AS truncated
FROM gold WHERE final_status = 'LOADED' ORDER BY dedup_key LIMIT 5""",
    "month_stats": _TRUTH + f"""
SELECT count(*) AS items_scanned, count(*) AS invoice_records, CAST(0 AS BIGINT) AS quarantine_tombstones,
  CAST(coalesce(sum(total_gbp), 0) AS DECIMAL(18, 2)) AS total_gbp,
  CAST(coalesce(round(CAST(count(*) FILTER (final_status = 'LOADED') AS DECIMAL(18, 6)) / nullif(count(*), 0), 4), 0) AS DECIMAL(10, 4)) AS clean_rate
FROM gold WHERE month = '{MONTH}'""",
    "flag_report": _TRUTH + "," + _RULES + """
SELECT r.name AS rule, count(f.name) AS n FROM rules AS r LEFT JOIN flagged AS f ON r.name = f.name
WHERE severity = 'soft_warn' GROUP BY r.name""",
    "batch_outcomes": _TRUTH + "," + _RULES + """
SELECT 'outcome' AS kind, final_status AS key, count(*) AS n FROM cls GROUP BY final_status
UNION ALL SELECT 'flag', name, count(*) FROM flagged GROUP BY name""",
    "rule_counts": _TRUTH + "," + _RULES + """
SELECT r.name, severity, stage, count(s.name) AS n FROM rules AS r LEFT JOIN seen AS s ON r.name = s.name GROUP BY ALL""",
    "provenance": _TRUTH + """
SELECT k AS o_orderkey, ccy AS original_currency,
  CAST(CAST(total_c AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS original_total,
  CAST(CAST(prod_c AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS original_product,
  CAST(CAST(r100 AS DECIMAL(18, 0)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS fx_rate, DATE '2026-09-09' AS fx_rate_date
FROM rec WHERE hard_rule IS NULL""",
    "fx_audit": _TRUTH + """
SELECT k AS o_orderkey, k % 10 <> 0 AS fx_reversible FROM rec WHERE hard_rule IS NULL""",
    "load_history": _TRUTH + """
, placed AS (SELECT *, d >= DATE '1998-01-01' AS late FROM rec),
firsts AS (SELECT dedup_key, min(CASE WHEN late THEN 1 ELSE 0 END) AS batch, min(CASE WHEN late THEN k END) AS k
  FROM placed WHERE hard_rule IS NULL GROUP BY dedup_key)
SELECT p.k AS o_orderkey, CASE WHEN hard_rule IS NULL AND (f.batch = 0 OR f.k <> p.k) THEN 'DUPLICATE_SKIPPED' ELSE status END AS status
FROM placed AS p LEFT JOIN firsts AS f ON p.dedup_key = f.dedup_key WHERE late""",
    "page_counts": _LINES + """
SELECT k AS o_orderkey, api, 1 AS page_count, 'SUCCEEDED' AS job_status
FROM o, (VALUES ('AnalyzeExpense'), ('AnalyzeDocument')) AS t(api)""",
    "label_value_view": _LINES + """
SELECT k AS o_orderkey, type, label, value, confidence, page FROM summ""",
    "malformed_envelopes": """
SELECT o_orderkey, o_orderkey % 4 IN (1, 3) AS malformed, o_orderkey % 4 IN (0, 2) AND o_orderkey % 5 <> 0 AS job_ok,
  CAST(CASE WHEN o_orderkey % 4 IN (0, 2) THEN 3 ELSE 0 END AS BIGINT) AS n_fields FROM orders""",
    "vendor_keys": """
SELECT o_orderkey, 'ACMETRADING' || CAST(o_orderkey % 200 AS VARCHAR) AS vendor_key FROM orders""",
    "alias_apply": """
SELECT o_orderkey, 'Acme Trading ' || CAST(o_orderkey % 200 AS VARCHAR) AS company_name, strftime(o_orderdate, '%d-%m-%Y') AS date,
  'INV/' || CAST(o_orderkey AS VARCHAR) AS reference, printf('%.2f', o_totalprice) AS total_amount, 'INR' AS currency,
  'vendor_alias_cache' AS source
FROM orders WHERE o_orderkey % 5 <> 0
  AND o_orderkey % 200 IN (SELECT o_orderkey % 200 FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 2 = 0)""",
    "alias_apply_in_batch": """
WITH taught AS (SELECT o_orderkey % 200 AS v, min(o_orderkey) AS k FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 2 = 0 GROUP BY 1),
h AS (
  SELECT o_orderkey AS k, o_orderkey % 5 <> 0 AND coalesce(o_orderkey > t.k, FALSE) AS hit, o_orderkey % 9 <> 0 AS model
  FROM orders LEFT JOIN taught AS t ON o_orderkey % 200 = t.v)
SELECT k AS o_orderkey, hit OR model AS mapping_ok, CASE WHEN hit THEN 'vendor_alias_cache' ELSE 'bedrock' END AS source,
  CASE WHEN hit THEN 0 WHEN model AND k % 3 = 0 THEN 2 WHEN model THEN 1 END AS attempts,
  CASE WHEN hit OR model THEN 'INV/' || CAST(k AS VARCHAR) END AS reference FROM h""",
    "document_messages": _LINES + """
SELECT o.k AS o_orderkey, 'AnalyzeExpense' AS extracted_by, 1 AS page_count, printf('%d.%02d', c // 100, c % 100) AS total, TRUE AS three_pairs,
  printf('%d.%02d', l.ac // 100, l.ac % 100) AS first_amount
FROM o LEFT JOIN l ON o.k = l.k AND l.row_index = 0""",
    "gold_jsonl": _TRUTH + """
SELECT final_status AS status, count(*) AS n, CAST(sum(total_gbp) AS DECIMAL(18, 2)) AS total_gbp FROM gold GROUP BY final_status""",
    "assembled_pages": """
SELECT o_orderkey, o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AS job_ok,
  CAST(CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 THEN 6 ELSE 0 END AS BIGINT) AS n_fields FROM orders""",
    "size_gate_contents": f"""
WITH f AS (
  SELECT doc_id, 'plain' AS kind, coalesce(text, '') AS t FROM documents
  UNION ALL SELECT doc_id, 'headed', '%PDF-1.7 ' || coalesce(text, '') FROM documents
),
m AS (
  SELECT doc_id, kind, CAST(strlen(t) AS BIGINT) AS size_bytes, starts_with(t, '%PDF-') AS has_pdf_magic,
    NOT starts_with(t, '%PDF-') OR strlen(t) = 0 OR strlen(t) > {MAX_DOCUMENT_SIZE_BYTES} AS failed FROM f
)
SELECT doc_id, kind, size_bytes, has_pdf_magic, CASE WHEN failed THEN 'EXTRACTION_FAILED' END AS hard_rule,
  CASE WHEN failed THEN 'extraction' END AS failed_at_stage FROM m""",
    "size_gate": f"""
WITH m AS (
  SELECT doc_id, CAST(CASE doc_id % 10 WHEN 0 THEN 0 WHEN 1 THEN {MAX_DOCUMENT_SIZE_BYTES + 1} WHEN 2 THEN {MAX_DOCUMENT_SIZE_BYTES}
    ELSE strlen(text) END AS BIGINT) AS size_bytes FROM documents
)
SELECT doc_id, size_bytes, CASE WHEN doc_id % 10 IN (0, 1) OR doc_id % 7 = 0 OR size_bytes = 0 THEN 'EXTRACTION_FAILED' END AS hard_rule,
  CASE WHEN doc_id % 10 IN (0, 1) OR doc_id % 7 = 0 OR size_bytes = 0 THEN 'extraction' END AS failed_at_stage
FROM m""",
}
