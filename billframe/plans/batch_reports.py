"""Registered queries over the driver tables: paging, history, merged statistics, errors, payloads, odd inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billframe.operators import extract as X
from billframe.operators import load as L
from billframe.operators import mapping as M
from billframe.operators import merged_stats as S
from billframe.operators import paging as P
from billframe.operators import query as Q
from billframe.operators.key_index import index_rows
from billframe.plans import clustered as C
from billframe.plans import rendered as R
from billframe.plans.catalog import M2, _expense, _okey
from billframe.plans.commits import Run, read_sink
from billframe.plans.oracle import _LINES, _TRUTH
from billframe.plans.stages import materialize, stage_root
from billframe.session import configure
from billframe.sources.envelopes import rendered_blocks, rendered_expense
from billframe.sources.rendered import rendered_orders
from billframe.sources.tables import table


def page_chains(spark: SparkSession, sf: str) -> DataFrame:
    """Results captured in one to five pages, shuffled; some miss a page, some lead back to an earlier one."""
    configure(spark)
    k = F.col("load_order")
    n = (F.lit(1) + k % 5).cast("int")

    def token(i):
        return F.when((i > 0) & (i < n), F.concat_ws("-", F.lit("t"), k, i))

    lost = F.when((k % 7 == 0) & (n >= 2), 1).when((k % 7 != 0) & (k % 11 != 0) & (k % 13 == 0) & (n >= 2), n - 1)
    back = (k % 7 != 0) & (k % 11 == 0) & (n >= 3)
    i = F.col("i")
    dealt = F.array_sort(F.transform(F.sequence(F.lit(0), n - 1), lambda x: F.struct(F.xxhash64(k, x).alias("h"), x.alias("i"))))
    pages = rendered_expense(spark, sf).select("source_file", "load_order", "body", F.explode(dealt["i"]).alias("i"))
    pages = pages.where(lost.isNull() | (i != lost)).select(
        "source_file", "body", token(i).alias("token"),
        F.when(back & (i == n - 1), token(F.lit(1))).otherwise(token(i + 1)).alias("next_token"), F.lit("SUCCEEDED").alias("status"))
    parsed = X.parse_envelopes(P.joined_bodies(pages, "ExpenseDocuments")).drop("body")
    # of the parsed results only what is read below is written
    documents = F.transform("env.ExpenseDocuments", lambda d: d.dropFields("LineItemGroups"))
    parsed = materialize(parsed.withColumn("env", F.col("env").withField("ExpenseDocuments", documents)), "page_chains_parsed",
                         (uuid.uuid4().hex,), spark=spark)
    fields = X.expense_summary_fields(parsed).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_fields"))
    counted = X.expense_headers(parsed).select("source_file", F.col("page_count").cast("int").alias("page_count"))
    return parsed.join(fields, "source_file", "left").join(counted, "source_file").select(
        _okey(), "chain_error", "page_count", F.coalesce("n_fields", F.lit(0)).alias("n_fields"))


def block_page_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of block results, whose blocks lie on a page from 0 (unknown) to 3."""
    page = F.concat(F.lit('"Page":'), (F.col("load_order") % 4).cast("string"))
    bodies = rendered_blocks(spark, sf).withColumn("body", F.regexp_replace("body", F.lit('"Page":1'), page))
    headers = X.block_headers(X.parse_envelopes(bodies, schema=X.BLOCK_SCHEMA))
    return headers.select(_okey(), F.col("page_count").cast("int").alias("page_count"))


def load_three_batches(spark: SparkSession, sf: str) -> DataFrame:
    """K5: three batches by date of order, each classified against the key index that those before it committed."""
    configure(spark)
    out = f"{stage_root(spark)}/three-batches-{uuid.uuid4().hex[:12]}"
    dates = table(spark, sf, "orders").select(F.col("o_orderkey").alias("load_order"), "o_orderdate")
    part = F.when(F.col("o_orderdate") < F.lit("1995-01-01").cast("date"), 1).when(
        F.col("o_orderdate") < F.lit("1998-01-01").cast("date"), 2).otherwise(3)
    r = R.records(spark, sf).join(dates.hint("shuffle_hash"), "load_order").withColumn("part", part).drop("o_orderdate")
    r = materialize(r, "three_batches", (out,), spark=spark)
    found = None
    for i in (1, 2, 3):
        run = Run(spark, out, f"batch-{i}", None)
        done = L.first_write_wins(r.where(F.col("part") == i), read_sink(spark, out, "gold_keys"))
        done = run.write(done.select("load_order", "dedup_key", "status", "is_new"), "classified")
        run.write(index_rows(done.where("is_new")), "gold_keys", partition_by=["bucket"])
        run.commit(R.INGESTED_AT)
        rows = done.select(F.col("load_order").alias("o_orderkey"), F.lit(i).alias("batch"), "status")
        found = rows if found is None else found.unionByName(rows)
    return found


def merged_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of three batches, one of them replaced, added up from what each batch left."""
    configure(spark)
    out = f"{stage_root(spark)}/merged-stats-{uuid.uuid4().hex[:12]}"
    items = Q.scan_all(*R.gold_and_tombstones(spark, sf))
    part = F.pmod(F.xxhash64("source_file"), F.lit(3))
    for name, rows in (("b0", items.where(part == 0)), ("b1", items), ("b2", items.where(part == 2)), ("b1", items.where(part == 1))):
        run = Run(spark, out, name, None)
        run.write(S.partial(rows), "stats")
        run.commit(R.INGESTED_AT)
    totals = S.merged(read_sink(spark, out, "stats"))
    return totals.select("metric", "key", "n", F.col("amount").cast(M2).alias("total_gbp"))


def merged_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The one-row summary from stored counters."""
    configure(spark)
    items = Q.scan_all(*R.gold_and_tombstones(spark, sf))
    s = S.summary(S.merged(materialize(S.partial(items), "stats_partial", (uuid.uuid4().hex,), spark=spark)))
    return s.withColumn("total_gbp", F.col("total_gbp").cast(M2))


def clustered_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Q4: one invoice from gold bucketed by key, by a vendor and reference printed in another way."""
    gold, _ = R.gold_and_tombstones(spark, sf)
    name = uuid.uuid4().hex[:12]
    placed = C.write_clustered(gold, f"billframe_gold_{name}", f"{stage_root(spark)}/gold-clustered-{name}")
    found = C.look_up(placed, "acme   TRÁDING 005 (ltd)", "Inv # 5")
    return found.select("dedup_key", "month", F.col("total_amount").cast(M2).alias("total_gbp"))


def error_details(spark: SparkSession, sf: str) -> DataFrame:
    """Where validation found errors, in record order."""
    r = R.records(spark, sf).where(F.col("failed_at_stage").isin("pydantic_validation", "unknown"))
    rows = r.select(F.col("load_order").alias("o_orderkey"), F.posexplode("error_detail").alias("pos", "e"))
    return rows.select("o_orderkey", "pos", F.col("e.loc").alias("loc"), F.col("e.type").alias("type"))


def quarantine_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """K8: quarantined invoices with the payload that was mapped for them."""
    payload = rendered_orders(spark, sf).select("source_file", F.to_json(F.struct("fields")).alias("raw_mapped_payload"))
    side = L.quarantine_sidecars(R.classified(spark, sf), payload, R.BATCH_ID, R.INGESTED_AT)
    return side.select(
        F.regexp_extract("filename", r"(\d+)", 1).cast("long").alias("o_orderkey"), "dq_rule", "failed_at_stage", "error_type",
        F.get_json_object("raw_mapped_payload", "$.fields.buyer_name").alias("buyer_name"))


def latest_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    """K7: of two tombstones of a file and batch the later one stays."""
    _, stones = R.gold_and_tombstones(spark, sf)
    earlier = stones.withColumns({"failed_at_utc": F.lit("2026-09-08T00:00:00+00:00"), "dq_rule": F.lit("EARLIER")})
    kept = L.latest_tombstones(earlier.unionByName(stones))
    return kept.select(_okey(), "dq_rule", "failed_at_utc")


def finalized_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """C4: line items and source added to the metadata, unless it names them already."""
    p = _expense(spark, sf)
    k = F.regexp_extract("source_file", r"(\d+)", 1).cast("long")
    md = F.when(k % 3 == 0, F.create_map(F.lit("extracted_by"), F.lit("scanner"))).when(
        k % 3 == 1, F.create_map(F.lit("line_items"), F.lit("[]")))
    done = M.finalize_metadata(p.select("source_file", md.alias("unmapped_metadata")), X.expense_headers(p), X.expense_line_items(p))
    get = lambda path: F.get_json_object("unmapped_metadata.line_items", path)
    return done.select(
        _okey(), F.col("unmapped_metadata.extracted_by").alias("extracted_by"),
        F.json_array_length("unmapped_metadata.line_items").alias("n_items"), get("$[0].Amount").alias("first_amount"))


def vendor_key_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Vendors by every rank of field, ties, blanks, names that fold to nothing, and documents without any."""
    configure(spark)
    k = F.col("o_orderkey")
    f = lambda typ, label, value: F.struct(F.lit(typ).alias("type"), F.lit(label).alias("label"), value.alias("value"))
    name = lambda word: F.concat(F.lit(f"{word} "), k.cast("string"))
    blank = F.lit(" \t")
    fields = (
        F.when(k % 6 == 0, F.array(f("RECEIVER_NAME", "To", name("Rec")), f("SUPPLIER_NAME", "x", name("Sup")), f("VENDOR_NAME", "x", blank)))
        .when(k % 6 == 1, F.array(f("OTHER", "Company name", name("Com")), f("receiver_name", "To", name("Rec"))))
        .when(k % 6 == 2, F.array(f("OTHER", "Total", name("Tot")), f("OTHER", "MERCHANT", name("Mer")), f("OTHER", "Sold from", name("Fro"))))
        .when(k % 6 == 3, F.array(f("SUPPLIER_NAME", "x", name("Sup")), f("VENDOR_NAME", "x", name("Va")), f("VENDOR_NAME", "x", name("Vb"))))
        .when(k % 6 == 4, F.array(f("VENDOR_NAME", "x", F.lit("株式会社"))))
        .otherwise(F.array(f("OTHER", "Total", name("Tot"))))
    )
    o = table(spark, sf, "orders").select("o_orderkey", F.format_string("invoice_%d.pdf", k).alias("source_file"))
    rows = o.select("source_file", F.posexplode(fields).alias("i", "f")).select(
        "source_file", F.struct(F.lit(0).alias("branch"), F.lit(0).alias("doc"), F.col("i").alias("item")).alias("pos"), "f.*")
    return o.join(M.vendor_keys(rows), "source_file", "left").select("o_orderkey", "vendor_key")


def description_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Line items without a named description column: the longest cell that is no number."""
    configure(spark)
    bodies = rendered_expense(spark, sf).withColumn("body", F.regexp_replace("body", '"ITEM"', '"THING"'))
    rows = X.row_description(X.expense_line_items(X.parse_envelopes(bodies)))
    return rows.select(_okey(), "row_index", "description")


def folded_to_nothing(spark: SparkSession, sf: str) -> DataFrame:
    """K1: how many vendors and references have no letter or digit left in their key."""
    configure(spark)
    k = F.col("c_custkey")
    named = table(spark, sf, "customer").select(
        F.when(k % 7 == 0, F.lit("株式会社")).otherwise(F.col("c_name")).alias("company_name"),
        F.when(k % 11 == 0, F.lit("— / —")).otherwise(k.cast("string")).alias("invoice_reference_number"),
        F.lit(None).cast("date").alias("date"))
    return L.folded_to_nothing(named)


def fallback_both_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose two results are both without fields fail; one of them is enough."""
    configure(spark)
    k = F.col("load_order")
    empty = lambda member: F.lit(f'{{"JobStatus":"SUCCEEDED","{member}":[]}}')
    expense = rendered_expense(spark, sf).withColumn("body", F.when(k % 7 == 0, empty("ExpenseDocuments")).otherwise(F.col("body")))
    blocks = rendered_blocks(spark, sf).withColumn("body", F.when(k % 2 == 0, empty("Blocks")).otherwise(F.col("body")))
    p = materialize(X.parse_envelopes(expense).drop("body"), "both_empty", (uuid.uuid4().hex,), spark=spark)
    _, _, headers = X.fallback_merge(X.expense_summary_fields(p), X.expense_line_items(p), blocks.select("source_file", "body"), p.select("source_file"))
    return headers.select(_okey(), "extraction_ok", F.size("warnings").alias("n_warnings"))


QUERIES = {
    f.__name__: f
    for f in (
        page_chains, block_page_counts, load_three_batches, merged_stats, merged_summary, clustered_lookup, error_details,
        quarantine_payloads, latest_tombstones, finalized_metadata, vendor_key_ranks, description_fallback, folded_to_nothing,
        fallback_both_empty,
    )
}

ORACLE = {
    "page_chains": """
WITH p AS (
  SELECT o_orderkey AS k, CAST(1 + o_orderkey % 5 AS INTEGER) AS n FROM orders),
e AS (
  SELECT k, n, CASE WHEN k % 7 = 0 AND n >= 2 THEN 'gap' WHEN k % 7 = 0 THEN NULL WHEN k % 11 = 0 AND n >= 3 THEN 'loop' WHEN k % 11 = 0 THEN NULL
    WHEN k % 13 = 0 AND n >= 2 THEN 'gap' END AS err FROM p)
SELECT k AS o_orderkey, err AS chain_error, CASE WHEN err IS NULL THEN n ELSE 1 END AS page_count,
  CAST(CASE WHEN err IS NULL THEN 3 * n ELSE 0 END AS BIGINT) AS n_fields FROM e""",
    "block_page_counts": """
SELECT o_orderkey, CAST(greatest(o_orderkey % 4, 1) AS INTEGER) AS page_count FROM orders""",
    "load_three_batches": _TRUTH + """
, placed AS (SELECT *, CASE WHEN d_order < DATE '1995-01-01' THEN 1 WHEN d_order < DATE '1998-01-01' THEN 2 ELSE 3 END AS batch
  FROM rec JOIN (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d_order FROM orders) AS o ON o.o_orderkey = k),
ranked AS (SELECT *, row_number() OVER (PARTITION BY CASE WHEN hard_rule IS NULL THEN dedup_key END ORDER BY batch, k) AS place FROM placed)
SELECT k AS o_orderkey, batch, CASE WHEN hard_rule IS NULL AND place > 1 THEN 'DUPLICATE_SKIPPED' ELSE status END AS status FROM ranked""",
    "merged_stats": _TRUTH + """
, g AS (SELECT unnest([
    {'m': 'by_status', 'k': final_status}, {'m': 'by_vendor', 'k': vendor_key}, {'m': 'by_month', 'k': month},
    {'m': 'by_original_currency', 'k': ccy}, {'m': 'kind', 'k': 'record'}]) AS p, total_gbp FROM gold),
s AS (SELECT unnest([{'m': 'by_status', 'k': 'QUARANTINED'}, {'m': 'quarantine_reasons', 'k': error_type}, {'m': 'kind', 'k': 'tombstone'}]) AS p FROM stones)
SELECT p.m AS metric, p.k AS key, count(*) AS n, CAST(sum(total_gbp) AS DECIMAL(18, 2)) AS total_gbp FROM g GROUP BY ALL
UNION ALL SELECT p.m, p.k, count(*), NULL FROM s GROUP BY ALL
UNION ALL SELECT 'dq_flag_counts', f, count(*), NULL FROM (SELECT unnest(string_split(flags, ',')) AS f FROM gold WHERE flags <> '') GROUP BY f""",
    "merged_summary": _TRUTH + """
SELECT (SELECT count(*) FROM gold) + (SELECT count(*) FROM stones) AS items_scanned, count(*) AS invoice_records,
  (SELECT count(*) FROM stones) AS quarantine_tombstones, CAST(coalesce(sum(total_gbp), 0) AS DECIMAL(18, 2)) AS total_gbp,
  CAST(coalesce(round(CAST(count(*) FILTER (final_status = 'LOADED') AS DECIMAL(18, 6)) / nullif(count(*), 0), 4), 0) AS DECIMAL(10, 4)) AS clean_rate,
  (SELECT count(*) FROM gold) + (SELECT count(*) FROM stones) >= 1000000 AS exceeds_migration_threshold
FROM gold""",
    "clustered_lookup": _TRUTH + """
SELECT dedup_key, month, total_gbp FROM gold WHERE dedup_key = 'ACMETRADING005LTD|INV5'""",
    "error_details": _TRUTH + """
, e AS (
  SELECT k, CASE WHEN r100 IS NULL THEN [{'loc': 'currency', 'type': 'UnknownCurrencyError'}]
    WHEN ds = 10 OR k % 53 = 7 OR k % 59 = 3 OR ts = 10 THEN list_filter([
      CASE WHEN ds = 10 THEN {'loc': 'date', 'type': 'value_error'} END,
      CASE WHEN k % 53 = 7 THEN {'loc': 'company_name', 'type': 'value_error'} END,
      CASE WHEN k % 59 = 3 THEN {'loc': 'buyer_name', 'type': 'value_error'} END,
      CASE WHEN ts = 10 THEN {'loc': 'total_amount', 'type': 'value_error'} END], lambda x: x IS NOT NULL)
    ELSE [{'loc': '', 'type': 'value_error'}] END AS d
  FROM rec WHERE hard_rule IS NOT NULL AND k % 61 <> 5)
SELECT k AS o_orderkey, CAST(i AS INTEGER) AS pos, d[i + 1].loc AS loc, d[i + 1].type AS type
FROM (SELECT k, d, unnest(range(len(d))) AS i FROM e)""",
    "quarantine_payloads": _TRUTH + """
SELECT k AS o_orderkey, hard_rule AS dq_rule, failed_at_stage, error_type, CASE WHEN k % 59 = 3 THEN 'N/A' ELSE c_name END AS buyer_name
FROM stones JOIN orders ON o_orderkey = k JOIN customer ON o_custkey = c_custkey""",
    "latest_tombstones": _TRUTH + """
SELECT k AS o_orderkey, hard_rule AS dq_rule, '2026-09-09T12:00:00+00:00' AS failed_at_utc FROM stones""",
    "finalized_metadata": _LINES + """
SELECT o.k AS o_orderkey, CASE WHEN o.k % 3 = 0 THEN 'scanner' ELSE 'AnalyzeExpense' END AS extracted_by,
  CAST(CASE WHEN o.k % 3 = 1 THEN 0 ELSE nullif(count(l.k), 0) END AS INTEGER) AS n_items,
  CASE WHEN o.k % 3 <> 1 THEN max(printf('%d.%02d', ac // 100, ac % 100)) FILTER (row_index = 0) END AS first_amount
FROM o LEFT JOIN l ON o.k = l.k GROUP BY o.k""",
    "vendor_key_ranks": """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'SUP' || o_orderkey WHEN 1 THEN 'REC' || o_orderkey WHEN 2 THEN 'MER' || o_orderkey
  WHEN 3 THEN 'VA' || o_orderkey END AS vendor_key FROM orders""",
    "description_fallback": _LINES + """
SELECT k AS o_orderkey, CAST(row_index AS INTEGER) AS row_index, item AS description FROM l""",
    "folded_to_nothing": """
SELECT 'vendors' AS kind, count(*) AS n FROM customer WHERE c_custkey % 7 = 0
UNION ALL SELECT 'references', count(*) FROM customer WHERE c_custkey % 11 = 0""",
    "fallback_both_empty": """
SELECT o_orderkey, o_orderkey % 14 <> 0 AS extraction_ok, CAST(CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 0 END AS INTEGER) AS n_warnings FROM orders""",
}
