"""Registered scale queries over the driver tables (the driver's correctness gate).

Each function takes (spark, sf_dir) and returns a DataFrame with flat scalar
columns. Money is reported as decimal(18,2), ratios as decimal(10,4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billframe.config import QUARANTINED, SOFT_RULES
from billframe.functions import date_is_ambiguous, fold_key, mandatory_text, mandatory_text_error, optional_text, parse_date, parse_money
from billframe.operators import query as Q
from billframe.operators import stats as T
from billframe.operators.fx import attach_rates, fx_table, is_reversible, to_gbp
from billframe.plans import rendered as R
from billframe.session import configure
from billframe.sources.rendered import rendered_orders
from billframe.sources.tables import dealt, table

M2 = "decimal(18,2)"


def _k(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderkey", F.col("load_order"))


def coerce_money(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    r = rendered_orders(spark, sf)
    t = parse_money(F.col("fields.total_amount"))
    p = parse_money(F.col("fields.product_amount"))
    return r.select(
        F.col("load_order").alias("o_orderkey"),
        t["value"].cast(M2).alias("total_value"),
        t["error"].alias("total_error"),
        p["value"].cast(M2).alias("product_value"),
    )


def coerce_date(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    r = rendered_orders(spark, sf)
    return r.select(
        F.col("load_order").alias("o_orderkey"),
        parse_date(F.col("fields.date")).alias("invoice_date"),
        date_is_ambiguous(F.col("fields.date")).alias("ambiguous"),
    )


def nullish_fields(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    raw = (
        F.when(k % 6 == 0, F.lit("null")).when(k % 6 == 1, F.lit(" None ")).when(k % 6 == 2, F.lit(""))
        .when(k % 6 == 3, F.lit("n/a")).when(k % 6 == 4, F.lit("--")).otherwise(F.concat(F.lit("  "), F.col("c_name")))
    )
    return c.select(
        "c_custkey",
        optional_text(raw).alias("optional_value"),
        mandatory_text(raw).alias("mandatory_value"),
        mandatory_text_error(raw).alias("mandatory_error"),
    )


def fx_convert(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    amount = (F.round(F.col("_price") * 100).cast("long").cast("decimal(20,0)") / 100).cast("decimal(28,8)")
    o = dealt(table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("_price")), "o_orderkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", amount.alias("amount"), F.col("c_nationkey"))
    codes = F.element_at(F.array(*[F.lit(x) for x in ("GBP", "INR", "USD", "EUR", " inr ", "JPY")]), (F.col("c_nationkey") % 6 + 1).cast("int"))
    j = attach_rates(j.withColumn("ccy", F.upper(F.trim(codes))), "ccy", fx_table(spark))
    gbp = F.when(F.col("ccy") == "GBP", F.col("amount")).otherwise(to_gbp(F.col("amount"), F.col("fx_rate")))
    return j.select(
        "o_orderkey",
        F.col("ccy").alias("currency"),
        gbp.cast(M2).alias("amount_gbp"),
        is_reversible([F.col("amount")], [gbp], F.col("fx_rate")).alias("fx_reversible"),
    )


def _records(spark, sf):
    return R.records(spark, sf)


def hard_rules(spark: SparkSession, sf: str) -> DataFrame:
    return _k(_records(spark, sf)).select("o_orderkey", "status", "hard_rule", "error_type", "failed_at_stage")


def dq_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _k(_records(spark, sf)).select(
        "o_orderkey", F.array_join("dq_flags", ",").alias("flags"), "status",
        F.col("total_amount").cast(M2).alias("total_gbp"),
    )


def dq_status(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: invoices by outcome with count and reporting-currency total."""
    return _records(spark, sf).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("total_amount"), F.lit(0)).cast(M2).alias("total_gbp"),
    )


def flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    recs = _records(spark, sf)
    counts = recs.select(F.explode("dq_flags").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    rules = spark.createDataFrame([(r,) for r in SOFT_RULES], "rule string")
    return rules.join(counts, "rule", "left").select("rule", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def key_fold(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("src"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.lit("part").alias("src"))
    u = s.unionByName(p)
    k = F.col("id")
    accented = F.translate("name", "aeiouAEIOUcn", "áéíóúÁÉÍÓÚçñ")
    printed = (
        F.when(k % 4 == 0, F.col("name"))
        .when(k % 4 == 1, accented)
        .when(k % 4 == 2, F.concat(F.lit(" • "), F.regexp_replace(F.lower("name"), " ", " -- "), F.lit("/")))
        .otherwise(F.concat(F.upper(accented), F.lit(" (ltd.)")))
    )
    return u.select("src", "id", fold_key(printed).alias("key"))


def _classified(spark, sf):
    return R.classified(spark, sf)


def load_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def load_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    c = _classified(spark, sf)
    return _k(c).where(F.col("status") == "DUPLICATE_SKIPPED").select("o_orderkey", "dedup_key")


def quarantine_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    _, stones = R.gold_and_tombstones(spark, sf)
    return stones.groupBy("dq_rule", "error_type", "failed_at_stage").agg(F.count(F.lit(1)).alias("n"))


def _items(spark, sf):
    gold, stones = R.gold_and_tombstones(spark, sf)
    return gold, stones


def query_month(spark: SparkSession, sf: str) -> DataFrame:
    gold, stones = _items(spark, sf)
    return Q.run_query(gold, stones, {"operation": "query_month", "year_month": "1996-03",
                                       "aggregation": "sum_total_amount"}).select(
        "matched", F.col("total_gbp").cast(M2).alias("total_gbp"))


def query_status(spark: SparkSession, sf: str) -> DataFrame:
    gold, stones = _items(spark, sf)
    a = Q.run_query(gold, stones, {"operation": "query_status", "status": "LOADED_WITH_WARNINGS", "aggregation": "count"})
    b = Q.run_query(gold, stones, {"operation": "query_status", "status": QUARANTINED, "aggregation": "count"})
    c = Q.run_query(gold, stones, {"operation": "scan_all", "aggregation": "count"})
    return a.select(F.lit("LOADED_WITH_WARNINGS").alias("asked"), "matched").unionByName(
        b.select(F.lit("QUARANTINED").alias("asked"), "matched")).unionByName(
        c.select(F.lit("scan_all").alias("asked"), "matched"))


def vendor_sum(spark: SparkSession, sf: str) -> DataFrame:
    gold, stones = _items(spark, sf)
    return Q.run_query(gold, stones, {"operation": "scan_all", "vendor_contains": " Trading 01",
                                       "aggregation": "sum_total_amount"}).select(
        "matched", F.col("total_gbp").cast(M2).alias("total_gbp"))


def vendor_list(spark: SparkSession, sf: str) -> DataFrame:
    gold, stones = _items(spark, sf)
    items = Q.run_query(gold, stones, {"operation": "query_status", "status": "LOADED",
                                        "vendor_contains": "trading 00", "aggregation": "list"})
    return items.select("company_name", "invoice_reference_number", F.col("total_amount").cast(M2).alias("total_amount"),
                        "currency", "status", "date")


def batch_stats(spark: SparkSession, sf: str) -> DataFrame:
    gold, stones = _items(spark, sf)
    s = T.summary(Q.scan_all(gold, stones))
    return s.select("items_scanned", "invoice_records", "quarantine_tombstones",
                    F.col("total_gbp").cast(M2).alias("total_gbp"), "clean_rate", "exceeds_migration_threshold")


def _breakdown(spark, sf, metric):
    gold, stones = _items(spark, sf)
    return T.breakdown(Q.scan_all(gold, stones)).where(F.col("metric") == metric).select("key", "n")


def by_vendor(spark: SparkSession, sf: str) -> DataFrame:
    return _breakdown(spark, sf, "by_vendor")


def by_month(spark: SparkSession, sf: str) -> DataFrame:
    return _breakdown(spark, sf, "by_month")


def by_currency(spark: SparkSession, sf: str) -> DataFrame:
    return _breakdown(spark, sf, "by_original_currency")


def by_status_items(spark: SparkSession, sf: str) -> DataFrame:
    return _breakdown(spark, sf, "by_status")


def quarantine_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return _breakdown(spark, sf, "quarantine_reasons")


def _expense(spark, sf):
    from billframe.operators import extract as X
    from billframe.plans.stages import materialize
    from billframe.sources.envelopes import rendered_expense

    configure(spark)
    return materialize(lambda: X.parse_envelopes(rendered_expense(spark, sf)).drop("body"), "expense_parsed", (sf,),
                       spark=spark)


def _blocks(spark, sf):
    from billframe.operators import extract as X
    from billframe.plans.stages import materialize
    from billframe.sources.envelopes import rendered_blocks

    configure(spark)
    # Parse the block JSON once; the graph joins read the parsed stage.
    return materialize(lambda: X.parse_envelopes(rendered_blocks(spark, sf), schema=X.BLOCK_SCHEMA).drop("body"),
                       "blocks_parsed", (sf,), spark=spark)


def _okey(col="source_file"):
    return F.regexp_extract(F.col(col), r"invoice_(\d+)\.pdf", 1).cast("long").alias("o_orderkey")


def expense_summary(spark: SparkSession, sf: str) -> DataFrame:
    from billframe.operators import extract as X

    s = X.expense_summary_fields(_expense(spark, sf))
    return s.select(_okey(), F.col("pos.item").alias("item"), "type", "label", "value", "confidence", "page")


def expense_line_items(spark: SparkSession, sf: str) -> DataFrame:
    from billframe.operators import extract as X

    cells = X.line_cells(X.expense_line_items(_expense(spark, sf)))
    return cells.select(_okey(), "row_index", "col_pos", "col", "value", "confidence")


def label_confidence(spark: SparkSession, sf: str) -> DataFrame:
    from billframe.operators import extract as X

    p = _expense(spark, sf)
    summ = X.expense_summary_fields(p)
    s = X.confidence_by_label(summ).select(_okey(), F.lit("summary_max").alias("kind"), "label", "confidence")
    li = X.line_item_confidence_by_label(X.line_cells(X.expense_line_items(p))).select(
        _okey(), F.lit("line_min").alias("kind"), "label", "confidence")
    m = X.mean_confidence(summ).select(_okey(), F.lit("mean").alias("kind"), F.lit("").alias("label"),
                                       F.round("mean_confidence", 4).alias("confidence"))
    return s.unionByName(li).unionByName(m).select(
        "o_orderkey", "kind", "label", F.col("confidence").cast("decimal(10,4)").alias("confidence"))


def block_pairs(spark: SparkSession, sf: str) -> DataFrame:
    from billframe.operators import extract as X

    s = X.block_summary_fields(_blocks(spark, sf))
    return s.select(_okey(), "type", "label", "value", "confidence", "page")


def block_tables(spark: SparkSession, sf: str) -> DataFrame:
    from billframe.operators import extract as X

    items = X.block_line_items(_blocks(spark, sf))
    cells = items.select("source_file", "row_index", "confidence", F.explode("fields").alias("col", "value"))
    return cells.select(_okey(), "row_index", "col", "value", F.col("confidence").alias("row_confidence"))


def fallback_merge(spark: SparkSession, sf: str) -> DataFrame:
    from billframe.operators import extract as X
    from billframe.plans.stages import materialize
    from billframe.sources.envelopes import rendered_blocks

    p = _expense(spark, sf)
    # Block envelopes are joined to the unusable documents before they are parsed.
    blocks = materialize(lambda: rendered_blocks(spark, sf), "blocks_raw", (sf,), spark=spark)
    summ, items, headers = X.fallback_merge(
        X.expense_summary_fields(p), X.expense_line_items(p), blocks, p.select("source_file"))
    ns = summ.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_summary_fields"))
    nl = items.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_line_items"))
    return headers.join(ns, "source_file", "left").join(nl, "source_file", "left").select(
        _okey(), "api", F.size("warnings").alias("n_warnings"), "extraction_ok",
        F.coalesce("n_summary_fields", F.lit(0)).alias("n_summary_fields"),
        F.coalesce("n_line_items", F.lit(0)).alias("n_line_items"))


def product_name_join(spark: SparkSession, sf: str) -> DataFrame:
    from billframe.operators import extract as X

    names = X.product_names(X.expense_line_items(_expense(spark, sf)))
    return names.select(_okey(), "product_name")


def resolve_confidence(spark: SparkSession, sf: str) -> DataFrame:
    from billframe.operators import extract as X
    from billframe.operators.mapping import resolve_confidences

    p = _expense(spark, sf)
    summ = X.expense_summary_fields(p)
    cells = X.line_cells(X.expense_line_items(p))
    labels = F.create_map(F.lit("company_name"), F.lit("Vendor:"), F.lit("total_amount"), F.lit("TOTAL"),
                          F.lit("date"), F.lit("Invoice Date:"), F.lit("product_name"), F.lit(" ITEM"),
                          F.lit("buyer_name"), F.lit("Customer"))
    payloads = p.select("source_file", labels.alias("source_labels"))
    r = resolve_confidences(payloads, summ, cells)
    return r.select(_okey(), F.explode("extraction_confidence").alias("field", "confidence"))


def _attempts(spark, sf):
    """Captured model responses rendered from orders: attempt 1 lacks the tool
    call when k % 3 = 0; attempt 2 leaves company blank when k % 9 = 0;
    attempt 3 is valid but beyond the two allowed attempts."""
    o = dealt(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), "o_orderkey")
    k = F.col("o_orderkey")
    a = o.select("*", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("attempt"))
    full = k % 2 == 0
    labels = F.when(full, F.create_map(
        *[F.lit(x) for x in ("date", "Invoice Date:", "company_name", "Vendor:", "buyer_name", "Bill To",
                             "invoice_reference_number", "Invoice No", "total_amount", "TOTAL",
                             "product_amount", "Sub Total", "vat_tax_amount", "GST", "mode_of_payment", "Paid By",
                             "bogus", "ignored")])).otherwise(F.create_map(
        F.lit("company_name"), F.lit("Vendor:"), F.lit("total_amount"), F.lit("TOTAL")))
    tool = F.struct(
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("date"),
        F.when((F.col("attempt") == 2) & (k % 9 == 0), F.lit(" ")).otherwise(
            F.concat(F.lit("Acme Trading "), (k % 200).cast("string"))).alias("company_name"),
        F.concat(F.lit("Buyer "), F.col("o_custkey").cast("string")).alias("buyer_name"),
        F.concat(F.lit("INV/"), k.cast("string")).alias("invoice_reference_number"),
        F.format_string("%.2f", F.col("o_totalprice")).alias("total_amount"),
        F.lit("INR").alias("currency"),
        labels.alias("source_labels"),
        (k % 4 == 0).alias("multiple_total_candidates"),
    )
    has_tool = ~((F.col("attempt") == 1) & (k % 3 == 0))
    usage = F.struct((F.lit(1000) + k % 500).alias("inputTokens"), (F.lit(200) + F.col("attempt")).alias("outputTokens"))
    # The rendered tool input is embedded as a JSON object (not a string).
    content = F.when(has_tool, F.concat(
        F.lit('{"text":"calling tool"},{"toolUse":{"name":"map_invoice_fields","input":'), F.to_json(tool), F.lit("}}"),
    )).otherwise(F.lit('{"text":"no tool"}'))
    body = F.concat(F.lit('{"output":{"message":{"content":['), content, F.lit(']}},"stopReason":"tool_use","usage":'), F.to_json(usage), F.lit("}"))
    return a.select(F.format_string("invoice_%d.pdf", k).alias("source_file"), "attempt",
                    F.lit("model-a").alias("model_id"), body.alias("response"))


def attempt_select(spark: SparkSession, sf: str) -> DataFrame:
    from billframe.operators.mapping import select_attempt

    configure(spark)
    s = select_attempt(_attempts(spark, sf))
    return s.select(_okey(), "mapping_ok", "attempts", F.col("fields.company_name").alias("company_name"),
                    F.col("fields.total_amount").alias("total_amount"), F.col("fields.product_name").alias("product_name"),
                    F.size("source_labels").alias("n_labels"), "input_tokens", "output_tokens")


def alias_learn(spark: SparkSession, sf: str) -> DataFrame:
    from billframe.operators.mapping import learn_aliases, select_attempt

    configure(spark)
    s = select_attempt(_attempts(spark, sf)).where("mapping_ok").withColumn(
        "load_order", F.regexp_extract("source_file", r"invoice_(\d+)\.pdf", 1).cast("long"))
    head, alias = learn_aliases(s)
    n = alias.groupBy("vendor_key").agg(F.count(F.lit(1)).alias("n_aliases"))
    return head.join(n, "vendor_key", "left").select(
        "vendor_key", F.round("coverage", 4).cast("decimal(10,4)").alias("coverage"),
        F.col("learned_order").alias("learned_from"), F.coalesce("n_aliases", F.lit(0)).alias("n_aliases"),
        F.col("constants").getItem("currency").alias("constant_currency"))


def manifest_diff(spark: SparkSession, sf: str) -> DataFrame:
    from billframe.sources.manifest import manifest_diff as diff

    configure(spark)
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "source")
    cur = d.select("doc_id", F.lit("2026-05-14").cast("date").alias("batch_date"),
                   F.format_string("doc_%d.pdf", "doc_id").alias("filename"), F.col("n_chars").alias("size_bytes"))
    mirrored = d.where(F.col("doc_id") % 3 != 0).select(
        F.lit("2026-05-14").cast("date").alias("batch_date"), F.format_string("doc_%d.pdf", "doc_id").alias("filename"),
        (F.col("n_chars") + F.when(F.col("doc_id") % 5 == 0, F.lit(1)).otherwise(F.lit(0))).alias("size_bytes"))
    return diff(cur, mirrored).select("doc_id", "filename", "size_bytes")


def batch_partition(spark: SparkSession, sf: str) -> DataFrame:
    from billframe.sources.manifest import batch_date_prefix

    configure(spark)
    e = table(spark, sf, "events").select("event_id", "ts")
    d = F.to_date("ts")
    return e.groupBy(d.alias("batch_date")).agg(F.count(F.lit(1)).alias("n_files")).select(
        "batch_date", batch_date_prefix(F.col("batch_date")).alias("prefix"),
        batch_date_prefix(F.col("batch_date"), "yyyy/M/d/").alias("unpadded_prefix"), "n_files")


QUERIES = {
    "dq_status": dq_status,
    "coerce_money": coerce_money,
    "coerce_date": coerce_date,
    "nullish_fields": nullish_fields,
    "fx_convert": fx_convert,
    "hard_rules": hard_rules,
    "dq_flags": dq_flags,
    "flag_counts": flag_counts,
    "key_fold": key_fold,
    "load_first_wins": load_first_wins,
    "load_duplicates": load_duplicates,
    "quarantine_tombstones": quarantine_tombstones,
    "query_month": query_month,
    "query_status": query_status,
    "vendor_sum": vendor_sum,
    "vendor_list": vendor_list,
    "batch_stats": batch_stats,
    "by_vendor": by_vendor,
    "by_month": by_month,
    "by_currency": by_currency,
    "by_status_items": by_status_items,
    "quarantine_reasons": quarantine_reasons,
    "expense_summary": expense_summary,
    "expense_line_items": expense_line_items,
    "label_confidence": label_confidence,
    "block_pairs": block_pairs,
    "block_tables": block_tables,
    "fallback_merge": fallback_merge,
    "product_name_join": product_name_join,
    "resolve_confidence": resolve_confidence,
    "attempt_select": attempt_select,
    "alias_learn": alias_learn,
    "manifest_diff": manifest_diff,
    "batch_partition": batch_partition,
}
