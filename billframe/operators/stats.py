"""Batch data-quality statistics and batch outcome summaries.

Two aggregations over the items (records + tombstones), each one pass:
* ``summary``: one global row (partial aggregates per task, one tiny merge);
* ``breakdown``: every counter as long rows (metric, key, n) from one
  ``explode`` + ``groupBy`` — map-side combining keeps hot keys cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billframe.config import DQ_RULES, LOADED, MIGRATION_ITEM_THRESHOLD, QUARANTINED, SOFT_RULES
from billframe.functions.money import MONEY_TYPE

def _is_record():
    return F.col("kind") == "record"


def _is_stone():
    return F.col("kind") == "tombstone"


def month_scope(items: DataFrame, year_month: str | None) -> DataFrame:
    """Month-scoped stats read one month's records (no tombstones)."""
    if not year_month:
        return items
    return items.where(_is_record() & (F.col("month") == F.lit(year_month)))


def summary(items: DataFrame) -> DataFrame:
    """T1, T6, T7, T8 as one row."""
    return items.agg(
        F.count(F.lit(1)).alias("items_scanned"),
        F.count_if(_is_record()).alias("invoice_records"),
        F.count_if(_is_stone()).alias("quarantine_tombstones"),
        F.coalesce(F.sum(F.when(_is_record(), F.col("total_amount"))), F.lit(0)).cast(MONEY_TYPE).alias("total_gbp"),
        F.count_if(_is_record() & (F.col("status") == LOADED)).alias("_loaded"),
    ).select(
        "items_scanned",
        "invoice_records",
        "quarantine_tombstones",
        "total_gbp",
        F.coalesce(
            F.round(F.try_divide(F.col("_loaded").cast("decimal(20,0)"), F.col("invoice_records").cast("decimal(20,0)")), 4),
            F.lit(0),
        ).cast("decimal(10,4)").alias("clean_rate"),
        (F.col("items_scanned") >= MIGRATION_ITEM_THRESHOLD).alias("exceeds_migration_threshold"),
    )


def breakdown(items: DataFrame) -> DataFrame:
    """T2-T5 as (metric, key, n): by_status, dq_flag_counts, quarantine_reasons,
    by_vendor, by_month, by_original_currency."""
    def pair(metric: str, key) -> F.Column:
        return F.struct(F.lit(metric).alias("metric"), key.cast("string").alias("key"))

    record_pairs = F.array(
        pair("by_status", F.coalesce(F.col("status"), F.lit("UNKNOWN"))),
        pair("by_vendor", F.coalesce(F.regexp_replace(F.col("PK"), "^VENDOR#", ""), F.lit(""))),
        pair("by_month", F.coalesce(F.col("month"), F.lit(""))),
        pair("by_original_currency", F.coalesce(F.col("original_currency"), F.lit("UNKNOWN"))),
    )
    flag_pairs = F.transform(F.coalesce(F.col("dq_flags"), F.array().cast("array<string>")), lambda f: pair("dq_flag_counts", f))
    stone_pairs = F.array(
        pair("by_status", F.lit(QUARANTINED)),
        pair("quarantine_reasons", F.coalesce(F.col("error_type"), F.lit("Unknown"))),
    )
    pairs = F.when(_is_record(), F.concat(record_pairs, flag_pairs)).otherwise(stone_pairs)
    return (
        items.select(F.explode(pairs).alias("p"))
        .groupBy(F.col("p.metric").alias("metric"), F.col("p.key").alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def rule_catalogue(spark) -> DataFrame:
    """F16: the rule table."""
    return spark.createDataFrame(list(DQ_RULES), "name string, severity string, stage string")


def flag_report(breakdown_df: DataFrame) -> DataFrame:
    """Every soft rule with its count, zeroes kept (left join to the catalogue)."""
    spark = breakdown_df.sparkSession
    rules = spark.createDataFrame([(i, r) for i, r in enumerate(SOFT_RULES)], "ord int, rule string")
    counts = breakdown_df.where(F.col("metric") == "dq_flag_counts").select(F.col("key").alias("rule"), "n")
    return (
        rules.join(counts, "rule", "left")
    ).select("ord", "rule", F.coalesce("n", F.lit(0)).cast("long").alias("n")).orderBy("ord")


def render_report(summary_row, breakdown_rows, flag_rows) -> str:
    """Text report (driver-side formatting of already-aggregated, bounded rows)."""
    s = summary_row
    lines = [
        f"records: {s['invoice_records']}  quarantined: {s['quarantine_tombstones']}",
        f"clean rate: {s['clean_rate']:.1%}",
        f"total (GBP): {s['total_gbp']}",
        "",
        "status:",
    ]
    status = sorted((r["key"], r["n"]) for r in breakdown_rows if r["metric"] == "by_status")
    lines += [f"  {k:<24} {v}" for k, v in status]
    lines += ["", "dq flags:"]
    lines += [f"  {r['rule']:<28} {r['n']}" for r in flag_rows]
    reasons = sorted((r["key"], r["n"]) for r in breakdown_rows if r["metric"] == "quarantine_reasons")
    if reasons:
        lines += ["", "quarantine reasons:"]
        lines += [f"  {k:<28} {v}" for k, v in reasons]
    return "\n".join(lines)


def batch_counts(outcomes_df: DataFrame) -> DataFrame:
    """Outcome counts of one batch."""
    return outcomes_df.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def batch_flag_counts(outcomes_df: DataFrame) -> DataFrame:
    """Flag counts over one batch's outcomes."""
    return outcomes_df.select(F.explode("dq_flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))
