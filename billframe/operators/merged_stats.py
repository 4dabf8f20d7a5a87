"""T1-T9, T11 from partial aggregates: each batch leaves its counters, reports add them up.

A partial is a small long table (month, metric, key, n, amount), made in one
pass over a batch's own items by grouping sets; the store itself is not read
again. Partials of several batches are added, those of a replaced batch simply
do not take part (the commit log names the run that counts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billframe.config import LOADED, MIGRATION_ITEM_THRESHOLD, QUARANTINED
from billframe.functions.money import MONEY_TYPE

#: Metrics that ``operators.stats.breakdown`` reports, by the grouping they come from.
BREAKDOWNS = ("by_status", "by_vendor", "by_month", "by_original_currency", "quarantine_reasons")


def partial(items: DataFrame, outcomes: DataFrame | None = None) -> DataFrame:
    """Counters of one batch's items (records and tombstones, tagged by ``kind``) and outcomes."""
    record = F.col("kind") == "record"
    none = F.array().cast("array<string>")
    slim = items.select(
        F.when(record, F.coalesce("month", F.lit(""))).alias("month"),
        F.when(record, F.coalesce("status", F.lit("UNKNOWN"))).otherwise(F.lit(QUARANTINED)).alias("by_status"),
        F.when(record, F.coalesce(F.regexp_replace("PK", "^VENDOR#", ""), F.lit(""))).alias("by_vendor"),
        F.when(record, F.coalesce("month", F.lit(""))).alias("by_month"),
        F.when(record, F.coalesce("original_currency", F.lit("UNKNOWN"))).alias("by_original_currency"),
        F.when(~record, F.coalesce("error_type", F.lit("Unknown"))).alias("quarantine_reasons"),
        "kind",
        F.when(record, F.col("total_amount")).alias("amount"),
        F.when(record, F.coalesce("dq_flags", none)).otherwise(none).alias("flags"),
    )
    dimensions = [*BREAKDOWNS, "kind"]
    sets = [[F.col("month"), F.col(d)] for d in dimensions]
    counted = slim.groupingSets(sets, "month", *dimensions).agg(
        F.grouping_id().alias("set"), F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    # The bit of a grouped dimension is 0 (month has the highest bit).
    width = len(dimensions)
    metric, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, d in enumerate(dimensions):
        grouped = F.col("set").bitwiseAND(F.lit(1 << (width - 1 - i))) == 0
        metric, key = F.when(grouped, F.lit(d)).otherwise(metric), F.when(grouped, F.col(d)).otherwise(key)
    out = counted.select("month", metric.alias("metric"), key.alias("key"), "n", F.col("amount").cast(MONEY_TYPE).alias("amount"))
    flags = slim.select("month", F.explode("flags").alias("key")).groupBy("month", "key").agg(F.count(F.lit(1)).alias("n"))
    nothing = F.lit(None).cast(MONEY_TYPE).alias("amount")
    out = out.where(F.col("key").isNotNull()).unionByName(flags.select("month", F.lit("dq_flag_counts").alias("metric"), "key", "n", nothing))
    if outcomes is not None:
        pairs = F.concat(
            F.array(F.struct(F.lit("outcome").alias("metric"), F.col("outcome").alias("key"))),
            F.transform("dq_flags", lambda f: F.struct(F.lit("outcome_flag").alias("metric"), f.alias("key"))))
        counts = outcomes.select(F.explode(pairs).alias("p")).groupBy("p.metric", "p.key").agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(counts.select(F.lit(None).cast("string").alias("month"), "metric", "key", "n", nothing))
    return out


def merged(partials: DataFrame, year_month: str | None = None) -> DataFrame:
    """(metric, key, n, amount) over all batches, or over the records of one month."""
    scoped = partials if not year_month else partials.where(
        (F.col("month") == year_month) & ~F.col("metric").isin("outcome", "outcome_flag", "quarantine_reasons"))
    return scoped.groupBy("metric", "key").agg(F.sum("n").alias("n"), F.sum("amount").cast(MONEY_TYPE).alias("amount"))


def summary(totals: DataFrame) -> DataFrame:
    """T1, T6, T7, T8 as one row, from merged counters."""
    n = lambda metric, key=None: F.coalesce(F.sum(F.when(
        (F.col("metric") == metric) & (F.lit(True) if key is None else F.col("key") == key), F.col("n"))), F.lit(0))
    one = totals.agg(
        n("kind").alias("items_scanned"), n("kind", "record").alias("invoice_records"),
        n("kind", "tombstone").alias("quarantine_tombstones"),
        F.coalesce(F.sum(F.when(F.col("metric") == "kind", F.col("amount"))), F.lit(0)).cast(MONEY_TYPE).alias("total_gbp"),
        n("by_status", LOADED).alias("_loaded"))
    ratio = F.try_divide(F.col("_loaded").cast("decimal(20,0)"), F.col("invoice_records").cast("decimal(20,0)"))
    return one.select(
        "items_scanned", "invoice_records", "quarantine_tombstones", "total_gbp",
        F.coalesce(F.round(ratio, 4), F.lit(0)).cast("decimal(10,4)").alias("clean_rate"),
        (F.col("items_scanned") >= MIGRATION_ITEM_THRESHOLD).alias("exceeds_migration_threshold"))


def breakdown(totals: DataFrame) -> DataFrame:
    """T2-T5 as (metric, key, n), from merged counters."""
    return totals.where(~F.col("metric").isin("kind", "outcome", "outcome_flag")).select("metric", "key", "n")
