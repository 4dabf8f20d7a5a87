"""Q1-Q9: the fixed query menu over gold items and tombstones.

``run_query(gold, stones, intent)`` is one Catalyst plan: partition filter on
``month`` or predicate on ``status``, optional vendor filter, tombstone rule,
aggregate. Nothing is fetched to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billframe.config import ANSWER_SAMPLE_SIZE, DISPLAY_FIELDS, QUARANTINED
from billframe.functions import fold_key
from billframe.functions.money import MONEY_TYPE


def scan_all(gold: DataFrame, stones: DataFrame | None) -> DataFrame:
    """Q1: records and tombstones, tagged by ``kind``."""
    items = gold.withColumn("kind", F.lit("record"))
    if stones is None:
        return items
    return items.unionByName(stones.withColumn("kind", F.lit("tombstone")), allowMissingColumns=True)


def query_month(gold: DataFrame, year_month: str) -> DataFrame:
    """Q2: records of one 'yyyy-MM' month (a partition filter on ``month``)."""
    return gold.where(F.col("month") == F.lit(year_month)).withColumn("kind", F.lit("record"))


def query_status(gold: DataFrame, stones: DataFrame | None, status: str) -> DataFrame:
    """Q3: one status bucket, tombstones included, in ingest order."""
    items = scan_all(gold, stones)
    ts = F.coalesce(F.col("ingested_at_utc"), F.col("failed_at_utc")) if stones is not None else F.col("ingested_at_utc")
    return items.where(F.col("status") == F.lit(status)).withColumn("_ts", ts).orderBy("_ts").drop("_ts")


def get_by_key(gold: DataFrame, company_name: str, reference: str) -> DataFrame:
    """Q4: lookup on folded keys."""
    spark = gold.sparkSession
    key = spark.range(1).select(
        F.concat_ws("|", fold_key(F.lit(company_name)), fold_key(F.lit(reference))).alias("k")
    )
    return gold.join(F.broadcast(key), gold["dedup_key"] == key["k"], "left_semi")


def fetch(gold: DataFrame, stones: DataFrame | None, intent: dict) -> DataFrame:
    """Q5-Q7: dispatch, vendor filter, tombstone rule."""
    op = intent.get("operation")
    if op == "query_status":
        items = query_status(gold, stones, intent["status"])
    elif op == "query_month":
        items = query_month(gold, intent["year_month"])
    else:
        items = scan_all(gold, stones)
    vendor = (intent.get("vendor_contains") or "").strip().lower()
    if vendor:
        items = items.where(F.lower(F.col("company_name")).contains(F.lit(vendor)))
    if not (op == "query_status" and intent.get("status") == QUARANTINED):
        items = items.where(F.col("kind") == "record")
    return items


def run_query(gold: DataFrame, stones: DataFrame | None, intent: dict) -> DataFrame:
    """Q8: count / sum_total_amount -> one row; list -> the matched items."""
    items = fetch(gold, stones, intent)
    agg = intent.get("aggregation", "list")
    if agg == "count":
        return items.agg(F.count(F.lit(1)).alias("matched"))
    if agg == "sum_total_amount":
        return items.agg(
            F.count(F.lit(1)).alias("matched"),
            F.coalesce(F.sum("total_amount"), F.lit(0)).cast(MONEY_TYPE).alias("total_gbp"),
        )
    return items


def answer_sample(items: DataFrame, aggregation: str = "list") -> DataFrame:
    """Q9: the first five matches (declared order: dedup_key, source_file) with
    display fields and ``truncated`` (list aggregation with more than five
    matches). "More than five" is read off a top-6 (bounded), not a full count.
    """
    n = ANSWER_SAMPLE_SIZE
    order = [F.col("dedup_key").asc_nulls_last(), F.col("source_file").asc_nulls_last()]
    top = items.orderBy(*order).limit(n + 1).select(
        *[F.col(c).cast("string").alias(c) for c in DISPLAY_FIELDS], "dedup_key", "source_file"
    )
    w = Window.orderBy(*order)
    ranked = top.withColumn("_rn", F.row_number().over(w)).withColumn(
        "truncated", (F.max("_rn").over(Window.partitionBy(F.lit(1))) > n) & F.lit(aggregation == "list")
    )
    return ranked.where(F.col("_rn") <= n).orderBy("_rn").select(*DISPLAY_FIELDS, "truncated")
