"""K2-K9: keyed first-write-wins load, duplicates, tombstones, outcomes.

Dedup is decided on (key, order) only: a partial aggregation (min load order per
folded key, history keys first), where map-side combining keeps a hot key to one
row per task. The orders that win are joined back to the whole rows on the order,
which is unique, so whole rows cross one shuffle, unsorted, and no key can be hot there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billframe.config import DUPLICATE_SKIPPED, MONEY_FIELDS, QUARANTINED, SCHEMA_VERSION
from billframe.functions import fold_key, month_key
from billframe.functions.money import MONEY_TYPE
from billframe.operators.key_index import touched


def with_keys(records: DataFrame) -> DataFrame:
    """K2/K3: PK, SK, dedup_key, month, date sort key (each name folded once)."""
    folded = records.select(
        "*", fold_key("company_name").alias("vendor_key"), fold_key("invoice_reference_number").alias("_ref_key")
    )
    pk = F.concat(F.lit("VENDOR#"), F.col("vendor_key"))
    return folded.select(
        "*",
        pk.alias("PK"),
        F.concat(F.lit("INVOICE#"), F.col("_ref_key")).alias("SK"),
        F.concat_ws("|", F.col("vendor_key"), F.col("_ref_key")).alias("dedup_key"),
        month_key("date").alias("month"),
        F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("#"), pk).alias("date_sk"),
    ).drop("_ref_key")


def folded_to_nothing(records: DataFrame) -> DataFrame:
    """K1: (kind, n): vendors and references whose key has no letter or digit, so that they share one key."""
    counts = with_keys(records).agg(
        F.count_if(F.col("vendor_key") == "").alias("vendors"), F.count_if(F.col("SK") == "INVOICE#").alias("references"))
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in ("vendors", "references")])).alias("c")).select("c.*")


def first_write_wins(
    records: DataFrame,
    history: DataFrame | None = None,
    order_col: str = "load_order",
) -> DataFrame:
    """K5/K6: classify valid records as loaded or DUPLICATE_SKIPPED.

    ``records`` carry ``hard_rule``/``status`` (from build_records) and a
    unique ``order_col``. ``history`` is any DataFrame with ``dedup_key`` (the
    gold table), or the key index (``dedup_key``, ``bucket``), of which only the
    batch's own buckets are read: a key already there is a duplicate; within the
    batch the lowest ``order_col`` wins. Invalid rows have no key. Write
    ``records`` before, since they are read twice. Returns every input row with
    ``dedup_key`` (NULL for invalid rows), ``is_new`` and the final status.
    """
    valid = F.col("hard_rule").isNull()
    keyed = with_keys(records)
    narrow = keyed.select(F.when(valid, F.col("dedup_key")).alias("dedup_key"), F.col(order_col).cast("long").alias("_order"))
    narrow = narrow.where(F.col("dedup_key").isNotNull())
    candidates = narrow
    if history is not None:
        before = touched(history, narrow) if "bucket" in history.columns else history.select("dedup_key")
        candidates = narrow.unionByName(before.withColumn("_order", F.lit(-1).cast("long")))
    firsts = candidates.groupBy("dedup_key").agg(F.min("_order").alias("_first")).select("_first").where(F.col("_first") >= 0)
    joined = keyed.withColumn("_order", F.col(order_col).cast("long")).join(
        firsts.hint("shuffle_hash"), F.col("_order") == F.col("_first"), "left")
    is_new = valid & F.col("_first").isNotNull()
    null_keys = ["PK", "SK", "dedup_key", "vendor_key", "month", "date_sk"]
    return joined.select(
        *[c for c in keyed.columns if c not in null_keys + ["status"]],
        *[F.when(valid, F.col(c)).alias(c) for c in null_keys],
        is_new.alias("is_new"),
        F.when(~valid | is_new, F.col("status")).otherwise(F.lit(DUPLICATE_SKIPPED)).alias("status"),
    )


def gold_items(classified: DataFrame, batch_id, ingested_at) -> DataFrame:
    """K4: the stored item for every newly loaded record."""
    return classified.where(F.col("is_new")).select(
        "*",
        F.lit(batch_id).alias("batch_id") if "batch_id" not in classified.columns else F.col("batch_id").alias("_b"),
        F.lit(ingested_at).cast("string").alias("ingested_at_utc"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    ).drop("_b", "is_new", "hard_rule", "error_type", "failed_at_stage", "error_detail")


def tombstones(classified: DataFrame, batch_id, failed_at) -> DataFrame:
    """K7: one tombstone per quarantined file of the batch."""
    bid = F.col("batch_id") if "batch_id" in classified.columns else F.lit(batch_id)
    return classified.where(F.col("status") == QUARANTINED).select(
        F.concat(F.lit("QUARANTINE#"), bid).alias("PK"),
        F.concat(F.lit("FILE#"), F.col("source_file")).alias("SK"),
        F.lit(QUARANTINED).alias("status"),
        F.col("source_file"),
        bid.alias("batch_id"),
        F.col("error_type"),
        # A tombstone names the failing stage when the error carries one;
        # validation and unclassified errors are recorded as validation.
        F.when(F.col("failed_at_stage").isin("extraction", "mapping", "storage"), F.col("failed_at_stage"))
        .otherwise(F.lit("pydantic_validation")).alias("failed_at_stage"),
        F.col("hard_rule").alias("dq_rule"),
        F.lit(failed_at).cast("string").alias("failed_at_utc"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )


def latest_tombstones(stones: DataFrame) -> DataFrame:
    """K7: unconditional put semantics -> the last write per (batch_id, file) wins."""
    return stones.groupBy("batch_id", "source_file").agg(
        F.max_by(F.struct(*[c for c in stones.columns]), F.col("failed_at_utc")).alias("t")
    ).select("t.*")


def outcomes(classified: DataFrame) -> DataFrame:
    """T11 input: one outcome per file (duplicates carry no flags or key)."""
    dup = F.col("status") == DUPLICATE_SKIPPED
    q = F.col("status") == QUARANTINED
    return classified.select(
        F.col("source_file").alias("filename"),
        F.col("status").alias("outcome"),
        F.when(dup | q, F.array().cast("array<string>")).otherwise(F.col("dq_flags")).alias("dq_flags"),
        F.when(q, F.col("error_type")).alias("error_type"),
        F.when(q, F.col("hard_rule")).when(dup, F.concat(F.col("dedup_key"), F.lit(" was loaded before"))).alias("error_message"),
        F.when(~(dup | q), F.col("dedup_key")).alias("dedup_key"),
    )


def quarantine_sidecars(classified: DataFrame, mapped: DataFrame | None, batch_id, failed_at) -> DataFrame:
    """One sidecar row per quarantined file, with its latest mapped payload."""
    q = classified.where(F.col("status") == QUARANTINED)
    bid = F.col("batch_id") if "batch_id" in classified.columns else F.lit(batch_id)
    src = F.coalesce(F.col("path"), F.col("source_file")) if "path" in classified.columns else F.col("source_file")
    side = q.select(
        src.alias("source_file"),
        F.col("source_file").alias("filename"),
        F.col("failed_at_stage"),
        F.lit(failed_at).cast("string").alias("failed_at_utc"),
        F.col("error_type"),
        F.col("hard_rule").alias("dq_rule"),
        F.col("error_detail"),
        bid.alias("batch_id"),
    )
    if mapped is not None:
        payload = mapped.select(
            F.col("source_file").alias("filename"), F.col("raw_mapped_payload")
        )
        side = side.join(payload, "filename", "left")
    else:
        side = side.withColumn("raw_mapped_payload", F.lit(None).cast("string"))
    return side


def _money_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c in MONEY_FIELDS or c.removeprefix("original_") in MONEY_FIELDS]


def write_gold_jsonl(gold: DataFrame, path: str) -> None:
    """Gold items as one JSON object a line; money as text, since JSON has no decimals."""
    gold.withColumns({c: F.col(c).cast("string") for c in _money_columns(gold.columns)}).write.mode("overwrite").json(path)


def read_gold_jsonl(spark, path: str, schema) -> DataFrame:
    """Gold items from such files, money as decimals again; blank lines are no items.

    ``schema``: that of the gold table.
    """
    money = set(_money_columns(schema.names))
    raw = T.StructType([T.StructField(f.name, T.StringType()) if f.name in money else f for f in schema.fields])
    return spark.read.schema(raw).json(path).withColumns({c: F.col(c).try_cast(MONEY_TYPE) for c in money})
