"""K5: the index of gold's keys, a narrow table partitioned by a bucket of the key's hash.

A batch asks it which of its keys were loaded before. Its own buckets are sent
to the scan (at most ``BUCKETS`` rows), so buckets it does not touch are not
read; the keys that are read meet the batch's keys on one narrow shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed for the life of an index.
BUCKETS = 64


def key_bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def index_rows(loaded: DataFrame) -> DataFrame:
    """Index entries (dedup_key, bucket) of newly loaded items, a file for each bucket at most."""
    keys = loaded.select("dedup_key", key_bucket(F.col("dedup_key")).alias("bucket"))
    return keys.repartition("bucket").sortWithinPartitions("bucket", "dedup_key")


def touched(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Index entries of the buckets of ``keys`` (dedup_key), pruned at the scan."""
    own = keys.select(key_bucket(F.col("dedup_key")).alias("_b")).where(F.col("_b") >= 0).distinct()
    return index.join(F.broadcast(own), index["bucket"] == own["_b"]).select("dedup_key")
