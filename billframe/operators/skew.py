"""Joins whose keys may be hot: a key with a third of all rows must not land in one task; rows that meet to be lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot with more than 1 / HOT_SHARE of the rows, so there are fewer than HOT_SHARE hot keys.
HOT_SHARE = 1024


def join_unique(rows: DataFrame, unique: DataFrame, key: str) -> DataFrame:
    """Inner join with a table that has one row for each key.

    The entries of hot keys (fewer than HOT_SHARE rows, whatever the size of the
    data) are sent to the rows, which stay where they are; the others meet on
    the key. Write ``rows`` before: they are read three times.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.count(F.lit(1)).alias("_total"))
    hot = counts.crossJoin(F.broadcast(total)).where(F.col("_n") * HOT_SHARE > F.col("_total")).select(key)
    hot = F.broadcast(hot)
    few = unique.join(hot, key, "left_semi")
    near = rows.join(F.broadcast(few), key)
    far = rows.join(hot, key, "left_anti").join(unique, key)
    return near.unionByName(far.select(*near.columns))


def met(rows: DataFrame, *keys: str, n: int = 0, share: int = 1) -> DataFrame:
    """Rows sent to their key before they are collected into lists.

    Lists get no shorter where rows are read, yet Spark would sort all rows of a
    task there to build them and spill; after the shuffle it sorts a small share.
    Of ``n`` rows, if given, a task gets ``share`` at most, in more tasks than
    the session's shuffle partitions where it takes more.
    """
    tasks = n // share + 1
    if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return rows.repartition(tasks, *keys)
    return rows.repartition(*keys)
