"""Q3, Q4, K3: gold laid out for look-ups.

A table bucketed by the hash of ``dedup_key`` and sorted by it inside a bucket:
a look-up by key reads one bucket and, inside it, the row groups whose range
holds the key; joins on the key need no exchange. It is rebuilt from committed
gold whenever that is worth a pass over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billframe.functions import fold_key

BUCKETS = 64


def write_clustered(gold: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Gold as a table of the catalog: one file for each bucket, sorted by key, date and status."""
    spark = gold.sparkSession
    rows = gold.repartition(buckets, "dedup_key")
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, "dedup_key").sortBy(
        "dedup_key", "date_sk", "status").saveAsTable(table)
    return spark.table(table)


def folded_key(spark, company_name: str, reference: str) -> str:
    """The stored key of a printed vendor and reference."""
    return spark.range(1).select(F.concat_ws("|", fold_key(F.lit(company_name)), fold_key(F.lit(reference)))).first()[0]


def look_up(clustered: DataFrame, company_name: str, reference: str) -> DataFrame:
    """Q4: one bucket of the table is read."""
    return clustered.where(F.col("dedup_key") == F.lit(folded_key(clustered.sparkSession, company_name, reference)))
