"""Driver parquet tables (read with column pruning; no schema inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Source rows dealt out by a key before documents are rendered from them.

    Rendering makes kilobytes of text from each narrow row, so its parallelism
    must not hang on how many files the table happens to have. For rendering
    only; captured inputs are read as they lie.
    """
    return df.repartition(key)
