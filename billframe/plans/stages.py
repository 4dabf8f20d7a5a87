"""Materialised stages: write a stage once, read it back everywhere.

A stage that feeds several consumers (gold, tombstones, outcomes, stats) is
written as Parquet under the shared folder named by ``spark.checkpoint.dir``
(cluster) or a scratch folder (local), then read back. This cuts lineage (a
lost executor re-reads the stage instead of recomputing the whole parse) and
keeps every downstream plan small. Within one session a stage is written once
per (name, inputs) key; folders among the inputs count with their listing, so
new files in a folder make a new stage.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from billframe.session import ensure_checkpoint_dir

_MEMO: dict[tuple, str] = {}


def stage_root(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark)
    app = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/billframe-stages/{app}"


def _listing(spark: SparkSession, key: tuple) -> tuple:
    """Names, sizes and times of what lies in the folders of a key (one level)."""
    out = []
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for part in key:
        if isinstance(part, str) and "/" in part and len(part) < 1000:
            p = jvm.org.apache.hadoop.fs.Path(part)
            fs = p.getFileSystem(conf)
            if fs.exists(p):
                out += sorted((str(s.getPath()), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))
    return tuple(out)


def materialize(df, name: str, key: tuple = (), partition_by: list[str] | None = None,
                spark: SparkSession | None = None) -> DataFrame:
    """Write a stage once per (name, key) for this session and return the re-read table.

    ``df`` is a DataFrame or a zero-argument callable building one (then the
    plan is only built when the stage is not yet written).
    """
    spark = spark or (df.sparkSession if isinstance(df, DataFrame) else SparkSession.getActiveSession())
    memo_key = (spark.sparkContext.applicationId, name, key, _listing(spark, key))
    path = _MEMO.get(memo_key)
    if path is None:
        if not isinstance(df, DataFrame):
            df = df()
        digest = hashlib.sha1(repr(key).encode()).hexdigest()[:12]
        path = f"{stage_root(spark)}/{name}-{digest}-{uuid.uuid4().hex[:8]}"
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        _MEMO[memo_key] = path
    return spark.read.parquet(path)


def forget(name: str | None = None) -> None:
    """Drop memo entries (the files stay; they live under the checkpoint folder)."""
    for k in list(_MEMO):
        if name is None or k[1] == name:
            del _MEMO[k]
