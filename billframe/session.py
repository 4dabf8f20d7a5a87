"""Session helpers: SQL settings the operators rely on, and shared scratch.

Operators never create a session; they take the caller's and only set the few
runtime SQL options their semantics depend on.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL options the column expressions assume.
REQUIRED_SQL_CONF = {
    # Date parsing must follow the documented patterns, never the legacy
    # SimpleDateFormat fallback (which would raise on mismatch).
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.session.timeZone": "UTC",
    # Duplicate map keys: last wins instead of raising (label maps).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Options that help at scale but are not semantic.
PERFORMANCE_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# The same, left as they are where a session sets them. Narrow rows become documents of kilobytes, and
# text that repeats shrinks tenfold on disk, so a task's share is kept small: its sorts stay in memory.
PARTITION_SQL_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "32m",
    # A write by month keeps the files of a task open instead of sorting its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "128",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL options the operators depend on (idempotent)."""
    for k, v in {**REQUIRED_SQL_CONF, **PERFORMANCE_SQL_CONF}.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in PARTITION_SQL_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def local_session(app: str = "billframe", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BILLFRAME_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**REQUIRED_SQL_CONF, **PERFORMANCE_SQL_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as-is. Only when it is unset (local tests) is a scratch folder created.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is not set; on a cluster it must name a shared folder")
    local = tempfile.mkdtemp(prefix="billframe-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local
