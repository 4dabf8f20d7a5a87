"""Plans over invoices rendered from the driver tables (see sources.rendered).

These are the scale plans the driver checks: every stage is a column
expression or a keyed aggregation, so the work grows linearly with orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billframe.config import DEFAULT_SETTINGS, Settings
from billframe.operators.load import first_write_wins, gold_items, tombstones
from billframe.operators.records import build_records
from billframe.plans.stages import materialize
from billframe.session import configure
from billframe.sources.rendered import rendered_orders, with_mapping_gate

# Fixed run stamps so rendered plans are deterministic.
BATCH_ID = "2026-09-09T12-00-00Z-run01"
INGESTED_AT = "2026-09-09T12:00:00+00:00"


def records_plan(spark: SparkSession, sf_dir: str, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """render -> mapping gate -> coerce -> FX -> hard rule -> DQ flags -> status (lazy)."""
    configure(spark)
    return build_records(with_mapping_gate(rendered_orders(spark, sf_dir)), settings=settings)


def records(spark: SparkSession, sf_dir: str, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """The records stage, written once per session and read back."""
    configure(spark)
    return materialize(lambda: records_plan(spark, sf_dir, settings), "records", (sf_dir, repr(settings)), spark=spark)


def classified(spark: SparkSession, sf_dir: str, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """records + first-write-wins (the order key is the load order), written once."""
    return materialize(lambda: first_write_wins(records(spark, sf_dir, settings)), "classified",
                       (sf_dir, repr(settings)), spark=spark)


def gold_and_tombstones(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The stored tables the query menu and statistics read."""
    gold = materialize(lambda: gold_items(classified(spark, sf_dir), BATCH_ID, INGESTED_AT), "gold", (sf_dir,),
                       partition_by=["month"], spark=spark)
    stones = materialize(lambda: tombstones(classified(spark, sf_dir), BATCH_ID, INGESTED_AT), "tombstones",
                         (sf_dir,), spark=spark)
    return gold, stones
