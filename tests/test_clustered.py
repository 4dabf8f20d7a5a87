"""A look-up in clustered gold reads one bucket."""

import re

from billframe.plans import clustered as C


def test_look_up_reads_one_bucket(spark, tmp_path):
    rows = spark.range(2000).selectExpr("concat('VENDOR', id, '|INV', id) as dedup_key", "'2024-01' as month", "'d' as date_sk", "'LOADED' as status", "id")
    placed = C.write_clustered(rows, "billframe_test_gold", str(tmp_path / "gold"), buckets=16)
    found = C.look_up(placed, "vendor 77", "Inv # 77")
    assert [r["id"] for r in found.collect()] == [77]
    # without this setting the scan skips the other buckets' files as well, but the plan does not say so
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    found = C.look_up(placed, "vendor 77", "Inv # 77")
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = found._jdf.queryExecution().explainString(formatted)
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert re.search(r"SelectedBucketsCount: 1 out of 16", plan)
    spark.sql("drop table billframe_test_gold")
