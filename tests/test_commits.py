"""A batch is seen whole or not at all, however often it is started."""

import json
import os

import pytest

from billframe.config import Settings
from billframe.operators import load as L
from billframe.operators.key_index import index_rows
from billframe.plans import commits
from billframe.plans.batch import BatchPaths, latest_sidecars, read_items, run_batch
from tests.golden import TEST_RATES, write_batch

SETTINGS = Settings(fx_rates=dict(TEST_RATES))


def outcomes(result):
    found = {}
    for r in result["outcomes"].collect():
        found[r["outcome"]] = found.get(r["outcome"], 0) + 1
    return found


def test_a_run_that_dies_after_its_writes_is_run_again(spark, tmp_path, monkeypatch):
    written = write_batch(str(tmp_path))
    paths = BatchPaths(raw=written["raw"], ocr=written["ocr"], model=written["model"], out=str(tmp_path / "out"))

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(commits.Run, "commit", die)
        with pytest.raises(RuntimeError, match="killed"):
            run_batch(spark, paths, "one", SETTINGS, now="2026-09-09T12:00:00+00:00")
    assert os.path.isdir(tmp_path / "out" / "gold") and read_items(spark, paths.out) == (None, None)
    left = commits.unpublished(spark, paths.out)
    assert left and all("run=" in p for p in left)
    expected = {"LOADED": 3, "LOADED_WITH_WARNINGS": 3, "QUARANTINED": 1}
    assert outcomes(run_batch(spark, paths, "one", SETTINGS, now="2026-09-09T13:00:00+00:00")) == expected
    gold, stones = read_items(spark, paths.out)
    assert (gold.count(), stones.count()) == (6, 1)
    # a quarantined file keeps its payload and the errors found
    sidecar = latest_sidecars(spark, paths.out).first()
    payload = json.loads(sidecar["raw_mapped_payload"])
    assert payload["fields"]["total_amount"] == "(75.00)" and payload["unmapped_metadata"]["address"] == "1 Example Road"
    assert sidecar["dq_rule"] == "NEGATIVE_MONEY_VALUE" and [e["loc"] for e in sidecar["error_detail"]] == [""]
    assert commits.unpublished(spark, paths.out) == left
    assert outcomes(run_batch(spark, paths, "two", SETTINGS)) == {"DUPLICATE_SKIPPED": 6, "QUARANTINED": 1}


def test_two_writers_take_two_versions(spark, tmp_path):
    out = str(tmp_path)
    runs = [commits.Run(spark, out, b, None) for b in ("a", "b", "a")]
    for i, run in enumerate(runs):
        run.write(spark.createDataFrame([(i,)], "x int"), "sink")
    real = commits.commits
    # the second writer does not see the first one's commit when it chooses its version
    first = runs[0].commit("t")
    calls = []

    def stale(*args):
        calls.append(1)
        return [] if len(calls) == 1 else real(*args)  # once, in the choice of the version

    commits.commits = stale
    try:
        second = runs[1].commit("t")
    finally:
        commits.commits = real
    assert (first.version, second.version) == (1, 2) and len(calls) == 2
    assert sorted(r["x"] for r in commits.read_sink(spark, out, "sink").collect()) == [0, 1]
    runs[2].commit("t")  # replaces the first one's rows
    assert sorted(r["x"] for r in commits.read_sink(spark, out, "sink").collect()) == [1, 2]
    assert [r["x"] for r in commits.read_sink(spark, out, "sink", but="a").collect()] == [1]
    # runs that decide on gold's keys do not pass each other
    early, late = (commits.Run(spark, out, b, None) for b in ("c", "d"))
    for run in (early, late):
        run.write(spark.createDataFrame([("k", 1)], "dedup_key string, bucket int"), "gold_keys", partition_by=["bucket"])
    late.commit("t")
    with pytest.raises(commits.Conflict):
        early.commit("t")
    assert commits.read_sink(spark, out, "gold_keys").count() == 1
    assert commits.read_sink(spark, out, "other") is None and len(commits.unpublished(spark, out)) == 2


def test_key_index_reads_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "keys")
    index_rows(spark.range(5000).selectExpr("concat('K', id) as dedup_key")).write.partitionBy("bucket").parquet(path)
    index = spark.read.parquet(path)
    batch = spark.createDataFrame(
        [(1, "K7", None), (2, "K7", None), (3, "NEW", None), (4, "NEW", None), (5, "NEW", "NEGATIVE_MONEY_VALUE"), (6, "K4999", None)],
        "load_order long, ref string, hard_rule string",
    ).selectExpr("*", "'' as company_name", "ref as invoice_reference_number", "date'2024-01-01' as date", "concat('f', load_order) as source_file",
                 "case when hard_rule is null then 'LOADED' else 'QUARANTINED' end as status")
    index = index.selectExpr("concat('|', dedup_key) as dedup_key", "bucket")
    got = L.first_write_wins(batch, spark.read.parquet(path).select("dedup_key"))
    assert got.count() == 6  # keys of another form match nothing
    real = str(tmp_path / "real")
    index_rows(index.select("dedup_key")).write.partitionBy("bucket").parquet(real)
    done = L.first_write_wins(batch, spark.read.parquet(real))
    assert {r["load_order"]: r["status"] for r in done.collect()} == {
        1: "DUPLICATE_SKIPPED", 2: "DUPLICATE_SKIPPED", 3: "LOADED", 4: "DUPLICATE_SKIPPED", 5: "QUARANTINED", 6: "DUPLICATE_SKIPPED"}
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
