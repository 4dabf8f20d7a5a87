"""End-to-end batch over seven invented documents; running it again adds nothing."""

import os
import shutil
import tempfile
from decimal import Decimal

from billframe.config import Settings
from billframe.operators import merged_stats as S
from billframe.operators import query as Q
from billframe.operators import stats as T
from billframe.plans.batch import BatchPaths, latest_sidecars, read_items, read_silver, read_stats, run_batch
from tests.golden import TEST_RATES, write_batch

SETTINGS = Settings(fx_rates=dict(TEST_RATES))
FIRST = ("2026-09-09T12-00-00Z-run01", "2026-09-09T12:00:00+00:00")
SECOND = ("2026-09-10T12-00-00Z-run01", "2026-09-10T12:00:00+00:00")


def _paths(root, written):
    return BatchPaths(raw=written["raw"], ocr=written["ocr"], model=written["model"], out=os.path.join(root, "out"))


def _counts(res):
    counts = {}
    for r in res["outcomes"].collect():
        counts[r["outcome"]] = counts.get(r["outcome"], 0) + 1
    return counts


def test_golden_batch_and_rerun(spark):
    root = tempfile.mkdtemp(prefix="billframe-golden-")
    paths = _paths(root, write_batch(root))
    res = run_batch(spark, paths, FIRST[0], SETTINGS, now=FIRST[1])
    out = {r["filename"]: r for r in res["outcomes"].collect()}
    assert out["timber.pdf"]["outcome"] == "QUARANTINED"
    assert out["timber.pdf"]["error_message"] == "NEGATIVE_MONEY_VALUE"
    assert out["ridge.pdf"]["dq_flags"] == ["MULTIPLE_TOTAL_CANDIDATES"]
    assert out["meadow.pdf"]["dq_flags"] == ["ZERO_TOTAL_AMOUNT", "ZERO_PRODUCT_AMOUNT", "LOW_FIELD_CONFIDENCE"]
    assert out["quarry.pdf"]["dq_flags"] == ["ZERO_TAX_WITH_NONZERO_RATE"]
    assert _counts(res) == {"LOADED": 3, "LOADED_WITH_WARNINGS": 3, "QUARANTINED": 1}

    gold, stones = read_items(spark, paths.out)
    items = Q.scan_all(gold, stones)
    s = T.summary(items).collect()[0]
    assert s["total_gbp"] == Decimal("505.50")
    assert s["clean_rate"] == Decimal("0.5000")
    b = {(r["metric"], r["key"]): r["n"] for r in T.breakdown(items).collect()}
    assert {k: n for k, n in b.items() if k[0] == "by_original_currency"} == {
        ("by_original_currency", "GBP"): 2, ("by_original_currency", "INR"): 3, ("by_original_currency", "USD"): 1}
    assert b[("by_month", "2023-11")] == 1
    # the same from the counters that the batch left
    stats = read_stats(spark, paths.out).collect()
    merged = {(r["metric"], r["key"]): r["n"] for r in stats}
    assert {k: n for k, n in merged.items() if not k[0].startswith(("outcome", "kind"))} == b
    assert {k[1]: n for k, n in merged.items() if k[0] == "outcome"} == _counts(res)
    assert merged[("outcome_flag", "LOW_FIELD_CONFIDENCE")] == 1
    totals = spark.createDataFrame(stats, "metric string, key string, n long, amount decimal(28,8)")
    assert S.summary(totals).collect() == T.summary(items).collect()
    march = {(r["metric"], r["key"]): r["n"] for r in read_stats(spark, paths.out, "2024-03").collect()}
    assert march[("by_month", "2024-03")] == 1 and march[("kind", "record")] == 1 and ("kind", "tombstone") not in march
    g = {r["source_file"]: r for r in gold.collect()}
    assert g["ridge.pdf"]["total_amount"] == Decimal("25.00")
    assert g["willow.pdf"]["coupon_discount_amount"] == Decimal("1.00")
    assert g["willow.pdf"]["vat_tax_amount"] == Decimal("2.00")

    # silver reads back as it was written, and holds line items too
    silver = read_silver(spark, paths.out, FIRST[0])
    assert {n: df.count() for n, df in silver.items()} == {"summary_fields": 35, "line_items": 7, "documents": 7, "mapped": 7}

    # the same batch again: it is committed, so its outcomes stay and nothing doubles
    again = run_batch(spark, paths, FIRST[0], SETTINGS, now=FIRST[1])
    assert _counts(again) == {"LOADED": 3, "LOADED_WITH_WARNINGS": 3, "QUARANTINED": 1}
    read = lambda sink: spark.read.parquet(os.path.join(paths.out, sink)).count()
    assert (read("gold"), read("tombstones"), read("outcomes"), read("silver/mapped")) == (6, 1, 7, 7)
    assert spark.read.json(os.path.join(paths.out, "quarantine")).count() == 1

    # another batch over the same files: labels learned before are used, quarantines repeat
    r2 = run_batch(spark, paths, SECOND[0], SETTINGS, now=SECOND[1])
    assert _counts(r2) == {"DUPLICATE_SKIPPED": 6, "QUARANTINED": 1}
    assert read("gold") == 6
    by_alias = {r["source_file"] for r in read_silver(spark, paths.out, SECOND[0])["mapped"].collect() if r["source"] == "vendor_alias_cache"}
    assert by_alias == set(out) - {"north.pdf"}  # whose printed date label is not the one cited
    assert [r["failed_at_utc"] for r in latest_sidecars(spark, paths.out).collect()] == [SECOND[1]]
    twice = {(r["metric"], r["key"]): r["n"] for r in read_stats(spark, paths.out).collect()}
    assert (twice[("kind", "record")], twice[("kind", "tombstone")], twice[("outcome", "DUPLICATE_SKIPPED")]) == (6, 2, 6)
    month = Q.run_query(*read_items(spark, paths.out), {"operation": "query_month", "year_month": "2023-11",
                                                         "aggregation": "count"}).collect()[0]
    assert month["matched"] == 1
    q = Q.run_query(*read_items(spark, paths.out), {"operation": "query_status", "status": "QUARANTINED",
                                                     "aggregation": "count"}).collect()[0]
    assert q["matched"] == 2  # one tombstone per (batch, file)


def test_same_name_in_two_folders_and_a_date_folder(spark):
    root = tempfile.mkdtemp(prefix="billframe-folders-")
    written = write_batch(root)
    for kind in ("raw", "ocr", "model"):
        for folder, stem in (("2025/03/01", "north"), ("2025/03/02", "harbour"), ("2025/03/02", "willow")):
            os.makedirs(os.path.join(written[kind], folder), exist_ok=True)
            for suffix in (".pdf", ".json", ".mapped.json"):
                path = os.path.join(written[kind], stem + suffix)
                if os.path.exists(path):
                    name = "bill" if stem != "willow" else stem
                    shutil.copy(path, os.path.join(written[kind], folder, name + suffix))
    with open(os.path.join(written["raw"], "2025/03/02", "zero.pdf"), "wb"):
        pass
    with open(os.path.join(written["raw"], "2025/03/02", "text.pdf"), "wb") as f:
        f.write(b"no header")
    day = run_batch(spark, _paths(root, written), "day", SETTINGS, now=FIRST[1], batch_date="2025-03-02")
    out = {r["filename"]: r["outcome"] for r in day["outcomes"].collect()}
    assert out == {"2025/03/02/bill.pdf": "LOADED", "2025/03/02/willow.pdf": "LOADED", "2025/03/02/zero.pdf": "QUARANTINED",
                   "2025/03/02/text.pdf": "QUARANTINED"}
    first = run_batch(spark, _paths(root, written), "one", SETTINGS, now=FIRST[1], batch_date="2025-03-02", limit=1)
    assert [r["filename"] for r in first["outcomes"].collect()] == ["2025/03/02/bill.pdf"]
    assert run_batch(spark, _paths(root, written), "none", SETTINGS, now=FIRST[1], batch_date="2025-03-09")["outcomes"].count() == 0
    whole = run_batch(spark, _paths(root, written), "whole", SETTINGS, now=SECOND[1])
    rows = {r["filename"]: r["outcome"] for r in whole["outcomes"].collect()}
    assert len(rows) == 12
    # the two documents named bill.pdf are told apart: one is new, one was loaded by the day's batch
    assert rows["2025/03/01/bill.pdf"] == "LOADED" and rows["2025/03/02/bill.pdf"] == "DUPLICATE_SKIPPED"
    assert rows["north.pdf"] == "DUPLICATE_SKIPPED"  # same invoice, later path
    gold = {r["source_file"] for r in spark.read.parquet(os.path.join(root, "out", "gold")).collect()}
    assert {"2025/03/01/bill.pdf", "2025/03/02/bill.pdf"} <= gold
