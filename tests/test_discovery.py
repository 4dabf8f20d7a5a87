"""Discovery lists first, chooses, and opens only the files chosen, once each."""

import hashlib
import io
import os

import pytest

from billframe.config import Settings
from billframe.plans.batch import BatchPaths, read_items, read_silver, run_batch
from billframe.sources import manifest
from billframe.sources.manifest_source import ManifestReader, looked_into
from billframe.streaming import landing
from tests.golden import TEST_RATES, write_batch

SETTINGS = Settings(fx_rates=dict(TEST_RATES))


def counting(folder):
    """An opener that leaves a mark in ``folder`` for every file it opens."""
    os.makedirs(folder, exist_ok=True)

    def opener(path):
        import os as _os
        import uuid as _uuid

        local = path.removeprefix("file:")
        with open(_os.path.join(folder, _uuid.uuid4().hex), "w") as f:
            f.write(local)
        with open(local, "rb") as f:
            return io.BytesIO(f.read())

    return opener


def opened(folder):
    return sorted(open(os.path.join(folder, n)).read() for n in os.listdir(folder))


@pytest.fixture()
def tree(tmp_path):
    contents = {"a/1.pdf": b"%PDF-1.4 one", "a/2.PDF": b"%PDF-1.7 two", "a-b/3.pdf": b"", "b/c/4.pdf": b"no header", "5.pdf": b"%PDF", "b/6.txt": b"%PDF-"}
    for name, body in contents.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    return tmp_path / "raw", contents


def test_manifest_of_a_tree(spark, tree):
    root, contents = tree
    got = {r["path"].removeprefix(f"file:{root}/"): r for r in manifest.discover_files(spark, str(root)).collect()}
    assert set(got) == set(contents) - {"b/6.txt"}
    for name, row in got.items():
        body = contents[name]
        assert row["size_bytes"] == len(body) and row["filename"] == name.split("/")[-1]
        assert row["has_pdf_magic"] == body.startswith(b"%PDF-")
        assert row["sha256"] == (hashlib.sha256(body).hexdigest() if row["has_pdf_magic"] else None)
        assert abs(row["modified_utc"].timestamp() - os.path.getmtime(root / name)) < 1
    assert manifest.discover_files(spark, str(root / "absent")).collect() == []
    ordered = manifest.in_order(manifest.list_files(spark, str(root))).orderBy("discovery_order").collect()
    assert [r["path"].removeprefix(f"file:{root}/") for r in ordered] == ["5.pdf", "a/1.pdf", "a/2.PDF", "a-b/3.pdf", "b/c/4.pdf"]


def test_folders_are_partitions(tree):
    root, _ = tree
    for folders, expected in ((1, 1), (2, 4), (4, 5)):
        parts = ManifestReader({"path": str(root), "folders": str(folders)}).partitions()
        assert len(parts) == expected
    rows = [n for p in parts for b in ManifestReader({"path": str(root)}).read(p) for n in b.column("path").to_pylist()]
    assert len(rows) == len(set(rows)) == 5


def test_chosen_files_are_opened_once(spark, tree, tmp_path):
    root, _ = tree
    marks = str(tmp_path / "marks")
    assert len(manifest.discover_files(spark, str(root), limit=2, opener=counting(marks)).collect()) == 2
    assert opened(marks) == [f"{root}/5.pdf", f"{root}/a/1.pdf"]
    one = spark.createDataFrame([(f"file://{root}/b/c/4.pdf",)], "path string")
    marks = str(tmp_path / "only")
    assert [r["has_pdf_magic"] for r in manifest.discover_files(spark, str(root), only=one, opener=counting(marks)).collect()] == [False]
    assert opened(marks) == [f"{root}/b/c/4.pdf"]
    plan = manifest.list_files(spark, str(root), only=one, limit=3)._jdf.queryExecution().toString()
    assert "content" not in plan and "binaryFile" not in plan


def test_sizes_beyond_the_gate_and_unreadable_files(spark, tmp_path):
    rows = [("file:/a", 0), ("file:/b", 524_288_001), (f"file:{tmp_path}/absent.pdf", 9)]
    got = looked_into(spark.createDataFrame(rows, "path string, size_bytes long"), opener=counting(str(tmp_path / "m"))).collect()
    assert {(r["path"][-5:], r["has_pdf_magic"]) for r in got} == {("le:/a", False), ("le:/b", None), ("t.pdf", True)}


def test_landing_opens_each_file_once(spark, tmp_path):
    written = write_batch(str(tmp_path))
    later = tmp_path / "later"
    os.makedirs(later)
    for name in ("quarry.pdf", "willow.pdf"):
        os.rename(os.path.join(written["raw"], name), later / name)
    paths = BatchPaths(raw=written["raw"], ocr=written["ocr"], model=written["model"], out=str(tmp_path / "out"))
    marks = str(tmp_path / "marks")

    def drain():
        query = landing.start(spark, paths, str(tmp_path / "ckpt"), SETTINGS, opener=counting(marks))
        query.awaitTermination()
        return sorted(os.path.basename(p) for p in opened(marks))

    assert drain() == ["harbour.pdf", "meadow.pdf", "north.pdf", "ridge.pdf", "timber.pdf"]
    for name in os.listdir(later):
        os.rename(later / name, os.path.join(written["raw"], name))
    assert drain() == sorted(f"{n}.pdf" for n in ("harbour", "meadow", "north", "ridge", "timber", "quarry", "willow"))
    gold, stones = read_items(spark, paths.out)
    assert {r["batch_id"] for r in gold.collect()} == {"stream-00000000", "stream-00000001"}
    assert gold.count() == 6 and stones.count() == 1


def test_a_day_reads_its_own_folders_and_silver_reads_back(spark, tmp_path):
    days = {"2025-03-01": "2025/03/01", "2025-03-02": "2025/03/02"}
    paths = BatchPaths(*(str(tmp_path / d) for d in ("raw", "ocr", "model")), out=str(tmp_path / "out"))
    for folder in days.values():
        written = write_batch(str(tmp_path / "all" / folder))
        for kind in ("raw", "ocr", "model"):
            os.makedirs(os.path.dirname(tmp_path / kind / folder), exist_ok=True)
            os.rename(written[kind], tmp_path / kind / folder)
    first = run_batch(spark, paths, None, SETTINGS, now="2026-09-09T12:00:00+00:00", batch_date="2025-03-01")
    assert {r["batch_id"] for r in first["classified"].collect()} == {"2026-09-09T12-00-00Z-run01"}
    run_batch(spark, paths, "second", SETTINGS, now="2026-09-10T12:00:00+00:00", batch_date="2025-03-02")
    silver = read_silver(spark, paths.out, batch_date="2025-03-01")
    plan = silver["mapped"]._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "batch_date" in plan[plan.index("PartitionFilters") :][:200]
    mapped = {r["source_file"]: r for r in silver["mapped"].collect()}
    assert len(mapped) == 7 and all(name.startswith("2025/03/01/") for name in mapped)
    ridge = mapped["2025/03/01/ridge.pdf"]
    assert ridge["fields"]["total_amount"] == "2,500.00" and ridge["fields"]["currency"] == "INR"
    assert ridge["extraction_confidence"]["buyer_name"] == 88.0 and ridge["multiple_total_candidates"] is True
    assert ridge["unmapped_metadata"]["address"] == "1 Example Road" and ridge["unmapped_metadata"]["extracted_by"] == "AnalyzeExpense"
    summary = silver["summary_fields"].where("source_file = '2025/03/01/north.pdf' and type = 'TOTAL'").collect()
    assert [(r["label"], r["value"], r["confidence"], r["page"]) for r in summary] == [("Grand Total", "£120.00", 95.5, 1)]
    items = silver["line_items"].where("source_file = '2025/03/01/north.pdf'").collect()
    assert [(r["fields"], r["confidence"]) for r in items] == [({"Description": "Service 0", "Amount": "100.00"}, 90.5)]
    header = silver["documents"].where("source_file = '2025/03/01/north.pdf'").first()
    assert (header["api"], header["extraction_ok"], header["job_ok"]) == ("AnalyzeExpense", True, True)
    later = read_silver(spark, paths.out, batch_id="second")["mapped"].collect()
    assert {r["source_file"].rsplit("/", 1)[0] for r in later} == {"2025/03/02"}
