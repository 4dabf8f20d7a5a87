"""A batch that is given a listing takes its files from there, without a walk of the tree."""

import datetime
import os

from billframe.config import Settings
from billframe.plans.batch import BatchPaths, run_batch
from billframe.sources import manifest
from tests.golden import TEST_RATES, write_batch


def test_batch_takes_empty_files_from_the_listing(spark, tmp_path, monkeypatch):
    written = write_batch(str(tmp_path))
    paths = BatchPaths(raw=written["raw"], ocr=written["ocr"], model=written["model"], out=os.path.join(tmp_path, "out"))
    now = datetime.datetime(2026, 9, 9)
    names = [f"file:{written['raw']}/void.PDF", f"file:{written['raw']}/void.txt", f"file:{tmp_path}/elsewhere/void.pdf"]
    listing = spark.createDataFrame([(n, 0, now) for n in names], "path string, length long, modificationTime timestamp")

    def walk(*_):
        raise AssertionError("the tree was walked")

    monkeypatch.setattr(manifest.S, "listed", walk)
    got = run_batch(spark, paths, batch_id="listed", settings=Settings(fx_rates=dict(TEST_RATES)), listing=listing)
    void = [r for r in got["records"].collect() if "void" in r["source_file"]]
    assert [(r["source_file"], r["hard_rule"]) for r in void] == [("void.pdf", "EXTRACTION_FAILED")]
