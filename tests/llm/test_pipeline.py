"""The pipeline, stage by stage, against brute force; and on odd rows and empty tables."""

import os

import duckdb
import pytest

import corpus_pipeline as P
from billframe.llm import mixture, quality_fm
from billframe.llm.common import DOCUMENT_COLUMNS, write_stage
from billframe.sources.tables import table
from test_operators import WORDS, bag, components, fingerprint, hits, kept_lines

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def rows_of(df):
    return [tuple(r[c] for c in DOCUMENT_COLUMNS) for r in df.collect()]


def test_stages_equal_brute_force(spark):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "line dedup", "near duplicates", "benchmark decontamination", "mixing"]
    docs = table(spark, SF, "documents")
    frames = [docs]
    for name, stage in P.STAGES:
        frames.append(write_stage(stage(spark, frames[-1], SF), "test-" + name.replace(" ", "-")))
    given = [rows_of(f) for f in frames[:-1]]
    assert all(f.columns == DOCUMENT_COLUMNS for f in frames[:-1])

    model = quality_fm.train(docs, table(spark, SF, "labels"))
    good = [r for r in given[0] if model.score((r[1] or "").encode()) >= 0.5]
    assert bag(given[1]) == bag(good) and 0 < len(good) < len(given[0])

    kept = kept_lines(given[1])
    lines = []
    for i, t, lang, source, _ in given[1]:
        numbers = set(kept.get((i, t or ""), []))
        if numbers or not WORDS.search(t or ""):
            text = "\n".join(x for at, x in enumerate(t.split("\n")) if at in numbers or not WORDS.search(x))
            lines.append((i, text, lang, source, len(text)))
    assert bag(given[2]) == bag(lines)

    root = components({fingerprint(r[1]) for r in given[2]}, 4)
    first = {}
    for r in sorted(given[2]):
        first.setdefault(root[fingerprint(r[1])], r)
    assert bag(given[3]) == bag(first.values())

    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    words = {w for _, t in items for w in t.lower().split()[:3]}
    clean = [r for r in given[3] if not words & set(r[1].lower().split()) or not hits(r[1], items)[1]]
    assert bag(given[4]) == bag(clean)

    kept_docs = frames[4].toPandas()  # noqa: F841 (read by the SQL below)
    expected = duckdb.sql(mixture.SQL_FILLED.format(documents="kept_docs")).fetchall()
    assert bag((r.doc_id, r.source, r.block, r.n_tokens, round(r.progress, 9)) for r in frames[5].collect()) == bag(
        (a, b, c, d, round(e, 9)) for a, b, c, d, e in expected)


def test_run_gives_the_last_stage(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "source", "block", "n_tokens", "progress"] and out.count() > 0


def test_stages_on_odd_and_empty_documents(spark, docs, empty):
    for name, stage in P.STAGES:
        got = stage(spark, docs, SF)
        if name != "mixing":
            assert got.columns == DOCUMENT_COLUMNS, name
        assert 0 < got.count(), name
        assert stage(spark, empty, SF).count() == 0, name
