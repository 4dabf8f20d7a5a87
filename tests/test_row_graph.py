"""Block graphs followed within the row give what the joins give; stripping is by Unicode white space."""

import random

from pyspark.sql import functions as F

from billframe.functions import strip_ws
from billframe.operators import extract as X


def _document(rng):
    n = rng.randint(0, 24)
    ids = [f"b{i}" for i in range(n)] + ["gone", None]
    kinds = [*["WORD"] * 4, "SELECTION_ELEMENT", *["CELL"] * 6, "TABLE", "TABLE", "KEY_VALUE_SET", "KEY_VALUE_SET", "TABLE", "LINE", None]
    texts = ["x", "Qty", " y ", "", None, "two  words"]
    rel = lambda: {"Type": rng.choice([*["CHILD"] * 4, "VALUE", "OTHER"]), "Ids": rng.choice([None, *[rng.choices(ids, k=rng.randint(0, 14)) for _ in range(5)]])}
    return [{
        "Id": rng.choice([f"b{i}"] * 30 + [None]), "BlockType": rng.choice(kinds), "EntityTypes": rng.choice([None, [], ["KEY"], ["KEY"], [None, "VALUE"], ["KEY", None]]),
        "Text": rng.choice(texts), "SelectionStatus": rng.choice([None, "SELECTED", "NOT_SELECTED"]), "Confidence": rng.choice([None, 0.0, 12.5, 80.0]),
        "Page": rng.choice([None, 0, 2]), "RowIndex": rng.choice([None, 0, 1, 2, 3]), "ColumnIndex": rng.choice([None, 1, 2]),
        "Relationships": rng.choice([None, *[[rel() for _ in range(rng.randint(0, 3))] for _ in range(4)]]),
    } for i in range(n)]


def test_row_graph_equals_joins(spark, monkeypatch):
    import json

    rng = random.Random(8)
    rows = [(f"d{i}.pdf", json.dumps({"JobStatus": "SUCCEEDED", "Blocks": _document(rng)})) for i in range(1200)]
    rows += [("none.pdf", '{"JobStatus":"SUCCEEDED"}'), ("bad.pdf", "{oops")]
    both = [{"Id": "k", "BlockType": "KEY_VALUE_SET", "EntityTypes": ["KEY"], "Relationships": [{"Type": "CHILD", "Ids": ["w"]}]}, {"Id": "w", "BlockType": "WORD", "Text": "ID"}]
    rows += [("twice.pdf", json.dumps({"Blocks": both}))] * 2 + [(None, json.dumps({"Blocks": both}))]  # one graph; no name, no rows
    raw = spark.createDataFrame(rows, "source_file string, body string")
    assert X.parse_envelopes(raw, schema=X.BLOCK_SCHEMA).where("spread").count() == 0

    def found():
        parsed = X.parse_envelopes(raw, schema=X.BLOCK_SCHEMA).cache()
        pairs = X.block_summary_fields(parsed)
        items = X.block_line_items(parsed)
        items = items.withColumns({c: F.map_entries(c) for c in ("fields", "field_confidences")})
        return [sorted(map(repr, df.collect())) for df in (pairs, items)]

    within = found()
    monkeypatch.setattr(X, "ROW_GRAPH_BLOCKS", -1)
    assert min(map(len, within)) > 100
    assert [r for r in within[0] if "twice" in r and "'ID ID'" in r] and not [r for x in within for r in x if "source_file=None" in r]
    assert found() == within


def test_strip_ws_is_that_of_unicode_white_space(spark):
    odd = [f"{a}{c}x {c} y{b}" for c in map(chr, [*range(1, 33), 0x7F, 0x85, 0xA0, 0x1680, *range(0x1FFF, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF])
           for a in ("", c) for b in ("", c, c + "\n")] + ["", " \n ", None]
    df = spark.createDataFrame([(x,) for x in odd], "t string")
    assert df.where(~strip_ws("t").eqNullSafe(F.regexp_replace("t", r"(?U)^\s+|\s+$", ""))).count() == 0
