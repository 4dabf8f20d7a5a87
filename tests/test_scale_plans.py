"""Steps that grow with the data: what is parsed or folded once, what meets without sorts, what no hot key holds up."""

import contextlib
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from billframe.functions.keys import _multi_class, fold_key
from billframe.operators import extract as X
from billframe.operators import load as L
from billframe.operators import mapping as M
from billframe.operators.fx import attach_rates, fx_table
from billframe.operators.skew import met
from billframe.session import PARTITION_SQL_CONF, configure
from billframe.sources import envelopes as V


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def no_broadcasts(spark):
    """Tables too large to be broadcast by their size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rates_do_not_deal_documents_by_currency(spark, no_broadcasts):
    df = spark.range(6).select(F.element_at(F.array(*map(F.lit, ("GBP", " inr ", "JPY"))), (F.col("id") % 3 + 1).cast("int")).alias("ccy"))
    joined = attach_rates(df, "ccy", fx_table(spark))
    plan = _plan(joined)
    assert "BroadcastHashJoin" in plan and "hashpartitioning(upper(trim(ccy" not in plan
    assert joined.count() == 6 and joined.where(F.col("fx_rate").isNull()).count() == 2


def test_whole_rows_meet_their_order_unsorted(spark, no_broadcasts):
    rows = spark.createDataFrame([("A", "1", 1), ("a", "1", 2), ("B", "1", 3), (None, "1", 4)], "company_name string, invoice_reference_number string, load_order long")
    rows = rows.withColumns({"date": F.lit("2026-01-01").cast("date"), "status": F.lit("LOADED"),
                             "hard_rule": F.when(F.col("company_name").isNull(), F.lit("MISSING_MANDATORY_FIELD"))})
    done = L.first_write_wins(rows)
    assert "ShuffledHashJoin" in _plan(done) and "SortMergeJoin" not in _plan(done)
    assert sorted((r.load_order, r.is_new, r.status) for r in done.collect()) == [
        (1, True, "LOADED"), (2, False, "DUPLICATE_SKIPPED"), (3, True, "LOADED"), (4, False, "LOADED")]


def _envelope(rows):
    det = lambda text, conf=None: {"Text": text, "Confidence": conf}
    fields = [[{"Type": det(t), "LabelDetection": det(label), "ValueDetection": det(v, c)} for t, label, v, c in row] for row in rows]
    items = [{"LineItemExpenseFields": f} for f in fields]
    return json.dumps({"ExpenseDocuments": [{"SummaryFields": [], "LineItemGroups": [{"LineItems": items}]}, None]})


def _folded(row):
    """One line item, cell after cell."""
    cells, seen = {}, []
    for typ, label, value, conf in row:
        key = (label or "").strip() or typ or f"COL{len(cells)}"
        old = cells.get(key, ("", None))[1]
        cells[key] = ((value or "").strip(), conf if conf else old)
        seen += [conf] if conf else []
    return [(k, v, c) for k, (v, c) in cells.items()], sum(seen) / len(seen) if seen else 0.0


def test_line_items_equal_a_fold_over_cells(spark):
    configure(spark)
    rng = random.Random(5)
    texts = [None, "", "Qty", " Qty ", "COL1", "COL2", "Amount"]
    rows = [[(rng.choice([None, "", "ITEM", "PRICE"]), rng.choice(texts), rng.choice([None, " 7 ", "x"]), rng.choice([None, 0.0, 50.0, 90.5]))
             for _ in range(rng.randint(0, 5))] for _ in range(600)]
    parsed = X.parse_envelopes(spark.createDataFrame([("d.pdf", _envelope(rows)), ("no.pdf", "{}"), ("bad.pdf", "{oops")], "source_file string, body string"))
    items = X.expense_line_items(parsed)
    found = {r.row_index: ([(k, r.fields[k], r.field_confidences.get(k)) for k in r._keys], r.confidence) for r in items.collect()}
    assert found == dict(enumerate(_folded(row) for row in rows if row))
    # one parse of the body and one fold of the rows, though nothing was written in between
    assert _plan(items).count("from_json(") == 1 and _plan(items).count("array_distinct(") == 1


def test_lists_are_built_after_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("source_file"), F.col("id").alias("row_order"), F.create_map(F.lit("ITEM"), F.lit("x")).alias("fields"), F.array(F.lit("ITEM")).alias("_keys"))
    names = X.product_names(df)
    tree = _plan(names).split("\n\n")[0]
    assert tree.index("ObjectHashAggregate") < tree.rindex("ObjectHashAggregate") < tree.index("Exchange")
    assert sorted(tuple(r) for r in names.collect()) == [(0, "x; x; x; x"), (1, "x; x; x"), (2, "x; x; x")]
    assert met(df, "source_file").count() == 10


def test_descriptions_by_priority_else_the_longest(spark):
    rows = [("a", 0, {"Name": " n ", "item": " ", "Description": " d "}), ("a", 1, {"x": "1,000.5", "y": " long ", "z": "same"}),
            ("a", 2, {"x": "7"}), ("b", 0, {"x": " "}), ("c", 0, {"ITEM": "i", "NAME": "n"})]
    df = spark.createDataFrame(rows, "source_file string, row_order int, fields map<string,string>").withColumn("_keys", F.map_keys("fields"))
    assert sorted(tuple(r) for r in X.product_names(df).collect()) == [("a", "d; long"), ("c", "i")]
    # made once: no filter on a description of its own
    assert _plan(X.product_names(df)).count("regexp_replace(") == 1


def test_losing_attempts_travel_without_payload(spark):
    ok = json.dumps({"date": "d", "company_name": "c", "buyer_name": "b", "invoice_reference_number": "r", "total_amount": "1", "currency": "GBP"})
    df = spark.createDataFrame([("a", 1, "{}"), ("a", 2, ok), ("b", 1, "{}"), ("b", 2, None), ("c", 1, ok), ("c", 2, ok)], "source_file string, attempt int, response string")
    best = M.select_attempt(df, is_tool_input=True)
    assert sorted((r.source_file, r.mapping_ok, r.attempts, r.fields and r.fields.company_name) for r in best.collect()) == [
        ("a", True, 2, "c"), ("b", False, None, None), ("c", True, 1, "c")]


def test_shares_of_a_task_are_small_unless_a_session_sets_them(spark):
    configure(spark)
    name = "spark.sql.files.maxPartitionBytes"
    assert all(spark.conf.get(k) == v for k, v in PARTITION_SQL_CONF.items())
    spark.conf.set(name, "7m")
    assert configure(spark).conf.get(name) == "7m"
    spark.conf.unset(name)
    configure(spark)


def test_folding_passes_over_ascii(spark):
    assert _multi_class().startswith(r"(?=[^\x00-\x7F])")
    df = spark.createDataFrame([("Ltd ① ﬁ Á㎏-x",), ("plain 1",), ("株",), (None,)], "t string")
    assert [r.k for r in df.select(fold_key("t").alias("k")).collect()] == ["LTD1FIAKGX", "PLAIN1", "", ""]


def test_large_inputs_meet_in_more_tasks_than_the_sessions(spark, tmp_path, monkeypatch):
    assert met(spark.range(100), "id", n=100, share=5).rdd.getNumPartitions() == 21
    assert "REPARTITION_BY_COL" in _plan(met(spark.range(100), "id", n=100, share=50))
    spark.range(60).selectExpr("id as l_orderkey", "id % 9 as l_partkey", "1 as l_linenumber", "3.0 as l_quantity", "9.25 as l_extendedprice").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(9).selectExpr("id as p_partkey", "concat('part ', id) as p_name").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(V, "TASK_LINES", 4)
    lines = V._lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() == 16 and lines.count() == 60
