"""Captured OCR envelopes: readers, and envelopes rendered from the driver tables.

Rendered envelopes (one per order) let the extraction operators run over data
that grows with ``lineitem``:

expense  SummaryFields  VENDOR_NAME 'Vendor:' | TOTAL (no printed label) |
                        INVOICE_RECEIPT_DATE '  Invoice\\n Date: '; confidences
                        10/20/30 when orderkey % 7 = 0 (forces the fallback)
         LineItems      per line (l_linenumber order): ITEM = part name (90),
                        QUANTITY label 'Qty' (30 + (orderkey + 7*line) % 70),
                        PRICE label 'Amount' (60 + line); when line % 4 = 0 an
                        unlabelled untyped 'note' cell (confidence 0) -> 'COL3';
                        when line % 5 = 0 a second 'Qty' cell 'dup' (confidence 0)
                        overwriting the first value but not its confidence.
blocks   KEY 'Order ID' -> value words <orderkey>; KEY 'Grand Total' -> total;
         one TABLE: header 'Description' | 'Qty', one row per line item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billframe.operators.skew import met
from billframe.sources.tables import table


def read_json_folder(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """One row per JSON file: (path, source_file, body). Whole-text reads keep a
    pretty-printed document in one row."""
    df = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).option(
        "recursiveFileLookup", True).text(path)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("json_name"),
                     F.col("value").alias("body"))


def _cents_text(c: Column) -> Column:
    """'1234.56' from integer cents, by casts: a formatter costs as much as the rest of a line."""
    whole, rest = (c / 100).cast("long"), (c % 100).cast("int")
    zero = F.when((rest >= 0) & (rest < 10), F.lit(".0")).otherwise(F.lit("."))
    return F.coalesce(F.concat(whole.cast("string"), zero, rest.cast("string")), F.lit("null.null"))


def _file_name(k: Column) -> Column:
    return F.concat(F.lit("invoice_"), F.coalesce(k.cast("string"), F.lit("null")), F.lit(".pdf"))


def _escaped(text: Column) -> Column:
    """The text as it stands between the quotes of a JSON string."""
    whole = F.to_json(F.struct(text.alias("t")))
    return F.when(text.isNotNull(), F.substring(whole, F.lit(7), F.length(whole) - 8))


def _object(*members: Column) -> Column:
    """A JSON object of its members; NULL members are left out, as ``to_json`` does."""
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _string(name: str, text: Column) -> Column:
    """A member of text that is escaped or needs no escaping."""
    return F.concat(F.lit(f'"{name}":"'), text, F.lit('"'))


def _number(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), value.cast("string"))


def _det(text: Column, conf: Column) -> Column:
    return _object(_string("Text", text), _number("Confidence", conf.cast("double")))


#: Lines that one task renders: each becomes up to a kilobyte and a half of text, which the task may have to send on.
TASK_LINES = 1 << 18


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, ls): an order's lines as narrow structs in a total order, since line numbers repeat
    within an order in the driver data. Texts are rendered from them after the shuffle."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                                        "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", _escaped(F.col("p_name")).alias("item"))
    li = li.join(part, li.l_partkey == part.p_partkey)
    line = F.struct("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "item")
    dealt = met(li.select("l_orderkey", line.alias("line")), "l_orderkey", n=table(spark, sf_dir, "lineitem").count(), share=TASK_LINES)
    return dealt.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("line")).alias("ls"))


def _qty(x: Column) -> Column:
    return x["l_quantity"].cast("long").cast("string")


def _qty_conf(k: Column, x: Column) -> Column:
    return F.lit(30) + (k + x["l_linenumber"] * 7) % 70


def rendered_expense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_file, load_order, body) expense envelopes, one per order (without lines: an empty group)."""

    def fld(typ, label, value):
        return _object(F.lit(f'"Type":{{"Text":"{typ}"}}'), F.concat(F.lit('"LabelDetection":'), label) if label is not None else F.lit(None).cast("string"),
                       F.concat(F.lit('"ValueDetection":'), value))

    qty_label, amount_label = _det(F.lit("Qty"), F.lit(80)), _det(F.lit("Amount"), F.lit(80))

    def line(x):
        n = x["l_linenumber"]
        amount = _cents_text(F.round(x["l_extendedprice"] * 100).cast("long"))
        return F.concat(F.lit('{"LineItemExpenseFields":['), F.concat_ws(
            ",",
            fld("ITEM", None, _det(x["item"], F.lit(90))),
            fld("QUANTITY", qty_label, _det(_qty(x), _qty_conf(F.col("l_orderkey"), x))),
            fld("PRICE", amount_label, _det(amount, F.lit(60) + n)),
            F.when(n % 4 == 0, fld("", None, _det(F.lit("note"), F.lit(0)))),
            F.when(n % 5 == 0, fld("QUANTITY", qty_label, _det(F.lit("dup"), F.lit(0)))),
        ), F.lit("]}"))

    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    rows = _lines(spark, sf_dir)
    j = o.join(rows, o.o_orderkey == rows.l_orderkey, "left")
    k = F.col("o_orderkey")
    total = _cents_text(F.round(F.col("o_totalprice") * 100).cast("long"))
    low = k % 7 == 0  # weak OCR: mean confidence below the fallback threshold
    body = F.concat(
        F.lit('{"JobStatus":"SUCCEEDED","DocumentMetadata":{"Pages":1},"ExpenseDocuments":[{"ExpenseIndex":1,"SummaryFields":['),
        fld("VENDOR_NAME", _det(F.lit("Vendor:"), F.lit(95)),
            _det(F.concat(F.lit("Acme Trading "), (k % 200).cast("string")), F.when(low, F.lit(10)).otherwise(F.lit(50) + k % 50))),
        F.lit(","),
        fld("TOTAL", None, _det(total, F.when(low, F.lit(20)).otherwise(F.lit(40) + (k * 3) % 60))),
        F.lit(","),
        fld("INVOICE_RECEIPT_DATE", _det(F.lit("  Invoice\\n Date: "), F.lit(90)),
            _det(F.date_format("o_orderdate", "dd-MM-yyyy"), F.when(low, F.lit(30)).otherwise(F.lit(99)))),
        F.lit('],"LineItemGroups":[{"LineItemGroupIndex":0,"LineItems":['),
        F.coalesce(F.array_join(F.transform("ls", line), ","), F.lit("")),
        F.lit("]}]}]}"),
    )
    return j.select(_file_name(k).alias("source_file"), k.alias("load_order"), body.alias("body"))


def rendered_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_file, load_order, body) block envelopes, one per order (without lines: a table of its header only)."""

    def block(id_, typ, text=None, conf=None, ents=None, child=None, value=None, row=None, col=None):
        """``child`` and ``value``: the quoted ids, comma-joined."""
        rel = lambda kind, ids: F.concat(F.lit(f'{{"Type":"{kind}","Ids":['), ids, F.lit("]}"))
        rels = [rel(kind, ids) for kind, ids in (("CHILD", child), ("VALUE", value)) if ids is not None]
        members = [
            _string("Id", id_), F.lit(f'"BlockType":"{typ}"'), F.lit(f'"EntityTypes":["{ents}"]') if ents else None,
            _string("Text", text) if text is not None else None, _number("Confidence", (conf if conf is not None else F.lit(99.0)).cast("double")),
            F.lit('"Page":1'), _number("RowIndex", row) if row is not None else None, _number("ColumnIndex", F.lit(col)) if col is not None else None,
            F.concat(F.lit('"Relationships":['), F.concat_ws(",", *rels), F.lit("]")),
        ]
        return _object(*[m for m in members if m is not None])

    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    per = _lines(spark, sf_dir)

    def line_blocks(x, i):
        ix = i.cast("string")
        name = lambda kind, col: F.concat(F.lit(kind), ix, F.lit(f"_{col}"))
        quoted = lambda kind, col: F.concat(F.lit('"'), name(kind, col), F.lit('"'))
        row = (i + 2).cast("int")
        return F.concat_ws(
            ",",
            block(name("c", 1), "CELL", conf=F.lit(88), child=quoted("w", 1), row=row, col=1),
            block(name("w", 1), "WORD", text=x["item"]),
            block(name("c", 2), "CELL", conf=_qty_conf(F.col("l_orderkey"), x), child=quoted("w", 2), row=row, col=2),
            block(name("w", 2), "WORD", text=_qty(x)),
        )

    j = o.join(per, o.o_orderkey == per.l_orderkey, "left")
    k = F.col("o_orderkey")
    total = _cents_text(F.round(F.col("o_totalprice") * 100).cast("long"))
    ids = lambda *names: F.lit(",".join(f'"{n}"' for n in names))
    cell_ids = F.array_join(F.transform("ls", lambda x, i: F.concat(
        F.lit(',"c'), i.cast("string"), F.lit('_1","c'), i.cast("string"), F.lit('_2"'))), "")
    head = (
        block(F.lit("k1"), "KEY_VALUE_SET", ents="KEY", conf=F.lit(70), child=ids("w_a", "w_b"), value=ids("v1")),
        block(F.lit("w_a"), "WORD", text=F.lit("Order")),
        block(F.lit("w_b"), "WORD", text=F.lit("ID")),
        block(F.lit("v1"), "KEY_VALUE_SET", ents="VALUE", conf=F.lit(40) + k % 60, child=ids("w_c")),
        block(F.lit("w_c"), "WORD", text=k.cast("string")),
        block(F.lit("k2"), "KEY_VALUE_SET", ents="KEY", conf=F.lit(70), child=ids("w_d", "w_e"), value=ids("v2")),
        block(F.lit("w_d"), "WORD", text=F.lit("Grand")),
        block(F.lit("w_e"), "WORD", text=F.lit("Total")),
        block(F.lit("v2"), "KEY_VALUE_SET", ents="VALUE", conf=F.lit(90), child=ids("w_f")),
        block(F.lit("w_f"), "WORD", text=total),
        block(F.lit("t1"), "TABLE", child=F.concat(ids("h1", "h2"), F.coalesce(cell_ids, F.lit("")))),
        block(F.lit("h1"), "CELL", child=ids("w_g"), row=F.lit(1), col=1),
        block(F.lit("w_g"), "WORD", text=F.lit("Description")),
        block(F.lit("h2"), "CELL", child=ids("w_h"), row=F.lit(1), col=2),
        block(F.lit("w_h"), "WORD", text=F.lit("Qty")),
    )
    body = F.concat(F.lit('{"JobStatus":"SUCCEEDED","Blocks":['),
                    F.concat_ws(",", *head, F.array_join(F.transform("ls", line_blocks), ",")), F.lit("]}"))
    return j.select(_file_name(k).alias("source_file"), k.alias("load_order"), body.alias("body"))
