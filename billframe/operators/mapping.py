"""Captured model output -> mapped payloads; vendor alias learn/apply.

Tables (long form, one row per item):
  attempts        (source_file, attempt, response)  captured model responses
  summary_fields  (source_file, pos, type, label, value, confidence, ...)
  line_cells      (source_file, row_index, col, value, confidence)
  alias           (vendor_key, label, canonical) + alias_head (vendor_key, coverage, ...)
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, MapType, StringType, StructField, StructType

from billframe.config import (
    ALIAS_CONSTANT_FIELDS,
    DEFAULT_SETTINGS,
    VENDOR_LABEL_HINTS,
    VENDOR_TYPES,
    Settings,
    canonical_names,
    defaults,
    required_names,
)
from billframe.functions import fold_key, normalize_label, strip_ws
from billframe.operators.extract import confidence_by_label, line_item_confidence_by_label
from billframe.operators.skew import join_unique, met
from billframe.plans.stages import materialize

TOOL_NAME = "map_invoice_fields"
FIELDS_TYPE = StructType([StructField(n, StringType()) for n in canonical_names()])

# Tool input as the model returns it: every canonical value a string (a JSON
# number is kept as its text), plus the two maps and the flag.
TOOL_INPUT_SCHEMA = StructType(
    [StructField(n, StringType()) for n in canonical_names()]
    + [
        StructField("source_labels", MapType(StringType(), StringType())),
        StructField("unmapped_metadata", MapType(StringType(), StringType())),
        StructField("multiple_total_candidates", BooleanType()),
        StructField("notes", StringType()),
    ]
)
RESPONSE_SCHEMA = (
    "struct<output:struct<message:struct<content:array<struct<text:string,"
    "toolUse:struct<name:string,input:string>>>>>,stopReason:string,"
    "usage:struct<inputTokens:bigint,outputTokens:bigint>>"
)


def required_blank(fields: Column) -> Column:
    """Any required canonical field missing or blank."""
    out = F.lit(False)
    for n in required_names():
        out = out | F.coalesce(strip_ws(fields.getField(n)) == "", F.lit(True))
    return out


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (bound to a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def _tool_call(parsed: Column) -> Column:
    calls = F.filter(parsed["output"]["message"]["content"], lambda b: b["toolUse"]["name"] == F.lit(TOOL_NAME))
    return F.get(calls, 0)["toolUse"]["input"]


def tool_input(response: Column) -> Column:
    """The first tool call with the mapping tool's name, as JSON text (NULL if none)."""
    return _let(F.from_json(response, RESPONSE_SCHEMA), _tool_call)


def shape_payload(rows: DataFrame, tool: str) -> DataFrame:
    """``rows`` with valid, fields, source_labels, unmapped_metadata, multiple_total_candidates and notes of a tool's JSON.

    The JSON is parsed and every text stripped once, however often they are read:
    in projections of their own, which Spark does not merge with what reads them.
    """
    dflt, kept = defaults(), list(rows.columns)
    names, required = list(canonical_names()), required_names()
    empty = F.create_map().cast("map<string,string>")
    rows = rows.withColumn("ti", F.from_json(tool, TOOL_INPUT_SCHEMA))
    rows = rows.select(*kept, "ti", *[strip_ws(F.col(f"ti.{n}")).alias(f"_{n}") for n in names])
    blank = F.lit(False)
    for n in required:
        blank = blank | F.coalesce(F.col(f"_{n}") == "", F.lit(True))
    return rows.select(
        *kept,
        (F.col("ti").isNotNull() & ~blank).alias("valid"),
        F.struct(*[F.coalesce(F.nullif(F.col(f"_{n}"), F.lit("")), F.lit(dflt.get(n, ""))).alias(n) for n in names]).alias("fields"),
        F.map_filter(F.coalesce("ti.source_labels", empty), lambda k, v: k.isin(*names)).alias("source_labels"),
        F.coalesce("ti.unmapped_metadata", empty).alias("unmapped_metadata"),
        F.coalesce("ti.multiple_total_candidates", F.lit(False)).alias("multiple_total_candidates"),
        F.coalesce("ti.notes", F.lit("")).alias("notes"),
    )


def select_attempt(attempts: DataFrame, settings: Settings = DEFAULT_SETTINGS, response_col: str = "response",
                   is_tool_input: bool = False) -> DataFrame:
    """The first valid attempt per document (at most ``max_mapping_attempts``).

    Output per source_file: mapping_ok, attempts (ordinal of the winner),
    fields, source_labels, unmapped_metadata, multiple_total_candidates,
    notes, model_id, input_tokens, output_tokens, source='bedrock'. The
    response and the tool's JSON are each parsed once.
    """
    model = F.col("model_id") if "model_id" in attempts.columns else F.lit("")
    rows = attempts.where(F.col("attempt") <= settings.max_mapping_attempts).select(
        "source_file", "attempt", model.alias("model_id"), F.col(response_col).alias("response"))
    if is_tool_input:
        rows = rows.withColumn("tool", F.col("response")).withColumn("usage", F.lit(None).cast("struct<inputTokens:bigint,outputTokens:bigint>"))
    else:
        rows = rows.withColumn("r", F.from_json("response", RESPONSE_SCHEMA)).withColumn("tool", _tool_call(F.col("r"))).withColumn("usage", F.col("r.usage"))
    payload = shape_payload(rows.select("source_file", "attempt", "model_id", "usage", "tool"), "tool")
    # attempts are sorted by document: those that can not win travel without their payload
    a = F.struct(
        F.struct("fields", "source_labels", "unmapped_metadata", "multiple_total_candidates", "notes").alias("p"),
        F.col("model_id"),
        F.coalesce("usage.inputTokens", F.lit(0)).alias("input_tokens"),
        F.coalesce("usage.outputTokens", F.lit(0)).alias("output_tokens"),
        F.col("attempt").alias("attempts"),
    )
    shaped = payload.select("source_file", "attempt", F.when(F.col("valid"), a).alias("a"))
    best = shaped.groupBy("source_file").agg(
        F.expr("min_by(a, attempt) FILTER (WHERE a IS NOT NULL)").alias("w"),
    )
    return best.select(
        "source_file",
        F.col("w").isNotNull().alias("mapping_ok"),
        F.col("w.attempts").alias("attempts"),
        F.col("w.p.fields").alias("fields"),
        F.col("w.p.source_labels").alias("source_labels"),
        F.col("w.p.unmapped_metadata").alias("unmapped_metadata"),
        F.col("w.p.multiple_total_candidates").alias("multiple_total_candidates"),
        F.col("w.p.notes").alias("notes"),
        F.col("w.model_id").alias("model_id"),
        F.col("w.input_tokens").alias("input_tokens"),
        F.col("w.output_tokens").alias("output_tokens"),
        F.lit("bedrock").alias("source"),
    )


def _vendor_rank() -> Column:
    """How far a summary field names the seller: by its enum (0 first), else by a label hint; NULL if not at all."""
    t = F.upper(F.col("type"))
    rank = F.lit(None).cast("int")
    for i, wanted in reversed(list(enumerate(VENDOR_TYPES))):
        rank = F.when(t == wanted, F.lit(i)).otherwise(rank)
    label_hint = F.lit(False)
    for h in VENDOR_LABEL_HINTS:
        label_hint = label_hint | F.lower(F.col("label")).contains(h)
    return F.coalesce(rank, F.when(label_hint, F.lit(len(VENDOR_TYPES))))


def _vendor_key(value: Column) -> Column:
    return F.nullif(fold_key(value), F.lit("")).alias("vendor_key")


def vendor_keys(summary_fields: DataFrame) -> DataFrame:
    """(source_file, vendor_key) from the seller enums, else a label hint; NULL if none."""
    rank = _vendor_rank()
    cand = summary_fields.where(rank.isNotNull() & (strip_ws(F.col("value")) != "")).select(
        "source_file", F.struct(rank.alias("r"), F.col("pos").alias("pos")).alias("o"), "value"
    )
    return cand.groupBy("source_file").agg(F.min_by("value", "o").alias("vendor_value")).select(
        "source_file", _vendor_key(F.col("vendor_value")))


def _documents(summary_fields: DataFrame) -> DataFrame:
    """(source_file, vendor_key, own): C6 and a document's printed labels with their values, the last first."""
    label, value = strip_ws(F.col("label")), strip_ws(F.col("value"))
    rank = F.when(value != "", _vendor_rank())
    fields = met(summary_fields.select("source_file", "pos", label.alias("label"), value.alias("value"), rank.alias("r")), "source_file")
    own = F.when(F.col("label").isNotNull() & F.col("pos").isNotNull(), F.struct("pos", "label", "value"))
    docs = fields.groupBy("source_file").agg(
        F.min_by("value", F.when(F.col("r").isNotNull(), F.struct("r", "pos"))).alias("vendor_value"),
        F.sort_array(F.collect_list(own), asc=False).alias("own"))
    own = F.struct(F.transform("own", lambda x: x["label"]).alias("labels"), F.transform("own", lambda x: x["value"]).alias("vals"))
    return docs.select("source_file", _vendor_key(F.col("vendor_value")), own.alias("own"))


ENTRY_FIELDS = ("company_name", "labels", "constants", "coverage", "model_id", "multiple_total_candidates", "learned_order")


def entries_of(payloads: DataFrame, order_col: str = "load_order") -> DataFrame:
    """The alias entry that each model-sourced payload teaches.

    vendor_key, company_name, labels (canonical -> printed), constants,
    coverage, model_id, multiple_total_candidates, learned_order.
    """
    names = list(canonical_names())
    n = float(len(names))
    company = strip_ws(F.col("fields.company_name"))
    labels = F.map_filter(F.col("source_labels"), lambda k, v: k.isin(*names))
    constants = F.map_from_entries(F.filter(
        F.array(*[F.struct(F.lit(c).alias("key"), strip_ws(F.col("fields").getField(c)).alias("value"))
                  for c in ALIAS_CONSTANT_FIELDS]),
        lambda e: (e["value"] != "") & ~F.map_contains_key(labels, e["key"]),
    ))
    covered = F.array_union(F.map_keys(labels), F.map_keys(constants))
    return payloads.where((company != "") & (F.size(labels) > 0)).select(
        fold_key(company).alias("vendor_key"),
        company.alias("company_name"),
        labels.alias("labels"),
        constants.alias("constants"),
        (F.size(covered) / F.lit(n)).alias("coverage"),
        F.coalesce(F.col("model_id"), F.lit("")).alias("model_id"),
        F.coalesce(F.col("multiple_total_candidates"), F.lit(False)).alias("multiple_total_candidates"),
        F.col(order_col).cast("long").alias("learned_order"),
    )


def learn_entries(payloads: DataFrame, order_col: str = "load_order") -> DataFrame:
    """The best alias entry of every vendor: the highest coverage, ties -> the later payload."""
    src = entries_of(payloads, order_col)
    return src.groupBy("vendor_key").agg(
        F.max_by(F.struct(*src.columns), F.struct("coverage", "learned_order")).alias("e")
    ).select("e.*")


def alias_tables(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(head without labels, vendor_key / label / canonical) of alias entries."""
    alias = entries.select("vendor_key", F.explode("labels").alias("canonical", "label")).select(
        "vendor_key", strip_ws(F.col("label")).alias("label"), "canonical"
    ).where(F.col("label") != "")
    return entries.drop("labels"), alias


def learn_aliases(payloads: DataFrame, order_col: str = "load_order") -> tuple[DataFrame, DataFrame]:
    """Head and alias tables of the best entries."""
    return alias_tables(learn_entries(payloads, order_col))


def _with_entry(docs: DataFrame, *more: str) -> DataFrame:
    """C8 for documents (source_file, vendor_key, own, entry, more): every payload that its entry gives, with ``hit``:
    all required fields filled. An entry's labels are looked up among the document's own within the row."""
    names = list(canonical_names())
    dflt = defaults()
    empty = F.create_map().cast("map<string,string>")

    def named(e):
        def found(label):
            at = F.array_position("own.labels", label).cast("int")
            return F.struct(e["key"].alias("canonical"), label.alias("label"), F.get("own.vals", at - 1).alias("value"))

        return _let(strip_ws(e["value"]), found)

    found = F.filter(F.transform(F.map_entries("entry.labels"), named), lambda x: x["value"] != "")
    j = docs.withColumn("found", F.coalesce(found, F.array()))
    # in projections of their own: made once, though each is read for every field
    j = j.withColumn("vals", F.map_from_entries(F.transform("found", lambda x: F.struct(x["canonical"], x["value"])))).withColumn(
        "consts", F.coalesce("entry.constants", empty))
    fields = F.struct(*[F.coalesce(F.col("vals")[n], F.col("consts")[n], F.lit(dflt.get(n, ""))).alias(n) for n in names])
    return j.select(
        "source_file",
        fields.alias("fields"),
        F.map_from_entries(F.transform("found", lambda x: F.struct(x["canonical"], x["label"]))).alias("source_labels"),
        empty.alias("unmapped_metadata"),
        F.col("entry.multiple_total_candidates").alias("multiple_total_candidates"),
        F.concat(F.lit("labels known from earlier invoices of vendor "), F.col("vendor_key")).alias("notes"),
        F.col("entry.model_id").alias("model_id"),
        F.lit("vendor_alias_cache").alias("source"),
        F.lit(0).alias("attempts"),
        *more,
    ).withColumn("hit", ~required_blank(F.col("fields")))


def apply_entries(summary_fields: DataFrame, entries: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """Rebuild payloads from alias entries (one row a vendor, as ``learn_entries`` gives them); only
    complete hits are returned. A vendor's entry is attached to its documents once, as one value."""
    spark = summary_fields.sparkSession
    vendors = materialize(_documents(summary_fields), "alias_vendors", (uuid.uuid4().hex,), spark=spark)
    known = entries.where(F.col("coverage") >= settings.alias_min_coverage).select(
        "vendor_key", F.struct(*[c for c in entries.columns if c != "vendor_key"]).alias("entry"))
    docs = join_unique(vendors, known, "vendor_key")
    return _with_entry(docs).where("hit").drop("hit")


def apply_aliases(summary_fields: DataFrame, head: DataFrame, alias: DataFrame,
                  settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """C8 with the entries given as head and alias tables."""
    labels = alias.groupBy("vendor_key").agg(F.map_from_entries(F.collect_list(F.struct("canonical", "label"))).alias("labels"))
    entries = head.join(labels, "vendor_key", "left").withColumn(
        "labels", F.coalesce("labels", F.create_map().cast("map<string,string>")))
    return apply_entries(summary_fields, entries, settings)


#: Load orders that one block of the running best covers.
ORDER_BLOCK_BITS = 12


def _best_before(readers: DataFrame, writers: DataFrame) -> DataFrame:
    """For each reader (key, at, ...) the place of the best entry that a writer (key, at, coverage) before it left.

    Best: highest coverage, then latest. A running maximum in two levels: over
    the blocks of a key (one value each), then inside a block of 2^12 orders, so
    a vendor with very many documents is no single task. Entries themselves take
    no part: ``entry_at`` tells them apart within a key.
    """
    block = F.shiftright("at", ORDER_BLOCK_BITS)
    writers = writers.select("key", "at", block.alias("block"), F.struct("coverage", "at").alias("best"))
    none = F.lit(None).cast(writers.schema["best"].dataType)
    readers = readers.withColumn("block", block)
    # Blocks that readers are in take part without a value.
    steps = writers.select("key", "block", "best").unionByName(readers.select("key", "block").distinct().withColumn("best", none))
    steps = steps.groupBy("key", "block").agg(F.max("best").alias("best"))
    up_to = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = steps.select("key", "block", F.max("best").over(up_to).alias("before"))
    inside = Window.partitionBy("key", "block").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    both = readers.withColumn("best", none).unionByName(writers, allowMissingColumns=True)
    seen = both.withColumn("here", F.max("best").over(inside))
    out = seen.where(F.col("source_file").isNotNull()).join(earlier, ["key", "block"], "left")
    best = F.greatest("here", "before")
    return out.where(best.isNotNull()).select(*[c for c in readers.columns if c != "block"], best["at"].alias("entry_at"))


def _same_orders(a: DataFrame, b: DataFrame) -> bool:
    sides = a.select("load_order", F.lit(1).alias("side")).unionByName(b.select("load_order", F.lit(2).alias("side")))
    return sides.groupBy("load_order").agg(F.bit_or("side").alias("sides")).where("sides <> 3").isEmpty()


def map_in_order(summary_fields: DataFrame, model_payloads: DataFrame, orders: DataFrame, known: DataFrame | None = None,
                 settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """C7-C9 within a batch: every document sees what the documents before it taught.

    ``orders`` (source_file, load_order >= 0) names the documents. A document
    takes the best entry of its vendor among ``known`` and the model payloads of
    earlier documents that found no hit; without a hit it goes to the model and
    teaches in its turn. Who goes to the model is found by iteration: from the
    assumption that all do, each round looks up the best entries before every
    document and decides anew. What a document does depends on earlier documents
    only, so a round that leaves the hits as they were is the sequential result,
    and after n rounds the first n documents of each vendor are right: as many
    rounds as the longest chain of decisions that overturn each other, two where
    a vendor's invoices are alike. Every round is written.

    A round looks for places of entries; an entry meets the documents that take
    it once they are known, and their labels lie in the row. Entries of too low
    a coverage are never taken nor better than others, so they are left out.
    """
    spark, run = summary_fields.sparkSession, uuid.uuid4().hex
    readers = orders.join(_documents(summary_fields), "source_file").where(F.col("vendor_key").isNotNull()).select(
        F.col("vendor_key").alias("key"), F.col("load_order").cast("long").alias("at"), "source_file", "own")
    readers = materialize(readers, "alias_readers", (run,), spark=spark)
    at, entry = F.col("learned_order").alias("at"), F.struct(*ENTRY_FIELDS).alias("entry")
    taught = entries_of(model_payloads.where("mapping_ok").join(orders, "source_file")).select(F.col("vendor_key").alias("key"), at, entry)
    if known is not None:
        before = known.withColumn("learned_order", F.lit(-1).cast("long"))
        taught = taught.unionByName(before.select(F.col("vendor_key").alias("key"), at, F.struct(*ENTRY_FIELDS).alias("entry")))
    taught = taught.where(F.col("entry.coverage") >= settings.alias_min_coverage).groupBy("key", "at").agg(
        F.max_by("entry", "entry.coverage").alias("entry")).withColumn("id", F.struct("key", "at"))
    taught = materialize(taught, "alias_taught", (run,), spark=spark)
    places = taught.select("key", "at", F.col("entry.coverage").alias("coverage"))
    hits = None
    for i in range(1 << 30):
        writers = places if hits is None else places.join(hits.select(F.col("load_order").alias("at")), "at", "left_anti")
        docs = _best_before(readers, writers).select("source_file", F.col("key").alias("vendor_key"), F.col("at").alias("load_order"), "own",
                                                     F.struct("key", F.col("entry_at").alias("at")).alias("id"))
        docs = materialize(docs, "alias_docs", (run, str(i)), spark=spark)
        now = _with_entry(join_unique(docs, taught.select("id", "entry"), "id"), "load_order").where("hit").drop("hit")
        now = materialize(now, "alias_hits", (run, str(i)), spark=spark)
        if now.isEmpty() if hits is None else _same_orders(now, hits):
            break
        hits = now
    return route(now, model_payloads.where(F.col("source_file").isNotNull()))


def route(alias_payloads: DataFrame, model_payloads: DataFrame) -> DataFrame:
    """An alias hit replaces the model payload for that document."""
    cols = ["source_file", "fields", "source_labels", "unmapped_metadata", "multiple_total_candidates",
            "notes", "model_id", "source", "attempts"]
    hits = alias_payloads.select(*cols).withColumn("mapping_ok", F.lit(True))
    rest = model_payloads.join(alias_payloads.select("source_file"), "source_file", "left_anti")
    return hits.unionByName(rest, allowMissingColumns=True)


def finalize_metadata(payloads: DataFrame, docs: DataFrame, line_items: DataFrame | None = None) -> DataFrame:
    """C4: add 'line_items' JSON (if the document has rows and the key is absent)
    and default 'extracted_by' to the extraction API."""
    j = payloads.join(docs.select("source_file", "api"), "source_file", "left")
    md = F.coalesce(F.col("unmapped_metadata"), F.create_map().cast("map<string,string>"))
    if line_items is not None:
        rows = met(line_items.select("source_file", "row_order", "fields"), "source_file").groupBy("source_file").agg(
            F.to_json(F.transform(F.array_sort(
                F.collect_list(F.struct("row_order", "fields")),
                lambda a, b: F.when(a["row_order"] < b["row_order"], -1).when(a["row_order"] > b["row_order"], 1).otherwise(0),
            ), lambda r: r["fields"])).alias("_li")
        )
        j = j.join(rows, "source_file", "left")
        md = F.when(F.col("_li").isNotNull() & ~F.map_contains_key(md, F.lit("line_items")),
                    F.map_concat(md, F.create_map(F.lit("line_items"), F.col("_li")))).otherwise(md)
    md2 = F.when(F.map_contains_key(md, F.lit("extracted_by")) | F.col("api").isNull(), md).otherwise(
        F.map_concat(md, F.create_map(F.lit("extracted_by"), F.col("api"))))
    out = j.withColumn("unmapped_metadata", md2).drop("api")
    return out.drop("_li") if "_li" in out.columns else out


def resolve_confidences(payloads: DataFrame, summary_fields: DataFrame, line_cells: DataFrame | None) -> DataFrame:
    """Canonical -> confidence of the cited label (summary first, then line items).

    One row for each cited label meets the confidences by label (B9, B10); only
    what a payload cites, thirteen labels at most, is put together again.
    """
    cited = payloads.select("source_file", F.explode("source_labels").alias("canonical", "cited")).select(
        "source_file", "canonical", normalize_label("cited").alias("label"))
    key = ["source_file", "label"]
    found = cited.join(confidence_by_label(summary_fields).withColumnRenamed("confidence", "_summary"), key, "left")
    best = F.col("_summary")
    if line_cells is not None:
        found = found.join(line_item_confidence_by_label(line_cells).withColumnRenamed("confidence", "_line"), key, "left")
        best = F.coalesce("_summary", "_line")
    resolved = found.where(best.isNotNull()).groupBy("source_file").agg(
        F.map_from_entries(F.collect_list(F.struct("canonical", best.cast("double")))).alias("_confidence"))
    j = payloads.join(resolved, "source_file", "left")
    empty = F.create_map().cast("map<string,double>")
    return j.withColumn("extraction_confidence", F.when(F.col("source_labels").isNotNull(), F.coalesce("_confidence", empty))).drop("_confidence")


def document_messages(headers: DataFrame, summary: DataFrame, items: DataFrame) -> DataFrame:
    """source_file and message, the compact JSON of a document that a mapping model is given.

    headers: source_file, api, page_count, warnings. Fields and rows are in document order.
    """
    fields = summary.select("source_file", "pos", "type", "label", "value", "confidence", "page")
    pairs = met(fields, "source_file").groupBy("source_file").agg(F.array_sort(F.collect_list(F.struct(
        "pos", F.struct("type", "label", "value", F.round("confidence", 2).alias("confidence"), "page").alias("v")))).alias("ps"))
    # maps have no order of their own: rows are sorted by their place alone
    rows = met(items.select("source_file", "row_order", "fields"), "source_file").groupBy("source_file").agg(F.array_sort(
        F.collect_list(F.struct("row_order", "fields")),
        lambda a, b: F.when(a["row_order"] < b["row_order"], -1).when(a["row_order"] > b["row_order"], 1).otherwise(0)).alias("rs"))
    joined = headers.join(pairs, "source_file", "left").join(rows, "source_file", "left")
    values = F.coalesce(F.transform("ps", lambda p: p["v"]), F.array())
    lines = F.coalesce(F.transform("rs", lambda r: r["fields"]), F.array())
    return joined.select("source_file", F.to_json(F.struct(
        "source_file", F.col("api").alias("extracted_by"), "page_count", "warnings",
        values.alias("label_value_pairs"), lines.alias("line_items"))).alias("message"))
