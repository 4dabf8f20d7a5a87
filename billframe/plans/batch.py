"""The batch run over captured inputs, end to end (3.1 of the design notes).

    raw PDFs ──manifest + gates──┐
    captured OCR envelopes ──extract (+ fallback)──┤
    captured model output ──attempts / alias routing──┴─► payloads
    payloads ──records (coerce, FX, rules, flags)──► stage (written once)
    stage ──first write wins vs. gold──► gold (append, by month) | tombstones | sidecars | outcomes

Documents are named by their path below the batch's folder, in every stage and
every join. A failing document becomes a row with a ``hard_rule``, never an
exception. All sinks of a run are published by one commit (``commits``): a run
that dies leaves nothing that readers see, and is run again; a batch that was
committed is not run again, its results are returned as they are.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billframe.config import DEFAULT_SETTINGS, EXTRACTION_ERROR, MAPPING_ERROR, Settings
from billframe.operators import extract as X
from billframe.operators import load as L
from billframe.operators import merged_stats
from billframe.operators import mapping as M
from billframe.operators import paging as P
from billframe.operators.fx import fx_table
from billframe.operators.key_index import index_rows
from billframe.operators.query import scan_all
from billframe.operators.records import build_records
from billframe.plans.commits import Run, exists, live, read_sink
from billframe.plans.stages import materialize
from billframe.session import configure
from billframe.sources.envelopes import read_json_folder
from billframe.sources.manifest import (
    document_key,
    gate_rule,
    in_order,
    list_files,
    new_batch_id,
    partition_root,
    relative_path,
    resolve_batch_date,
    with_headers,
)


@dataclass
class BatchPaths:
    raw: str            # PDFs (read-only)
    ocr: str            # <path>[.page<any>].json expense envelopes, <path>.blocks[.page<any>].json block envelopes
    model: str          # <path>.mapped.json tool inputs or <path>.attempt<N>.json responses
    out: str            # gold/, gold_keys/, tombstones/, quarantine/, silver/, outcomes/, classified/, stats/, alias/, _commits/


def _of_day(spark: SparkSession, folder: str, batch_date: _dt.date | None) -> DataFrame:
    """Captured JSON files, of one date's folder only where there is a date."""
    part = folder if batch_date is None else partition_root(folder, batch_date)
    if not exists(spark, part):
        return spark.createDataFrame([], "path string, json_name string, body string, source_file string")
    return read_json_folder(spark, part).withColumn(
        "source_file", document_key(relative_path(spark, F.col("path"), folder, encoded=True)))


def run_batch(spark: SparkSession, paths: BatchPaths, batch_id: str | None = None, settings: Settings = DEFAULT_SETTINGS,
              rates: DataFrame | None = None, now: str | None = None, batch_date: str | _dt.date | None = None,
              limit: int | None = None, only: DataFrame | None = None,
              listing: DataFrame | None = None, opener=None) -> dict[str, DataFrame]:
    """Run one batch, or return what it wrote if it was committed before.

    ``batch_id``: a new one of the current time where None (A9). ``batch_date``:
    take the files and captured results of that date's folder (A4, A5);
    ``limit``: only the first so many files in path order (A16); ``only``: only
    files with these paths (column path); ``listing`` (path, length,
    modificationTime): the files there are, instead of a walk of the tree.
    Date, limit and ``only`` are decided on the listing, before files are opened.
    """
    configure(spark)
    run = uuid.uuid4().hex  # stages of this run alone
    now = now or _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="seconds")
    if batch_id is None:
        batch_id = spark.range(1).select(new_batch_id(F.lit(now).cast("timestamp"))).first()[0]
    done = live(spark, paths.out).get(batch_id)
    if done is not None:
        return committed_batch(spark, paths.out, batch_id)
    date = resolve_batch_date(batch_date) if batch_date is not None else None
    sinks = Run(spark, paths.out, batch_id, date.isoformat() if date else None)
    raw = partition_root(paths.raw, date) if date else paths.raw
    chosen = materialize(list_files(spark, raw, listing, only, limit), "batch_listing", (run,), spark=spark)
    opened = materialize(with_headers(spark, chosen, raw, opener=opener), "batch_headers", (run,), spark=spark)
    manifest = gate_rule(in_order(opened)).withColumn(
        "source_file", document_key(relative_path(spark, F.col("path"), paths.raw)))
    manifest = materialize(manifest, "batch_manifest", (run,), spark=spark)
    wanted = manifest.where(F.col("hard_rule").isNull()).select("source_file")

    # Extraction (B2-B12): expense envelopes, block fallback for unusable ones. Its results are
    # written once: silver (A10) is what every later step reads.
    ocr = _of_day(spark, paths.ocr, date).join(wanted, "source_file", "left_semi")
    pages = materialize(P.captured_pages(ocr), "batch_pages", (run,), spark=spark)
    is_block = F.col("json_name").rlike(r"(?i)\.blocks(\.page[a-z0-9_-]*)?\.json$")
    columns = ["source_file", "body", "token", "next_token", "status"]
    whole = P.joined_bodies(pages.where(~is_block).select(*columns), "ExpenseDocuments")
    expense = materialize(X.parse_envelopes(whole).drop("body"), "batch_expense", (run,), spark=spark)
    blocks = P.joined_bodies(pages.where(is_block).select(*columns), "Blocks").select("source_file", "body")
    summary, items, headers = X.fallback_merge(
        X.expense_summary_fields(expense), X.expense_line_items(expense), blocks, expense.select("source_file"), settings)
    headers = headers.join(expense.select("source_file", X.job_succeeded(F.col("env")).alias("job_ok")), "source_file", "left")
    summary = sinks.write(summary, "silver/summary_fields")
    items = sinks.write(items, "silver/line_items")
    headers = sinks.write(headers, "silver/documents")

    # Mapping (C1-C4, C8-C9): captured attempts, alias hits from earlier batches.
    model_files = _of_day(spark, paths.model, date).join(wanted, "source_file", "left_semi")
    attempts = model_files.select(
        "source_file",
        F.coalesce(F.regexp_extract("json_name", r"\.attempt(\d+)\.json$", 1).try_cast("int"), F.lit(1)).alias("attempt"),
        F.col("json_name").endswith(".mapped.json").alias("is_tool_input"),
        F.col("body"),
    )
    shaped = attempts.select(
        "source_file", "attempt",
        F.when(F.col("is_tool_input"), F.concat(
            F.regexp_replace(F.get_json_object("body", "$.fields"), r"\}\s*$", ""),
            F.lit(',"source_labels":'), F.coalesce(F.get_json_object("body", "$.source_labels"), F.lit("{}")),
            F.lit(',"unmapped_metadata":'), F.coalesce(F.get_json_object("body", "$.unmapped_metadata"), F.lit("{}")),
            F.lit(',"multiple_total_candidates":'), F.coalesce(F.get_json_object("body", "$.multiple_total_candidates"), F.lit("false")),
            F.lit("}"))).otherwise(M.tool_input(F.col("body"))).alias("response"),
        F.coalesce(F.get_json_object("body", "$.model_id"), F.lit("")).alias("model_id"),
    )
    model_payloads = M.select_attempt(shaped, settings, is_tool_input=True)
    model_payloads = materialize(model_payloads, "batch_model", (run,), spark=spark)
    orders = manifest.where(F.col("hard_rule").isNull()).select("source_file", F.col("discovery_order").alias("load_order"))
    payloads = M.map_in_order(summary, model_payloads, orders, known_aliases(spark, paths.out, but=batch_id), settings)
    payloads = M.finalize_metadata(payloads, headers, items)
    payloads = M.resolve_confidences(payloads, summary, X.line_cells(items))
    payloads = sinks.write(payloads, "silver/mapped")

    # Failure precedence before validation: gates > extraction > mapping.
    docs = manifest.join(headers.select("source_file", "extraction_ok", "job_ok"), "source_file", "left") \
        .join(payloads, "source_file", "left")
    extraction_bad = ~F.coalesce(F.col("job_ok"), F.lit(False)) | ~F.coalesce(F.col("extraction_ok"), F.lit(False))
    mapping_bad = ~F.coalesce(F.col("mapping_ok"), F.lit(False))
    rule = F.coalesce(F.col("hard_rule"), F.when(extraction_bad | mapping_bad, F.lit("EXTRACTION_FAILED")))
    etype = F.coalesce(F.col("error_type"), F.when(extraction_bad, F.lit(EXTRACTION_ERROR))
                       .when(mapping_bad, F.lit(MAPPING_ERROR)))
    stage = F.coalesce(F.col("failed_at_stage"), F.when(extraction_bad, F.lit("extraction")).when(mapping_bad, F.lit("mapping")))
    empty_fields = F.struct(*[F.lit(None).cast("string").alias(n) for n in M.FIELDS_TYPE.names])
    docs = docs.select(
        F.lit(batch_id).alias("batch_id"), "path", "source_file", F.col("discovery_order").alias("load_order"),
        F.coalesce(F.col("fields"), empty_fields).alias("fields"),
        F.coalesce(F.col("source_labels"), F.create_map().cast("map<string,string>")).alias("source_labels"),
        "extraction_confidence", "unmapped_metadata", "multiple_total_candidates",
        F.coalesce(F.col("source"), F.lit("bedrock")).alias("mapping_source"), "model_id", "attempts",
        rule.alias("hard_rule"), etype.alias("error_type"), stage.alias("failed_at_stage"),
    )
    records = materialize(build_records(docs, rates if rates is not None else fx_table(spark, settings), settings),
                          "batch_records", (run,), spark=spark)

    # Load (K5-K7) against the published keys of gold. Nothing is seen of this run before its commit.
    index = read_sink(spark, paths.out, "gold_keys")
    classified = materialize(L.first_write_wins(records, index), "batch_classified", (run,), spark=spark)
    gold = L.gold_items(classified, batch_id, now)
    sinks.write(gold, "gold", partition_by=["month"])
    sinks.write(index_rows(gold), "gold_keys", partition_by=["bucket"])
    stones = sinks.write(L.tombstones(classified, batch_id, now), "tombstones")
    sidecars = L.quarantine_sidecars(classified, payloads.select(
        "source_file", F.to_json(F.struct("fields", "source_labels", "unmapped_metadata")).alias("raw_mapped_payload")),
        batch_id, now)
    sinks.write(sidecars, "quarantine", "json")
    outcomes = sinks.write(L.outcomes(classified), "outcomes")
    # Counters of this batch alone; reports add them up and never read the store.
    sinks.write(merged_stats.partial(scan_all(gold, stones), outcomes), "stats")
    # Learn aliases from this batch's model payloads for later batches.
    learn_src = classified.select("source_file", "load_order").join(payloads.where(F.col("source") == "bedrock"), "source_file")
    sinks.write(M.learn_entries(learn_src).withColumn("learned_at", F.lit(now)), "alias")
    sinks.write(classified.drop("batch_id"), "classified")
    sinks.commit(now)
    return committed_batch(spark, paths.out, batch_id)


def committed_batch(spark: SparkSession, out: str, batch_id: str) -> dict[str, DataFrame]:
    """What a committed batch decided: ``records`` and ``classified`` (one table), and its ``outcomes``."""
    classified = read_sink(spark, out, "classified", batch_id=batch_id)
    outcomes = read_sink(spark, out, "outcomes", batch_id=batch_id).drop("batch_id", "batch_date")
    return {"records": classified, "classified": classified, "outcomes": outcomes}


def known_aliases(spark: SparkSession, out: str, but: str | None = None) -> DataFrame | None:
    """The best alias entry of every vendor over all batches but one (ties: the latest)."""
    entries = read_sink(spark, out, "alias", but=but)
    if entries is None:
        return None
    return entries.groupBy("vendor_key").agg(
        F.max_by(F.struct(*[c for c in entries.columns if c != "vendor_key"]), F.struct("coverage", "learned_at", "learned_order")).alias("e")
    ).select("vendor_key", "e.*")


def latest_sidecars(spark: SparkSession, out: str) -> DataFrame:
    """The last sidecar of every quarantined file."""
    rows = read_sink(spark, out, "quarantine")
    return rows.groupBy("source_file").agg(
        F.max_by(F.struct(*[c for c in rows.columns if c != "source_file"]), "failed_at_utc").alias("s")
    ).select("source_file", "s.*")


SILVER = ("summary_fields", "line_items", "documents", "mapped")


def read_silver(spark: SparkSession, out: str, batch_id: str | None = None, batch_date: str | None = None) -> dict[str, DataFrame]:
    """The extraction and mapping results of a batch or of a date, as they were written."""
    return {name: read_sink(spark, out, f"silver/{name}", batch_id, batch_date) for name in SILVER}


def read_stats(spark: SparkSession, out: str, year_month: str | None = None) -> DataFrame | None:
    """The counters of all committed batches (metric, key, n, amount), or of one month's records."""
    partials = read_sink(spark, out, "stats")
    return None if partials is None else merged_stats.merged(partials, year_month)


def read_items(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame | None]:
    """Gold items and tombstones of committed batches (Q1 inputs)."""
    stones = read_sink(spark, out, "tombstones")
    if stones is not None:
        stones = L.latest_tombstones(stones.drop("batch_date"))
    return read_sink(spark, out, "gold"), stones
