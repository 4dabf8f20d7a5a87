"""Results captured in pages, put in order by their chain of tokens.

A page knows the token it was asked for with (none for the first) and the token
of the page after it (none on the last). The order is found for all jobs at once
by list ranking: every page points to the page after it and, round by round, to
the page its target points to, adding up the steps to the end - log2 of the
longest job rounds, each a join on (job, token), so that the pages of one large
job spread over all tasks. Every round is written, so its plan stays small and
lost work is read again.

A job whose chain does not visit each of its pages once fails: a page is missing
(``gap``, the last one included), a token comes back (``loop``), there is no
first page (``no first page``), two different pages answer one token (``two
pages for a token``), or a page is asked for by no other (``stray page``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billframe.operators.skew import met
from billframe.plans.stages import materialize

#: Statuses of a finished job (fixed values).
FINISHED = ("SUCCEEDED", "PARTIAL_SUCCESS")
#: Pages up to which a document's chain is followed within its row; a longer one is ranked by joins.
ROW_CHAIN_PAGES = 256
#: Pages that one task puts together.
TASK_PAGES = 1 << 16


def _token(c: Column) -> Column:
    return F.when(c != "", c)


def chain_order(pages: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Pages (``keys``, ``token``, ``next_token``, ...) with ``page_no`` from 1 on and ``chain_error``.

    A page captured twice counts once. Pages of a job with an error keep it on
    every row and have no number. Write ``pages`` before: they are read twice.
    """
    keys = keys or ["source_file"]
    run = uuid.uuid4().hex
    spark = pages.sparkSession
    pages = pages.distinct().withColumns({"token": F.coalesce(_token(F.col("token")), F.lit("")), "next_token": _token(F.col("next_token"))})
    jobs = pages.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.max((F.col("token") == "").cast("int")).alias("first"),
        (F.count(F.lit(1)) > F.count_distinct("token")).alias("twice"))
    # State of a page: the token it points to, the steps there, and whether the chain broke there.
    known = pages.select(*keys, "token").distinct()
    state = pages.groupBy(*keys, "token").agg(F.max("next_token").alias("to")).withColumn("steps", F.when(F.col("to").isNull(), 0).otherwise(1).cast("long"))
    target = known.withColumnRenamed("token", "to").withColumn("there", F.lit(True))
    state = state.join(target, [*keys, "to"], "left")
    broken = F.col("to").isNotNull() & F.col("there").isNull()
    state = state.select(*keys, "token", F.when(~broken, F.col("to")).alias("to"), "steps", broken.alias("gap"))
    state = materialize(state, "page_chain", (run, "0"), spark=spark)
    longest = state.groupBy(*keys).count().agg(F.max("count")).first()[0] or 1
    for i in range((longest - 1).bit_length()):
        if state.where(F.col("to").isNotNull()).isEmpty():
            break
        ahead = state.select(*keys, F.col("token").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"), F.col("gap").alias("_gap"))
        moved = state.join(ahead, [*keys, "to"], "left").select(
            *keys, "token", F.col("_to").alias("to"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
            (F.col("gap") | F.coalesce("_gap", F.lit(False))).alias("gap"))
        state = materialize(moved, "page_chain", (run, str(i + 1)), spark=spark)
    heads = state.where(F.col("token") == "").select(*keys, F.col("steps").alias("length"), F.col("to").alias("still"), F.col("gap").alias("broken"))
    error = (
        F.when(F.col("first") == 0, "no first page")
        .when(F.col("twice"), "two pages for a token")
        .when(F.col("still").isNotNull(), "loop")
        .when(F.col("broken"), "gap")
        .when(F.col("length") + 1 != F.col("n"), "stray page")
    )
    verdict = jobs.join(heads, keys, "left").select(*keys, "length", error.alias("chain_error"))
    placed = pages.join(state.select(*keys, "token", "steps"), [*keys, "token"]).join(verdict, keys)
    return placed.withColumn("page_no", F.when(F.col("chain_error").isNull(), F.col("length") - F.col("steps") + 1)).drop("length", "steps")


def captured_pages(captured: DataFrame) -> DataFrame:
    """Tokens and status of captured bodies: members RequestToken, NextToken and JobStatus."""
    member = lambda name: F.when(F.col("body").contains(f'"{name}"'), F.get_json_object("body", f"$.{name}"))
    return captured.withColumns({"token": member("RequestToken"), "next_token": member("NextToken"), "status": member("JobStatus")})


def _inside(items: Column) -> Column:
    """A list's text between its brackets. It is cut by bytes; only text with white space beside a bracket
    needs the expression, which looks at every character."""
    text = items.cast("binary")
    blank = lambda at: F.substring(text, at, 1).cast("string").isin(*" \t\n\x0b\f\r")
    plain = items.startswith("[") & items.endswith("]") & ~blank(2) & ~blank(-2)
    return F.when(plain, F.substring(text, F.lit(2), F.octet_length(items) - 2).cast("string")).otherwise(
        F.regexp_replace(items, r"^\s*\[\s*|\s*\]\s*$", ""))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (bound to a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def _alone() -> Column:
    return (F.col("n") == 1) & (F.col("asked") == 0) & (F.col("more") == 0)


def _counted(pages: DataFrame, *aggs: Column) -> DataFrame:
    token, more = _token(F.col("token")), _token(F.col("next_token"))
    return pages.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.count(token).alias("asked"), F.count(more).alias("more"), *aggs)


def _whole(status: Column, items_field: str, listed: Column) -> Column:
    return F.concat(F.lit('{"JobStatus":"'), status, F.lit(f'","{items_field}":['), listed, F.lit("]}"))


def joined_bodies(pages: DataFrame, items_field: str) -> DataFrame:
    """One body for each document from its captured pages (source_file, body, token, next_token, status).

    A document with one page that names no token keeps its body as it is. Of
    several pages the last one's status counts; a broken chain or an unfinished
    job leaves no body, only ``chain_error``. Chains of up to
    ``ROW_CHAIN_PAGES`` pages are followed where the document's pages meet, so
    that each page crosses one shuffle and nothing is written; longer ones are
    ranked by joins, for which ``pages`` are read several times. Counting, which
    comes first, reads no bodies.
    """
    pages = pages.where(F.col("source_file").isNotNull())
    counted = _counted(pages)
    found = counted.agg(F.sum("n").alias("n"), F.max("n").alias("longest"), F.max((~_alone()).cast("int")).alias("chained")).first()
    if not found["chained"]:
        return pages.select("source_file", "body", F.lit(None).cast("string").alias("chain_error"))
    if found["longest"] <= ROW_CHAIN_PAGES:
        return _joined_in_row(pages, items_field, found["n"])
    long = materialize(counted.where(F.col("n") > ROW_CHAIN_PAGES).select("source_file"), "long_chains", (uuid.uuid4().hex,), spark=pages.sparkSession)
    short = _joined_in_row(pages.join(long, "source_file", "left_anti"), items_field, found["n"])
    return short.unionByName(_joined_by_ranks(pages.join(long, "source_file", "left_semi"), items_field))


def _joined_in_row(pages: DataFrame, items_field: str, n: int) -> DataFrame:
    """Documents of few pages, ``n`` pages in all: pages meet by document and the chain is followed there.

    The walk holds the places (from 1) of the pages from the first on, and ends in
    0 where a page is missing. In a whole chain it has as many places as there are pages.
    """
    docs = _counted(met(pages, "source_file", n=n, share=TASK_PAGES), F.collect_set(F.struct("token", "next_token", "status", "body")).alias("ps"))

    def place(tokens, token):
        return F.array_position(tokens, token).cast("int")

    def walked(tokens, following):
        def step(walk, _):
            more = F.get(following, F.element_at(walk, -1) - 1)
            return F.when(more.isNull(), walk).otherwise(F.concat(walk, F.array(place(tokens, more))))

        return F.aggregate(F.sequence(F.lit(1), F.size(tokens)), F.array(place(tokens, F.lit(""))), step)

    def broken(tokens, walk):
        last, moved = F.element_at(walk, -1), F.size(walk)
        return (
            F.when(walk[0] == 0, "no first page")
            .when(F.size(F.array_distinct(tokens)) < F.size(tokens), "two pages for a token")
            .when(last == 0, "gap")
            .when(moved > F.size(tokens), "loop")
            .when(moved < F.size(tokens), "stray page")
        )

    def joined(walk, error):
        page = lambda i: F.get("ps", i - 1)
        status = F.coalesce(page(F.element_at(walk, -1))["status"], F.lit("SUCCEEDED"))
        items = F.transform(walk, lambda i: _let(F.get_json_object(page(i)["body"], f"$.{items_field}"), _inside))
        listed = F.array_join(F.filter(items, lambda x: x != ""), ",")
        ok = error.isNull() & status.isin(*FINISHED)
        return F.struct(F.when(ok, _whole(status, items_field, listed)).alias("body"), F.coalesce(error, F.when(~ok, status)).alias("chain_error"))

    tokens = F.transform("ps", lambda p: F.coalesce(_token(p["token"]), F.lit("")))
    following = F.transform("ps", lambda p: _token(p["next_token"]))
    chained = _let(tokens, lambda ts: _let(following, lambda fs: _let(walked(ts, fs), lambda walk: _let(broken(ts, walk), lambda e: joined(walk, e)))))
    kept = F.struct(F.get("ps", F.lit(0))["body"].alias("body"), F.lit(None).cast("string").alias("chain_error"))
    docs = docs.select("source_file", F.when(_alone(), kept).otherwise(chained).alias("j"))
    return docs.select("source_file", "j.body", "j.chain_error")


def _joined_by_ranks(pages: DataFrame, items_field: str) -> DataFrame:
    """Documents of any number of pages: the chain is found without bodies, a digest tells pages apart."""
    token, more = _token(F.col("token")), _token(F.col("next_token"))
    narrow = pages.select("source_file", "token", "next_token", "status", F.sha2("body", 256).alias("digest"))
    many = narrow.join(_counted(pages).where(~_alone()).select("source_file"), "source_file", "left_semi")
    ordered = chain_order(many).groupBy("source_file").agg(
        F.sort_array(F.collect_list(F.struct("token", "page_no"))).alias("numbers"),
        F.max_by("status", "page_no").alias("status"), F.max("chain_error").alias("chain_error"))
    # Bodies cross one shuffle. In a whole chain no token comes twice, so both lists by token name the same pages.
    items = F.regexp_replace(F.get_json_object("body", f"$.{items_field}"), r"^\s*\[\s*|\s*\]\s*$", "")
    agg = pages.groupBy("source_file").agg(
        F.first(F.when(token.isNull() & more.isNull(), F.col("body")), ignorenulls=True).alias("only"),
        F.sort_array(F.collect_set(F.struct(F.coalesce(token, F.lit("")).alias("token"), items.alias("items")))).alias("ps"))
    agg = agg.join(ordered, "source_file", "left")
    placed = F.sort_array(F.zip_with("ps", "numbers", lambda p, n: F.struct(n["page_no"].alias("page_no"), p["items"].alias("items"))))
    listed = F.array_join(F.transform(F.filter(placed, lambda x: x["items"] != ""), lambda x: x["items"]), ",")
    status = F.coalesce("status", F.lit("SUCCEEDED"))
    chained, ok = F.col("numbers").isNotNull(), F.col("chain_error").isNull() & status.isin(*FINISHED)
    return agg.select(
        "source_file", F.when(~chained, F.col("only")).when(ok, _whole(status, items_field, listed)).alias("body"),
        F.when(chained, F.coalesce("chain_error", F.when(~ok, status))).alias("chain_error"))
