"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Every text gets a few metrics that are high for bad texts. A rule rejects a
text whose metric exceeds its cutoff. Cutoffs are not guessed: for each stratum
and metric a ladder of candidate cutoffs is tested on labelled holdouts. A
cutoff is certified if the exact binomial (Clopper-Pearson) upper bound of its
false rejection rate - good texts above the cutoff - is at most ``risk``. The
error probability ``delta`` is shared out over all ladders, that is strata
times metrics (Bonferroni). Within a ladder the candidates are tested from lax
to strict and the first failure ends it (fixed-sequence testing, which needs
no further share); since stricter cutoffs reject no fewer, this is the
strictest cutoff that passes. So with probability 1 - delta every certified
cutoff of every stratum keeps its promise. A stratum without enough good labels
certifies none and rejects nothing.

That promise is each cutoff's own: a text is rejected if any rule rejects it, so
the verdict's false rejection rate is bounded by the number of metrics times
``risk``. With ``joint`` the verdict itself is certified: the sets of cutoffs
form one fixed, nested sequence (``SEQUENCE``: no rule, then one rung of one
metric more at each step, in turn, from lax to strict), k is the number of good
texts that any rule of the set rejects, and delta is shared out over strata
only. So with probability 1 - delta the verdict of every stratum rejects at
most ``risk`` of its good texts.

The bound needs no inverse: the upper bound is at most ``risk`` exactly if the
binomial tail P(X <= k | n, risk) is at most the level; the tail is summed in
log space, so no count of labels is too large.

The labels are holdouts in that no metric and no candidate depends on them.

Edge cases: NULL and empty texts have no words and fail the base rules; a NULL
stratum is a stratum of its own; labels whose id or quality is NULL are left
out; a repeated label counts once, and an id labelled both ways counts as good
(the safe side); repeated rows are judged each; an empty labels table
certifies nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billframe.llm.common import SPACES, write_stage

#: metric -> candidate cutoffs, from strict to lax. Shares of the text's words or characters.
CANDIDATES: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2),
    "word_length": (5.5, 6.0, 6.5, 7.0, 8.0, 10.0, 15.0),
    "dup_line_share": (0.02, 0.05, 0.1, 0.2, 0.3, 0.5),
    "repeat_share": (0.05, 0.1, 0.15, 0.2, 0.3, 0.4),
    "capital_share": (0.05, 0.1, 0.2, 0.3, 0.5, 0.8),
    "mark_share": (0.02, 0.05, 0.1, 0.2, 0.3),
    "digit_share": (0.05, 0.1, 0.2, 0.3, 0.5),
}
RISK, DELTA = 0.02, 0.05
MIN_WORDS = 50
#: The (metric, cutoff) that each step of the joint test adds to the set, from lax to strict.
SEQUENCE: list[tuple[str, float]] = [
    (m, sorted(cuts, reverse=True)[i])
    for i in range(max(map(len, CANDIDATES.values())))
    for m, cuts in CANDIDATES.items()
    if i < len(cuts)
]


def counts(docs: DataFrame, stratum: str | None = None) -> DataFrame:
    """doc_id, stratum and the whole-text counts of every row, in one pass without a shuffle.

    Arrays are bound once to a lambda variable (``_let``), so that no step is
    evaluated twice.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    ws = F.filter(F.split(text, SPACES), lambda w: w != "")
    base = docs.select(
        "doc_id",
        (F.col(stratum).cast("string") if stratum else F.lit(None).cast("string")).alias("stratum"),
        F.length(text).cast("long").alias("chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[!?]", ""))).cast("long").alias("n_marks"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[A-Z]", ""))).cast("long").alias("n_capitals"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[0-9]", ""))).cast("long").alias("n_digits"),
        F.length(F.regexp_replace(text, SPACES, "")).cast("long").alias("word_chars"),
        _let(F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))), _line_counts).alias("lines"),
        _let(ws, _word_counts).alias("words"),
    )
    return base.select(
        "doc_id", "stratum", "chars", "word_chars", "n_symbols", "n_marks", "n_capitals", "n_digits",
        F.col("words.n_words").alias("n_words"), F.col("words.n_repeat_words").alias("n_repeat_words"),
        F.col("lines.n_lines").alias("n_lines"), F.col("lines.n_dup_lines").alias("n_dup_lines"),
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _line_counts(lines: Column) -> Column:
    return F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
    )


def _word_counts(ws: Column) -> Column:
    """Words, and words within three-word windows that occur twice or more."""
    hashed = F.transform(ws, lambda w: F.xxhash64(w))
    return _let(hashed, lambda h: F.struct(
        F.size(h).cast("long").alias("n_words"),
        F.when(F.size(h) < 4, F.lit(0).cast("long")).otherwise(_let(_windows(h), _covered)).alias("n_repeat_words"),
    ))


def _windows(h: Column) -> Column:
    """The hash of the window at every position."""
    return F.transform(
        F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2))
    )


def _covered(windows: Column) -> Column:
    """Positions under windows that occur twice or more: equal windows stand together once
    sorted, and between two such positions in text order lie at most three new words."""
    nothing_twice = F.size(F.array_distinct(windows)) == F.size(windows)
    placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    again = lambda s: F.filter(
        F.transform(
            s,
            lambda x, j: F.when(
                (F.get(s, j - 1)["w"] == x["w"]) | (F.get(s, j + 1)["w"] == x["w"]), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    spread = lambda at: F.aggregate(
        at,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(
            i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"]).cast("long")).alias("n")
        ),
        lambda acc: acc["n"],
    )
    return F.when(nothing_twice, F.lit(0).cast("long")).otherwise(
        _let(placed, lambda s: _let(F.sort_array(again(s)), spread))
    )


def metrics() -> dict[str, Column]:
    """The metrics over the columns of ``counts``; zero for texts without words."""
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "symbol_share": part("n_symbols", "word_chars"),
        "word_length": part("word_chars", "n_words"),
        "dup_line_share": part("n_dup_lines", "n_lines"),
        "repeat_share": part("n_repeat_words", "n_words"),
        "capital_share": part("n_capitals", "word_chars"),
        "mark_share": part("n_marks", "word_chars"),
        "digit_share": part("n_digits", "word_chars"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), summed in log space up to k; 1 if k is at or above the mean.

    Only small tails decide anything, and those have k below the mean, where
    the terms rise up to k; so the sum runs from k downwards and ends where
    terms no longer count.
    """
    ratio = (1 - p) / p
    step = lambda acc, j: F.struct(
        (acc["term"] * (j.cast("double") / (n - j + 1)) * ratio).alias("term"),
        (acc["total"] + acc["term"] * (j.cast("double") / (n - j + 1)) * ratio).alias("total"),
    )
    # log of the top term C(n, k) p^k (1-p)^(n-k), from log factorials
    log_term = (
        F.aggregate(
            F.sequence(F.lit(0).cast("long"), k),
            F.lit(0.0),
            lambda acc, j: acc + F.when(j > 0, F.log((n - j + 1).cast("double") / j)).otherwise(F.lit(0.0)),
        )
        + k * F.log(F.lit(p))
        + (n - k) * F.log(F.lit(1 - p))
    )
    scaled = F.aggregate(
        F.when(k > 0, F.reverse(F.sequence(F.lit(1).cast("long"), k))).otherwise(F.array().cast("array<bigint>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        step,
        lambda acc: acc["total"],
    )
    return F.when(k >= n * F.lit(p), F.lit(1.0)).otherwise(F.exp(log_term) * scaled)


def thresholds(labelled: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """stratum, metric, cutoff, n_good, n_rejected: the strictest certified cutoffs.

    ``labelled``: stratum, good (boolean) and the metric columns, one row for
    each label. One aggregation counts the good texts above every candidate.
    """
    names = list(CANDIDATES)
    sums = [
        F.sum((F.col(m) > c).cast("long")).alias(f"{m}:{i}") for m in names for i, c in enumerate(CANDIDATES[m])
    ]
    table = write_stage(
        labelled.where("good").groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), *sums), "rule-ladder"
    )
    rungs = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(m).alias("metric"), F.lit(float(c)).alias("cutoff"), F.col(f"`{m}:{i}`").alias("n_rejected")
                )
                for m in names
                for i, c in enumerate(CANDIDATES[m])
            )
        )
    )
    tests = max(1, table.count()) * len(CANDIDATES)  # ladders
    tested = (
        table.select("stratum", "n_good", rungs.alias("r"))
        .select("stratum", "n_good", "r.*")
        .where(tail(F.col("n_rejected"), F.col("n_good"), risk) <= F.lit(delta / tests))
    )
    return tested.groupBy("stratum", "metric").agg(F.min("cutoff").alias("cutoff"), F.max("n_good").alias("n_good"))


def joint_thresholds(labelled: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """stratum and a column of each metric: the cutoffs of the strictest set whose joint rejection is certified.

    Sets are nested, so a text is rejected from some step on: one aggregation
    counts the good texts by that step.
    """
    first = F.least(*(F.when(F.col(m) > c, F.lit(i)) for i, (m, c) in enumerate(SEQUENCE)))
    table = write_stage(
        labelled.where("good")
        .select("stratum", first.alias("first"))
        .groupBy("stratum")
        .agg(
            F.count(F.lit(1)).alias("n_good"),
            *(F.count(F.when(F.col("first") <= i, 1)).alias(f"k:{i}") for i in range(len(SEQUENCE))),
        ),
        "joint-ladder",
    )
    steps = F.explode(
        F.array(*(F.struct(F.lit(i).alias("step"), F.col(f"`k:{i}`").alias("k")) for i in range(len(SEQUENCE))))
    )
    last = (
        table.select("stratum", "n_good", steps.alias("s"))
        .where(tail(F.col("s.k"), F.col("n_good"), risk) <= F.lit(delta / max(1, table.count())))
        .groupBy("stratum")
        .agg(F.max("s.step").alias("last"))
    )
    return last.select(
        "stratum",
        *(
            F.least(*(F.when(F.col("last") >= i, F.lit(float(c))) for i, (of, c) in enumerate(SEQUENCE) if of == m)).alias(m)
            for m in CANDIDATES
        ),
    )


def judged(
    measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, joint: bool = False
) -> DataFrame:
    """The rows of ``counts`` with base_failed and kept. ``measured`` should be a written table."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    rated = measured.where(~base_failed()).withColumns(metrics())
    labelled = rated.join(known, "doc_id").select("stratum", (F.col("quality") > 0).alias("good"), *CANDIDATES)
    if joint:
        cutoffs = joint_thresholds(labelled, risk, delta)
    else:
        cutoffs = thresholds(labelled, risk, delta).groupBy("stratum").pivot("metric", list(CANDIDATES)).agg(F.first("cutoff"))
    cutoffs = cutoffs.select(F.col("stratum").alias("of"), *(F.col(m).alias(f"max_{m}") for m in CANDIDATES))
    rows = measured.withColumns(metrics())
    passed = reduce(
        lambda a, b: a & b, (F.coalesce(F.col(m) <= F.col(f"max_{m}"), F.lit(True)) for m in CANDIDATES)
    )
    return (
        rows.join(cutoffs, rows["stratum"].eqNullSafe(cutoffs["of"]), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & passed)
        .select(*measured.columns, "base_failed", "kept")
    )


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", joint: bool = False) -> DataFrame:
    """Counts and verdict of every row; ``joint``: the risk holds for the verdict, not for each cutoff."""
    return judged(write_stage(counts(docs, stratum), "rule-counts"), labels, joint=joint)


_LADDER = ", ".join(f"('{m}', {float(c)!r})" for m, cs in CANDIDATES.items() for c in cs)
_VALUES = ", ".join(f"('{m}', {m})" for m in CANDIDATES)

#: The same in DuckDB, by language; binomial tails by log gamma.
SQL = rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
),
grams AS (
  SELECT doc_id, i, concat_ws(' ', ws[i], ws[i + 1], ws[i + 2]) AS g FROM d, unnest(range(1, len(ws) - 1)) AS u(i)
),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT place) AS n FROM twice, unnest(range(i, i + 3)) AS u(place) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n, count(DISTINCT line) AS n_distinct
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
counted AS (
  SELECT d.doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS BIGINT) AS n_marks,
    CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS BIGINT) AS n_digits,
    coalesce(l.n, 0) AS n_lines, coalesce(l.n - l.n_distinct, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lines AS l ON d.doc_id = l.doc_id LEFT JOIN repeats AS r ON d.doc_id = r.doc_id
),
measured AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    coalesce(n_symbols / nullif(CAST(word_chars AS DOUBLE), 0), 0) AS symbol_share,
    coalesce(word_chars / nullif(CAST(n_words AS DOUBLE), 0), 0) AS word_length,
    coalesce(n_dup_lines / nullif(CAST(n_lines AS DOUBLE), 0), 0) AS dup_line_share,
    coalesce(n_repeat_words / nullif(CAST(n_words AS DOUBLE), 0), 0) AS repeat_share,
    coalesce(n_capitals / nullif(CAST(word_chars AS DOUBLE), 0), 0) AS capital_share,
    coalesce(n_marks / nullif(CAST(word_chars AS DOUBLE), 0), 0) AS mark_share,
    coalesce(n_digits / nullif(CAST(word_chars AS DOUBLE), 0), 0) AS digit_share
  FROM counted
),
long AS (SELECT m.doc_id, m.lang, m.base_failed, v.metric, v.x FROM measured AS m, LATERAL (VALUES {_VALUES}) AS v(metric, x)),
good AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING max(quality) > 0
),
ladder AS (
  SELECT lang, metric, cutoff, count(*) AS n, count(*) FILTER (x > cutoff) AS k
  FROM long JOIN (VALUES {_LADDER}) AS c(metric, cutoff) USING (metric)
  WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good) GROUP BY ALL
),
certified AS (
  SELECT lang, metric, min(cutoff) AS cutoff FROM ladder
  WHERE k < n * {RISK} AND
    (SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK}) + (n - j) * ln(1 - {RISK})))
     FROM unnest(range(0, k + 1)) AS u(j))
    <= {DELTA} / ((SELECT count(DISTINCT lang) FROM ladder) * {len(CANDIDATES)})
  GROUP BY lang, metric
),
rejected AS (
  SELECT DISTINCT doc_id FROM long JOIN certified AS c ON long.metric = c.metric AND long.lang IS NOT DISTINCT FROM c.lang WHERE x > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM measured
"""

_STEPS = ", ".join(f"({i}, '{m}', {float(c)!r})" for i, (m, c) in enumerate(SEQUENCE))

#: The joint verdict in DuckDB: the same counts, then the step of the nested sets from which a text is rejected.
SQL_JOINT = SQL[: SQL.index("ladder AS (")] + rf"""steps(i, metric, cutoff) AS (VALUES {_STEPS}),
firsts AS (SELECT doc_id, min(i) AS first FROM long JOIN steps USING (metric) WHERE x > cutoff GROUP BY doc_id),
goods AS (
  SELECT m.doc_id, lang, first FROM measured AS m LEFT JOIN firsts AS f ON m.doc_id = f.doc_id
  WHERE NOT base_failed AND m.doc_id IN (SELECT doc_id FROM good)
),
sets AS (SELECT lang, i, count(*) AS n, count(*) FILTER (first <= i) AS k FROM goods, (SELECT i FROM steps) AS s GROUP BY lang, i),
certified AS (
  SELECT lang, max(i) AS last FROM sets
  WHERE k < n * {RISK} AND
    (SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK}) + (n - j) * ln(1 - {RISK})))
     FROM unnest(range(0, k + 1)) AS u(j))
    <= {DELTA} / (SELECT count(*) FROM (SELECT DISTINCT lang FROM goods))
  GROUP BY lang
)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(first > last, TRUE) AS kept
FROM measured AS m LEFT JOIN firsts AS f ON m.doc_id = f.doc_id LEFT JOIN certified AS c ON m.lang IS NOT DISTINCT FROM c.lang
"""
