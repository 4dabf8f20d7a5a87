"""Mixing sources to target weights by temperature, in DataFrame operations only.

Shares: a source's part p of all tokens (white-space words). Weights are
proportional to p ** t. The exponent t in [0, 1] (1: natural shares, 0: equal
weights) is found by bisection: the largest t whose entropy reaches
``target_entropy`` (as part of the greatest possible), but no smaller than the
exponent at which some source would be repeated more than ``max_repeats``
times. The tree of the next four midpoints is evaluated in one aggregation
over the shares, so a search takes a few small jobs, whatever their number.

Realisation: with a budget of tokens a source gets floor(weight * budget)
tokens. It is passed over in blocks; each block is a permutation of the
source's documents by a hash of id, block and seed. Whole blocks are followed
by the documents of one more whose running sum stays within the rest of the
budget; with ``filled``, by documents until the rest is reached, those longer
than the rest standing last in that block. Then a source misses its budget by
no more than the longest document it gives: one giant text cannot use up or
bar the rest of a small source. ``progress`` is the place of a document in its source's budget;
ordering the mixture by it blends the sources at the target weights
throughout.

Running sums are two-level: token sums of hash buckets first, then the order
within a bucket, so no source, however large, is sorted in one task. The
weights reach the documents through a join salted by bucket.

Edge cases: a NULL source is a source of its own; sources without any token
have weight zero and give no rows; texts without words cost nothing and are
kept with their block; rows that repeat a doc_id stand at one place and are taken or left
together; a single source has entropy 0 = the greatest possible; an empty
table gives an empty mixture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billframe.llm.common import write_stage

TARGET_ENTROPY, MAX_REPEATS, BUDGET, SEED = 0.95, 4.0, 1.0, 7
STEPS, LEVELS, SALTS = 32, 4, 16


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens of every row."""
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_tokens"),
    )


def exponent(shares: DataFrame, target_entropy: float, max_repeats: float, budget: float) -> float:
    """The exponent by bisection; ``shares``: p of every source with tokens."""
    n = shares.count()
    if n < 2:
        return 1.0
    wanted = target_entropy * float(shares.agg(F.log(F.count("p"))).first()[0])

    def too_small(ts: list[float]) -> list[bool]:
        aggs = []
        for i, t in enumerate(ts):
            power = F.pow("p", F.lit(t))
            aggs += [
                F.sum(power).alias(f"z{i}"),
                F.sum(power * F.log("p")).alias(f"l{i}"),
                F.max(F.pow("p", F.lit(t - 1.0))).alias(f"m{i}"),
            ]
        r = shares.agg(*aggs).select(
            *(
                (
                    (F.log(f"z{i}") - F.lit(t) * F.col(f"l{i}") / F.col(f"z{i}") >= F.lit(wanted))
                    & (F.col(f"m{i}") * F.lit(budget) / F.col(f"z{i}") <= F.lit(max_repeats))
                ).alias(f"even{i}")
                for i, t in enumerate(ts)
            ),
            *((F.col(f"m{i}") * F.lit(budget) / F.col(f"z{i}") > F.lit(max_repeats)).alias(f"over{i}") for i in range(len(ts))),
        ).first()
        # move up if the entropy is still reached, or if a source is repeated too often
        return [r[f"even{i}"] or r[f"over{i}"] for i in range(len(ts))]

    low, high = 0.0, 1.0
    for _ in range(STEPS // LEVELS):
        cuts = 1 << LEVELS
        mids = [low + (high - low) * i / cuts for i in range(1, cuts)]
        up = too_small(mids)
        a, b = 0, cuts
        while b - a > 1:
            m = (a + b) // 2
            a, b = (m, b) if up[m - 1] else (a, m)
        low, high = low + (high - low) * a / cuts, low + (high - low) * b / cuts
    return (low + high) / 2


def weights(
    counted: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, budget: float = BUDGET
) -> DataFrame:
    """source, tokens, weight, budget (tokens) of every source with tokens."""
    totals = write_stage(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "mix-totals")
    whole = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = totals.withColumn("p", F.col("tokens") / F.lit(float(max(1, whole))))
    t = exponent(shares, target_entropy, max_repeats, budget)
    z = shares.agg(F.sum(F.pow("p", F.lit(t)))).first()[0] or 1.0
    weight = F.pow("p", F.lit(t)) / F.lit(z)
    return shares.select(
        "source", "tokens", weight.alias("weight"), F.floor(weight * F.lit(budget * whole)).cast("long").alias("budget")
    )


def place(block: Column, seed: int) -> Column:
    """A document's hash in a block's permutation."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), block.cast("string")))


def mixture(
    docs: DataFrame,
    target_entropy: float = TARGET_ENTROPY,
    max_repeats: float = MAX_REPEATS,
    budget: float = BUDGET,
    seed: int = SEED,
    filled: bool = False,
) -> DataFrame:
    """doc_id, source, block, n_tokens, progress of every document in every block it is taken in."""
    counted = write_stage(sized(docs), "mix-sizes")
    per_source = weights(counted, target_entropy, max_repeats, budget).select(
        F.col("source").alias("of"), "tokens", "budget", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    rows = counted.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    hashed = place(F.col("block"), seed)
    if filled:  # 'g' stands behind all hexadecimal digits
        rest = F.col("budget") - F.col("block") * F.col("tokens")
        hashed = F.when(F.col("n_tokens") > rest, F.concat(F.lit("g"), hashed)).otherwise(hashed)
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("budget") - 1) / F.col("tokens")))
    dealt = (
        rows.join(per_source, rows["source"].eqNullSafe(per_source["of"]) & (rows["salt"] == per_source["salt"]))
        .where("budget > 0")
        .select("doc_id", "source", "n_tokens", "tokens", "budget", F.explode(blocks).alias("block"))
        .withColumn("place", hashed)
        .withColumn("bucket", F.substring("place", 1, 3))
        .withColumn("group", F.coalesce("source", F.lit("\x00")))
    )
    dealt = write_stage(dealt, "mix-dealt")
    return _placed(dealt, filled)


def _placed(dealt: DataFrame, filled: bool) -> DataFrame:
    from pyspark.sql import Window

    key = ["group", "block", "bucket"]
    sums = dealt.groupBy(*key).agg(F.sum("n_tokens").alias("held"))
    before = F.sum("held").over(Window.partitionBy("group", "block").orderBy("bucket")) - F.col("held")
    # peers of one place share the frame, so copies of a row are taken or left together
    within = F.sum("n_tokens").over(Window.partitionBy(*key).orderBy("place"))
    peers = F.sum("n_tokens").over(Window.partitionBy(*key, "place"))
    upto = F.col("before") + F.col("within")
    offset = F.col("block") * F.col("tokens")
    taken = offset + upto - F.col("peers") < F.col("budget") if filled else offset + upto <= F.col("budget")
    return (
        dealt.join(sums.select(*key, before.alias("before")), key)
        .withColumn("within", within)
        .withColumn("peers", peers)
        .where(taken)
        .select(
            "doc_id", "source", F.col("block").cast("int").alias("block"), "n_tokens",
            ((offset + upto - F.col("peers")) / F.col("budget")).alias("progress"),
        )
    )


#: The same in DuckDB: shares, 32 bisection steps, blocks and running sums.
SQL = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS n_tokens
  FROM {{documents}}
),
totals AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM sized GROUP BY source HAVING sum(n_tokens) > 0),
shares AS (SELECT source, tokens, tokens / CAST((SELECT sum(tokens) FROM totals) AS DOUBLE) AS p FROM totals),
steps(step, low, high) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT step + 1, CASE WHEN up THEN mid ELSE low END, CASE WHEN up THEN high ELSE mid END
  FROM (
    SELECT step, low, high, mid,
      (SELECT (ln(sum(pow(p, mid))) - mid * sum(pow(p, mid) * ln(p)) / sum(pow(p, mid)) >= {TARGET_ENTROPY} * ln(count(*)))
           OR max(pow(p, mid - 1)) * {BUDGET} / sum(pow(p, mid)) > {MAX_REPEATS} FROM shares) AS up
    FROM (SELECT step, low, high, (low + high) / 2 AS mid FROM steps) AS s
  ) AS judged WHERE step < {STEPS}
),
chosen AS (SELECT CASE WHEN (SELECT count(*) FROM shares) < 2 THEN 1.0 ELSE (low + high) / 2 END AS t FROM steps WHERE step = {STEPS}),
budgets AS (
  SELECT source, tokens, CAST(floor(pow(p, t) / (SELECT sum(pow(p, t)) FROM shares)
    * ({BUDGET} * (SELECT sum(tokens) FROM totals))) AS BIGINT) AS budget FROM shares, chosen
),
dealt AS (
  SELECT d.doc_id, d.source, d.n_tokens, tokens, budget, block,
    md5(concat_ws('-', '{SEED}', coalesce(CAST(d.doc_id AS VARCHAR), ''), CAST(block AS VARCHAR))) AS place
  FROM sized AS d JOIN budgets AS b ON d.source IS NOT DISTINCT FROM b.source,
    unnest(range(0, CAST(floor((budget - 1) / tokens) AS BIGINT) + 1)) AS u(block)
  WHERE budget > 0
),
placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source, block ORDER BY place) AS upto,
    sum(n_tokens) OVER (PARTITION BY source, block, place) AS peers FROM dealt
)
SELECT doc_id, source, CAST(block AS INT) AS block, n_tokens,
  CAST(block * tokens + upto - peers AS DOUBLE) / budget AS progress
FROM placed WHERE block * tokens + upto <= budget
"""

#: The same for ``filled``.
SQL_FILLED = SQL.replace(
    "    md5(concat_ws('-',", "    CASE WHEN d.n_tokens > budget - block * tokens THEN 'g' ELSE '' END || md5(concat_ws('-',"
).replace("WHERE block * tokens + upto <= budget", "WHERE block * tokens + upto - peers < budget")
