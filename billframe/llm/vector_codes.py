"""Operator 13: vector code compression with a GNAT over codebook entries.

Vectors become integers, are cut into equal consecutive parts, and every part is
stored as the index of its nearest codebook entry (squared Euclidean distance,
ties to the lower index). A codebook starts as the parts of the smallest ids;
every round assigns all parts and replaces each entry by the floor of the mean.
All arithmetic that decides a result is on integers, so a result does not depend
on how rows are dealt to tasks.

Method: geometric near-neighbour access tree (GNAT) over the entries of a part. A
node has up to ``SPLITS`` entries as split points; every other entry goes to the
child of its nearest split point, and a table keeps the range of distances from
each split point to the entries of each child. A query's distance ``d`` to a
split point eliminates a child whose range [lo, hi] lies strictly outside
[d - r, d + r], with r the best distance so far. Ranges and distances are
compared with a relative slack far above the rounding of their square roots, so
rounding can only keep a child; entries that are left are compared by their
integer squared distances, then by index. The tree is walked for all rows of an
Arrow batch at once, each node for the rows that still need it.

Plan: a round is one pass over the vectors; every task hands on its sums and
counts of each (part, entry), which one small aggregation adds up. Driver and
tasks hold the codebooks (entries x dimension integers) only. The last pass
writes codes and errors; errors are added up by label, the totals of labels with
over 1 / HOT_SHARE of the rows are broadcast (at most HOT_SHARE rows) and the
others joined by label.

Edge cases: rows whose vector is NULL or holds a NULL or non-finite component are
dropped. Integers are kept within the range of a long, sums are of 38 digits,
and an error beyond a long is reported as the greatest long. Vectors are filled up
with zeros to the longest length, and that to a multiple of the number of parts.
Fewer kept rows than entries make as many entries as there are rows; no kept row
gives an empty result. Rows that share an id are ordered by their vectors; NULL
ids come last. Repeated rows give a row each.
"""

from __future__ import annotations

import decimal
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billframe.llm.common import tune, write_stage

SPLITS = 4
#: Relative slack of the comparisons that eliminate.
SLACK = 1e-9
#: Integers within this bound keep every squared distance of up to 2^12 components within 64 bits.
PLAIN = 1 << 24
LONG_MAX = (1 << 63) - 1
HOT_SHARE = 1024
#: Rows that one walk of a tree takes.
BATCH_ROWS = 4096


@dataclass
class Node:
    """Split points (entry indexes), their children and the distance ranges ``low[i][j]``, ``high[i][j]``
    from split point i to all entries of child j."""

    splits: list[int]
    children: list["Node | None"]
    low: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    high: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))


def squared(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Integer squared distances of rows to one entry."""
    gap = x - entry
    return (gap * gap).sum(axis=1)


def _distance(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def build_tree(entries: np.ndarray, members: list[int] | None = None) -> Node | None:
    """GNAT over the entries with these indexes."""
    members = list(range(len(entries))) if members is None else members
    if not members:
        return None
    # Split points far from each other: each is the farthest from those before it.
    splits = [members[0]]
    nearest = squared(entries[members], entries[splits[0]])
    while len(splits) < min(SPLITS, len(members)):
        ranked = [(-int(d), m) for d, m in zip(nearest, members) if m not in splits]
        splits.append(min(ranked)[1])
        nearest = np.minimum(nearest, squared(entries[members], entries[splits[-1]]))
    below: list[list[int]] = [[] for _ in splits]
    for m in members:
        if m not in splits:
            below[min(range(len(splits)), key=lambda i: (int(squared(entries[m : m + 1], entries[splits[i]])[0]), i))].append(m)
    low, high = (np.zeros((len(splits), len(splits))) for _ in range(2))
    for i, s in enumerate(splits):
        for j, child in enumerate(below):
            if child:
                d = _distance(squared(entries[child], entries[s]))
                low[i, j], high[i, j] = d.min(), d.max()
    return Node(splits, [build_tree(entries, child) for child in below], low, high)


def nearest_entries(tree: Node, entries: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of every row's nearest entry, and how many distances were taken."""
    best = np.full(len(x), -1, dtype=np.int64)
    least = np.zeros(len(x), dtype=x.dtype)
    taken = 0

    def visit(node: Node, rows: np.ndarray) -> None:
        nonlocal taken
        away = []
        for s in node.splits:
            d = squared(x[rows], entries[s])
            taken += len(rows)
            away.append(_distance(d))
            held, at = least[rows], best[rows]
            better = (at < 0) | (d < held) | ((d == held) & (s < at))
            least[rows[better]], best[rows[better]] = d[better], s
        for j, child in enumerate(node.children):
            if child is None:
                continue
            reach = _distance(least[rows])
            left = np.ones(len(rows), dtype=bool)
            for i, d in enumerate(away):
                left &= (node.low[i, j] <= (d + reach) * (1 + SLACK)) & (d <= (node.high[i, j] + reach) * (1 + SLACK))
            if left.any():
                visit(child, rows[left])

    if len(x):
        visit(tree, np.arange(len(x)))
    return best, least, taken


class Coder:
    """Codebooks (parts x entries x positions, Python integers) and a tree for each part."""

    def __init__(self, codebooks: list[list[list[int]]]):
        flat = [v for book in codebooks for e in book for v in e]
        self.plain = all(abs(v) <= PLAIN for v in flat)
        kind = np.int64 if self.plain else object
        self.codebooks = codebooks
        self.books = [np.array(b, dtype=kind).reshape(len(b), -1) for b in codebooks]
        self.trees = [build_tree(b) for b in self.books]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Codes (rows x parts) and the squared distances of every part; Python integers where 64 bits may not do."""
        plain = self.plain and (not vectors.size or int(np.abs(vectors).max()) <= PLAIN) and vectors.shape[1] <= 1 << 12
        x = vectors if plain else vectors.astype(object)
        width = vectors.shape[1] // len(self.books)
        codes = np.zeros((len(x), len(self.books)), dtype=np.int64)
        errors = []
        for p, (book, tree) in enumerate(zip(self.books, self.trees)):
            codes[:, p], d, _ = nearest_entries(tree, book if plain else book.astype(object), x[:, p * width : (p + 1) * width])
            errors.append(d)
        return codes, errors


def _integers(column: pa.Array, dimension: int) -> np.ndarray:
    """The kept vectors of a batch as rows of integers, filled up with zeros."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths == dimension).all():
        return values.reshape(len(lengths), dimension)
    out = np.zeros((len(lengths), dimension), dtype=np.int64)
    out[np.arange(dimension) < lengths[:, None]] = values
    return out


def _larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to about ``BATCH_ROWS`` rows: a tree is walked once for each."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= BATCH_ROWS:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


def _kept(df: DataFrame, vector: Column, scale: int) -> tuple[Column, Column]:
    """Whether a row is kept, and its vector as integers (within the range of a long)."""
    x = vector.cast("array<double>")
    ok = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    top = float(1 << 63)

    def whole(v: Column) -> Column:
        y = v * F.lit(float(scale))
        return F.when(y >= top, F.lit(LONG_MAX)).when(y <= -top, F.lit(-LONG_MAX)).otherwise(F.floor(F.when(F.abs(y) < top, y)))

    return ok, F.transform(x, whole)


def _sums(kept: DataFrame, coder: Coder, dimension: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and componentwise sum of the parts assigned to every (part, entry)."""
    out = "part int, entry int, at int, n long, s decimal(38,0)"
    sent = kept.sparkSession.sparkContext.broadcast(coder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = sent.value
        width = dimension // len(coder.books)
        totals: dict[tuple[int, int], list] = {}
        for b in _larger(batches):
            vectors = _integers(b.column("v"), dimension)
            codes, _ = coder.assign(vectors)
            wide = vectors if not vectors.size or int(np.abs(vectors).max()) <= PLAIN else vectors.astype(object)
            for p in range(len(coder.books)):
                part = wide[:, p * width : (p + 1) * width]
                order = np.argsort(codes[:, p], kind="stable")
                ranked = codes[order, p]
                firsts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else []
                for first, last in zip(firsts, [*firsts[1:], len(ranked)]):
                    got = totals.setdefault((p, int(ranked[first])), [0, [0] * width])
                    got[0] += int(last - first)
                    got[1] = [a + int(s) for a, s in zip(got[1], part[order[first:last]].sum(axis=0))]
        rows = [(p, e, i, n, decimal.Decimal(s)) for (p, e), (n, sums) in totals.items() for i, s in enumerate(sums)]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
        arrays = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "at", "n", "s"])

    rows = kept.select("v").mapInArrow(run, out).groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    found: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for r in sorted(rows, key=lambda r: r["at"]):
        found.setdefault((r["part"], r["entry"]), (r["n"], []))[1].append(int(r["s"]))
    return found


def train(kept: DataFrame, dimension: int, parts: int, entries: int, rounds: int) -> Coder | None:
    """Codebooks of rows with ``vec_id`` and integer vector ``v``; None where there is no row."""
    first = kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    width = dimension // parts
    full = [list(r["v"]) + [0] * (dimension - len(r["v"])) for r in first]
    books = [[v[p * width : (p + 1) * width] for v in full] for p in range(parts)]
    for _ in range(rounds):
        for (p, e), (n, sums) in _sums(kept, Coder(books), dimension).items():
            books[p][e] = [s // n for s in sums]
    return Coder(books)


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> tuple[DataFrame, list[list[list[int]]]]:
    """``vec_id``, ``label``, ``code`` (array of entry indexes) and ``error`` of every kept row, and the codebooks."""
    spark = tune(df.sparkSession)
    ok, whole = _kept(df, F.col(vector_col), scale)
    kept = df.where(ok).select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), whole.alias("v"))
    kept = write_stage(kept, "vector-integers")  # every round reads them
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    dimension = -(-(longest or 0) // parts) * parts
    coder = train(kept, dimension, parts, entries, rounds)
    out = T.StructType([kept.schema["vec_id"], kept.schema["label"], T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])
    if coder is None:
        return spark.createDataFrame([], out), []
    sent = spark.sparkContext.broadcast(coder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = sent.value
        for b in _larger(batches):
            codes, errors = coder.assign(_integers(b.column("v"), dimension))
            error = sum(errors[1:], errors[0])
            if error.dtype == object:
                error = np.array([min(int(e), LONG_MAX) for e in error], dtype=np.int64)
            code = pa.ListArray.from_arrays(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1], pa.array(codes.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), code, pa.array(error)], names=["vec_id", "label", "code", "error"])

    return write_stage(kept.mapInArrow(run, out), "vector-codes"), coder.codebooks


def decode(codes: DataFrame, codebooks: list[list[list[int]]]) -> DataFrame:
    """The integer vectors that codes stand for, as column ``vector``."""
    books = F.lit([v for book in codebooks for e in book for v in e]).cast("array<long>")
    n, width = (len(codebooks[0]), len(codebooks[0][0])) if codebooks else (0, 0)
    part = F.transform("code", lambda e, p: F.slice(F.col("__books"), (p * n + e) * width + 1, F.lit(width)))
    return codes.withColumn("__books", books).withColumn("vector", F.flatten(part)).drop("__books")


def label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` (a written table) with ``label_error``, the errors added up over equal labels (NULLs together)."""
    totals = codes.groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"),
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long").alias("label_error"),
    )
    totals = write_stage(totals, "vector-label-totals")
    n = totals.agg(F.sum("rows")).first()[0] or 0
    hot = F.col("rows") * HOT_SHARE > n
    named = totals.select(F.col("label").alias("__label"), "rows", "label_error")
    same = F.col("label").eqNullSafe(F.col("__label"))
    hot_rows, cold_rows = F.broadcast(named.where(hot)), named.where(~hot)
    columns = [*codes.columns, "label_error"]
    few = codes.join(hot_rows.select("__label"), same, "left_anti")
    return codes.join(hot_rows, same).select(*columns).unionByName(few.join(cold_rows, same).select(*columns))


def digest(codes: DataFrame, codebooks: list[list[list[int]]]) -> DataFrame:
    """Contract columns."""
    numbers = ",".join(str(v) for book in codebooks for e in book for v in e)
    return label_errors(codes).select(
        "vec_id",
        F.array_join(F.transform("code", lambda e: F.lpad(F.lower(F.hex(e.cast("long"))), 2, "0")), "").alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """DuckDB SQL of the contract for vectors of one length: each round is a table of assignments and one of entries."""
    gap = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""cut AS MATERIALIZED (
  SELECT rid, p AS part, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS v
  FROM kept, range({parts}) AS r(p))""",
        f"b0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, v AS c FROM cut WHERE rid <= {entries})",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
  SELECT rid, part, min(({{'d': {gap}, 'e': entry}})) AS best FROM cut JOIN b{r} USING (part) GROUP BY rid, part)"""
        )
        if r < rounds:
            steps.append(
                f"""s{r} AS (
  SELECT part, entry, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM (SELECT part, best.e AS entry, unnest(v) AS x, unnest(range(len(v))) AS i FROM a{r} JOIN cut USING (rid, part))
  GROUP BY part, entry, i),
m{r} AS (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{r} GROUP BY part, entry),
b{r + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m{r}.c, b{r}.c) AS c FROM b{r} LEFT JOIN m{r} USING (part, entry))"""
            )
    return f"""WITH {",".join(steps)},
coded AS (
  SELECT rid, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
  FROM a{rounds} GROUP BY rid),
books AS (
  SELECT sha256(string_agg(list_aggregate(list_transform(c, lambda x: x::VARCHAR), 'string_agg', ','), ',' ORDER BY part, entry)) AS h
  FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (rid), books"""
