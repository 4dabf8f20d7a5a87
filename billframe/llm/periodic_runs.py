"""Operator 11: periodic runs of words in every text.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
equal) of at least ``max(min_length, 2 * q)`` words that no neighbouring word
extends. Diagonal ``q`` of the DP matrix counts, at each word, how many words
up to it equal the word ``q`` before them; a run is a stretch of a diagonal of
``max(q, min_length - q)`` or more matches.

Method: online sparse diagonal DP. Words are read in order; the earlier
occurrences of a word increment the match lengths of their lags, and a lag that
no occurrence continues ends there: if its match is long enough the run is
emitted at once. Two exact economies make the matrix sparse. A run has at least
``ceil(min_length / 2)`` matches in a row, so an occurrence counts only with
that many equal words before it and a lag starts with that length; in prose
almost no cell is left. And a text of few different words, whose cells would
outnumber ``cells_per_word`` times its words (a million times the same word has
half a billion), has its diagonals sampled: a stretch of ``s = max(q,
min_length - q)`` matches passes a position divisible by ``s``, so each diagonal
is entered at these stations only (n log n of them in all) and its match is
lengthened in both directions by doubling strides over ranks of 2^k-word
blocks. Both ways find the same runs (tests compare them).

A stretch that has a smaller period too is that period's run (Fine and Wilf):
of stretches with equal ends the one with the smallest lag stays.

Plan: one pass over the texts in Arrow batches, no shuffle; nothing is
broadcast. Memory: a group of texts of ``GROUP_BYTES`` or one longer text; the
stations need log2(n) ranks of four bytes a word.

Edge cases: a NULL, empty or blank text has no words, no runs and an empty
``collapsed``; repeated rows and ids give a row each.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billframe.llm.common import map_texts, narrow, words

#: Texts are taken together up to this many bytes.
GROUP_BYTES = 1 << 21
#: Cells of the sparse matrix for each word of a text beyond which its diagonals are entered at stations.
CELLS_PER_WORD = 64
#: Stations looked at in one step.
STATION_BLOCK = 1 << 20

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def online_runs(positions: list[int], contexts: list[int], least: int, min_length: int) -> Iterator[tuple[int, int, int]]:
    """Stretches (start, length, lag) of a text, from the words whose context recurs.

    ``positions`` rise; ``contexts`` number the ``least`` words up to each position.
    """
    earlier: dict[int, list[int]] = {}
    active: dict[int, int] = {}
    last = -2
    for i, context in zip(positions, contexts):
        if i != last + 1:
            for q, n in active.items():
                if n >= q and n + q >= min_length:
                    yield last - n - q + 1, n + q, q
            active = {}
        occurrences = earlier.setdefault(context, [])
        going = {}
        for j in occurrences:
            going[i - j] = active.pop(i - j, least - 1) + 1
        for q, n in active.items():  # ended at the word before
            if n >= q and n + q >= min_length:
                yield last - n - q + 1, n + q, q
        occurrences.append(i)
        active, last = going, i
    for q, n in active.items():
        if n >= q and n + q >= min_length:
            yield last - n - q + 1, n + q, q


def block_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """For each k the rank of the 2^k words from every position on (equal ranks: equal words)."""
    _, rank = np.unique(ids, return_inverse=True)
    ranks = [rank.astype(np.int32)]
    width = 1
    while 2 * width <= len(ids):
        before = ranks[-1].astype(np.int64)
        pairs = before[: len(before) - width] * (len(ids) + 1) + before[width:]
        ranks.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))
        width *= 2
    return ranks


def station_runs(ids: np.ndarray, min_length: int) -> Iterator[tuple[int, int, int]]:
    """Stretches (start, length, lag) of a text, with diagonals entered at stations."""
    n = len(ids)
    ranks = block_ranks(ids)
    lags = np.arange(1, n // 2 + 1, dtype=np.int64)
    steps = np.maximum(lags, min_length - lags)
    counts = (n - 1) // steps
    upto = np.cumsum(counts)
    # The last stretch found over each word. A station whose two words lie in one stretch of a lag that
    # divides its own only finds that stretch again.
    over, over_lag = np.full(n, -1, dtype=np.int64), np.ones(n, dtype=np.int64)
    known: set[tuple[int, int]] = set()
    first = 0
    while first < len(lags):
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + STATION_BLOCK, "right")))
        c = counts[first:last]
        q = np.repeat(lags[first:last], c)
        s = np.repeat(steps[first:last], c)
        at = (np.arange(len(q)) - np.repeat(np.cumsum(c) - c, c) + 1) * s
        live = ids[at] == ids[at - q]
        live &= (over[at] < 0) | (over[at] != over[at - q]) | (q % over_lag[at] != 0)
        q, at, s = q[live], at[live], s[live]
        end, begin = at.copy(), at.copy()
        for k in range(len(ranks) - 1, -1, -1):
            w, rank = 1 << k, ranks[k]
            fits = np.flatnonzero(end + w <= n)
            fits = fits[rank[end[fits]] == rank[end[fits] - q[fits]]]
            end[fits] += w
            fits = np.flatnonzero(begin - w - q >= 0)
            fits = fits[rank[begin[fits] - w] == rank[begin[fits] - w - q[fits]]]
            begin[fits] -= w
        long = end - begin >= s
        found = np.unique(np.stack([begin[long] - q[long], end[long] - begin[long] + q[long], q[long]], 1), axis=0)
        # By ends, then lag: the smallest lag of equal ends, unless an earlier block has them.
        found = found[np.lexsort((found[:, 2], found[:, 1]))]
        for start, length, lag in found.tolist():
            if (start, length) not in known:
                known.add((start, length))
                over[start : start + length], over_lag[start : start + length] = len(known), lag
                yield start, length, lag
        first = last


def smallest_periods(stretches) -> list[tuple[int, int, int]]:
    """Runs by start, then period: of stretches with equal ends the one with the smallest lag."""
    best: dict[tuple[int, int], int] = {}
    for start, length, q in stretches:
        at = (start, length)
        if q < best.get(at, q + 1):
            best[at] = q
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def _contexts(ids: np.ndarray, owner: np.ndarray, least: int, multiplier: int) -> np.ndarray:
    """A 64-bit hash of every ``least`` words of one text, by their last position (0 elsewhere)."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(multiplier)
    mixed ^= mixed >> np.uint64(29)
    h = np.zeros(len(ids), dtype=np.uint64)
    for back in range(least):
        h[least - 1 :] = h[least - 1 :] * np.uint64(0x9E3779B97F4A7C15) + mixed[back : len(ids) - least + 1 + back]
    h ^= h >> np.uint64(32)
    h = (h + owner.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93) | np.uint64(1)
    whole = np.zeros(len(ids), dtype=bool)
    whole[least - 1 :] = owner[least - 1 :] == owner[: len(ids) - least + 1]
    return np.where(whole, h, np.uint64(0))


def runs_of(texts: list[list[bytes]], min_length: int = 12, cells_per_word: int = CELLS_PER_WORD) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of every text, given as words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    total, least = int(sizes.sum()), (min_length + 1) // 2
    if total < min_length:
        return out
    numbers: dict[bytes, int] = {}
    ids = np.fromiter(map(numbers.setdefault, itertools.chain.from_iterable(texts), itertools.count()), np.int64, total)
    owner = np.repeat(np.arange(len(texts)), sizes)
    starts = np.cumsum(sizes) - sizes
    for multiplier in itertools.count(0xBF58476D1CE4E5B9, 2):
        h = _contexts(ids, owner, least, multiplier)
        order = np.argsort(h, kind="stable")
        ranked = h[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        group = np.cumsum(new) - 1
        several = (np.bincount(group)[group] > 1) & (ranked != 0)
        same = np.flatnonzero(several[1:] & ~new[1:]) + 1
        here, there = order[same], order[same - 1]
        if all((ids[here - b] == ids[there - b]).all() for b in range(least)):
            break  # no two contexts share a hash
    at, group = order[several], group[several]
    by_place = np.argsort(at)
    at, group = at[by_place], group[by_place]
    bounds = np.searchsorted(at, np.concatenate([starts, [total]]))
    for d in np.unique(owner[at]).tolist():
        lo, hi = int(bounds[d]), int(bounds[d + 1])
        seen = np.unique(group[lo:hi], return_counts=True)[1].astype(np.float64)
        if (seen * (seen - 1) / 2).sum() <= cells_per_word * sizes[d]:
            found = online_runs((at[lo:hi] - starts[d]).tolist(), group[lo:hi].tolist(), least, min_length)
        else:
            found = station_runs(ids[starts[d] : starts[d] + sizes[d]], min_length)
        out[d] = smallest_periods(found)
    return out


def collapse(text: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if runs:
        edges = np.zeros(len(text) + 1, dtype=np.int64)
        for start, length, q in runs:
            edges[start + q] += 1
            edges[start + length] -= 1
        text = list(itertools.compress(text, (np.cumsum(edges[:-1]) == 0).tolist()))
    return b" ".join(text)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 12) -> DataFrame:
    """``doc_id``, ``runs`` (array of start, length, period; by start, then period) and ``collapsed``
    (the text without what its runs repeat) of every row."""
    if min_length < 2:
        raise ValueError("a run has two words or more")

    def make():
        def work(texts: list[bytes]):
            runs, collapsed, first = [], [], 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and (last == first or size + len(texts[last]) <= GROUP_BYTES):
                    size += len(texts[last])
                    last += 1
                split = [t.split() for t in texts[first:last]]  # at \x20 and \x09-\x0D
                found = runs_of(split, min_length)
                runs += [[dict(zip(RUN.names, r)) for r in rs] for rs in found]
                collapsed += [collapse(t, rs).decode() for t, rs in zip(split, found)]
                first = last
            return runs, collapsed

        return work

    fields = [
        T.StructField("runs", T.ArrayType(RUN, containsNull=False)),
        T.StructField("collapsed", T.StringType()),
    ]
    return map_texts(narrow(docs, id_col, text_col), make, fields)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Contract: h = crc32(doc_id as text), g = floor(h / 10); if h % 10 = 0, the words from a = g % n on
    repeat the first p = 1 + floor((n - a) / (3 + g % 8)) of them. A NULL id counts as the empty text."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    parts = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("long").alias("g"), words(F.col("text")).alias("w"))
    n = F.size("w")
    a = (F.col("g") % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))).cast("int")

    def word(w: Column, i: Column) -> Column:
        return F.when(i >= F.col("a"), F.get("w", F.col("a") + (i - F.col("a")) % F.col("p"))).otherwise(w)

    planted = (F.col("h") % 10 == 0) & (n > 0)
    placed = parts.select("doc_id", "text", "w", planted.alias("planted"), F.when(planted, a).alias("a"), F.when(planted, p).alias("p"))
    return placed.select("doc_id", F.when(F.col("planted"), F.array_join(F.transform("w", word), " ")).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Contract columns: the longest run and the hashes of all runs and of the collapsed text."""
    # Greatest length, then smallest start, then smallest period.
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("*", top.alias("top"), F.size("runs").cast("long").alias("n_runs")).select(
        "doc_id",
        "n_runs",
        (-F.col("top.s")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("top.length") / -F.col("top.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: The contract in DuckDB: contexts of six words joined with their earlier occurrences, stretches of
#: consecutive words at one lag, the smallest lag of equal ends.
SQL = r"""
WITH hashed AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS given,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])),
        lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) AS h
  FROM documents
),
parted AS (
  SELECT row, doc_id, given, len(given) AS n, h, h // 10 AS g,
    CASE WHEN len(given) > 0 THEN (h // 10) % len(given) END AS a FROM hashed
),
texts AS MATERIALIZED (
  SELECT row, doc_id, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: CASE WHEN i >= a THEN given[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] ELSE given[i + 1] END)
    ELSE given END AS ws FROM parted
),
words AS MATERIALIZED (SELECT row, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM texts),
contexts AS (
  SELECT row, i, i0, c FROM (
    SELECT row, i, min(i) OVER six AS i0, string_agg(w, ' ') OVER six AS c FROM words
    WINDOW six AS (PARTITION BY row ORDER BY i ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)) AS t
  WHERE i0 = i - 5
),
cells AS (SELECT x.row, x.i, x.i - y.i AS q FROM contexts AS x JOIN contexts AS y ON x.row = y.row AND x.c = y.c AND y.i < x.i),
stretches AS (
  SELECT row, q, min(i) - 5 - q AS start, count(*) + 5 + q AS length
  FROM (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM cells) AS t
  GROUP BY row, q, island HAVING count(*) + 5 >= q AND count(*) + 5 + q >= 12
),
runs AS MATERIALIZED (SELECT row, start, length, min(q) AS period FROM stretches GROUP BY row, start, length),
dropped AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT row, string_agg(w, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN dropped USING (row, i) GROUP BY row
),
listed AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    min({'l': -length, 's': start, 'p': period}) AS top FROM runs GROUP BY row
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, -top.l AS length, top.p AS period,
  1000 * -top.l // top.p AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (row) LEFT JOIN kept USING (row)
"""
