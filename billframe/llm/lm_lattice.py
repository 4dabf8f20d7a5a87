"""Language-model scoring by subword lattices.

Pieces: the vocabulary of an existing subword model, whose scores rank its
pieces, with single UTF-8 bytes for characters it lacks. A word (white-space
words, A-Z lower-cased, opened by the word mark) spans a lattice of all its
segmentations; no piece crosses a word, and a document ends with one end
token, so a document's marginal probability is the product of its words' and
of the end's. A word's marginal is computed by forward recursion in log
space over all segmentations.

Piece probabilities: the existing scores are ranks, so they give Zipf's law as
a first estimate; rounds of expectation maximisation over all distinct
training words, weighted by their counts, adapt it, the first estimate staying
as a prior worth ``prior`` pieces, so that no piece has probability zero. Probabilities of
pieces and of the end sum to one, so the score is a true probability.

Plan: one scan counts words (per task first, then by word). A word's count and
log probability are computed once per distinct word. Each document then needs
both for all its words: the words that hold at least one part in 2^16 of all
tokens - 65,536 at most, whatever the input - are broadcast and summed
within the scan; the others, none of which can be hot, are joined by word and
summed by document.

Base score: sum over tokens of log10((c + 1) / (N + 1 * (V + 1))) with the
training count c of the token, N training tokens and V distinct ones, the end
token included.

Edge cases: NULL and empty texts have the end token only; an empty training
part leaves the prior (and c = N = V = 0); repeated rows are scored each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billframe.llm.common import narrow, tune, write_stage

MARK = "▁"
#: Frequent words: those with at least this share of all tokens; at most 1 / share of them.
FREQUENT = 2**-16
#: Distinct words that a task holds before it passes its counts on.
HELD_WORDS = 400_000
LOG10 = math.log(10)
#: Characters of a word up to which its arcs are kept for the way back.
KEPT_ARCS = 1 << 14


class Lattice:
    """Pieces with log probabilities, and the sums over a word's segmentations.

    ``table`` maps every piece to its log probability, and every other prefix
    of a piece to None, so that the arcs from a position are found by
    lengthening a substring for as long as it is in the table.
    """

    def __init__(self, pieces: list[str], log_probs: np.ndarray):
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.lp = dict(zip(pieces, log_probs.tolist(), strict=True))
        self.table: dict[str, float | None] = {p[:k]: None for p in pieces if p[0] != "<" for k in range(1, len(p))}
        self.table |= self.lp
        self.arc = {p: None if x is None else (math.exp(x), self.ids[p]) for p, x in self.table.items()}
        self.spelled = [self.lp[f"<0x{b:02X}>"] for b in range(256)]
        self.longest = max(map(len, pieces))

    def by_bytes(self, ch: str) -> float:
        """Log probability of a character spelled in bytes, for those that are no piece."""
        return sum(self.spelled[b] for b in ch.encode("utf-8"))

    def log_marginal(self, word: str) -> float:
        """Natural log of the summed probability of all segmentations, by log-space forward recursion."""
        text = MARK + word
        n = len(text)
        find, exp, log = self.table.get, math.exp, math.log
        terms: list[list[float]] = [[] for _ in range(n + 1)]
        terms[0].append(0.0)
        for i in range(n):
            at = terms[i]
            if len(at) == 1:
                alpha = at[0]
            else:
                top = max(at)
                alpha = top + log(sum([exp(t - top) for t in at]))
            j = i + 1
            p = find(text[i], False)
            if not p:  # no piece of one character: spell it
                terms[j].append(alpha + self.by_bytes(text[i]))
            while p is not False:
                if p is not None:
                    terms[j].append(alpha + p)
                j += 1
                if j > n:
                    break
                p = find(text[i:j], False)
        at = terms[n]
        top = max(at)
        return top + log(sum([exp(t - top) for t in at]))

    def expect(self, word: str, weight: float, counts: list[float]) -> None:
        """Add the expected uses of every piece in ``weight`` occurrences of a word.

        Forward in plain probabilities, the positions within a piece's reach scaled
        up whenever they get small, which keeps long words in range; then the mass
        flows back. Very long words find their arcs a second time on the way
        back instead of keeping them.
        """
        text = MARK + word
        n = len(text)
        find, longest = self.arc.get, self.longest
        keep = n <= KEPT_ARCS
        alpha = [0.0] * (n + 1)
        alpha[0] = 1.0
        arcs: list[tuple] = []
        append = arcs.append if keep else lambda arc: None
        scales: dict[int, float] = {}
        for i in range(n):
            a = alpha[i]
            if a < 1e-200:
                reach = min(n, i + longest) + 1
                top = max(alpha[i:reach]) or 1.0
                for k in range(i, reach):
                    alpha[k] /= top
                scales[i] = top
                a = alpha[i]
            j = i + 1
            got = find(text[i], False)
            if not got:  # no piece of one character: spell it
                p = math.exp(self.by_bytes(text[i]))
                alpha[j] += a * p
                append((i, j, p, -2))
            while got is not False:
                if got is not None:
                    alpha[j] += a * got[0]
                    append((i, j, got[0], got[1]))
                j += 1
                if j > n:
                    break
                got = find(text[i:j], False)
        mass = [0.0] * (n + 1)
        mass[n] = weight
        if keep and not scales:  # nearly all words
            for i, j, p, piece in reversed(arcs):
                m = mass[j]
                if m and alpha[j]:
                    part = m * alpha[i] * p / alpha[j]
                    mass[i] += part
                    if piece >= 0:
                        counts[piece] += part
                    else:
                        for b in text[i].encode("utf-8"):
                            counts[self.ids[f"<0x{b:02X}>"]] += part
            return
        last = n
        for i, j, p, piece in reversed(arcs) if keep else self._arcs_back(text):
            while last > i:  # positions behind a scaling are compared with those before it no more
                if last in scales:
                    for k in range(last, min(n, last + longest) + 1):
                        alpha[k] *= scales[last]
                last -= 1
            m = mass[j]
            if m and alpha[j]:
                part = m * alpha[i] * p / alpha[j]
                mass[i] += part
                if piece >= 0:
                    counts[piece] += part
                else:
                    for b in text[i].encode("utf-8"):
                        counts[self.ids[f"<0x{b:02X}>"]] += part

    def _arcs_back(self, text: str):
        """The arcs (from, to, probability, piece; -2 for a spelled character) of a text, last position first."""
        find, n = self.arc.get, len(text)
        for i in range(n - 1, -1, -1):
            got = find(text[i], False)
            if not got:
                yield i, i + 1, math.exp(self.by_bytes(text[i])), -2
            j = i + 1
            while got is not False:
                if got is not None:
                    yield i, j, got[0], got[1]
                j += 1
                if j > n:
                    break
                got = find(text[i:j], False)


def vocabulary(model_file: str) -> tuple[list[str], np.ndarray]:
    """Pieces of an existing subword model and their first probabilities, Zipf's law on their rank."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i))]
    byte = {i for i in ids if sp.is_byte(i)}
    ranked = sorted((i for i in ids if i not in byte), key=lambda i: -sp.get_score(i))
    pieces = [sp.id_to_piece(i) for i in ranked] + [sp.id_to_piece(i) for i in sorted(byte)]
    weights = 1.0 / (np.arange(len(pieces)) + 10.0)
    if MARK not in pieces:
        pieces.append(MARK)
        weights = np.append(weights, weights[-1])
    return pieces, weights / weights.sum()


def _counted(docs: DataFrame, held_out) -> DataFrame:
    """word, n: the training counts of all words, zero for those in held-out rows only."""
    rows = docs.select(held_out.alias("held_out"), "text")
    out = T.StructType([T.StructField("word", T.StringType(), False), T.StructField("n", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush():
            got = list(seen.items())
            seen.clear()
            for i in range(0, len(got), 50_000):
                part = got[i : i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in part], pa.binary()).cast(pa.string()), pa.array([n for _, n in part], pa.int64())],
                    names=["word", "n"],
                )

        for b in batches:
            for out_, raw in zip(b.column("held_out").to_pylist(), b.column("text").to_pylist(), strict=True):
                ws = raw.lower().split()
                if out_:
                    for w in set(ws):
                        seen[w] += 0
                else:
                    seen.update(ws)
            if len(seen) > HELD_WORDS:
                yield from flush()
        yield from flush()

    return rows.mapInArrow(run, out).groupBy("word").agg(F.sum("n").alias("n"))


def _expected(words: DataFrame, held, n_pieces: int) -> np.ndarray:
    """Expected uses of every piece over all training words."""
    out = T.StructType([T.StructField("piece", T.IntegerType(), False), T.StructField("n", T.DoubleType(), False)])

    def run(batches):
        lattice = Lattice(*held.value)
        counts = [0.0] * n_pieces
        for b in batches:
            for w, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist(), strict=True):
                lattice.expect(w, n, counts)
        counts = np.array(counts)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["piece", "n"]
            )

    total = words.where("n > 0").mapInArrow(run, out).groupBy("piece").agg(F.sum("n").alias("n"))
    got = np.zeros(n_pieces)
    for r in total.toLocalIterator():  # as many rows as there are pieces, at most
        got[r.piece] = r.n
    return got


def lm_scores(
    docs: DataFrame,
    model_file: str,
    held_out,
    rounds: int = 2,
    prior: float = 100.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``held_out``: a boolean column over ``doc_id``; rows where it holds are not learned from.
    """
    spark = docs.sparkSession
    tune(spark)
    rows = narrow(docs, id_col, text_col)
    flagged = rows.select("doc_id", held_out.alias("held_out"), "text")
    words = write_stage(_counted(rows, held_out), "words")
    n_docs = flagged.where(~F.col("held_out")).count()
    sums = words.agg(F.sum("n"), F.count(F.when(F.col("n") > 0, 1))).first()
    n_train, v_train = (sums[0] or 0) + n_docs, sums[1] + (n_docs > 0)

    pieces, first = vocabulary(model_file)
    ends = 1.0 + n_docs
    probs, uses = first, prior
    for _ in range(rounds if n_docs else 0):
        # the end's share does not matter within words
        held = spark.sparkContext.broadcast((pieces, np.log(probs)))
        got = _expected(words, held, len(pieces)) + prior * first
        uses = float(got.sum())
        probs = got / uses
    inside = uses / (uses + ends)
    log_probs, log_end = np.log(probs * inside), math.log(1 - inside)
    scored = write_stage(_word_scores(words, spark.sparkContext.broadcast((pieces, log_probs))), "word-scores")

    base_of = lambda c: F.log10((c + 1) / F.lit(float(n_train + v_train + 1)))
    table = scored.select("word", "log_p", base_of(F.col("n")).alias("base"), (F.col("n") > 0).cast("long").alias("known"))
    # at most 1 / FREQUENT words can have so large a share of the training tokens
    frequent = table.join(
        scored.where(F.col("n") >= F.lit(max(1.0, n_train * FREQUENT))).select("word"), "word", "left_semi"
    ).toArrow()
    common = spark.sparkContext.broadcast(
        {
            w.encode(): (p, b)
            for w, p, b in zip(*(frequent[c].to_pylist() for c in ("word", "log_p", "base")), strict=True)
        }
    )
    rest = _spread(flagged, common)
    end_base = math.log10((n_docs + 1) / (n_train + v_train + 1))
    per_row = (
        rest.join(table, "word", "left")
        .groupBy("row", "doc_id", "held_out")
        .agg(
            F.sum("n_tokens").alias("n_tokens"),
            (F.sum("n_known") + F.sum(F.coalesce(F.col("times") * F.col("known"), F.lit(0)))).alias("n_known"),
            (F.sum("base_sum") + F.sum(F.coalesce(F.col("times") * F.col("base"), F.lit(0.0)))).alias("base_sum"),
            (F.sum("log_sum") + F.sum(F.coalesce(F.col("times") * F.col("log_p"), F.lit(0.0)))).alias("log_sum"),
        )
    )
    return per_row.select(
        "doc_id",
        "held_out",
        (F.col("n_tokens") + 1).alias("n_tokens"),
        (F.col("n_known") + F.lit(int(n_docs > 0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base_sum") + F.lit(end_base)).alias("base_score"),
        ((F.col("log_sum") + F.lit(log_end)) / F.lit(LOG10)).alias("score"),
    )


def _word_scores(words: DataFrame, held) -> DataFrame:
    """word, n, log_p: the log marginal of every distinct word."""
    out = T.StructType([*words.schema.fields, T.StructField("log_p", T.DoubleType(), False)])

    def run(batches):
        lattice = Lattice(*held.value)
        for b in batches:
            lp = [lattice.log_marginal(w) for w in b.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lp, pa.float64())], names=out.names)

    return words.mapInArrow(run, out)


def _spread(flagged: DataFrame, common) -> DataFrame:
    """For every row: one line with its sums over frequent words, and one line for each other word.

    The first kind carries a word with a space and the row's number, which no
    word is and no two rows share, so that a left join by word has no hot key.
    """
    keyed = flagged.withColumn("row", F.monotonically_increasing_id())
    kinds = [
        ("word", T.StringType()), ("times", T.LongType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()),
        ("base_sum", T.DoubleType()), ("log_sum", T.DoubleType()),
    ]
    out = T.StructType([*(keyed.schema[c] for c in ("row", "doc_id", "held_out")), *(T.StructField(n, t) for n, t in kinds)])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, known = to_arrow_schema(out), common.value
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            at, word, times, n_tokens, n_known, base_sum, log_sum = cols
            for i, (row, raw) in enumerate(zip(b.column("row").to_pylist(), b.column("text").to_pylist(), strict=True)):
                counts = Counter(raw.lower().split())
                total = inside = 0
                base = logs = 0.0
                for w, n in counts.items():
                    total += n
                    got = known.get(w)
                    if got is None:
                        at.append(i)
                        word.append(w)
                        times.append(n)
                    else:
                        inside += n
                        logs += n * got[0]
                        base += n * got[1]
                fresh = len(at) - len(n_tokens)
                for c in (n_tokens, n_known):
                    c.extend([0] * fresh)
                for c in (base_sum, log_sum):
                    c.extend([0.0] * fresh)
                for c, x in zip(cols, (i, f" {row}".encode(), 0, total, inside, base, logs), strict=True):
                    c.append(x)
            idx = pa.array(at, pa.int64())
            keep = [b.column(c).take(idx) for c in ("row", "doc_id", "held_out")]
            made = [pa.array(word, pa.binary()).cast(pa.string())]
            made += [pa.array(c, type=schema.field(4 + i).type) for i, c in enumerate(cols[2:])]
            yield pa.RecordBatch.from_arrays(keep + made, names=schema.names)

    return keyed.mapInArrow(run, out)

