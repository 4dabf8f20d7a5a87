"""Quality classifier: a factorisation machine over hashed words, structure and length.

Features of a text: its white-space words hashed into ``word_dims`` columns
with weight log(1 + count), scaled to length one; structure statistics (shares
of symbols, capitals, digits, repeated words and lines, ...) each in one-hot
bins; and the length in characters as metadata. Labels, language, source and
id are never features.

score = sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j), where the
pair term is computed in linear time as
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Training: a bounded sample of labelled rows, at most ``per_class`` of each
label in the order of a hash of the id, fitted on the driver by mini-batch
AdaGrad. The intercept is corrected for the true share of each label among all
labelled rows. Scoring reads whole texts where they lie, without a shuffle.

Edge cases: NULL and empty texts are scored from their structure bins; labels
that are NULL are not used; if one label is missing, or there are none, the
score is the smoothed share of label 1; repeated labels count as often as they
occur.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billframe.llm.common import map_texts, narrow, tune

WORD_DIMS = 1 << 12
FACTORS = 6
#: Bound of the training sample, for each label.
PER_CLASS = 2_500
SEED = 11

#: Upper edges of the bins of each statistic; the last bin is open.
BINS: dict[str, tuple[float, ...]] = {
    "words": (0, 5, 20, 50, 100, 300, 1000, 5000),
    "characters": (0, 30, 100, 300, 1000, 3000, 10000, 50000),
    "word_length": (2, 3, 4, 5, 6, 7, 9, 12),
    "symbols": (0, 0.005, 0.02, 0.05, 0.1, 0.2),
    "marks": (0, 0.01, 0.03, 0.05, 0.1, 0.2),
    "capitals": (0, 0.02, 0.05, 0.1, 0.2, 0.5, 0.8),
    "digits": (0, 0.01, 0.03, 0.1, 0.3),
    "distinct_words": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9),
    "top_word": (0.02, 0.05, 0.1, 0.2, 0.4, 0.7),
    "same_as_next": (0, 0.01, 0.05, 0.2, 0.5),
    "repeated_lines": (0, 0.05, 0.1, 0.3, 0.6),
    "lone_marks": (0, 0.01, 0.05, 0.1, 0.2, 0.4),
    "marked_words": (0, 0.05, 0.15, 0.3, 0.6),
    "words_per_line": (1, 3, 6, 12, 25, 60, 200),
}
_STARTS = np.cumsum([0] + [len(b) + 1 for b in BINS.values()])
STRUCTURE_DIMS = int(_STARTS[-1])
_SYMBOL = re.compile(rb"[#*$%&|<>@^~=+_\\/\[\]{}]+")
_MARK = re.compile(rb"[!?;:\"()'-]+")


def _total(pattern: re.Pattern, raw: bytes) -> int:
    return sum(map(len, pattern.findall(raw)))


_CAPITALS, _LETTERS, _DIGITS = re.compile(rb"[A-Z]+"), re.compile(rb"[A-Za-z]+"), re.compile(rb"[0-9]+")


def statistics(raw: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """The structure statistics of a text, in the order of BINS."""
    n, size = max(1, len(words)), max(1, len(raw))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        len(words),
        len(raw),
        sum(map(len, words)) / n,
        _total(_SYMBOL, raw) / size,
        _total(_MARK, raw) / size,
        _total(_CAPITALS, raw) / max(1, _total(_LETTERS, raw)),
        _total(_DIGITS, raw) / size,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(c for w, c in counts.items() if len(w) == 1 and not w.isalnum() and w < b"\x80") / n,
        sum(c for w, c in counts.items() if len(w) > 1 and w[-1:] in b"!#$%&*|<>") / n,
        len(words) / max(1, len(lines)),
    ]


def features(raw: bytes, word_dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns (structure first, then hashed words) and values of one text."""
    words = raw.split()
    counts = Counter(words)
    bins = [
        int(_STARTS[i]) + int(np.searchsorted(edges, x))
        for i, (x, edges) in enumerate(zip(statistics(raw, words, counts), BINS.values(), strict=True))
    ]
    hashed = np.zeros(word_dims)
    if counts:
        at = np.fromiter(map(zlib.crc32, counts), dtype=np.int64, count=len(counts)) & (word_dims - 1)
        hashed = np.bincount(at, weights=np.fromiter(counts.values(), dtype=np.float64), minlength=word_dims)
    cols = np.flatnonzero(hashed)
    vals = np.log1p(hashed[cols])
    vals /= max(1e-9, float(np.sqrt((vals**2).sum())))
    unit = 1 / np.sqrt(len(BINS))
    return (
        np.concatenate([np.array(bins, dtype=np.int64), cols + STRUCTURE_DIMS]),
        np.concatenate([np.full(len(bins), unit), vals]),
    )


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    word_dims: int

    def margin(self, cols: np.ndarray, vals: np.ndarray) -> float:
        v = self.factors[cols] * vals[:, None]
        pairs = 0.5 * float((v.sum(axis=0) ** 2).sum() - (v**2).sum())
        return self.bias + float(self.linear[cols] @ vals) + pairs

    def score(self, raw: bytes) -> float:
        m = self.margin(*features(raw, self.word_dims))
        return float(1 / (1 + np.exp(-np.clip(m, -40, 40))))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    share: float,
    word_dims: int = WORD_DIMS,
    factors: int = FACTORS,
    epochs: int = 12,
    batch: int = 64,
    rate: float = 0.15,
    decay: float = 1e-5,
) -> Model:
    """Fit by AdaGrad on the log loss. ``share``: the true share of label 1."""
    rng = np.random.default_rng(SEED)
    dims = STRUCTURE_DIMS + word_dims
    prior = float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return Model(prior, np.zeros(dims), np.zeros((dims, factors)), word_dims)
    w0, w, v = 0.0, np.zeros(dims), rng.normal(0, 0.05, (dims, factors))
    g0, gw, gv = 1e-6, np.full(dims, 1e-6), np.full((dims, factors), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            picked = order[at : at + batch]
            cols = np.concatenate([rows[i][0] for i in picked])
            vals = np.concatenate([rows[i][1] for i in picked])
            sizes = np.array([len(rows[i][0]) for i in picked])
            heads = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            vx = v[cols] * vals[:, None]
            sums = np.add.reduceat(vx, heads)
            pairs = 0.5 * (sums**2 - np.add.reduceat(vx**2, heads)).sum(axis=1)
            m = w0 + np.add.reduceat(w[cols] * vals, heads) + pairs
            err = (1 / (1 + np.exp(-np.clip(m, -40, 40))) - labels[picked]) / len(picked)
            each = np.repeat(err, sizes)
            d0 = float(err.sum())
            g0 += d0 * d0
            w0 -= rate * d0 / np.sqrt(g0)
            used, inverse = np.unique(cols, return_inverse=True)
            dw = np.bincount(inverse, weights=each * vals, minlength=len(used)) + decay * w[used]
            gw[used] += dw**2
            w[used] -= rate * dw / np.sqrt(gw[used])
            part = (each * vals)[:, None] * (np.repeat(sums, sizes, axis=0) - vx)
            dv = np.stack([np.bincount(inverse, weights=part[:, f], minlength=len(used)) for f in range(factors)], axis=1)
            dv += decay * v[used]
            gv[used] += dv**2
            v[used] -= rate * dv / np.sqrt(gv[used])
    sample = float(labels.mean())
    return Model(w0 + prior - float(np.log(sample / (1 - sample))), w, v, word_dims)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    word_dims: int = WORD_DIMS,
    per_class: int = PER_CLASS,
) -> Model:
    """Fit on labelled documents. ``learn``: a condition on ``doc_id`` of the rows that may be used."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(
        "doc_id", (F.col("quality") > 0).cast("int").alias("label")
    )
    if learn is not None:
        known = known.where(learn)
    share = known.agg(F.sum("label"), F.count("label")).first()
    ones, n = share[0] or 0, share[1]
    order = F.xxhash64("doc_id")
    # a bounded sample: at most 2 * per_class ids, whatever the size of the labels
    picked = [known.where(F.col("label") == x).orderBy(order, "doc_id").limit(per_class) for x in (0, 1)]
    sample = F.broadcast(picked[0].unionByName(picked[1]))
    texts = narrow(docs).join(sample, "doc_id")

    fields = [T.StructField("cols", T.ArrayType(T.IntegerType()), False), T.StructField("vals", T.ArrayType(T.FloatType()), False)]

    def make():
        def work(raw):
            got = [features(x, word_dims) for x in raw]
            return [[c.tolist() for c, _ in got], [x.tolist() for _, x in got]]

        return work

    rows = map_texts(texts, make, fields, carry=["doc_id", "label"]).toArrow().sort_by("doc_id")
    got = [
        (np.asarray(c.values, dtype=np.int64), np.asarray(x.values, dtype=np.float64))
        for c, x in zip(rows["cols"], rows["vals"], strict=True)
    ]
    return fit(got, np.asarray(rows["label"], dtype=np.float64), (ones + 1) / (n + 2), word_dims)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def make():
        m = held.value
        return lambda texts: [[m.score(x) for x in texts]]

    return map_texts(narrow(docs, id_col, text_col), make, [T.StructField("score", T.DoubleType(), False)])


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Documents that score at least ``least``, with the columns they came with."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            yield b.filter(pa.array([m.score(x or b"") >= least for x in texts], type=pa.bool_()))

    tune(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
