"""Operator 12: language of every text by language-bitmask n-gram filters.

Method: the n-grams of a language are kept in a Bloom filter; the filters of all
languages share slots and hash functions and are stored bit-sliced, one bit of a
slot's word for each language, so that the AND of an n-gram's slots is the
bitmask of all languages that (seem to) contain it. A text's popcount for a
language is the number of its n-grams with that bit. With the false-positive
rate ``f`` of the language's filter (its fill to the power of the hash
functions, counted on the built filter) the share of n-grams known to it is
``(popcount / n - f) / (1 - f)``; the greatest share decides and is the score.

N-grams are of 1 to 4 characters of a lower-cased word (letters and the marks on
them) with a blank before and after it. An n-gram belongs to a language if it
makes up at least ``SHARE`` of the n-grams of all its learning texts, so the odd
foreign passage does not, and a language has at most 1 / SHARE n-grams however
large the corpus is. That bounds the filter: at most 2^21 slots, each a word of
64 bits for every 64 languages.

Plan: learning counts n-grams within every task (whole texts), then by
(language, n-gram) over a hash shuffle of the tasks' distinct n-grams; slots are
made by a second aggregation and fetched (bounded as above). Scoring is one pass
in Arrow batches with the filter broadcast, no shuffle. Long texts are counted in
pieces cut at spaces, so memory does not grow with a text (but with one unbroken word).

Edge cases: a text that is NULL or has no letter is ``und`` with score 0, as is
every text when nothing was learned; equal shares go to the language first in
order; a text none of whose n-grams is known goes to the language with most
learning texts' n-grams, with score 0. Repeated rows and ids give a row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billframe.llm.common import kept_in_worker, map_texts, narrow, tune, write_stage

LENGTHS = (1, 2, 3, 4)
#: Least share of a language's n-grams that makes an n-gram its own.
SHARE = 1e-5
#: Slots looked at for an n-gram, of 21 bits of its hash each.
HASHES = 3
SLOT_BITS = 21
#: Slots for each n-gram of the language with most of them.
SLOTS_PER_GRAM = 16
MAX_LANGUAGES = 1024
#: Texts are taken together up to this many bytes.
GROUP_BYTES = 1 << 20
#: Distinct n-grams that a learning task holds before it hands them on.
HELD_GRAMS = 1 << 20
UNDETERMINED = "und"


def _classes() -> np.ndarray:
    """For each code point 1 if it is a letter, 2 if it is a mark, else 0."""
    import sys
    import unicodedata

    kinds = {"L": 1, "M": 2}
    return np.array([kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)], dtype=np.uint8)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and number of the text of every n-gram, and for each text whether it has a letter."""
    classes = kept_in_worker(("character classes",), _classes)
    lowered = [t.decode("utf-8", "replace").lower() for t in texts]
    codes = np.frombuffer("".join(f" {t} " for t in lowered).encode("utf-32-le", "replace"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in lowered])
    kind = classes[codes]
    lettered = np.bincount(owner[kind == 1], minlength=len(texts)) > 0
    inside = kind > 0
    beside = inside.copy()  # word characters and the blanks next to them
    beside[1:] |= inside[:-1]
    beside[:-1] |= inside[1:]
    codes, owner, inside = codes[beside], owner[beside], inside[beside]
    codes = np.where(inside, codes, np.uint32(0x20)).astype(np.uint64)
    hashes, owners = [], []
    h = np.zeros(len(codes), dtype=np.uint64)
    middle = np.ones(len(codes), dtype=bool)  # the characters but the first and the last are of one word
    for n in LENGTHS:
        if len(codes) < n:
            break
        size = len(codes) - n + 1
        h = h[:size] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(1)
        if n > 2:
            middle = middle[:size] & inside[n - 2 : n - 2 + size]
        at = np.flatnonzero(middle if n > 2 else inside[:size] | inside[n - 1 :])
        x = h[at] + np.uint64(n)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        hashes.append(x)
        owners.append(owner[at])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), lettered
    return np.concatenate(hashes), np.concatenate(owners), lettered


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of GROUP_BYTES at most, cut at spaces and line ends, where no n-gram crosses."""
    first = 0
    while len(text) - first > GROUP_BYTES:
        at = max(text.rfind(b" ", first, first + GROUP_BYTES), text.rfind(b"\n", first, first + GROUP_BYTES))
        if at <= first:  # one unbroken stretch
            ends = [x for x in (text.find(b" ", first + 1), text.find(b"\n", first + 1)) if x >= 0]
            if not ends:
                break
            at = min(ends)
        yield text[first:at]
        first = at
    yield text[first:]


def _groups(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Pieces of the texts, together GROUP_BYTES at most or one piece, with the numbers of their texts."""
    numbers: list[int] = []
    held: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        for piece in _pieces(text):
            if held and size + len(piece) > GROUP_BYTES:
                yield numbers, held
                numbers, held, size = [], [], 0
            numbers.append(i)
            held.append(piece)
            size += len(piece)
    if held:
        yield numbers, held


def _gram_counts(learning: DataFrame) -> DataFrame:
    """lang, gram, n: counted within each task, in parts of a bounded number of n-grams."""
    out = "lang string, gram long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pd.Series]] = {}
        size = 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                n = pd.concat(parts).groupby(level=0, sort=False).sum()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), pa.array(n.index.to_numpy().view(np.int64)), pa.array(n.to_numpy(), pa.int64())],
                    names=["lang", "gram", "n"],
                )

        for b in batches:
            langs, texts = np.array(b.column("lang").to_pylist(), dtype=object), b.column("text").to_pylist()
            for lang in sorted(set(langs)):
                mine = [texts[i] for i in np.flatnonzero(langs == lang)]
                for _, group in _groups(mine):
                    n = pd.Series(grams(group)[0]).value_counts(sort=False)
                    held.setdefault(lang, []).append(n)
                    size += len(n)
                if size > 4 * HELD_GRAMS:
                    held = {k: [pd.concat(v).groupby(level=0, sort=False).sum()] for k, v in held.items()}
                    size = sum(len(v[0]) for v in held.values())
                    if size > HELD_GRAMS:
                        yield from hand_on()
                        held, size = {}, 0
        yield from hand_on()

    tune(learning.sparkSession)
    return learning.mapInArrow(run, out).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Filters:
    """The bit-sliced filters: ``words[w][slot]`` holds a bit for each of languages 64 w to 64 w + 63."""

    languages: list[str]
    words: np.ndarray
    false_rates: np.ndarray
    commonest: int


def train(docs: DataFrame, learn: Column | None = None, share: float = SHARE) -> Filters:
    """Filters of all languages, from the texts of rows with a text, a ``lang`` and ``learn`` true."""
    if not 2 ** (SLOT_BITS - 4) * share >= 1:
        raise ValueError("share too small for the number of slots")
    spark = docs.sparkSession
    known = F.col("text").isNotNull() & F.col("lang").isNotNull()
    learning = docs.where(known if learn is None else known & learn)
    counts = write_stage(_gram_counts(learning.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))), "language-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    found = totals.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r["lang"] for r in found]
    if not languages:
        return Filters([], np.zeros((0, 1), np.uint64), np.zeros(0), 0)
    number = spark.createDataFrame([(r["lang"], i, float(r["total"])) for i, r in enumerate(found)], "lang string, number int, total double")
    members = counts.join(F.broadcast(number), "lang").where(F.col("n") >= F.col("total") * share).select("number", "gram")
    most = members.groupBy("number").count().agg(F.max("count")).first()[0] or 1
    bits = min(SLOT_BITS, max(6, (SLOTS_PER_GRAM * most - 1).bit_length()))
    slots = F.array(*[F.shiftrightunsigned("gram", SLOT_BITS * j).bitwiseAND(F.lit((1 << bits) - 1).cast("long")) for j in range(HASHES)])
    bit = F.expr("shiftleft(1L, number % 64)")
    rows = (
        members.select((F.col("number") / 64).cast("int").alias("word"), bit.alias("bit"), F.explode(slots).alias("slot"))
        .groupBy("word", "slot").agg(F.bit_or("bit").alias("bits")).toPandas()
    )
    words = np.zeros(((len(languages) + 63) // 64, 1 << bits), dtype=np.uint64)
    words[rows["word"].to_numpy(), rows["slot"].to_numpy()] = rows["bits"].to_numpy().astype(np.int64).view(np.uint64)
    fill = np.array([((words[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
    return Filters(languages, words, fill**HASHES, int(np.argmax([r["total"] for r in found])))


def containing(filters: Filters, hashes: np.ndarray) -> np.ndarray:
    """For each n-gram the bitmask of the languages containing it, in words of 64 languages."""
    last = np.uint64(filters.words.shape[1] - 1)
    found = None
    for j in range(HASHES):
        slot = ((hashes >> np.uint64(SLOT_BITS * j)) & last).astype(np.int64)
        mask = filters.words[:, slot]
        found = mask if found is None else found & mask
    return found


def shares(filters: Filters, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Corrected share of every text's n-grams known to each language, and whether it has a letter."""
    n = np.zeros(len(texts))
    popcounts = np.zeros((len(texts), len(filters.languages)))
    lettered = np.zeros(len(texts), dtype=bool)
    for numbers, group in _groups(texts):
        hashes, owners, has = grams(group)
        masks = containing(filters, hashes)
        np.add.at(n, numbers, np.bincount(owners, minlength=len(group)))
        np.logical_or.at(lettered, numbers, has)
        for i in range(len(filters.languages)):
            hit = (masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            np.add.at(popcounts[:, i], numbers, np.bincount(owners, weights=hit, minlength=len(group)))
    rates = filters.false_rates
    # A filter with every bit set says nothing.
    corrected = (popcounts / np.maximum(n, 1)[:, None] - rates) / np.where(rates < 1, 1 - rates, 1)
    return np.where(rates < 1, np.clip(corrected, 0, 1), 0), lettered


def languages(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def make():
        model = sent.value

        def work(texts: list[bytes]):
            if not model.languages:
                return [[UNDETERMINED] * len(texts), [0.0] * len(texts)]
            found, lettered = shares(model, texts)
            best = np.where(found.any(axis=1), found.argmax(axis=1), model.commonest)
            score = np.where(lettered, found[np.arange(len(texts)), best], 0.0)
            return [[model.languages[i] if ok else UNDETERMINED for i, ok in zip(best, lettered.tolist())], score.tolist()]

        return work

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return map_texts(narrow(docs, id_col, text_col), make, fields)
