"""License scan: MinHash bands over overlapping windows retrieve templates, containment verifies them.

A template is a licence notice, as words (runs of letters and digits, lower
case) and shingles of five words. Templates are put in grades by size: a grade
L takes those of L/2 < m <= L shingles (the least grade all small ones). For
each grade a text is cut into windows of 2 L shingles, one every L, so every
passage of L shingles lies whole in some window and a template contained to a
part c has a Jaccard similarity with that window of at least c m / (2 L + (1 -
c) m).

Bands: with ``BANDS`` bands of one MinHash each, a window of similarity J
meets its template with probability 1 - (1 - J) ** BANDS. At the verified
containment of 0.8 the least J of any grade is above 0.19, so at 96 bands the
chance of a miss is below 2e-9. A band of one hash is selective enough here,
since a window and a template that share no shingle never meet.

A template so small that it must be contained whole (at 0.8 up to four
shingles) needs no bands: the shingles of these are looked up one by one.

Verification is exact, on words: the window, widened by L shingles on either
side, must hold at least 0.8 of the template's distinct shingles. A match is
reported with its span of words, from the first to the last shingle of the
template that the widened window holds; overlapping matches of a licence are
one, however many of its templates match. A family's name (GPL) gives way to a
member (GPL-3.0) that overlaps it.

A licence whose text holds most of another's is reported beside it (BSD-2-Clause
in BSD-3-Clause, GPL-3.0 in texts derived from it); containment tells them apart.

Scale: texts are scanned where they lie, without a shuffle; templates are
configuration, read from a table whose size is checked.

Templates of three and four words have no shingle; they are looked up whole, as
sequences of words, and reported with containment 1.

Edge cases: NULL and empty texts and texts under three words match nothing;
templates under three words, empty or NULL ones are left out; templates that
repeat a name are all searched and reported under it; texts are read whole.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billframe.llm.common import kept_in_worker, map_texts, narrow
from billframe.llm.licence_templates import BRIEF
from billframe.llm.licence_templates import templates as public_templates

SHINGLE, CONTAINMENT = 5, 0.8
BANDS, LEAST_GRADE = 96, 2
#: Characters that all templates together may have: they travel to every task.
TEMPLATE_CHARS = 4_000_000
#: Bits of the table that tells whether a MinHash value occurs in any template.
TABLE_BITS = 18
_TABLE = np.uint64((1 << TABLE_BITS) - 1)
#: Blocks up to this size are padded and halved; beyond, those of each text are paired by themselves.
PADDED = 32

# Whole texts and announcements, and short notices that public licences ask for.
TEMPLATES = [
    *public_templates(),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("BSD", "Use of this source code is governed by a BSD-style license"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "GPL",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    ("MIT", "Released under the MIT License"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]

_SPLIT = re.compile(rb"[0-9a-z\x80-\xff]+")
_FIELDS = [
    T.StructField(
        "matches",
        T.ArrayType(
            T.StructType(
                [
                    T.StructField("license", T.StringType()),
                    T.StructField("containment", T.DoubleType()),
                    T.StructField("first_word", T.LongType()),
                    T.StructField("last_word", T.LongType()),
                ]
            )
        ),
        False,
    )
]
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)


_PLACE = _constants(SHINGLE, 3)
_POWERS = np.cumprod(np.full(64, 1_099_511_628_211, dtype=np.uint64))
_HASHES = _constants(BANDS, 5)


def word_hashes(raw: bytes) -> tuple[list[bytes], np.ndarray]:
    """Words of a text and a hash of each: a polynomial in the bytes, beyond 64 bytes wrapped."""
    low = raw.lower()
    ws = _SPLIT.findall(low)
    if not ws:
        return ws, np.empty(0, dtype=np.uint64)
    sizes = np.fromiter(map(len, ws), dtype=np.int64, count=len(ws))
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    data = np.frombuffer(b"".join(ws), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    at = np.arange(len(data)) - np.repeat(starts, sizes)
    h = np.add.reduceat(data * _POWERS[at % 64], starts)
    return ws, _mix(h + sizes.astype(np.uint64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_hashes(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles, from those of the words."""
    n = len(h) - size + 1
    if n < 1:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += h[k : k + n] * _PLACE[k]
    return _mix(total)


def grade(n_shingles: int) -> int:
    size = LEAST_GRADE
    while size < n_shingles:
        size *= 2
    return size


class Scanner:
    """Shingles of the small templates and band tables, by grade, of the others."""

    def __init__(self, templates: list[tuple[str, bytes]], containment: float):
        self.containment = containment
        self.templates: list[tuple[str, set]] = []
        self.grades: dict[int, tuple[np.ndarray, list[dict[int, list[int]]]]] = {}
        self.least: dict[int, int] = {}  # shingles of the smallest template of a grade
        self.small: dict[int, list[tuple[int, int]]] = {}
        self.small_bits = np.zeros(1 << TABLE_BITS, dtype=bool)
        self.brief: dict[tuple, list[str]] = {}
        self.brief_bits = {n: np.zeros(1 << TABLE_BITS, dtype=bool) for n in range(BRIEF, SHINGLE)}
        for name, raw in templates:
            ws, h = word_hashes(raw)
            if len(ws) in self.brief_bits:
                self.brief.setdefault(tuple(ws), []).append(name)
                self.brief_bits[len(ws)][int(shingle_hashes(h, len(ws))[0] & _TABLE)] = True
            sh = shingle_hashes(h)
            if not len(sh):
                continue
            t, size = len(self.templates), grade(len(sh))
            own = {tuple(ws[i : i + SHINGLE]) for i in range(len(sh))}
            self.templates.append((name, own))
            if (len(own) - 1) / len(own) < containment:
                for v in set(sh.tolist()):
                    self.small.setdefault(v, []).append((size, t))
                self.small_bits[(sh & _TABLE).view(np.int64)] = True
                continue
            self.least[size] = min(self.least.get(size, len(own)), len(own))
            bits, tables = self.grades.setdefault(
                size, (np.zeros(1 << TABLE_BITS, dtype=bool), [{} for _ in range(BANDS)])
            )
            for band, c in enumerate(_HASHES):
                v = (sh * c).min()
                tables[band].setdefault(int(v), []).append(t)
                bits[int(v & _TABLE)] = True

    def candidates(self, shingles: list[np.ndarray]) -> list[set[tuple[int, int, int]]]:
        """For each text the (size, window, template) that share a band or, of small templates, a
        shingle; window w of a grade covers the shingles from w * size on. Texts lie one after the
        other, each in whole blocks; a window over a border belongs to the text it begins in."""
        found: list[set[tuple[int, int, int]]] = [set() for _ in shingles]
        if not shingles:
            return found
        n = np.array([len(sh) for sh in shingles])
        flat = np.concatenate(shingles)
        ends = np.cumsum(n)
        for at in np.flatnonzero(self.small_bits[(flat & _TABLE).view(np.int64)]).tolist():
            for size, t in self.small.get(int(flat[at]), ()):
                doc = int(np.searchsorted(ends, at, side="right"))
                found[doc].add((size, (at - int(ends[doc] - n[doc])) // size, t))
        if not self.grades:
            return found
        widest = max(self.grades)
        base = min(PADDED, widest)
        blocks = -(-n // base)
        starts = (np.cumsum(blocks) - blocks) * base
        data = np.zeros(int(blocks.sum()) * base, dtype=np.uint64)
        padding = np.ones(len(data), dtype=bool)
        for sh, at in zip(shingles, starts.tolist(), strict=True):
            data[at : at + len(sh)] = sh
            padding[at : at + len(sh)] = False
        pad = np.flatnonzero(padding)
        levels = self._levels(n, base, blocks, starts)
        for band, c in enumerate(_HASHES):
            values = data * c
            values[pad] = _NONE
            for size, pairs, looked in levels:
                values = np.minimum(values[::2], values[1::2]) if pairs is None else np.minimum.reduceat(values, pairs)
                if looked is None:
                    continue
                owner, first, long_enough = looked
                bits, tables = self.grades[size]
                least = np.minimum(values, np.append(values[1:], _NONE))
                for w in np.flatnonzero(bits[(least & _TABLE).view(np.int64)] & long_enough).tolist():
                    for t in tables[band].get(int(least[w]), ()):
                        found[owner[w]].add((size, w - int(first[owner[w]]), t))
        return found

    def _levels(self, n: np.ndarray, base: int, blocks: np.ndarray, starts: np.ndarray) -> list[tuple]:
        """(size, first blocks of the pairs to unite, how to look blocks up) of every level up to the widest
        that any of the texts, of ``n`` shingles, is long enough for."""
        levels = []
        wanted = {size: n >= self.containment * self.least[size] for size in self.grades}
        last = max((size for size, ok in wanted.items() if ok.any()), default=1)
        size, held, first = 1, blocks * base, starts
        while size < last:
            pairs = None
            if size < base:
                held, first = held // 2, first // 2
            else:
                own = np.arange(held.sum()) - np.repeat(first, held)
                pairs = np.flatnonzero(own % 2 == 0)
                held = -(-held // 2)
                first = np.cumsum(held) - held
            size *= 2
            looked = None
            if size in wanted:
                owner = np.repeat(np.arange(len(n)), held)
                looked = owner, first, wanted[size][owner]
            levels.append((size, pairs, looked))
        return levels

    def scan(self, texts: list[bytes]) -> list[list[dict]]:
        """Verified matches of each text."""
        out = []
        for i in range(0, len(texts), 64):
            hashed = [word_hashes(x) for x in texts[i : i + 64]]
            shingles = [shingle_hashes(h) for _, h in hashed]
            noted = self.noted(hashed)
            out += [self.verified(ws, c, b) for (ws, _), c, b in zip(hashed, self.candidates(shingles), noted, strict=True)]
        return out

    def noted(self, hashed: list[tuple[list[bytes], np.ndarray]]) -> list[list[tuple[str, int, int]]]:
        """(name, first word, last word) of the brief notices of each text."""
        found: list[list[tuple[str, int, int]]] = [[] for _ in hashed]
        ends = np.cumsum([len(h) for _, h in hashed])
        flat = np.concatenate([h for _, h in hashed])
        for n, bits in self.brief_bits.items():
            for at in np.flatnonzero(bits[(shingle_hashes(flat, n) & _TABLE).view(np.int64)]).tolist():
                doc = int(np.searchsorted(ends, at, side="right"))
                ws = hashed[doc][0]
                i = at - int(ends[doc]) + len(ws)
                found[doc] += [(name, i, i + n - 1) for name in self.brief.get(tuple(ws[i : i + n]), ())]
        return found

    def verified(self, ws: list[bytes], candidates: set[tuple[int, int, int]], noted: list[tuple[str, int, int]]) -> list[dict]:
        """The candidates of one text whose widened window contains the template, and its brief notices."""
        spans: dict[str, list] = {}
        for name, first, last in noted:
            spans.setdefault(name, []).append((first, last, 1.0))
        n = len(ws) - SHINGLE + 1
        for size, w, t in sorted(candidates):
            name, wanted = self.templates[t]
            a, b = max(0, (w - 1) * size), min(n, (w + 3) * size)
            held = [i for i in range(a, b) if tuple(ws[i : i + SHINGLE]) in wanted]
            part = len({tuple(ws[i : i + SHINGLE]) for i in held}) / len(wanted)
            if part >= self.containment:
                spans.setdefault(name, []).append((held[0], held[-1] + SHINGLE - 1, part))
        out = []
        for name, found in spans.items():
            runs: list[list] = []
            for first, last, part in sorted(found):
                if runs and first <= runs[-1][1]:
                    runs[-1] = [runs[-1][0], max(last, runs[-1][1]), max(part, runs[-1][2])]
                else:
                    runs.append([first, last, part])
            out += [{"license": name, "containment": p, "first_word": a, "last_word": b} for a, b, p in runs]
        out = [
            m
            for m in out
            if not any(
                x["license"].startswith(m["license"] + "-")
                and x["first_word"] <= m["last_word"]
                and m["first_word"] <= x["last_word"]
                for x in out
            )
        ]
        return sorted(out, key=lambda m: (m["first_word"], m["license"], m["last_word"]))


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license string, text string")


def license_matches(
    docs: DataFrame,
    templates: DataFrame,
    containment: float = CONTAINMENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id and matches (license, containment, first_word, last_word) of every row.

    ``templates``: license, text.
    """
    known = templates.where(F.col("text").isNotNull() & F.col("license").isNotNull())
    size = known.agg(F.sum(F.length("text"))).first()[0] or 0
    if size > TEMPLATE_CHARS:
        raise ValueError(f"templates have {size} characters; at most {TEMPLATE_CHARS} are configuration")
    rows = sorted((r.license, r.text.encode()) for r in known.select("license", "text").toLocalIterator())
    held = docs.sparkSession.sparkContext.broadcast(rows)

    def make():
        scanner = kept_in_worker(
            ("licences", containment, hash(tuple(held.value))), lambda: Scanner(held.value, containment)
        )
        return lambda texts: [scanner.scan(texts)]

    return map_texts(narrow(docs, id_col, text_col), make, _FIELDS)
