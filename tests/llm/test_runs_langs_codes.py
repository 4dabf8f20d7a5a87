"""Operators 11 to 13 against brute force, on odd rows and on empty tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from billframe.llm import language_id, periodic_runs, vector_codes
from billframe.llm.common import crc_mod

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# --- 11 periodic runs -------------------------------------------------------


def brute_runs(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            begin = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            if i - begin >= q and i - begin + q >= least:
                at = (begin - q, i - begin + q)
                found[at] = min(found.get(at, q), q)
            i += i == begin
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def odd_words(rng):
    n, kinds = rng.choice([0, 1, 11, 12, 13, 24, 40, 90]), rng.choice([1, 2, 2, 3, 30])
    w = [b"w%d" % rng.randrange(kinds) for _ in range(n)]
    if n > 20 and rng.random() < 0.6:
        a, p = rng.randrange(10), rng.randint(1, 12)
        w = w[:a] + [w[a + i % p] for i in range(n - a)]
        if rng.random() < 0.5:
            w[rng.randrange(n)] = b"x"
    return w


def test_online_and_station_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        texts = [odd_words(rng) for _ in range(rng.randint(1, 4))]
        expected = [brute_runs(t) for t in texts]
        for cells in (0, periodic_runs.CELLS_PER_WORD, math.inf):
            assert periodic_runs.runs_of(texts, cells_per_word=cells) == expected
        assert periodic_runs.runs_of(texts, min_length=5) == [brute_runs(t, 5) for t in texts]


def test_runs_of_a_million_equal_words_and_of_two_words():
    rng = random.Random(4)
    same = [b"a"] * 1_000_000
    assert periodic_runs.runs_of([same]) == [[(0, 1_000_000, 1)]]
    assert periodic_runs.collapse(same, [(0, 1_000_000, 1)]) == b"a"
    binary = [b"%d" % rng.randrange(2) for _ in range(3000)]
    assert periodic_runs.runs_of([binary]) == [brute_runs(binary)]


def planted(doc_id, text):
    w = WORDS.findall(text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]


def run_digest(doc_id, text):
    w = planted(doc_id, text)
    runs = brute_runs(w) if len(w) < 5000 else periodic_runs.smallest_periods(periodic_runs.station_runs(np.unique(w, return_inverse=True)[1], 12))
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(top or (None, None, None)),
        1000 * top[1] // top[2] if top else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        sha(" ".join(t for i, t in enumerate(w) if i not in drop)),
    )


def test_periodic_runs_digest(spark, docs, rows, empty):
    rng = random.Random(8)
    more = [(1000 + i, b" ".join(odd_words(rng)).decode(), None, None, None) for i in range(60)]
    frame = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(more, empty.schema))
    got = periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.with_planted_runs(frame)))
    expected = [run_digest(r[0], r[1]) for r in rows + more]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(expected)
    assert sum(e[1] > 0 for e in expected) > 20
    assert periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.with_planted_runs(empty))).collect() == []


# --- 12 language identification ---------------------------------------------


def brute_grams(text):
    out = []
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        out += [g for n in language_id.LENGTHS for p in (f" {w} ",) for g in (p[i : i + n] for i in range(len(p) - n + 1)) if g.strip()]
    return out


def tongues(rng, n, words):
    forms = {"xx": "ba be bi bo bu ka ke".split(), "yy": "ra re ri ro ru ta tö".split(), "zz": "sch ich ach och ba ra".split()}
    out = []
    for i in range(n):
        lang = rng.choice(sorted(forms))
        out.append((i, " ".join("".join(rng.choice(forms[lang]) for _ in range(rng.randint(2, 4))) for _ in range(words)), lang))
    return out


def test_grams_equal_brute_force():
    texts = ["Ab cd, e. f1gh", "", "  ", "123 !", "É tå-z", "ab", "x" * 50 + " İi"]
    hashes, owners, lettered = language_id.grams([t.encode() for t in texts])
    assert lettered.tolist() == [any(c.isalpha() for c in t) for t in texts]
    for i, t in enumerate(texts):
        if "İ" in t:  # lower-casing adds a mark, which the brute force splits at
            continue
        assert collections.Counter(collections.Counter(hashes[owners == i].tolist()).values()) == collections.Counter(collections.Counter(brute_grams(t)).values())


def test_long_texts_are_counted_in_pieces(monkeypatch):
    rng = random.Random(7)
    texts = [" ".join("ab cd\nef".replace("a", rng.choice("xyzé")) for _ in range(rng.randint(0, 400))).encode() for _ in range(8)]
    texts += [b"", b"q" * 500, b"one " + b"w" * 300 + b" two\nthree" * 40]
    whole = [collections.Counter(language_id.grams([t])[0].tolist()) for t in texts]
    monkeypatch.setattr(language_id, "GROUP_BYTES", 64)
    counted = [collections.Counter() for _ in texts]
    for numbers, group in language_id._groups(texts):
        hashes, owners, _ = language_id.grams(group)
        for h, o in zip(hashes.tolist(), owners.tolist()):
            counted[numbers[o]][h] += 1
        assert len(group) == 1 or sum(map(len, group)) <= 64
    assert counted == whole


def test_filters_hold_what_was_learned_and_correct_false_positives(spark):
    rng = random.Random(2)
    rows = tongues(rng, 60, 40)
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), share=1e-3)
    assert model.languages == ["xx", "yy", "zz"]
    counts = {k: collections.Counter() for k in model.languages}
    for _, t, lang in rows:
        counts[lang].update(brute_grams(t))
    members = {k: {g for g in c if c[g] >= 1e-3 * c.total()} for k, c in counts.items()}
    texts = [t for _, t, _ in rows]
    hashes, owners, _ = language_id.grams([t.encode() for t in texts])
    masks = language_id.containing(model, hashes)[0]
    for i, t in enumerate(texts):
        g = brute_grams(t)
        for bit, k in enumerate(model.languages):
            exact, filtered = sum(x in members[k] for x in g), int(((masks[owners == i] >> np.uint64(bit)) & np.uint64(1)).sum())
            assert exact <= filtered <= exact + 0.1 * len(g)  # no member is missed
            share = (filtered / len(g) - model.false_rates[bit]) / (1 - model.false_rates[bit])
            assert language_id.shares(model, [t.encode()])[0][0, bit] == pytest.approx(max(0, share))
    assert len(set().union(*counts.values())) > 50 and (model.false_rates < 0.05).all()


def test_languages_of_held_out_and_odd_texts(spark, docs, rows, empty):
    rng = random.Random(5)
    frame = spark.createDataFrame(tongues(rng, 240, 6), "doc_id long, text string, lang string")
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = language_id.train(frame, learn=~held, share=1e-3)
    got = language_id.languages(frame.where(held), model).join(frame, "doc_id").collect()
    assert len(got) > 40 and sum(r["lang_pred"] == r["lang"] for r in got) >= 0.95 * len(got)
    odd = language_id.languages(docs, model).collect()
    assert collections.Counter(r["doc_id"] for r in odd) == collections.Counter(r[0] for r in rows)
    assert all(0 <= r["score"] <= 1 for r in odd)
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !"), (4, "漢字"), (5, "baba")], "doc_id long, text string")
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.languages(blank, model).collect()}
    assert [by_id[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert by_id[4] == (model.languages[model.commonest], 0.0) and by_id[5][0] in ("xx", "zz")
    assert language_id.languages(empty, model).collect() == []
    nothing = language_id.train(empty)
    assert {r["lang_pred"] for r in language_id.languages(docs, nothing).collect()} == {"und"}
    assert {r["lang_pred"] for r in language_id.languages(docs, language_id.train(docs.withColumn("lang", F.lit(None).cast("string")))).collect()} == {"und"}


def test_more_than_64_languages(spark):
    rows = [(i, chr(0x4E00 + i) * 3, f"l{i:03d}") for i in range(130)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(frame)
    assert model.words.shape[0] == 3
    assert all(r["lang_pred"] == f"l{r['doc_id']:03d}" for r in language_id.languages(frame, model).collect())


# --- 13 vector codes --------------------------------------------------------


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label), kept ones only."""
    size = max((len(v) for _, v, _ in rows), default=0)
    size += -size % parts
    ints = [[max(-(1 << 63) + 1, min((1 << 63) - 1, math.floor(4096 * x))) for x in v] + [0] * (size - len(v)) for _, v, _ in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, [math.floor(4096 * x) for x in rows[i][1]]))
    width = size // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in ints]
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = collections.defaultdict(list)
            for c in cut:
                groups[nearest(c[p], books[p])[1]].append(c[p])
            for e, xs in groups.items():
                books[p][e] = [sum(col) // len(xs) for col in zip(*xs)]
    coded = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    top = (1 << 63) - 1
    errors = [min(top, sum(d for d, _ in c)) for c in coded]
    by_label = collections.Counter()
    for (_, _, label), e in zip(rows, errors):
        by_label[label] += e
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return [
        (r[0], "".join(f"{e:02x}" for _, e in c), d, min(top, by_label[r[2]]), sha) for r, c, d in zip(rows, coded, errors)
    ], books


def vectors(rng, n, size=16):
    out = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.3:  # ties and repeats
            v = [rng.choice([-0.25, 0.0, 0.25]) for _ in range(size)]
        else:
            v = [rng.gauss(i % 5, 0.3) for _ in range(size)]
        out.append((i // 2 if i % 7 == 0 else i, v, rng.choice([0, 0, 0, 1, 2, None])))
    return out


SCHEMA = "vec_id long, embedding array<double>, label int"


def kept_rows(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


@pytest.mark.parametrize("case", ["plain", "large", "uneven", "few"])
def test_codes_equal_brute_force(spark, case):
    rng = random.Random(11)
    rows = vectors(rng, 9 if case == "few" else 80)
    rows += [(500, None, 1), (501, [None] + [0.0] * 15, 1), (502, [math.nan] * 16, 1), (503, [math.inf] + [0.0] * 15, 0), (None, [0.5] * 16, None)]
    if case == "large":
        rows += [(600, [1e9] * 16, 0), (601, [-1e17] * 16, 3), (602, [1e300] + [0.0] * 15, 3)]
    if case == "uneven":
        rows += [(700, [0.5] * 11, 0), (701, [], 0)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "vec_id as code", "vec_id as error", "vec_id as rows", "vec_id as v").repartition(3)
    codes, books = vector_codes.compress(frame)
    expected, expected_books = brute_codes(kept_rows(rows))
    assert books == expected_books
    assert collections.Counter(map(tuple, vector_codes.digest(codes, books).collect())) == collections.Counter(expected)
    if case == "plain":
        for r in vector_codes.decode(codes, books).collect():
            width = len(books[0][0])
            assert r["vector"] == [v for p, e in enumerate(r["code"]) for v in books[p][e]] and len(r["vector"]) == 8 * width


def test_tree_is_exact_and_takes_fewer_distances():
    rng = np.random.default_rng(1)
    entries = rng.integers(-50, 50, (60, 3)).astype(np.int64)
    entries[7] = entries[3]
    x = np.concatenate([rng.integers(-60, 60, (4000, 3)), entries]).astype(np.int64)
    best, least, taken = vector_codes.nearest_entries(vector_codes.build_tree(entries), entries, x)
    d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (best == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
    assert taken < 0.6 * d.size


def test_no_vectors(spark):
    for rows in ([], [(1, None, 0)]):
        codes, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
        assert books == [] and vector_codes.digest(codes, books).collect() == []
