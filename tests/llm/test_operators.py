"""Every operator against a brute-force version, on odd rows and on empty tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from billframe.llm import (
    decontaminate,
    extract_main,
    licence_scan,
    line_dedup,
    lm_lattice,
    mixture,
    quality_fm,
    quality_rules,
    simhash,
    token_count,
)
from billframe.llm.common import crc_mod
from billframe.llm.components import connected_components
from billframe.llm.queries import tokenizer_file

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").encode().lower().decode()


def bag(rows):
    return collections.Counter(map(repr, rows))


# --- 1 licence scan ---------------------------------------------------------


def test_license_matches_equal_containment_search(spark, docs, rows):
    rng = random.Random(2)
    notice = dict(licence_scan.TEMPLATES)["GPL"]
    ws = notice.split()
    ws[7] = "may"  # four shingles of 25 lost
    more = [(900, " ".join(["x"] * 37) + " " + " ".join(ws) + " y z"), (901, " ".join(rng.sample(ws, len(ws))))]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = licence_scan.license_matches(frame, licence_scan.template_table(spark)).collect()
    split = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
    wanted = []
    for name, text in licence_scan.TEMPLATES:
        w = split(text)
        wanted.append((name, {tuple(w[i : i + 5]) for i in range(len(w) - 4)}))
    expected = []
    for i, t in [(r[0], r[1]) for r in rows] + more:
        w = split(t)
        sh = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        hits = set()
        for name, tpl in wanted:
            reach = 2 * licence_scan.grade(len(tpl))
            if any(len(tpl.intersection(sh[k : k + reach])) >= 0.8 * len(tpl) for k in range(len(sh)) if sh[k] in tpl):
                hits.add(name)
        expected.append((i, sorted(hits)))
    assert bag((r.doc_id, sorted({m["license"] for m in r.matches})) for r in got) == bag(expected)
    assert ["GPL"] in [sorted({m["license"] for m in r.matches}) for r in got if r.doc_id == 900]
    assert any(h for _, h in expected if h == ["MIT"])


def test_license_templates_are_checked(spark, docs):
    odd = spark.createDataFrame([("a", None), (None, "b " * 9), ("c", "too short")], "license string, text string")
    assert all(r.matches == [] for r in licence_scan.license_matches(docs, odd).collect())
    with pytest.raises(ValueError):
        licence_scan.license_matches(docs, spark.createDataFrame([("a", "x" * 4_000_001)], "license string, text string"))


def test_common_licences_and_wordings_are_found():
    found = licence_scan.Scanner([(k, t.encode()) for k, t in licence_scan.TEMPLATES], licence_scan.CONTAINMENT)
    names = lambda text: {m["license"] for m in found.scan([text.encode()])[0]}
    for text, wanted in (
        ("Licensed under the MIT License", "MIT"),
        ("This project is licensed under the MIT license.", "MIT"),
        ("Licensed under CC BY 4.0", "CC-BY-4.0"),
        ("Photos: CC BY-NC 3.0", "CC-BY-NC-3.0"),
        ("This work is under a Creative Commons Attribution-ShareAlike 3.0 Unported licence", "CC-BY-SA-3.0"),
        ("free software under the GNU Lesser General Public License v2.1", "LGPL-2.1"),
        ("released under the terms of the GNU GPL version 2", "GPL-2.0"),
        ("SPDX-License-Identifier: AGPL-3.0-or-later", "AGPL-3.0"),
        ("distributed under the GNU General Public License.", "GPL"),
    ):
        assert names(text) == {wanted}, text
    whole = dict(reversed(licence_scan.TEMPLATES))  # the first of each name
    for name in ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "MPL-2.0"):
        texts = ["", "y", "before " * 500 + whole[name] + " behind" * 9000, "x y " * 3000] * 20
        assert [name in {m["license"] for m in found} for found in found.scan([x.encode() for x in texts])] == [False, False, True, False] * 20
    mit = next(t for k, t in licence_scan.TEMPLATES if k == "MIT")
    assert names(mit[mit.index("The above copyright") :]) == {"MIT"}
    bsd = next(t for k, t in licence_scan.TEMPLATES if k == "BSD-2-Clause")
    assert names(bsd[bsd.index("THIS SOFTWARE IS") :]) == {"BSD"}


# --- 2 quality rules --------------------------------------------------------


def count_words(text):
    ws = WORDS.findall(text or "")
    grams = [tuple(ws[k : k + 3]) for k in range(len(ws) - 2)]
    often = collections.Counter(grams)
    hit = {k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_rule_counts(docs, rows, labels):
    got = quality_rules.quality_rules(docs, labels).collect()
    mine = bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    expected = []
    for r in rows:
        c = count_words(r[1])
        expected.append((r[0], *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert mine == bag(expected)
    assert all(r.kept == (not r.base_failed) for r in got)  # too few labels to certify any cutoff


def test_thresholds_are_the_strictest_that_the_exact_bound_certifies(spark):
    rng = random.Random(3)
    risk, delta = 0.02, 0.05
    data = [(s, rng.random() < 0.9, *(rng.betavariate(1, 30) for _ in quality_rules.CANDIDATES)) for s in ("en", None) for _ in range(900)]
    schema = "stratum string, good boolean, " + ", ".join(f"{m} double" for m in quality_rules.CANDIDATES)
    got = {(r.stratum, r.metric): r.cutoff for r in quality_rules.thresholds(spark.createDataFrame(data, schema), risk, delta).collect()}
    level = delta / (2 * len(quality_rules.CANDIDATES))
    expected = {}
    for s in ("en", None):
        good = [r for r in data if r[0] == s and r[1]]
        for j, (m, cuts) in enumerate(quality_rules.CANDIDATES.items()):
            for c in sorted(cuts, reverse=True):
                k = sum(r[2 + j] > c for r in good)
                if sum(math.comb(len(good), i) * risk**i * (1 - risk) ** (len(good) - i) for i in range(k + 1)) > level:
                    break
                expected[s, m] = c
    assert got == expected and expected


def test_joint_verdict_keeps_the_risk_where_single_cutoffs_do_not(spark):
    names = list(quality_rules.CANDIDATES)
    n, risk, delta = 4000, 0.02, 0.05
    # every metric exceeds all its cutoffs in 1 % of the good texts, each in others
    data = [("en", True, *(100.0 if i % 100 == j else 0.0 for j in range(len(names)))) for i in range(n)]
    schema = "stratum string, good boolean, " + ", ".join(f"{m} double" for m in names)
    frame = spark.createDataFrame(data, schema)
    alone = {r.metric: r.cutoff for r in quality_rules.thresholds(frame, risk, delta).collect()}
    over = sum(any(x > alone.get(m, 1e9) for m, x in zip(names, r[2:], strict=True)) for r in data)
    assert over > risk * n  # all seven cutoffs are certified, their union rejects 7 %
    got = quality_rules.joint_thresholds(frame, risk, delta).collect()
    assert len(got) == 1 and got[0].stratum == "en"
    rejected = lambda cuts: sum(any(c is not None and x > c for c, x in zip(cuts, r[2:], strict=True)) for r in data)
    assert rejected([got[0][m] for m in names]) == 40  # one metric in a hundred texts; a second would be 2 %
    strict = [min((c for of, c in quality_rules.SEQUENCE[:2] if of == m), default=None) for m in names]
    k = rejected(strict)
    assert sum(math.comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1)) > delta


# --- 3 language model -------------------------------------------------------


def test_lattice_sums_all_segmentations():
    pieces = ["▁", "a", "b", "▁a", "ab", "ba", "▁ab", *(f"<0x{b:02X}>" for b in range(256))]
    rng = random.Random(1)
    probs = [rng.random() + 0.01 for _ in pieces]
    total = sum(probs)
    lattice = lm_lattice.Lattice(pieces, __import__("numpy").log([p / total for p in probs]))
    p = dict(zip(pieces, (x / total for x in probs), strict=True))

    def spell(text):
        if not text:
            return 1.0
        out = sum(p[x] * spell(text[len(x) :]) for x in pieces if len(x) < 6 and text.startswith(x))
        if text[0] not in p:
            out += math.prod(p[f"<0x{b:02X}>"] for b in text[0].encode()) * spell(text[1:])
        return out

    for w in ("a", "ab", "abba", "aéb", "漢a", "bbabab"):
        assert math.isclose(math.exp(lattice.log_marginal(w)), spell("▁" + w), rel_tol=1e-9)
        counts = __import__("numpy").zeros(len(pieces))
        lattice.expect(w, 1.0, counts)  # every segmentation covers all characters
        covered = sum(c * (len(x) if len(x) < 6 else 1 / len("é".encode() if w == "aéb" else "漢".encode())) for x, c in zip(pieces, counts, strict=True))
        assert math.isclose(covered, len(w) + 1, rel_tol=1e-6)


def test_lm_scores(spark, docs, rows):
    model = tokenizer_file("piece_bpe_32k.model")
    got = lm_lattice.lm_scores(docs, model, crc_mod(F.col("doc_id"), 7) == 2).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = collections.Counter()
    for r in rows:
        if not held(r[0]):
            c.update(WORDS.findall(lower(r[1])))
    ends = sum(not held(r[0]) for r in rows)
    n, v = sum(c.values()) + ends, len(c) + 1
    expected = []
    for r in rows:
        ws = WORDS.findall(lower(r[1]))
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws) + math.log10((ends + 1) / (n + v + 1))
        expected.append((r[0], held(r[0]), len(ws) + 1, sum(w in c for w in ws) + 1, n, round(base, 4)))
    assert bag((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == bag(expected)
    assert all(r.score < 0 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert abs(by_id[34].score - by_id[35].score) < 1e-9  # NULL and empty: the end alone


def test_lm_without_training_rows(empty, docs):
    model = tokenizer_file("piece_bpe_32k.model")
    assert lm_lattice.lm_scores(empty, model, F.lit(False)).count() == 0
    r = lm_lattice.lm_scores(docs.where("doc_id = 0"), model, F.lit(True)).first()
    assert r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score)


# --- 4 classifier -----------------------------------------------------------


def test_pair_term_equals_the_double_sum():
    rng = __import__("numpy").random.default_rng(0)
    m = quality_fm.Model(0.3, rng.normal(size=20), rng.normal(size=(20, 4)), 8)
    cols, vals = __import__("numpy").array([1, 4, 5, 11]), rng.normal(size=4)
    pairs = sum(float(m.factors[a] @ m.factors[b]) * x * y for (a, x), (b, y) in itertools.combinations(zip(cols, vals, strict=True), 2))
    assert math.isclose(m.margin(cols, vals), 0.3 + float(m.linear[cols] @ vals) + pairs)


def test_classifier_learns_and_scores_everything(spark, docs, rows, labels, empty):
    rng = random.Random(8)
    good = [" ".join(rng.choice(["the", "of", "and", "river", "stone"]) for _ in range(60)) for _ in range(150)]
    bad = [" ".join(rng.choice(["BUY!!", "###", "$$$ now", "|"]) for _ in range(60)) for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i < 150)) for i in range(300)], "doc_id long, quality int")
    model = quality_fm.train(frame, marks, learn=crc_mod(F.col("doc_id"), 3) != 1)
    got = quality_fm.scores(frame, model).collect()
    assert all((r.score >= 0.5) == (r.doc_id < 150) for r in got)
    assert quality_fm.scores(docs, model).count() == len(rows)
    kept = quality_fm.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() <= len(rows)
    one = quality_fm.train(docs, labels.where("quality = 1"))  # a single label
    assert all(0.5 < r.score < 1 for r in quality_fm.scores(docs, one).collect())
    assert quality_fm.scores(empty, quality_fm.train(empty, labels.limit(0))).count() == 0


# --- 5 token counts ---------------------------------------------------------


def test_token_counts_equal_the_library(docs, rows, empty):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    expected = bag((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False))) for r in rows)
    for chunk in (32_768, 7):
        got = token_count.token_counts(docs, path, chunk_chars=chunk).collect()
        assert bag((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == expected
    assert token_count.token_counts(empty, path).count() == 0


def test_transducer_on_random_strings():
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    library, machine = Tokenizer.from_file(path), token_count.Transducer(path, max_states=500)
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab c'sretvlld \n\t1é漢!.?😀 THE") for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    assert [machine.count(t) for t in texts] == [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    for t in texts[:200]:
        maps = [token_count.chunk_map(machine, t[i : i + 4]) for i in range(0, len(t), 4)] or [token_count.chunk_map(machine, "")]
        assert token_count.finish(machine, token_count.prefix_scan(machine, maps)[-1]) == machine.count(t)


# --- 6 SimHash --------------------------------------------------------------


def fingerprint(text, shingle=4):
    ws = WORDS.findall(lower(text))
    if not ws:
        return 0
    sh = [" ".join(ws[i : i + shingle]) for i in range(max(1, len(ws) - shingle + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps, max_bits):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= max_bits:
            parent[find(b)] = find(a)
    return {f: find(f) for f in parent}


def test_near_duplicates(docs, rows, empty):
    got = simhash.near_duplicates(docs, 4, 4).collect()
    marks = [(r[0], fingerprint(r[1])) for r in rows]
    root = components({f for _, f in marks}, 4)
    least = {}
    for i, f in marks:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    assert bag((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == bag((i, f, least.get(root[f])) for i, f in marks)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    kept = kept.select("doc_id", "text").collect()
    assert len(kept) == len(set(root.values()))
    assert {root[fingerprint(r.text)] for r in kept} == set(root.values())
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_tree_finds_every_close_pair(spark, levels):
    rng = random.Random(levels)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for f in fps[:100]:
        g = f
        for _ in range(3):  # chains of near fingerprints
            for b in rng.sample(range(64), rng.randint(1, 5)):
                g ^= 1 << b
            fps.append(g)
    fps = sorted(set(fps))
    frame = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    found = connected_components(simhash.links(frame, 4, levels))
    name = {r.node % (1 << 64): r.root for r in found.collect()}
    root = components(set(fps), 4)
    groups = collections.defaultdict(set)
    for f in fps:
        groups[root[f]].add(name.get(f, f))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


# --- 7 line dedup -----------------------------------------------------------


def near(a, b):
    """Word edit distance of at most one."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def kept_lines(rows, min_words=5):
    """Brute force: (id, text) -> numbers of the lines kept."""
    distinct = sorted({(math.inf if r[0] is None else r[0], r[1] or "") for r in rows})
    order, out = [], {}
    by_place = []
    for i, t in distinct:
        for at, line in enumerate(t.split("\n")):
            by_place.append((i, t, at, tuple(WORDS.findall(line))))
    for i, t, at, ws in by_place:
        if ws and not any(o == ws or len(o) >= min_words and len(ws) >= min_words and near(list(o), list(ws)) for o in order):
            out.setdefault((i, t), []).append(at)
        if ws:
            order.append(ws)
    return out


def line_rows():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(30)]
    lines = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 6, 7, 8, 9, 15, 16, 17, 24, 40]))] for _ in range(60)]
    texts = []
    for _ in range(60):
        picked = []
        for _ in range(rng.randint(1, 4)):
            ws = list(rng.choice(lines))
            for _ in range(rng.choice([0, 1, 1, 2])):
                k = rng.randrange(len(ws))
                kind = rng.choice("rid")
                if kind == "r":
                    ws[k] = "new" + str(rng.randrange(5))
                elif kind == "i":
                    ws.insert(k, "new" + str(rng.randrange(5)))
                elif len(ws) > 1:
                    del ws[k]
            picked.append((" " if rng.random() < 0.9 else "\t ").join(ws))
        texts.append("\n".join(picked))
    return [(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)]


def test_line_dedup(spark, docs, rows):
    made = line_rows()
    expected = kept_lines(made)
    frame = spark.createDataFrame(made, docs.select("doc_id", "text", "lang", "source", "n_chars").schema).repartition(4)
    for r in line_dedup.line_report(frame).collect():
        text = made[r.doc_id][1]
        kept = expected.get((r.doc_id, text), [])
        worded = [at for at, x in enumerate(text.split("\n")) if WORDS.search(x)]
        assert (r.n_lines, r.n_kept, r.dropped) == (len(worded), len(kept), [a for a in worded if a not in kept])
    whole = {r.doc_id: r.text for r in line_dedup.without_repeats(frame).collect()}
    assert whole == {
        i: "\n".join(x for at, x in enumerate(t.split("\n")) if at in expected[i, t] or not WORDS.search(x))
        for i, t, *_ in made if (i, t) in expected
    }


def test_line_dedup_on_odd_rows(docs, rows, empty):
    """The order of texts under one id is by hash, so only counts that do not depend on it are compared."""
    got = line_dedup.line_report(docs).collect()
    assert bag((r.doc_id, r.n_lines) for r in got) == bag(
        (r[0], sum(bool(WORDS.search(x)) for x in (r[1] or "").split("\n"))) for r in rows
    )
    once = {(math.inf if r[0] is None else r[0], r[1] or "") for r in rows}
    assert len(once) < len(rows)
    kept = line_dedup.without_repeats(docs)
    assert kept.columns == docs.columns
    ids = collections.Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert ids[5] == 3 and ids[34] == ids[35] == ids[36] == 1 and ids[30] == 0 and ids[38] == 0  # copies, no lines, all lines gone
    assert line_dedup.line_report(empty).count() == 0 and line_dedup.without_repeats(empty).count() == 0


# --- 8 mixing ---------------------------------------------------------------


def test_mixture_meets_its_budgets(docs, rows, empty):
    tokens = collections.Counter()
    for r in rows:
        tokens[r[3]] += len(WORDS.findall(r[1] or ""))
    whole = sum(tokens.values())
    counted = mixture.sized(docs)
    got = {r.source: r for r in mixture.weights(counted).collect()}
    assert {s: r.tokens for s, r in got.items()} == {s: n for s, n in tokens.items() if n}
    assert math.isclose(sum(r.weight for r in got.values()), 1)
    # the exponent: entropy reached, or no source repeated beyond the limit
    assert all(r.budget <= mixture.MAX_REPEATS * r.tokens * (1 + 1e-6) for r in got.values())
    taken = mixture.mixture(docs).collect()
    used, largest = collections.Counter(), collections.Counter()
    for r in taken:
        used[r.source] += r.n_tokens
    for r in rows:
        largest[r[3]] = max(largest[r[3]], 3 * len(WORDS.findall(r[1] or "")))  # a row that occurs three times
    for s, r in got.items():
        assert used[s] <= r.budget < used[s] + largest[s] + 1
    whole_blocks = collections.Counter((r.source, r.block) for r in taken)
    for s, r in got.items():
        for b in range(r.budget // r.tokens):
            assert whole_blocks[s, b] == sum(x[3] == s for x in rows)
    assert whole and mixture.mixture(empty).count() == 0


def test_filled_mixture_reaches_its_budgets(spark, docs, rows, empty):
    giant = [(9000, "giant " * 900, "en", "small", 1)] + [(9001 + i, "a b c d e", "en", "small", 1) for i in range(20)]
    giant += [(9100 + i, "many words of a large source " * 5, "en", "large", 1) for i in range(60)]
    frames = [docs.select(*empty.columns), spark.createDataFrame(giant, empty.schema)]
    for frame, budget in ((frames[0], 1.0), (frames[1], 0.3), (frames[1], 0.05), (frames[0].union(frames[1]), 0.7)):
        wanted = {r.source: r.budget for r in mixture.weights(mixture.sized(frame), budget=budget).collect()}
        taken = mixture.mixture(frame, budget=budget, filled=True).collect()
        copies = collections.Counter((r.doc_id, r.source, r.block) for r in taken)
        used, longest = collections.Counter(), collections.Counter()
        for r in taken:
            used[r.source] += r.n_tokens
            longest[r.source] = max(longest[r.source], r.n_tokens * copies[r.doc_id, r.source, r.block])
        for s, n in wanted.items():
            assert n <= used[s] < n + max(1, longest[s]), (s, n, used[s])
    small = [r for r in mixture.mixture(frames[1], budget=0.05, filled=True).collect() if r.source == "small"]
    assert small and all(r.doc_id != 9000 for r in small)
    assert mixture.mixture(empty, filled=True).count() == 0


def test_temperature_search(spark):
    shares = spark.createDataFrame([(x / 100,) for x in (70, 20, 9, 1)], "p double")

    def state(t):
        w = [p**t for p in (0.7, 0.2, 0.09, 0.01)]
        z = sum(w)
        return -sum(x / z * math.log(x / z) for x in w) / math.log(4), max(x / z / p for x, p in zip(w, (0.7, 0.2, 0.09, 0.01), strict=True))

    free = mixture.exponent(shares, 0.9, 1e9, 1.0)
    assert abs(state(free)[0] - 0.9) < 1e-6
    tied = mixture.exponent(shares, 0.9, 4.0, 1.0)
    assert tied > free and abs(state(tied)[1] - 4.0) < 1e-6
    assert mixture.exponent(shares, 0.1, 1e9, 1.0) > 0.999  # already more even than asked


# --- 9 decontamination ------------------------------------------------------


def hits(text, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    ws = split(text)
    hit, found = set(), set()
    for i, t in items:
        w = split(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if w else ():
            for at in range(len(ws) - n + 1):
                if ws[at : at + n] == w[k : k + n]:
                    hit.update(range(at, at + n))
                    found.add(i)
    return len(ws), len(hit), sorted(x for x in found if x is not None)


def test_benchmark_hits(spark, docs, rows, empty):
    t = [r[1] for r in rows]
    items = [(1, " ".join(t[0].split()[2:16])), (2, "One, TWO!"), (3, None), (4, "..."), (5, t[4][:80]), (5, t[8][:90]), (None, t[9][:90]), (7, "no such words here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    small = [r for r in rows if len(r[1] or "") < 50_000]
    expected = bag((r[0], *hits(r[1], items)) for r in small)
    frame = docs.where("text IS NULL OR length(text) < 50000")
    for chars in (400_000, 100):  # one automaton, several
        got = decontaminate.benchmark_hits(frame, bench, automaton_chars=chars).collect()
        assert bag((r.doc_id, r.n_words, r.n_hit, r.items) for r in got) == expected
    assert decontaminate.clean_documents(frame, bench, automaton_chars=100).count() == sum(not hits(r[1], items)[1] for r in small)
    for r in got:
        text = next(x[1] for x in rows if x[0] == r.doc_id and len(decontaminate.normalise((x[1] or "").encode())) == r.n_words)
        assert sum(len(decontaminate.normalise(text[s["start"] : s["end"]].encode())) for s in r.spans) == r.n_hit
    d = decontaminate.digest(decontaminate.benchmark_hits(frame, bench)).where("doc_id = 37").first()
    assert d.contaminated and d.items_sha256 == hashlib.sha256(b"2").hexdigest()
    kept = decontaminate.clean_documents(frame, bench)
    assert kept.columns == frame.columns
    assert bag(r.doc_id for r in kept.select("doc_id").collect()) == bag(r[0] for r in small if not hits(r[1], items)[1])
    assert decontaminate.benchmark_hits(empty, bench).count() == 0
    assert decontaminate.benchmark_hits(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_ids_of_any_type_and_one_automaton_a_worker(spark, docs, rows, monkeypatch):
    long = " ".join(f"w{i}" for i in range(400))
    items = [("q-1", " ".join(rows[0][1].split()[2:16])), ("q-10", long), ("q-9", rows[4][1][:80]), (None, "One, TWO!")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    frame = docs.where("text IS NULL OR length(text) < 50000").select("doc_id", "text")
    frame = frame.unionByName(spark.createDataFrame([(700, "x " + " ".join(f"W{i}" for i in range(190, 210)) + " y")], "doc_id long, text string"))
    expected = bag((r[0], hits(r[1], items)[2]) for r in [x for x in rows if len(x[1] or "") < 50_000] + [(700, " ".join(f"w{i}" for i in range(190, 210)))])
    for chars in (400_000, 400):
        got = decontaminate.benchmark_hits(frame, bench, automaton_chars=chars)
        assert bag((r.doc_id, r["items"]) for r in got.collect()) == expected
    one = decontaminate.digest(got).where("doc_id = 700").first()
    assert one.items_sha256 == hashlib.sha256(b"q-10").hexdigest() and (one.n_words, one.n_hit) == (22, 20)
    built = []
    monkeypatch.setattr(decontaminate, "build", lambda items, window: built.append(1) or object())
    sent = [decontaminate._Sent(type("B", (), {"value": [("a", b"x")]})()) for _ in range(2)]
    for s in (sent[0], sent[0], sent[1], sent[1]):
        decontaminate._machine(s, 10)
    assert len(built) == 2
    decontaminate.kept_in_worker(("benchmark automaton",), dict).clear()


# --- 10 main text -----------------------------------------------------------

PROSE = "This is a paragraph of the article that runs on for a good while, with commas &amp; more. "
PLAIN = PROSE.replace("&amp;", "&").strip()


@pytest.mark.parametrize(
    "html, expected",
    [
        ("", ""),
        ("plain  text", "plain text"),
        ("<p>a &amp; b<p>c &lt; d<br>e", "a & b\nc < d e"),
        ("<div><a href=x>only a link</a></div>", ""),
        (f"<nav><ul><li><a>menu</a></ul></nav><article><h1>T</h1><p><b>{PROSE}<br><p>ok.</p></article><footer>f", f"T\n{PLAIN}\nok."),
        (f"<body><header>{PROSE}</header><main><p>{PROSE}</p><aside>x</aside><form>y</form></main></body>", PLAIN),
        (
            f"<div class=site-header>S</div><div id=c><h2>T</h2><div>{PROSE}</div><div>Short.</div><div>{PROSE}</div></div>"
            f"<div class='side-bar'>q</div><div id=comments><p>{PROSE}</p></div><div class=cookieNotice>{PROSE}</div>",
            f"T\n{PLAIN}\nShort.\n{PLAIN}",
        ),
        (f"<form id=page><div><p>{PROSE}</p><p>Tiny</p></div></form>", f"{PLAIN}\nTiny"),
        (f"<script>if (a<b) x('<p>')</script><style>p{{}}</style><!-- c --><p>{PROSE}</p>", PLAIN),
    ],
)
def test_main_text(html, expected):
    assert extract_main.main_text(html) == expected


def test_main_text_keeps_formulas_and_split_articles():
    prose = lambda w: f"<p>{' '.join([w] * 30)}.</p>"
    page = "<body><nav><a href=x>home</a></nav>{}<footer>foot</footer></body>"
    sums = "<p>The sum <math><mi>a</mi> <mo>=</mo> <mi>b</mi><annotation>TEX</annotation></math> stands in this long line of text.</p>"
    got = extract_main.main_text(page.format(f"<article>{sums}{prose('word')}</article>"))
    assert got.split("\n")[0] == "The sum a = b stands in this long line of text."
    parts = [[prose(a), prose(b)] for a, b in (("four", "five"), ("nine", "zero"))]
    got = extract_main.main_text(page.format("".join(f"<article>{x}{y}</article>" for x, y in parts)))
    assert [x.split()[0] for x in got.split("\n")] == ["four", "five", "nine", "zero"]


def test_extract_rows(spark):
    rows = [(1, "u", None, 3), (1, None, "<p>x</p>", 4), (None, "u", "", 5), (2, "u", "<p>" + "word " * 50_000, 6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = bag((r.page_id, r.url, len(r.text)) for r in extract_main.extract(pages).collect())
    assert got == bag([(1, "u", 0), (1, None, 1), (None, "u", 0), (2, "u", 249_999)])
    assert extract_main.extract(pages.limit(0)).count() == 0
