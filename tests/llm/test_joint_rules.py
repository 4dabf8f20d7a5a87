"""The joint verdict of the quality rules against a brute-force certificate."""

import collections
import math
import random
import re

from billframe.llm import quality_rules as Q
from test_operators import WORDS, count_words


def shares(text):
    n, chars, symbols, dup, repeat = count_words(text)
    lines = sum(bool(WORDS.search(x)) for x in text.split("\n"))
    return {
        "symbol_share": symbols / chars, "word_length": chars / n, "dup_line_share": dup / lines, "repeat_share": repeat / n,
        "capital_share": len(re.findall("[A-Z]", text)) / chars, "mark_share": len(re.findall("[!?]", text)) / chars,
        "digit_share": len(re.findall("[0-9]", text)) / chars,
    }


def test_kept_equals_the_certificate(spark, empty):
    rng = random.Random(9)
    spoil = {0: "#", 1: "9", 2: "A", 3: "!"}
    rows, labels = [], []
    for i in range(2400):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(70)]
        for _ in range(rng.choice([0, 0, 1, 3]) if good else rng.randint(4, 60)):
            words[rng.randrange(70)] += spoil[i % 4] * rng.randint(1, 3)
        rows.append((i, " ".join(words) if i % 5 else "\n".join([" ".join(words[:35])] * 2 + [" ".join(words[35:])] * 2), ("en", "de", None)[i % 3], "s", 1))
        labels.append((i, int(good), 0))
    got = {r.doc_id: r.kept for r in Q.quality_rules(
        spark.createDataFrame(rows, empty.schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), joint=True).collect()}
    base, first = {}, {}
    for i, t, *_ in rows:
        n, _, _, _, repeat = count_words(t)
        base[i] = n < 50 or 100 * repeat > 50 * n
        m = shares(t)
        first[i] = min((k for k, (of, c) in enumerate(Q.SEQUENCE) if m[of] > c), default=math.inf)
    last = {}
    for lang in ("en", "de", None):
        good = [r[0] for r, (_, q, _) in zip(rows, labels) if r[2] == lang and q and not base[r[0]]]
        for step in range(len(Q.SEQUENCE)):
            k, n = sum(first[i] <= step for i in good), len(good)
            if sum(math.comb(n, j) * Q.RISK**j * (1 - Q.RISK) ** (n - j) for j in range(k + 1)) > Q.DELTA / 3:
                break
            last[lang] = step
    expected = {r[0]: not base[r[0]] and first[r[0]] > last.get(r[2], -1) for r in rows}
    assert last and got == expected
    rejected = collections.Counter(q for (i, q, _) in labels if not base[i] and not expected[i])
    assert rejected[0] > rejected[1]
