"""Fixtures of the training-data operators: an odd little documents table and an empty one."""

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def sentence(rng, n):
    syllables = "the an of ti on er re in ha ou st en nd th ed".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents():
    """Clean, copied, nearly copied, NULL, empty, blank, odd and very long texts; repeated and NULL ids."""
    rng = random.Random(5)
    texts = ["\n".join(sentence(rng, rng.randint(6, 25)).capitalize() + "." for _ in range(rng.randint(2, 6))) for _ in range(30)]
    texts += [texts[0], texts[1], texts[2].replace("the", "zzz", 1), texts[3] + " more"]
    texts += [None, "", "  \n\t ", "one two", "one  two", "A!! B## é漢字 ½ 😀 don't 's\n\n\nx", "<|endoftext|> a<|endoftext|>"]
    texts.append("\n".join([sentence(rng, 40)] * 3))
    texts.append(" ".join(["word"] * 300))
    texts.append(sentence(rng, 30_000))  # one very long line
    texts.append("Released under the MIT License. " + sentence(rng, 30))
    rows = [(i, t, ("en", "de", None)[i % 3], f"src{min(i % 7, 2)}" if i % 11 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (6, "a different text under a repeated id, of some words", "en", "src0", 3)]
    rows += [(None, texts[7], None, None, None), (None, "no id and no twin in this little table at all", None, "src1", 0)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With extra columns whose names clash with those that operators use inside."""
    extra = ["score", "fp", "row", "word", "n_words", "label", "stratum", "salt", "at", "root", "__n", "bits"]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", *(f"doc_id as `{c}`" for c in extra)).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, rows):
    found = [(r[0], 0 if r[1] and "word word" in r[1] else 1, 0) for r in rows if r[0] is not None and r[0] % 2 == 0]
    found += [(None, 1, 0), (3, None, 1), (4, 1, None), (4, 0, None)]
    return spark.createDataFrame(found, "doc_id long, quality int, toxic int")
