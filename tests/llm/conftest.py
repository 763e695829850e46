import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns with names that operators also use.
CLASHING = ("score", "fp", "size", "_part", "kind", "component_id", "target", "held_out", "kept", "tree", "a", "_row", "shard")


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def corpus(seed=1, n=60):
    """Texts with exact and near copies, shared passages, toxic words, junk and licence lines."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["ba", "ko", "ti", "re", "sun", "é", "mo", "la"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    passage = words(rng, 60, vocabulary)
    out = []
    for i in range(n):
        t = ".\n".join(words(rng, rng.randint(10, 60), vocabulary) for _ in range(rng.randint(1, 4)))
        if i % 7 == 3:
            t = out[i - 2]
        if i % 7 == 5:
            w = out[i - 1].split(" ")
            w[len(w) // 2] = "edited"
            t = " ".join(w)
        if i % 5 == 2:
            t += "\n\n" + passage
        out.append(t)
    return out


def table(spark, texts, first=0):
    rows = [(first + i, t, "en", f"s{i % 5}" if i % 11 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return table(spark, corpus()).repartition(3).cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, one id twice, a null id, clashing columns."""
    from pyspark.sql import functions as F

    long_ = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "s1", 0), (3, " \n\t ", "en", "s1", 4), (4, long_, "en", "s2", len(long_)),
        (5, "one two three", "en", None, 13), (5, "one two three", "en", None, 13), (6, "é" * 80, "fr", "s3", 80), (6, "other text under one id", "fr", "s3", 23),
        (None, "a text without an id that is long enough to be found elsewhere, to the letter", None, "s1", None),
        (7, "a text without an id that is long enough to be found elsewhere, to the letter", "en", "s1", 77), (8, "x" * 5000, "en", "s1", 5000),
    ]
    d = spark.createDataFrame(rows, SCHEMA)
    return d.withColumns({c: F.lit("clash") for c in CLASHING}).repartition(2).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 4 != 0), int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
