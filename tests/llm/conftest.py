"""Awkward documents that every operator must take."""

import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "pe", "ra", "so", "ti") for b in ("ber", "dan", "fel", "gor", "hin", "jas")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = ["key", "size", "shard", "score", "n", "batch", "words", "comp", "cell", "part", "ids", "kind", "held", "h", "s", "k", "_s", "_id", "kept"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def awkward_rows():
    rng = random.Random(5)
    long = prose(rng, 30_000)
    rows = [
        (None, prose(rng, 60), "en", "a", 1),
        (None, None, None, None, None),
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n\v\f\r ", "de", None, 7),
        (4, "one two", "en", "b", 7),
        (5, long, "en", "b", len(long)),
        (6, long + " tail", "en", "b", None),
        (7, "é ñ 日本 \U0001f642 \x1c x " + prose(rng, 80), None, "ü", 3),
        (8, "x " * 400, "en", "a", 800),
        (9, "\n".join(["same line here"] * 40), "en", "a", 600),
    ]
    same = prose(rng, 120)
    rows += [(10, same, "en", "a", 5)] * 3 + [(11, same, "en", "a", 5), (12, same + " end", "en", "c", 5)]
    rows += [(-5, prose(rng, 200), "en", "c", 9), (1 << 60, prose(rng, 90), "en", "c", 9)]
    rows += [(100 + i, prose(rng, rng.randint(1, 150)), "en", rng.choice(["a", "a", "b", "c"]), 1) for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows, SCHEMA)
    return df.select("*", *(F.lit("clash").alias(c) for c in CLASHES)).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(100 + i, i % 2, i % 3 // 2) for i in range(40)] + [(None, 1, 1), (10, None, None), (10, 1, 0), (10, 1, 0), (9999, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
