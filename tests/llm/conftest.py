import random

import pytest

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
#: Names that operators might use inside, as columns of the input.
CLASHES = {c: "x" for c in ("id", "fp", "hash", "slice", "first", "pos", "line", "key", "size", "copies", "score", "start", "end", "root", "component_id", "u", "v", "k", "bucket", "shard", "slot", "text_hash", "words", "unit", "value", "q", "p")}


def sentence(rng, n=9):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()) for _ in range(n)) + "."


def text(rng, sentences=6):
    return "\n".join(" ".join(sentence(rng) for _ in range(2)) for _ in range(sentences // 2))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows, rows that share an id, no id."""
    rng = random.Random(4)
    shared = text(rng)
    rows = [(i, text(rng), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), 1) for i in range(40)]
    rows += [
        (100, None, None, None, None), (101, "", "en", "a", 0), (102, " \t\n\x0b\x0c\r ", "en", "b", 7), (103, "\n\n", None, "c", 2), (104, "one", "en", "a", 3), (105, "two words", "en", "a", 9),
        (106, shared, "en", "a", 1), (107, shared, "en", "b", 1), (107, shared, "en", "b", 1), (108, "X" * 300_000, "en", "c", 1), (108, "other text under the same id", "de", "c", 1),
        (109, " ".join(["long"] * 60_000), "en", "a", 1), (None, shared, None, None, None), (None, "no id here", "en", "a", 1), (110, "Ünïcode größer 漢字 Ωmega ÀÉ", "de", "b", 1), (111, "123 !!! ???", "en", "b", 1),
    ]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd_clashing(spark, odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit(v).alias(c) for c, v in CLASHES.items()])


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
