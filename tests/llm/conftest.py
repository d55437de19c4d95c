import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang, source) rows."""
    def build(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, COLUMNS).repartition(parts)

    return build


@pytest.fixture(scope="session")
def prose():
    """Random prose of n words from a small vocabulary."""
    def build(n, seed, vocabulary=400):
        dice = random.Random(seed)
        return " ".join(f"w{dice.randrange(vocabulary)}" for _ in range(n))

    return build


@pytest.fixture
def odd_rows(prose):
    """Nulls, empty and long texts, ties, repeated rows, white space of all kinds."""
    long = prose(6000, 1)
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "One"), (6, "one two"), (7, long), (8, long), (9, "x" * 30000),
        (10, prose(120, 2)), (11, prose(120, 2)), (12, prose(119, 2)), (13, "a\x1cb\xa0c\x85d"), (14, "é ü\nñ \U0001d4b3"), (15, "the " * 200),
        (16, "the " * 201), (17, ""), (18, "0 1 2 3 4 5 6 7 8 9 " * 12),
    ]


def clashing(docs):
    """The same documents with further columns whose names the operators might use themselves."""
    from pyspark.sql import functions as F

    names = ("score", "key", "kept", "block", "size", "bucket", "words", "spans", "component", "copy", "y", "target", "shard", "part")
    return docs.select("*", *(F.lit(f"own {n}").alias(n) for n in names))
