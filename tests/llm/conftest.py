import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, keys int, pos int, score string"
WORDS = "the of and river stone tower garden winter morning silver paper window castle forest bridge market letter number circle summer".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.choice("abcdefghij")) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty and blank texts, ties, repeated rows, a long text, and columns whose names clash."""
    rng = random.Random(3)
    base = prose(rng, 120)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    rows = [
        (1, base, "en", "a", 1, "x", 1, 1, "s"), (2, base, "en", None, 1, "x", 1, 1, "s"), (3, near, None, "b", None, None, None, None, None),
        (4, None, "en", "a", 1, "x", 1, 1, "s"), (5, "", "en", "a", 1, "x", 1, 1, "s"), (6, " \n\t ", "fr", "a", 1, "x", 1, 1, "s"),
        (7, "one two", "fr", "a", 1, "x", 1, 1, "s"), (8, "ONE  two", "fr", "a", 1, "x", 1, 1, "s"), (9, prose(rng, 40_000), "en", "b", 1, "x", 1, 1, "s"),
        (10, prose(rng, 200), "fr", "b", 1, "x", 1, 1, "s"), (10, prose(rng, 200), "fr", "b", 1, "x", 1, 1, "s"), (11, base, "en", "a", 1, "x", 1, 1, "s"), (11, base, "en", "a", 1, "x", 1, 1, "s"),
        (None, prose(rng, 50), "en", "a", 1, "x", 1, 1, "s"), (12, "9 8 7 !!", None, None, None, None, None, None, None),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
