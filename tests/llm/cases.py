import pytest

#: names that operators use inside, as extra columns of the input
CLASHES = ("fp", "u", "v", "key", "row", "kind", "start", "end", "range", "turn", "next", "sketch", "tokens", "p",
           "rate", "label", "words", "match", "found", "length", "piece", "ids", "n", "score", "_fp", "_key")

WORDS = ("the and river stone walked slowly toward morning light under heavy clouds while children sang old songs near "
         "water mills beyond quiet hills where nobody had ever spoken about winter trade or distant harbours").split()


def prose(seed: int, n: int) -> str:
    import random
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


LONG = prose(99, 40_000)

#: nulls in every column, empty and white texts, a very long one, ties, repeated rows
ROWS = [
    (1, prose(1, 120), "en", "a", 10), (2, prose(1, 120), "en", "a", 10), (2, prose(1, 120), "en", "a", 10),
    (3, None, "en", "b", None), (4, "", None, None, 0), (5, " \t\n ", "fr", "b", 4), (6, LONG, "en", None, 5),
    (7, "one", "de", "c", 3), (8, "one two", "de", "c", 7), (None, prose(2, 60), None, None, None),
    (None, prose(2, 60), None, None, None), (9, prose(3, 80), "fr", "c", 1), (10, "???", "en", "c", 3),
    (11, "Grüße an zwei \U0001F600 Leute", "de", "d", 24),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_docs(spark):
    from pyspark.sql import functions as F
    return spark.createDataFrame(ROWS, SCHEMA).select("*", *[F.lit(f"x{c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
