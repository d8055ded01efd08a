import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names an operator might want for itself
CLASHING = ["size", "score", "target", "bucket", "node", "batch", "no", "kept", "position", "n_words"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
                    for _ in range(n))


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, odd
    white space, and extra columns with clashing names."""
    from pyspark.sql import functions as F
    rng = random.Random(3)
    long_text = prose(rng, 30_000)
    base = prose(rng, 80)
    rows = [
        (1, base, "en", "a", 1), (1, base, "en", "a", 1),
        (2, base, None, "a", None), (3, None, "en", "b", 2), (4, "", "fr", None, 0),
        (5, " \t\n\x0b\x0c\r ", None, "b", 7), (6, long_text, "fr", "b", 9),
        (None, "no id at all here", "en", "c", 3), (None, None, None, None, None),
        (7, base + " one more word", "en", "c", 5), (8, " é ß x", "fr", "c", 5),
        (9, "word", "en", "\U0001f600", 1), (10, "a\nb\na\nb\n a", "en", "a", 1),
    ] + [(100 + i, prose(rng, 60), ["en", "fr"][i % 2], "a", 1) for i in range(30)]
    d = spark.createDataFrame(rows, DOCS)
    for c in CLASHING:
        d = d.withColumn(c, F.lit("x"))
    return d


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
