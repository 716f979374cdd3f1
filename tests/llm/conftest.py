import random

import pytest
from pyspark.sql import functions as F

from rollbook.llm.registry import ship

#: Names that operators use inside; a table may have them too.
CLASHING = ["row", "key", "id", "n", "class", "text_key", "size", "shard_", "copies", "run", "m", "place", "word", "toxic_", "_copies", "_copy", "_run", "_key", "_id", "dropped_id", "taken_key"]
LETTERS = "abcdefghijklmnopqrstuvwxyz"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


def prose(seed, words):
    r = random.Random(seed)
    return " ".join("".join(r.choice(LETTERS) for _ in range(r.randint(2, 9))) for _ in range(words))


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with NULLs, empty and very long texts, ties, repeated rows and columns with clashing names."""
    long = prose(1, 60_000)
    texts = [
        (1, "", "a"), (2, None, "a"), (None, "some words here", "b"), (None, None, None), (3, long, "a"),
        (4, long, None), (5, prose(2, 50), "b"), (5, prose(2, 50), "b"), (6, prose(2, 50), "c"), (7, " \n\t ", "c"),
        (8, "\U0001f600 é中 \x00 ́", None), (9, "one", "a"), (10, "ONE", "a"), (11, prose(3, 200), "a"),
        (12, prose(3, 200) + " end", "a"), (13, "x" * 100_000, "b"),
    ]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, source string").repartition(3)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
