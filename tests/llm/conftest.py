import random

import pytest

LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(60_000))
BASE = "the quick brown fox jumps over the lazy dog while seven wizards quietly brew a potion of old moss and rain " * 2


def variant(seed: int, changes: int) -> str:
    words = BASE.split()
    for at in random.Random(seed).sample(range(len(words)), changes):
        words[at] = f"w{seed}x{at}"
    return " ".join(words)


@pytest.fixture(scope="session")
def texts() -> list[tuple[int, str | None]]:
    """Distinct ids; empty, blank, null, short and very long texts, copies and near copies."""
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "two words"), (7, LONG), (8, LONG + " tail"), (9, "...!!!")]
    rows += [(20 + i, BASE) for i in range(4)] + [(30 + i, variant(i, 1)) for i in range(12)] + [(50 + i, variant(100 + i, 6)) for i in range(6)]
    rows += [(70, "ab" * 300), (71, "ab" * 200 + "c"), (72, "é" * 150), (73, "é" * 149 + "e")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(texts, "doc_id bigint, text string").cache()


@pytest.fixture(scope="session")
def cluttered(docs):
    """The same table with extra columns under names that the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["id", "n", "bucket", "component", "row", "mark", "size", "place", "range", "shard", "run", "digest", "rank", "length", "low", "high", "keep_id", "margin", "score"]
    return docs.withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="session")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with null keys, rows that repeat key and text, and a key with two texts."""
    rows = [(None, BASE), (None, None), (1, BASE), (1, BASE), (2, "x" * 200), (2, "y" * 200), (3, BASE)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")
