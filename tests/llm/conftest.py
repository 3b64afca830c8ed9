import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, count: int, pool: int = 400) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghiklmnoprstuvwz") for _ in range(1 + rng.randrange(pool) % 7)) for _ in range(count)]


@pytest.fixture(scope="session")
def awkward_texts() -> list:
    """Null, empty, blank, tiny, very long, repeated and odd texts."""
    long_text = " ".join(words(7, 40_000))
    base = " ".join(words(1, 120))
    return [
        None,
        "",
        " \n\t ",
        "one",
        "two words",
        long_text,
        base,
        base,
        base + " tail",
        "née Straße   naïve 漢字 " * 30,
        "a  b\n\nc \x0b d\x1fe\r\n",
        " ".join(words(2, 60)) + "\n" + " ".join(words(3, 60)),
    ]


@pytest.fixture(scope="session")
def docs(spark, awkward_texts):
    rows = [(None if i == 4 else i, t, "en" if i % 3 else None, f"src{i % 2}", None if t is None else len(t)) for i, t in enumerate(awkward_texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same rows with columns named as the operators' own."""
    from pyspark.sql import functions as F

    names = ["row", "fp", "id", "size", "shard", "slot", "key1", "level", "a", "b", "hits", "quality", "score", "spans", "trusted_id", "digest"]
    return docs.select("*", *[F.lit("x").alias(n) for n in names], F.create_map(F.lit("k"), F.lit(1)).alias("map"))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
