import random

import pytest

#: Rows that every operator over texts must stand: null keys and texts, empty and blank texts, repeated rows, one key with two texts.
ODD = [(None, "a text without a key"), (None, None), (900001, None), (900002, ""), (900003, " \n\t "), (900004, "twice the same row"), (900004, "twice the same row"), (900005, "one key"), (900005, "two texts"), (900006, "1 2 3 ?!"), (900007, "日本語 текст ß é")]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with columns named like results."""
    rows = [(k, t, 7, 0.5, "x") for k, t in ODD] + [(900100, "word " * 60_000, 7, 0.5, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, score double, lang string")


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture
def words():
    rng = random.Random(3)
    return lambda n: [rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]) + str(rng.randint(0, 400)) for _ in range(n)]
