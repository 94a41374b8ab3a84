import random

import pytest
from pyspark.sql import types as T

from tests.conftest import spark  # noqa: F401

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, depth string"


@pytest.fixture
def odd(spark):  # noqa: F811
    """Rows with nulls, empty and long texts, ties, repeated rows and columns whose names operators add."""
    rng = random.Random(5)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "épsilon"]) + str(rng.randrange(50)) for _ in range(30_000))
    texts = [(1, "one two three four five"), (2, None), (3, ""), (4, " \t\n "), (5, long), (6, long + " end"), (7, "one  two three\nfour five"), (7, "one  two three\nfour five"), (None, "one two three four five"), (8, "123 !!"), (9, None)]
    return spark.createDataFrame([(i, t, None if i == 3 else "en", None if i in (1, 5) else "a", None, "x", "y") for i, t in texts], T.StructType.fromDDL(DOCS))


@pytest.fixture
def nothing(spark):  # noqa: F811
    return spark.createDataFrame([], T.StructType.fromDDL(DOCS))
