import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cases import ODD, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with columns whose names clash with those that operators add."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA)
    for name in ("n_words", "spans", "p_toxic", "shard", "shards", "near_a", "hash", "len", "row", "id"):
        df = df.withColumn(name, F.lit("mine"))
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def tokenizer():
    from varigrove.llm.queries import tokenizer_path

    return tokenizer_path()
