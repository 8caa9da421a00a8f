"""From raw documents to token files, in stages that each keep a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from varigrove.llm import bagminhash, decontaminate, mixing, queries, toxicity
from varigrove.llm.common import saved, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain takes for toxic go; it is trained on those that are labelled."""
    return toxicity.without_toxic(docs, queries.toxic_labels(spark, sf_dir), queries.CATEGORIES, reject="toxic")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest id."""
    return bagminhash.without_near_duplicates(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any window of a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources draws them."""
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, described as read back."""
    return queries.token_file_digests(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("MinHash near-dedup", without_copies),
    ("benchmark decontamination", clean_of_benchmark),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", token_files),
]

#: A trained classifier and signatures can't be told in SQL; tests/llm holds a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are written, and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = saved(docs, f"stage-{n}")
    return docs
