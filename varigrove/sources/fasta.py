"""FASTA files and name lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`file, header, seq`; the lines of a sequence are joined.

    The record mark is the line separator, so Spark splits large files itself.
    """
    text = F.regexp_replace("value", "\r", "")
    record = spark.read.option("lineSep", ">").text(path).select(
        F.col("_metadata.file_path").alias("file"), text.alias("v")
    )
    return record.where(F.trim(F.translate("v", "\n", "")) != "").select(
        "file",
        F.trim(F.substring_index("v", "\n", 1)).alias("header"),
        # Everything after the header line, without line ends or blanks.
        F.regexp_replace(
            F.when(F.instr("v", "\n") > 0, F.expr("substr(v, instr(v, '\n') + 1)")).otherwise(""), r"\s", ""
        ).alias("seq"),
    )


def write_fasta(df: DataFrame, path: str, by: str | None = None, name: str = "header", mode: str = "errorifexists") -> None:
    """`>name` and sequence per row; with `by`, one folder per value of that column."""
    text = F.concat(F.lit(">"), F.col(name).cast("string"), F.lit("\n"), F.col("seq"))
    if by is None:
        df.select(text.alias("value")).write.mode(mode).text(path)
        return
    # Few files per locus, yet a crowded locus is split over several tasks.
    out = df.select(F.col(by), text.alias("value")).hint("rebalance", by)
    out.write.mode(mode).partitionBy(by).text(path)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """One name per line, empty lines dropped."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where(F.col("name") != "")


def write_names(df: DataFrame, column: str, path: str, mode: str = "errorifexists") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)
