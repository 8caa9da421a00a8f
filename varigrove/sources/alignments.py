"""Text alignment records and contig indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varigrove.functions import bases as B


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of text alignment files; header lines are dropped.

    `rg` is the read-group tag, and `sample` its part before the run unit, or
    null without a tag. `sum_bq` sums qualities of 15 and more, the usual score
    for choosing among duplicates.
    """
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    f = F.split("value", "\t")
    tag = F.nullif(F.regexp_extract("value", "\tRG:Z:([^\t]*)", 1), F.lit(""))
    out = lines.select(
        f[0].alias("qname"),
        f[1].cast("int").alias("flag"),
        f[2].alias("rname"),
        f[3].cast("long").alias("pos"),
        f[4].cast("int").alias("mapq"),
        f[5].alias("cigar"),
        F.when(f[6] == "=", f[2]).otherwise(f[6]).alias("rnext"),
        f[7].cast("long").alias("pnext"),
        f[8].cast("int").alias("tlen"),
        f[9].alias("seq"),
        f[10].alias("qual"),
        tag.alias("rg"),
    )
    score = F.aggregate(
        B.phred(F.col("qual")), F.lit(0), lambda acc, q: acc + F.when(q >= 15, q).otherwise(F.lit(0))
    )
    return out.withColumns({"sample": F.substring_index("rg", "_", 3), "sum_bq": score})


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Contig `name, length, ord` of a sequence index, in file order.

    `ord` is the byte offset the index itself holds, which grows with the file.
    """
    return spark.read.csv(
        path, sep="\t", schema="name string, length long, ord long, line_bases int, line_width int"
    ).select("name", "length", "ord")


def write_alignments(aln: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet in coordinate order, so that a region reads few row groups.

    The record name takes part in the ranges: a pile at one position can
    spread over several tasks.
    """
    order = ["rname", "pos", "qname"]
    aln.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).parquet(path)
