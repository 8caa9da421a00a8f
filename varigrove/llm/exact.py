"""Exact duplicates by a 128-bit content hash, with the bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varigrove.llm.common import BLANK, quoted, saved


def content_hash(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting white space; null counts as
    empty, so null, empty and blank texts are one group. Of equal texts the row
    with the most code points stays, then the one with the smallest id (a null
    id comes last). A row that occurs several times is answered as often, and
    only one of its copies is kept. An empty table gives no rows; other columns,
    whatever their names, are not read.

    The hash decides first. Texts reach the network once: as distinct pairs of
    hash and text, of which each map task sends a group's text at most once. A
    hash with two texts is a collision, and its rows are then grouped by the
    text itself. Counts combine on the map side, so a group that holds a third
    of the rows is one row per map task.
    """
    whole = F.coalesce(quoted(text).cast("string"), F.lit(""))
    normal = F.regexp_replace(whole, BLANK + "+", "")
    rows = docs.select(quoted(key).alias("doc_id"), F.length(whole).alias("len"), normal.alias("norm")).withColumn(
        "hash", digest(F.col("norm"))
    )
    facts = saved(rows.select("doc_id", "len", "hash", F.sha2("norm", 256).alias("text_sha256")), "exact")

    pairs = rows.select("hash", "norm").distinct()
    collided = saved(pairs.groupBy("hash").count().where("count > 1").select("hash"), "exact-collided")
    apart = rows.join(collided, "hash", "left_semi").select(
        "doc_id", "len", "hash", F.sha2("norm", 256).alias("text_sha256"), F.col("norm").alias("tie")
    )
    plain = facts.join(collided, "hash", "left_anti").withColumn("tie", F.lit(""))
    classed = plain.unionByName(apart)

    # Rows that are the same in all of this are one row with a count from here on.
    same = classed.groupBy("hash", "tie", "doc_id", "len", "text_sha256").agg(F.count(F.lit(1)).alias("times"))
    best = F.min(F.struct(-F.col("len"), F.col("doc_id").isNull(), F.col("doc_id").alias("id")))
    # Written, so that the join below is of two plain shuffles and a large group can be split.
    groups = saved(same.groupBy("hash", "tie").agg(F.sum("times").alias("group_size"), best.alias("best")), "exact-groups")
    first = (F.col("best.id").eqNullSafe(F.col("doc_id"))) & (F.col("best.col1") == -F.col("len"))
    return (
        same.join(groups, ["hash", "tie"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select(
            "doc_id",
            F.col("best.id").alias("keep_id"),
            "group_size",
            (first & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )
