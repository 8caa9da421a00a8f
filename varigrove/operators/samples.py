"""Samples, manifests and resuming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varigrove.functions import names as N


def sample_names(bases: DataFrame) -> DataFrame:
    return bases.withColumn("name", N.sample_name(F.col("base")))


def drop_undetermined(bases: DataFrame) -> DataFrame:
    return bases.where(~N.is_undetermined(F.col("base")))


def read_groups(bases: DataFrame) -> DataFrame:
    """Read-group fields of all samples but the undetermined ones."""
    return drop_undetermined(bases).withColumns(N.read_group(F.col("base")))


def first_samples(bases: DataFrame, n: int = 5) -> DataFrame:
    """A few samples for a trial run."""
    return drop_undetermined(bases).orderBy("base").limit(n)


def discover_samples(files: DataFrame, suffix: str = "_1.fq.gz") -> DataFrame:
    """Inputs whose path ends in `suffix`, with their number per folder."""
    hit = files.where(F.col("path").endswith(suffix))
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return hit.groupBy(folder.alias("folder")).agg(
        F.count_distinct("path").alias("samples"), F.sum("size").alias("bytes")
    )


def sample_map(files: DataFrame, suffix: str = "_1.fq.gz") -> DataFrame:
    """Sample name and path."""
    return files.select(N.strip_path(F.col("path"), suffix).alias("sample"), "path")


def manifest_counts(files: DataFrame, by: Sequence[str] = ("side",)) -> DataFrame:
    """Files and bytes by side and extension."""
    extension = F.regexp_extract(N.file_name(F.col("path")), r"\.(.*)$", 1)
    return files.groupBy(*by, extension.alias("extension")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    )


def reconcile(source: DataFrame, dest: DataFrame) -> DataFrame:
    """Each path as same, changed, missing at the destination, or extra there."""
    s = source.select("path", F.col("checksum").alias("__s"))
    d = dest.select("path", F.col("checksum").alias("__d"))
    status = (
        F.when(F.col("__d").isNull(), "missing")
        .when(F.col("__s").isNull(), "extra")
        .when(F.col("__s") == F.col("__d"), "same")
        .otherwise("changed")
    )
    return s.join(d, "path", "full_outer").select("path", status.alias("status"))


def reconcile_verdict(statuses: DataFrame) -> DataFrame:
    """Counts by status; the source may go only if nothing is missing or changed."""
    count = lambda s: F.count(F.when(F.col("status") == s, 1)).alias(s)
    return statuses.agg(*[count(s) for s in ("same", "changed", "missing", "extra")]).withColumn(
        "safe_to_remove", (F.col("missing") == 0) & (F.col("changed") == 0)
    )


def pending(inputs: DataFrame, outputs: DataFrame, key: str = "sample") -> DataFrame:
    """Inputs that have no output yet."""
    return inputs.join(outputs.select(key), key, "left_anti")


def interval_list(contigs: DataFrame) -> DataFrame:
    """One contig name per row, in reference order."""
    return contigs.orderBy("ord").select("name")
