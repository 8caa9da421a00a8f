"""Missingness, depth, distributions and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varigrove.functions import bases as B
from varigrove.functions.numbers import MEGABASE, pct_round2, pct_trunc1, safe_ratio, window_number
from varigrove.operators.joins import exact_quantiles, lookup_join, null_safe_join
from varigrove.operators.variants import RULES, is_pass, main_chromosomes

BINS = 100
THRESHOLDS = (0.5, 0.3, 0.1)
MIN_DEPTH = 5

# Annotations compared with their limit: all rules but the one on QUAL.
ANNOTATION_RULES = tuple(r for r in RULES if r.column != "qual")


# -- missingness -------------------------------------------------------------

def _missingness(genotypes: DataFrame, by: Sequence[str]) -> DataFrame:
    missing = F.count(F.when(B.is_missing(F.col("gt")), 1))
    return (
        genotypes.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("calls"), missing.alias("missing"))
        .withColumn("f_missing", F.col("missing") / F.col("calls"))
    )


def site_missingness(genotypes: DataFrame) -> DataFrame:
    return _missingness(genotypes, ["chrom", "pos"])


def sample_missingness(genotypes: DataFrame) -> DataFrame:
    return _missingness(genotypes, ["sample"])


def missingness_filter(genotypes: DataFrame, limit: float = 0.1) -> DataFrame:
    """Sites with at most `limit` missing calls."""
    return site_missingness(genotypes).where(F.col("f_missing") <= limit)


def missingness_sweep(
    genotypes: DataFrame, regions: dict[str, Sequence[str]], thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Sites kept at each threshold, for each named set of contigs.

    One pass: a site is reduced to its missing share, then every pair of
    region and threshold is one conditional count.
    """
    sites = site_missingness(genotypes)
    member = {name: F.col("chrom").isin(*chroms) for name, chroms in regions.items()}
    cells = [(name, t) for name in regions for t in thresholds]
    kept = [F.count(F.when(member[n] & (F.col("f_missing") <= t), 1)).alias(f"k{i}") for i, (n, t) in enumerate(cells)]
    total = {n: F.count(F.when(member[n], 1)).alias(f"t_{i}") for i, n in enumerate(regions)}
    one = sites.agg(*kept, *total.values())
    places = {n: f"t_{i}" for i, n in enumerate(regions)}
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("region"),
                F.lit(float(t)).alias("threshold"),
                F.col(f"k{i}").alias("kept"),
                F.col(places[n]).alias("total"),
            )
            for i, (n, t) in enumerate(cells)
        ]
    )
    return one.select(F.inline(rows)).withColumn("pct", pct_trunc1(F.col("kept"), F.col("total")))


# -- depth -------------------------------------------------------------------

def depth_summary(ann: DataFrame, n_samples: int, min_depth: int = MIN_DEPTH) -> DataFrame:
    """Mean, median, sd, 1st and 99th percentile of depth, and suggested bounds."""
    known = ann.where(F.col("dp").isNotNull())
    spread = exact_quantiles(known, "dp", {"median_dp": 0.5, "p01": 0.01, "p99": 0.99})
    one = spread.select(F.struct("*").alias("s")).scalar()
    out = known.agg(F.avg("dp").alias("mean_dp"), F.stddev_samp("dp").alias("sd_dp")).withColumn("__q", one)
    return out.select(
        "mean_dp",
        F.col("__q.median_dp").alias("median_dp"),
        "sd_dp",
        F.col("__q.p01").alias("p01"),
        F.col("__q.p99").alias("p99"),
        F.lit(float(min_depth * n_samples)).alias("dp_min_suggested"),
        (F.col("__q.median_dp") * 2).alias("dp_max_suggested"),
    )


def depth_clip(ann: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Sites whose depth is within its own quantile range."""
    bounds = exact_quantiles(ann, "dp", {"lo": low, "hi": high})
    return ann.where(
        F.col("dp").between(bounds.select("lo").scalar(), bounds.select("hi").scalar())
    )


def depth_filter(sites: DataFrame, low: float, high: float) -> DataFrame:
    return sites.where(F.col("dp").between(low, high))


def clip_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows with `column` inside fixed limits."""
    return df.where(F.col(column).between(low, high))


# -- annotations in long form ------------------------------------------------

def to_long(tagged: DataFrame, keep: Sequence[str] = ("pass",)) -> DataFrame:
    """`annotation, value` rows, nulls left out."""
    pairs = F.array(
        *[F.struct(F.lit(r.label).alias("annotation"), F.col(r.column).alias("value")) for r in ANNOTATION_RULES]
    )
    return tagged.select(*keep, F.inline(pairs)).where(F.col("value").isNotNull())


def with_threshold(long: DataFrame) -> DataFrame:
    """Each value with the limit of its annotation and the failing side.

    The limits are the few fixed rules, so they travel as a literal map.
    """
    limits = [F.lit(x) for r in ANNOTATION_RULES for x in (r.label, r.limit)]
    signs = [F.lit(x) for r in ANNOTATION_RULES for x in (r.label, r.sign)]
    return long.withColumns(
        {
            "threshold": F.create_map(*limits)[F.col("annotation")],
            "sign": F.create_map(*signs)[F.col("annotation")],
        }
    )


def threshold_review(long: DataFrame) -> DataFrame:
    """Values on either side of the limit, by annotation and pass label."""
    v, t = F.col("value"), F.col("threshold")
    bad = ((F.col("sign") == "<") & (v < t)) | ((F.col("sign") == ">") & (v > t))
    return (
        with_threshold(long)
        .groupBy("annotation", "threshold", "pass")
        .agg(
            F.count(F.lit(1)).alias("sites"),
            F.count(F.when(bad, 1)).alias("beyond"),
            F.count(F.when(~bad, 1)).alias("within"),
        )
    )


def annotation_clip(long: DataFrame, low: float = 0.005, high: float = 0.995) -> DataFrame:
    """Per annotation, values within its own quantile range."""
    bounds = exact_quantiles(long, "value", {"lo": low, "hi": high}, by=["annotation"])
    # One row per annotation: they are the columns of a table.
    bounds = F.broadcast(bounds.withColumnRenamed("annotation", "__of"))
    return long.join(bounds, F.col("annotation").eqNullSafe(F.col("__of"))).drop("__of").where(
        (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi"))
    )


def histogram(df: DataFrame, value: str, split: Sequence[str], by: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """Counts in equal bins over the range of `value`; the last bin is closed.

    Edges are shared by all `split` groups within `by`, so that they can be
    laid over each other.
    """
    by = list(by)
    # Equal values are counted first; the range and the bins both come from those counts.
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, *split, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    ends = counts.groupBy(*by).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    if by:
        ranged = null_safe_join(counts, ends, by)
    else:
        one = ends.select(F.struct("*").alias("s")).scalar()
        ranged = counts.withColumn("__ends", one).select("*", "__ends.*").drop("__ends")
    width = F.col("__hi") - F.col("__lo")
    place = F.floor((F.col("__v") - F.col("__lo")) / F.when(width != 0, width) * bins)
    bin_no = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    return ranged.groupBy(*by, *split, bin_no.alias("bin")).agg(F.sum("__n").alias("sites"))


# -- density -----------------------------------------------------------------

def snp_density(tagged: DataFrame, width: int = MEGABASE) -> DataFrame:
    """Sites per main chromosome, window of `width` bases and pass label."""
    return (
        main_chromosomes(tagged)
        .groupBy("chrom", window_number(F.col("pos"), width).alias("window"), "pass")
        .agg(F.count(F.lit(1)).alias("sites"))
    )


def density_gaps(density: DataFrame) -> DataFrame:
    """Windows up to the last one of a chromosome that hold no site."""
    seen = density.select("chrom", "window").distinct()
    last = seen.groupBy("chrom").agg(F.max("window").alias("__last"))
    every = last.select("chrom", F.explode(F.sequence(F.lit(0).cast("long"), "__last")).alias("window"))
    return every.join(seen, ["chrom", "window"], "left_anti")


# -- run summary and sampling ------------------------------------------------

def run_qc_summary(tagged: DataFrame, run: str, n_samples: int, with_date: bool = True) -> DataFrame:
    """One row per run; `tagged` holds biallelic SNPs."""
    ti = B.is_transition(F.col("ref"), F.col("alt"))
    counts = tagged.agg(
        F.count(F.lit(1)).alias("raw_snps"),
        F.count(F.when(is_pass(), 1)).alias("pass_snps"),
        F.count(F.when(is_pass() & ti, 1)).alias("titv_ti"),
        F.count(F.when(is_pass() & ~ti, 1)).alias("titv_tv"),
    )
    depth = depth_summary(tagged, n_samples).select(F.struct("*").alias("s")).scalar()
    lost = F.col("raw_snps") - F.col("pass_snps")
    return counts.withColumn("__d", depth).select(
        F.lit(run).alias("run"),
        *([F.current_date().cast("string").alias("date")] if with_date else []),
        F.lit(n_samples).alias("n_samples"),
        "raw_snps",
        "pass_snps",
        pct_round2(lost, F.col("raw_snps")).alias("pct_removed"),
        safe_ratio(F.col("titv_ti"), F.col("titv_tv")).alias("titv"),
        F.col("titv_ti").cast("double").alias("titv_ti"),
        F.col("titv_tv").cast("double").alias("titv_tv"),
        F.bround("__d.mean_dp", 1).alias("dp_mean"),
        F.bround("__d.median_dp", 1).alias("dp_median"),
        F.bround("__d.sd_dp", 1).alias("dp_sd"),
        F.col("__d.dp_min_suggested").alias("dp_min_filter"),
        F.col("__d.dp_max_suggested").alias("dp_max_filter"),
    )


def hash_sample(df: DataFrame, keys: Sequence[str], n: int, digits: int = 4) -> DataFrame:
    """The `n` rows with the smallest key digest: a repeatable random sample.

    Counts per digest prefix (16 ** digits rows at most) tell which prefixes
    lie wholly inside the sample. Only the prefix the cut falls into is
    ranked, and only within itself. `keys` must identify a row.
    """
    digest = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))
    marked = df.withColumn("__digest", digest).withColumn("__prefix", F.substring("__digest", 1, digits))
    upto = Window.orderBy("__prefix").rowsBetween(Window.unboundedPreceding, -1)
    prefixes = marked.groupBy("__prefix").agg(F.count(F.lit(1)).alias("__n"))
    prefixes = prefixes.withColumn("__ahead", F.coalesce(F.sum("__n").over(upto), F.lit(0)))
    reached = prefixes.where(F.col("__ahead") < n)
    near = marked.join(F.broadcast(reached), "__prefix")
    whole = near.where(F.col("__ahead") + F.col("__n") <= n).select(*df.columns)
    inside = Window.partitionBy("__prefix").orderBy("__digest")
    cut = (
        near.where(F.col("__ahead") + F.col("__n") > n)
        .withColumn("__r", F.row_number().over(inside))
        .where(F.col("__ahead") + F.col("__r") <= n)
        .select(*df.columns)
    )
    return whole.unionByName(cut)
