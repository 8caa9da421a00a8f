"""Selecting, tagging and counting variant sites.

Sites: `chrom, pos, ref, alt, qual, qd, fs, sor, mq, mqranksum,
readposranksum, dp`; `alt` is a comma list. Tagged sites add `filter`, the
names of all failed rules joined by `;`, or `PASS`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varigrove.functions import bases as B
from varigrove.functions.numbers import pct_round2, safe_ratio

PASS = "PASS"


class Rule(NamedTuple):
    """A site fails if `column` lies strictly on the bad side of `limit`."""

    name: str
    column: str
    sign: str
    limit: float
    label: str

    def failed(self) -> Column:
        """Null where the annotation is null."""
        c = F.col(self.column)
        return c < self.limit if self.sign == "<" else c > self.limit

    @property
    def expression(self) -> str:
        return f"{self.label} {self.sign} {self.limit:.1f}"


# Names and limits of the hard filters.
RULES = (
    Rule("QD2", "qd", "<", 2.0, "QD"),
    Rule("QUAL30", "qual", "<", 30.0, "QUAL"),
    Rule("FS60", "fs", ">", 60.0, "FS"),
    Rule("SOR3", "sor", ">", 3.0, "SOR"),
    Rule("MQ40", "mq", "<", 40.0, "MQ"),
    Rule("MQRankSum-12.5", "mqranksum", "<", -12.5, "MQRankSum"),
    Rule("ReadPosRankSum-8", "readposranksum", "<", -8.0, "ReadPosRankSum"),
)


# -- selection ---------------------------------------------------------------

def classify(sites: DataFrame) -> DataFrame:
    """Variant type and number of alternate alleles."""
    return sites.withColumns(
        {
            "variant_type": B.variant_type(F.col("ref"), F.col("alt")),
            "n_alt": F.size(B.alleles(F.col("alt"))),
        }
    )


def is_snp() -> Column:
    return B.variant_type(F.col("ref"), F.col("alt")) == "SNP"


def is_biallelic() -> Column:
    return F.size(B.alleles(F.col("alt"))) == 1


def select_snps(sites: DataFrame) -> DataFrame:
    return sites.where(is_snp())


def biallelic(sites: DataFrame) -> DataFrame:
    return sites.where(is_biallelic())


def in_regions(sites: DataFrame, names: Sequence[str]) -> DataFrame:
    return sites.where(F.col("chrom").isin(*names))


def main_chromosomes(sites: DataFrame) -> DataFrame:
    return sites.where(F.col("chrom").rlike(r"^chr[0-9]+$"))


# -- hard filters ------------------------------------------------------------

def hard_filter(sites: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Tag every site; none is removed and a null annotation never fails."""
    failed = F.array_compact(F.array(*[F.when(r.failed(), F.lit(r.name)) for r in rules]))
    text = F.array_join(failed, ";")
    return sites.withColumn("filter", F.when(F.size(failed) > 0, text).otherwise(F.lit(PASS)))


def is_pass() -> Column:
    return F.col("filter") == PASS


def pass_label(tagged: DataFrame) -> DataFrame:
    return tagged.withColumn("pass", F.when(is_pass(), "PASS").otherwise("FAIL"))


def pass_only(tagged: DataFrame) -> DataFrame:
    return tagged.where(is_pass())


def _fails(rule: Rule) -> Column:
    return F.array_contains(F.split("filter", ";"), rule.name)


def filter_failures(tagged: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Sites failing each rule, 0 included, in one pass over the sites."""
    counts = tagged.agg(*[F.count(F.when(_fails(r), 1)).alias(r.name) for r in rules])
    rows = F.array(
        *[F.struct(F.lit(r.name).alias("filter"), F.col(f"`{r.name}`").alias("sites_failed")) for r in rules]
    )
    return counts.select(F.inline(rows))


def filter_combinations(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("filter").agg(F.count(F.lit(1)).alias("sites"))


def filter_counts_table(tagged: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Failures with the expression and percent of all sites, most first."""
    counts = tagged.agg(
        F.count(F.lit(1)).alias("raw_snps"), *[F.count(F.when(_fails(r), 1)).alias(r.name) for r in rules]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("filter"),
                F.col(f"`{r.name}`").alias("sites_failed"),
                F.lit(r.expression).alias("threshold"),
            )
            for r in rules
        ]
    )
    return (
        counts.select("raw_snps", F.inline(rows))
        .select(
            "filter",
            "sites_failed",
            "threshold",
            pct_round2(F.col("sites_failed"), F.col("raw_snps")).alias("pct_of_total"),
            "raw_snps",
        )
        .orderBy(F.desc("sites_failed"), "filter")
    )


def filter_attrition(sites: DataFrame, by: Sequence[str] = (), rules: Sequence[Rule] = RULES) -> DataFrame:
    """All sites, biallelic SNPs, passing ones and Ti/Tv, in one pass."""
    ref, alt = F.col("ref"), F.col("alt")
    raw = is_snp() & is_biallelic()
    good = raw & is_pass()
    count = lambda cond: F.count(F.when(cond, 1))
    ti = B.is_transition(ref, alt)
    out = (
        hard_filter(sites, rules)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("all_sites"),
            count(raw).alias("raw_snps"),
            count(good).alias("pass_snps"),
            count(good & ti).alias("ti"),
            count(good & ~ti).alias("tv"),
        )
    )
    return out.select(
        *by,
        "all_sites",
        "raw_snps",
        "pass_snps",
        (F.col("raw_snps") - F.col("pass_snps")).alias("removed"),
        pct_round2(F.col("raw_snps") - F.col("pass_snps"), F.col("raw_snps")).alias("pct_removed"),
        "ti",
        "tv",
        safe_ratio(F.col("ti"), F.col("tv")).alias("titv"),
    )


# -- statistics --------------------------------------------------------------

def titv(sites: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Transitions, transversions and their ratio; null over no transversion."""
    kind = B.substitution_class(F.col("ref"), F.col("alt"))
    out = sites.groupBy(*by).agg(
        F.count(F.when(kind == "transition", 1)).alias("ti"),
        F.count(F.when(kind == "transversion", 1)).alias("tv"),
    )
    return out.withColumn("titv", safe_ratio(F.col("ti"), F.col("tv")))


def variant_stats(sites: DataFrame) -> DataFrame:
    """Records, SNPs, indels and multiallelic sites per contig and in total."""
    kind = B.variant_type(F.col("ref"), F.col("alt"))
    n_alt = F.size(B.alleles(F.col("alt")))
    count = lambda cond: F.count(F.when(cond, 1))
    typed = sites.select("chrom", kind.alias("k"), n_alt.alias("n"))
    return (
        typed.rollup("chrom")
        .agg(
            F.grouping("chrom").alias("__all"),
            F.count(F.lit(1)).alias("records"),
            count(F.col("k") == "SNP").alias("snps"),
            count(F.col("k") == "INDEL").alias("indels"),
            count(~F.col("k").isin("SNP", "INDEL")).alias("others"),
            count(F.col("n") > 1).alias("multiallelic"),
        )
        .select(
            F.when(F.col("__all") == 1, "total").otherwise(F.col("chrom")).alias("region"),
            "records",
            "snps",
            "indels",
            "others",
            "multiallelic",
        )
    )


def append_runs(*runs: tuple[str, DataFrame]) -> DataFrame:
    """Tables of several runs under each other, the run name in front."""
    named = (df.select(F.lit(run).alias("run"), "*") for run, df in runs)
    return reduce(DataFrame.unionByName, named)


def compare_runs(runs: DataFrame, first: str, second: str) -> DataFrame:
    """Raw, passing and removed counts of two runs side by side."""
    sides = {"a": first, "b": second}
    pick = lambda c, run: F.max(F.when(F.col("run") == run, F.col(c)))
    both = runs.agg(
        *[pick("raw_snps", run).alias(f"raw_{s}") for s, run in sides.items()],
        *[pick("pass_snps", run).alias(f"pass_{s}") for s, run in sides.items()],
        *[pick("pct_removed", run).alias(f"pct_removed_{s}") for s, run in sides.items()],
    )
    return both.select(
        F.lit(first).alias("run_a"),
        F.lit(second).alias("run_b"),
        "raw_a",
        "raw_b",
        (F.col("raw_b") - F.col("raw_a")).alias("raw_change"),
        "pass_a",
        "pass_b",
        (F.col("pass_b") - F.col("pass_a")).alias("pass_change"),
        "pct_removed_a",
        "pct_removed_b",
    )
