"""Genotypes over an ordered list of alleles per site.

A site has its reference base and, most often seen first, every other base that
any sample shows. Likelihoods are an array over pairs of alleles, in the order
0/0, 0/1, 1/1, 0/2, 1/2, 2/2 and so on, so a site with two alternatives has six.
One aggregate of the pileup keeps what any pair needs: for each base, what its
rows gain if it is one or both of the two alleles. Allele lists, likelihoods and
everything per site then come from those sums, one row per sample and site.

Pileup: `sample, chrom, pos, ref, base, bq`; other bases than A, C, G and T are
no evidence. A null sample is a sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varigrove.functions import bases as B

LETTERS = "ACGT"
SITE = ("chrom", "pos")
GQ_CAP = 99
#: Error probability beyond which a base says less than a random one.
WORST_ERROR = 0.75
#: Stands for any other base at a site where none was seen.
UNSEEN = "<NON_REF>"
#: Pairs of up to four alleles, in order.
PAIRS = [(i, j) for j in range(4) for i in range(j + 1)]
GENOTYPES = [f"{i}/{j}" for i, j in PAIRS]

#: Frequencies of the alternatives that the site quality weighs, and the chance that a site varies at all.
FREQUENCIES = tuple(2.0**-k for k in range(6, 0, -1)) + tuple(1 - 2.0**-k for k in range(2, 7))
VARIABLE = 0.001


# -- sums per sample and site ------------------------------------------------

def base_sums(worst: float = WORST_ERROR) -> list[Column]:
    """Aggregates of a pileup: depth, the log10 likelihood of no allele fitting, and gains by base."""
    e = F.least(B.error_probability(F.col("bq")), F.lit(worst))
    neither, both, one = F.log10(e / 3), F.log10(1 - e), F.log10((1 - e) / 2 + e / 6)
    out = [F.count(F.lit(1)).alias("dp"), F.sum(neither).alias("__none")]
    for x in LETTERS:
        mine = F.col("base") == x
        out += [
            F.count(F.when(mine, 1)).alias(f"__n_{x}"),
            F.coalesce(F.sum(F.when(mine, both - neither)), F.lit(0.0)).alias(f"__both_{x}"),
            F.coalesce(F.sum(F.when(mine, one - neither)), F.lit(0.0)).alias(f"__one_{x}"),
        ]
    return out


SUMS = ["__none", *(f"__{k}_{x}" for x in LETTERS for k in ("n", "both", "one"))]


def evidence(piled: DataFrame) -> DataFrame:
    """Rows of a pileup that say something about a base."""
    return piled.where(F.col("base").isin(*LETTERS) & F.col("ref").isin(*LETTERS))


def _ordered_alleles(count: dict[str, Column]) -> Column:
    """The reference and the other bases that were counted, most first, ties by letter."""
    seen = [
        F.when((count[x] > 0) & (F.col("ref") != x), F.struct((-count[x]).alias("r"), F.lit(x).alias("base"))) for x in LETTERS
    ]
    alternatives = F.transform(F.array_sort(F.array_compact(F.array(*seen))), lambda s: s["base"])
    some = F.when(F.size(alternatives) > 0, alternatives).otherwise(F.array(F.lit(UNSEEN)))
    return F.concat(F.array("ref"), some)


def with_alleles(summed: DataFrame) -> DataFrame:
    """Rows per sample and site with the allele list of their site, and its depth by allele over all samples.

    The rows of a site meet in a window: one for each sample that covers it.
    """
    whole = Window.partitionBy(*SITE, "ref")
    totals = summed.withColumns({f"__all_{x}": F.sum(f"__n_{x}").over(whole) for x in LETTERS})
    listed = _settled(totals, alleles=_ordered_alleles({x: F.col(f"__all_{x}") for x in LETTERS}))
    depths = F.slice(F.array(*[_of(F.get("alleles", F.lit(i)), "all", F.lit(0)) for i in range(4)]), F.lit(1), F.size("alleles"))
    return listed.withColumn("site_ad", depths).drop(*[f"__all_{x}" for x in LETTERS])


def _of(letter: Column, kind: str, unseen: Column) -> Column:
    """The sum of one kind of the base that `letter` names."""
    found = F.when(letter == LETTERS[0], F.col(f"__{kind}_{LETTERS[0]}"))
    for x in LETTERS[1:]:
        found = found.when(letter == x, F.col(f"__{kind}_{x}"))
    return found.otherwise(unseen)


def _settled(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with further columns, worked out once: what follows, a filter too, sees them as columns and not as their expressions."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _with_likelihoods(listed: DataFrame) -> DataFrame:
    """`gl`, the log10 likelihoods of all pairs of `alleles` in order, and `ad`, the sample's bases by allele.

    The sums of the alleles are looked up once; the pairs then add two of them.
    """
    allele = [F.get("alleles", F.lit(i)) for i in range(4)]
    gains = {f"__{kind}{i}": _of(a, kind, F.lit(0.0)) for kind in ("both", "one") for i, a in enumerate(allele)}
    both, one = ([F.col(f"__{kind}{i}") for i in range(4)] for kind in ("both", "one"))
    each = [F.col("__none") + (both[i] if i == j else one[i] + one[j]) for i, j in PAIRS]
    n = F.size("alleles")
    ad = F.slice(F.array(*[_of(a, "n", F.lit(0)) for a in allele]), F.lit(1), n)
    return _settled(_settled(listed, ad=ad, **gains), gl=F.slice(F.array(*each), F.lit(1), (n * (n + 1) / 2).cast("int")))


def genotype_likelihoods(piled: DataFrame, keep: Sequence[str] = (), more: Sequence[Column] = ()) -> DataFrame:
    """`sample, chrom, pos, ref, alleles, dp, ad, gl` for each sample and site, and `site_ad`.

    `ad` counts the sample's bases by allele, `site_ad` those of all samples.
    Where nobody shows another base, the list holds the reference and `<NON_REF>`,
    so that there is a likelihood of not being homozygous for the reference. `more` are further
    aggregates of the pileup, named in `keep`.
    """
    summed = evidence(piled).groupBy("sample", *SITE, "ref").agg(*base_sums(), *more)
    return _with_likelihoods(with_alleles(summed)).select(
        "sample", *SITE, "ref", "alleles", "dp", "ad", "site_ad", "gl", *keep
    )


# -- calls -------------------------------------------------------------------

def call_genotypes(likelihoods: DataFrame) -> DataFrame:
    """Best genotype under a flat prior, scaled likelihoods and its quality.

    Likelihoods that agree to nine decimals are equal, since sums depend on the
    order of their terms; the first of equals is called.
    """
    scaled = F.transform("gl", lambda g: F.round((F.col("__top") - g) * 10.0).cast("int"))
    equal = F.transform("gl", lambda g: F.round(F.col("__top") - g, 9) == 0)
    best = F.array_position(equal, True).cast("int")
    topped = _settled(likelihoods, __top=F.array_max("gl"))
    called = _settled(topped, pl=scaled, gt=F.element_at(F.array(*map(F.lit, GENOTYPES)), best))
    quality = F.least(F.sort_array("pl")[1], F.lit(GQ_CAP)).alias("gq")
    return called.select("sample", *SITE, "ref", "alleles", "dp", "ad", "gt", quality, "pl")


def alternatives(alleles: Column) -> Column:
    """The alternatives of an allele list as comma text."""
    return F.array_join(F.slice(alleles, F.lit(2), F.size(alleles) - 1), ",")


def _others(counts: str) -> Column:
    """How many bases are not the reference."""
    return F.aggregate(F.slice(counts, F.lit(2), F.size(counts) - 1), F.lit(0).cast("long"), lambda acc, n: acc + n)


def candidate_sites(likelihoods: DataFrame) -> DataFrame:
    """Sites where at least one sample shows an alternative, with their allele list."""
    shown = _others("ad")
    return (
        likelihoods.groupBy(*SITE, "ref", "alleles", "site_ad")
        .agg(
            F.max(shown).alias("max_alt_dp"),
            F.sum("dp").alias("dp"),
            F.count(F.when(shown > 0, 1)).alias("samples_with_alt"),
        )
        .where(F.col("max_alt_dp") > 0)
    )


def joint_genotype(cells: DataFrame, sites: DataFrame) -> DataFrame:
    """Call counts per site and, for each alternative, its count and frequency: `ac` and `af` follow `alleles`.

    Cells hold `gt` over the allele list of `sites`; one with a `.` is no call.
    """
    called = ~B.is_missing(F.col("gt"))
    first, second = F.substring("gt", 1, 1), F.substring("gt", -1, 1)
    times = lambda k: F.length("gt") - F.length(F.translate("gt", str(k), ""))
    counted = cells.groupBy(*SITE).agg(
        F.count(F.when(called, 1)).alias("called"),
        F.count(F.when(~called, 1)).alias("no_call"),
        F.count(F.when(called & (first != second), 1)).alias("het"),
        F.count(F.when(called & (first == second) & (first != "0"), 1)).alias("hom_alt"),
        *[F.sum(F.when(called, times(k)).otherwise(0)).alias(f"__ac{k}") for k in (1, 2, 3)],
    )
    ac = F.slice(F.array("__ac1", "__ac2", "__ac3"), F.lit(1), F.size("alleles") - 1)
    return (
        counted.join(sites.select(*SITE, "ref", "alleles"), list(SITE))
        .withColumn("ac", ac)
        .withColumn("an", F.col("called") * 2)
        .withColumn("af", F.transform("ac", lambda n: n / F.when(F.col("an") > 0, F.col("an"))))
        .select(*SITE, "ref", "alleles", "called", "no_call", "het", "hom_alt", "ac", "an", "af")
    )


# -- site quality ------------------------------------------------------------

def _by_frequency() -> list[Column]:
    """log10 likelihood of a sample, relative to its best pair, if the alternatives have frequency 0 and each of FREQUENCIES.

    Alleles combine at random, and alternatives share their frequency as they
    share the bases seen. Pairs without, with one and with two alternatives then
    enter as three weights. No logarithm is of zero: the best pair weighs one.
    """
    total = _others("site_ad")
    share = lambda i: F.when(total > 0, F.coalesce(F.get("site_ad", F.lit(i)), F.lit(0)) / total).otherwise(
        F.lit(1.0 if i == 1 else 0.0)
    )
    s = {i: share(i) for i in (1, 2, 3)}
    top = F.array_max("gl")
    weight = {
        p: F.coalesce(F.pow(F.lit(10.0), F.get("gl", F.lit(n)) - top), F.lit(0.0)) for n, p in enumerate(PAIRS)
    }
    none = weight[0, 0]
    one = sum((s[j] * 2 * weight[i, j] for i, j in PAIRS if i == 0 < j), F.lit(0.0))
    two = sum((s[i] * s[j] * (1 if i == j else 2) * weight[i, j] for i, j in PAIRS if i > 0), F.lit(0.0))
    at = lambda f: F.log10(F.lit((1 - f) ** 2) * none + F.lit(f * (1 - f)) * one + F.lit(f * f) * two)
    return [F.get("gl", F.lit(0)) - top, *(at(f) for f in FREQUENCIES)]


def frequency_sums() -> list[Column]:
    """Aggregates over the samples of a site, for `quality_of`."""
    return [F.sum(c).alias(f"__f{n}") for n, c in enumerate(_by_frequency())]


def quality_of(variable: float = VARIABLE) -> Column:
    """Phred posterior that the alternatives have frequency 0, from `frequency_sums`.

    A site varies with the chance `variable`, and a frequency is the likelier
    the lower it is (in proportion to 1/f).
    """
    odds = sum(1 / f for f in FREQUENCIES)
    priors = [1 - variable, *(variable / f / odds for f in FREQUENCIES)]
    terms = [F.col(f"__f{n}") + F.log10(F.lit(p)) for n, p in enumerate(priors)]
    top = F.greatest(*terms)
    whole = top + F.log10(sum((F.pow(F.lit(10.0), t - top) for t in terms), F.lit(0.0)))
    return F.greatest((whole - terms[0]) * 10.0, F.lit(0.0))


def site_quality(likelihoods: DataFrame) -> DataFrame:
    """Phred confidence that a site varies, from the posterior of the allele frequency over all samples."""
    summed = likelihoods.groupBy(*SITE).agg(*frequency_sums(), F.sum("dp").alias("dp"))
    return summed.select(*SITE, quality_of().alias("qual"), "dp")
