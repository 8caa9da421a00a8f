"""Evidence, genotypes and site annotations as aggregations.

These give the tables a variant caller gives, per-site evidence, genotype
likelihoods, reference-confidence intervals, joint genotypes and annotations,
from aligned bases. There is no local assembly and no pair model, so calls are
not claimed to equal those of an assembly-based caller.

Pileup: `sample, chrom, pos, ref, base, bq, mapq, strand, read_pos`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varigrove.functions import bases as B
from varigrove.operators import genotyping
from varigrove.operators.genotyping import SITE
from varigrove.operators.joins import gathered_join, interval_join, lookup_join, null_safe_join, with_roster
from varigrove.operators.mapping import aligned_stretches

CONFIDENT_GQ = 20
BLOCK_SPAN = 1 << 16

HOM_REF = "0/0"


# -- evidence ----------------------------------------------------------------

def _stretch_table(aln: DataFrame) -> DataFrame:
    """Gap-free stretches `chrom, start, stop, read_off` with what their bases need."""
    with_bases = {"seq", "qual"} <= set(aln.columns)
    carried = ["sample", "rname", "pos", "flag", "mapq"] + (["seq", "qual"] if with_bases else [])
    b = F.col("__b")
    return aligned_stretches(aln, carried).select(
        "sample",
        F.col("rname").alias("chrom"),
        (F.col("pos") + b["ref_off"]).cast("long").alias("start"),
        (F.col("pos") + b["ref_off"] + b["len"]).cast("long").alias("stop"),
        b["read_off"].alias("read_off"),
        B.has_flag(F.col("flag"), B.REVERSE).cast("int").alias("strand"),
        "mapq",
        *(["seq", "qual"] if with_bases else []),
    )


def _letters(text: Column) -> Column:
    """Bases of a text one by one, in upper case."""
    return F.split(F.when(text.rlike("[acgt]"), F.translate(text, "acgt", "ACGT")).otherwise(text), "")


def _expand(stretches: DataFrame, ref: Column | None = None, *more: Column) -> DataFrame:
    """One row per position of each stretch; `ref` is the reference along it.

    Bases come in upper case, and only A, C, G and T are evidence. Texts are cut
    into letters once a stretch: looking each one up by its place would read the text from its start every time.
    """
    n = (F.col("stop") - F.col("start")).cast("int")
    if not {"seq", "qual"} <= set(stretches.columns):
        placed = stretches.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("stop") - F.col("start") - 1)).alias("__i"))
    else:
        along = lambda c: F.substring(F.col(c), (F.col("read_off") + 1).cast("int"), n)
        # An array that is null would leave no row, and one that is too short ends in nulls.
        held = {"base": _letters(along("seq")), "q": F.split(along("qual"), "")} | ({"ref": _letters(ref)} if ref is not None else {})
        none = F.array().cast("array<string>")
        zipped = F.arrays_zip(*[F.coalesce(c, none).alias(name) for name, c in held.items()])
        placed = stretches.select("*", F.posexplode(zipped).alias("__i", "__at"))
    at = F.col("read_off") + F.col("__i") + 1
    letter = lambda name: F.col("__at").getField(name)
    phred = F.when(F.col("qual").isNotNull(), F.coalesce(F.ascii(letter("q")), F.lit(0)) - B.PHRED_OFFSET) if "__at" in placed.columns else None
    rows = placed.select(
        "sample",
        "chrom",
        (F.col("start") + F.col("__i")).alias("pos"),
        "strand",
        "mapq",
        at.cast("int").alias("read_pos"),
        *([letter("base").alias("base"), phred.alias("bq")] if phred is not None else []),
        *([letter("ref").alias("ref")] if ref is not None else []),
        *more,
    )
    letters = [c for c in ("base", "ref") if c in rows.columns]
    return rows.where(reduce(Column.__and__, (F.col(c).isin(*"ACGT") for c in letters), F.lit(True)))


def pileup(aln: DataFrame) -> DataFrame:
    """One row per aligned base, duplicates left out.

    Only the columns a row needs are carried into the expansion. `base` and
    `bq` are there if the alignments hold `seq` and `qual`.
    """
    return _expand(_stretch_table(aln))


def pileup_on(aln: DataFrame, reference: DataFrame, chunk: int = 1000) -> DataFrame:
    """Pileup with the reference base of each position, from `reference(name, seq)`.

    The reference is cut into pieces of `chunk` bases, and stretches at the
    borders of pieces. They are joined before they become rows per base: the
    shuffle moves reads, and the far larger pileup is made in place. Pieces
    that reads crowd on are salted: `piece` and `salt` say where a row is, see `base_counts`.
    """
    # One pass over a contig: looking each piece up by its place would read it from the start every time.
    cut = F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    pieces = reference.where(F.length("seq") > 0).select(
        F.col("name").alias("chrom"), F.posexplode(cut).alias("__piece", "__ref")
    )
    touched = F.sequence(F.floor((F.col("start") - 1) / chunk), F.floor((F.col("stop") - 2) / chunk))
    # Positions count from 1, so piece p covers p * chunk + 1 up to (p + 1) * chunk.
    first = F.greatest(F.col("start"), F.col("__piece") * chunk + 1)
    parts = (
        _stretch_table(aln)
        .withColumn("__piece", F.explode(touched))
        .withColumns(
            {
                "read_off": F.col("read_off") + first - F.col("start"),
                "stop": F.least(F.col("stop"), (F.col("__piece") + 1) * chunk + 1),
                "start": first,
            }
        )
    )
    met = gathered_join(parts, pieces, ["chrom", "__piece"])
    at = F.pmod(F.col("start") - 1, F.lit(chunk)) + 1
    ref = F.substring(F.col("__ref"), at.cast("int"), (F.col("stop") - F.col("start")).cast("int"))
    return _expand(met, ref, F.col("__piece").alias("piece"), F.col("__salt").alias("salt"))


def base_counts(piled: DataFrame) -> DataFrame:
    """Bases, summed quality and named samples of each position, reference base and base of `pileup_on`.

    There are nearly as many groups as positions with reads, so they are made in the task
    that holds a piece and never moved, but for pieces that were salted.
    """
    base = [*SITE, "ref", "base"]
    counted = {"bases": F.count(F.lit(1)), "quality": F.sum("bq"), "named": F.count("sample")}
    own = piled.groupBy("chrom", "piece", "salt", "pos", "ref", "base").agg(*[c.alias(n) for n, c in counted.items()])
    salted = own.where(F.col("salt") >= 0).groupBy(*base).agg(*[F.sum(n).alias(n) for n in counted])
    return own.where(F.col("salt") < 0).select(*base, *counted).unionByName(salted)


def _is_alt() -> Column:
    return F.col("base") != F.col("ref")


def allele_counts(piled: DataFrame) -> DataFrame:
    """Depth per sample, site and base, by strand."""
    return piled.groupBy("sample", *SITE, "ref", "base").agg(
        F.count(F.lit(1)).alias("depth"),
        F.count(F.when(F.col("strand") == 0, 1)).alias("forward"),
        F.count(F.when(F.col("strand") == 1, 1)).alias("reverse"),
    )


# -- reference-confidence intervals ------------------------------------------

def reference_blocks(calls: DataFrame, confident: int = CONFIDENT_GQ, span: int = BLOCK_SPAN) -> DataFrame:
    """Runs of adjacent hom-ref positions of one confidence band.

    Runs are found inside stretches of `span` positions, so a long contig of
    one sample is many small windows. Only pieces that touch the edge of a
    stretch, two per stretch at most and band, can go on in the next one; they
    are joined up in a second, small window.
    """
    band = F.when(F.col("gq") >= confident, "confident").otherwise("low")
    keys = ["sample", "chrom", "band"]
    hom = calls.where(F.col("gt") == HOM_REF).select(
        "sample", "chrom", "pos", "gq", band.alias("band"), F.floor(F.col("pos") / span).alias("__s")
    )
    inside = Window.partitionBy(*keys, "__s").orderBy("pos")
    pieces = (
        hom.withColumn("__run", F.col("pos") - F.row_number().over(inside))
        .groupBy(*keys, "__s", "__run")
        .agg(F.min("pos").alias("start"), F.max("pos").alias("stop"), F.min("gq").alias("gq"))
    )
    at_edge = (F.col("start") == F.col("__s") * span) | (F.col("stop") == (F.col("__s") + 1) * span - 1)
    columns = [*keys, "start", "stop", "gq"]
    along = Window.partitionBy(*keys).orderBy("start")
    new = F.when(F.lag("stop").over(along) == F.col("start") - 1, 0).otherwise(1)
    joined = (
        pieces.where(at_edge)
        .withColumn("__new", new)
        .withColumn("__island", F.sum("__new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "__island")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("gq").alias("gq"))
        .select(*columns)
    )
    return pieces.where(~at_edge).select(*columns).unionByName(joined)


# -- cohort ------------------------------------------------------------------

def combine_cohort(calls: DataFrame, blocks: DataFrame) -> DataFrame:
    """Variant calls and reference-confidence intervals of all samples in one table."""
    variant = calls.where(F.col("gt") != HOM_REF).select(
        "sample",
        "chrom",
        F.col("pos").alias("start"),
        F.col("pos").alias("stop"),
        "gt",
        "gq",
        F.lit(False).alias("is_block"),
    )
    interval = blocks.select(
        "sample", "chrom", "start", "stop", F.lit(HOM_REF).alias("gt"), "gq", F.lit(True).alias("is_block")
    )
    return variant.unionByName(interval)


def blocks_over_sites(blocks: DataFrame, sites: DataFrame) -> DataFrame:
    """Every reference-confidence interval with the sites it covers."""
    return interval_join(blocks, sites.select(*SITE), "chrom", "start", "stop", "pos")


def cohort_grid(sites: DataFrame, samples: DataFrame, calls: DataFrame) -> DataFrame:
    """One cell per site and sample, a null sample among them; `./.` where there is no call.

    The join key is the cell itself, so no key is hot.
    """
    cells = with_roster(sites.select(*SITE), samples, "sample")
    return null_safe_join(cells, calls, [*SITE, "sample"], "left").withColumn("gt", F.coalesce("gt", F.lit("./.")))


def joint_cells(calls: DataFrame, sites: DataFrame, samples: DataFrame, blocks: DataFrame | None = None) -> DataFrame:
    """Genotype of every sample at every candidate site.

    Where a sample has no call but a reference-confidence interval covers the
    site, it counts as 0/0 with the best quality among such intervals.
    """
    own = calls.select("sample", *SITE, "gt", "gq", "dp")
    grid = cohort_grid(sites, samples, own)
    if blocks is None:
        return grid
    covered = (
        blocks_over_sites(blocks, sites).groupBy(*SITE, "sample").agg(F.max("gq").alias("__block_gq"))
    )
    silent = F.col("gt") == "./."
    return (
        null_safe_join(grid, covered, [*SITE, "sample"], "left")
        .withColumn("gq", F.when(silent, F.col("__block_gq")).otherwise(F.col("gq")))
        .withColumn("gt", F.when(silent & F.col("__block_gq").isNotNull(), HOM_REF).otherwise(F.col("gt")))
        .drop("__block_gq")
    )


def known_cells(calls: DataFrame, sites: DataFrame, blocks: DataFrame) -> DataFrame:
    """The cells of candidate sites that a call or a reference-confidence interval fills: sample, site, gt.

    A call counts before an interval. Cells without either are not made.
    """
    own = calls.join(sites.select(*SITE), list(SITE), "left_semi").select("sample", *SITE, "gt")
    covered = blocks_over_sites(blocks, sites).select("sample", *SITE, F.lit(None).cast("string").alias("gt"))
    merged = own.unionByName(covered).groupBy("sample", *SITE).agg(F.max("gt").alias("gt"))
    return merged.withColumn("gt", F.coalesce("gt", F.lit(HOM_REF)))


def joint_counts(cells: DataFrame, sites: DataFrame, samples: DataFrame) -> DataFrame:
    """As `genotyping.joint_genotype`, from the filled cells and the roster of `samples`.

    Cells that are not there are counted as the rest of the roster.
    """
    size = samples.select("sample").distinct().agg(F.count(F.lit(1)).alias("n"))
    return genotyping.joint_genotype(cells, sites).withColumn("no_call", size.scalar() - F.col("called"))


# -- site annotations --------------------------------------------------------

def qual_by_depth(quality: DataFrame) -> DataFrame:
    return quality.withColumn("qd", F.col("qual") / F.when(F.col("dp") > 0, F.col("dp")))


def _strand_columns() -> list[Column]:
    """Reads by allele and strand as aggregates."""
    alt = _is_alt()
    count = lambda cond: F.count(F.when(cond, 1))
    forward, reverse = F.col("strand") == 0, F.col("strand") == 1
    return [
        count(~alt & forward).alias("ref_f"),
        count(~alt & reverse).alias("ref_r"),
        count(alt & forward).alias("alt_f"),
        count(alt & reverse).alias("alt_r"),
    ]


def strand_table(piled: DataFrame) -> DataFrame:
    """Reads by allele and strand per site."""
    return piled.groupBy(*SITE).agg(*_strand_columns())


def _fisher_log10(a: Column, b: Column, c: Column, d: Column) -> Column:
    """log10 of the two-sided exact p of a 2x2 table, which itself may be too small for a double.

    Weights of the tables with the same margins follow from each other by ratio,
    starting at the lowest. One walk finds the weight of the table that was seen
    and the largest, a second adds up all weights, and those that are no larger
    than the one seen. Both keep a few numbers, whatever the depth.
    """
    row, other, col = a + b, c + d, a + c
    low, high = F.greatest(F.lit(0).cast("long"), col - other), F.least(row, col)
    steps = F.sequence(low, F.greatest(high - 1, low))

    def ratio(x: Column) -> Column:  # from table x to x + 1, in doubles, as products pass 64 bits
        f = lambda e: e.cast("double")
        return F.log(f(row - x)) + F.log(f(col - x)) - F.log(f(x + 1)) - F.log(f(other - col + x + 1))

    zero = F.lit(0.0)
    found = F.aggregate(
        steps,
        F.struct(zero.alias("last"), zero.alias("seen"), zero.alias("peak")),
        lambda s, x: F.struct(
            (s["last"] + ratio(x)).alias("last"),
            F.when(x + 1 == a, s["last"] + ratio(x)).otherwise(s["seen"]).alias("seen"),
            F.greatest(s["peak"], s["last"] + ratio(x)).alias("peak"),
        ),
    )

    def added(seen: Column, peak: Column) -> Column:
        # Weights that differ by rounding only are equal.
        counts = lambda w: F.when(w <= seen + 1e-7, F.exp(w - seen)).otherwise(0.0)
        return F.aggregate(
            steps,
            F.struct(zero.alias("last"), F.exp(-peak).alias("total"), counts(zero).alias("extreme")),
            lambda s, x: F.struct(
                (s["last"] + ratio(x)).alias("last"),
                (s["total"] + F.exp(s["last"] + ratio(x) - peak)).alias("total"),
                (s["extreme"] + counts(s["last"] + ratio(x))).alias("extreme"),
            ),
            lambda s: (F.log(s["extreme"]) + seen - F.log(s["total"]) - peak) / F.log(F.lit(10.0)),
        )

    # Bound as lambda variables, so that the first walk is made once.
    p = F.transform(F.array(found), lambda f: added(f["seen"], f["peak"]))[0]
    return F.when(low < high, F.least(p, zero)).otherwise(zero)


def fisher_strand(table: DataFrame) -> DataFrame:
    """Phred p-value of the strand table, as an expression over each site's four counts."""
    cells = [F.col(c) for c in ("ref_f", "ref_r", "alt_f", "alt_r")]
    return table.withColumn("fs", F.abs(_fisher_log10(*cells) * -10.0))


def strand_odds_ratio(table: DataFrame) -> DataFrame:
    """Symmetric log odds ratio, each cell one higher."""
    rf, rr, af, ar = (F.col(c) + 1.0 for c in ("ref_f", "ref_r", "alt_f", "alt_r"))
    ratio = (rf * ar) / (rr * af)
    skew = lambda x, y: F.log(F.least(x, y) / F.greatest(x, y))
    return table.withColumn("sor", F.log(ratio + 1 / ratio) + skew(rf, rr) - skew(af, ar))


def rms_mapq(piled: DataFrame) -> DataFrame:
    return piled.groupBy(*SITE).agg(F.sqrt(F.avg(F.col("mapq") * F.col("mapq"))).alias("mq"))


def rank_sum(piled: DataFrame, value: str, name: str) -> DataFrame:
    """Wilcoxon z of `value`, reads with the alternative against the others.

    Ranks come from counts per distinct value (a mapping quality or a place in
    the read, so few per site); the reads of a site are never sorted. Null
    unless both alleles were seen.
    """
    alt = F.count(F.when(_is_alt(), 1))
    counts = piled.groupBy(*SITE, value).agg(F.count(F.lit(1)).alias("n"), alt.alias("alt"))
    below = Window.partitionBy(*SITE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    mean_rank = F.coalesce(F.sum("n").over(below), F.lit(0)) + (F.col("n") + 1) / 2.0
    # Products of two counts of a deep site do not fit a long.
    n1, n0 = F.col("n_alt").cast("double"), F.col("n_ref").cast("double")
    u = F.col("ranks") - n1 * (n1 + 1) / 2.0
    z = (u - n1 * n0 / 2.0) / F.sqrt(n1 * n0 * (n1 + n0 + 1) / 12.0)
    return (
        counts.withColumn("__r", mean_rank * F.col("alt"))
        .groupBy(*SITE)
        .agg(
            F.sum("alt").alias("n_alt"),
            (F.sum("n") - F.sum("alt")).alias("n_ref"),
            F.sum("__r").alias("ranks"),
        )
        .select(*SITE, "n_ref", "n_alt", F.when((n1 > 0) & (n0 > 0), z).alias(name))
    )


def mapq_rank_sum(piled: DataFrame) -> DataFrame:
    return rank_sum(piled, "mapq", "mq_rank_sum")


def readpos_rank_sum(piled: DataFrame) -> DataFrame:
    return rank_sum(piled, "read_pos", "read_pos_rank_sum")


def site_depth(piled: DataFrame, by: Sequence[str] = SITE) -> DataFrame:
    return piled.groupBy(*by).agg(F.count(F.lit(1)).alias("dp"))


def annotate_sites(piled: DataFrame) -> DataFrame:
    """Candidate sites with their alternatives and all annotations the hard filters read.

    The pileup is by far the largest table of a study. One aggregate of it per
    sample and site feeds allele lists, likelihoods and all annotations that are
    sums; the two rank sums need counts by value, one aggregate each. Strand
    counts and rank sums hold all alternatives of a site against the reference.
    """
    cells = ("ref_f", "ref_r", "alt_f", "alt_r")
    piled = genotyping.evidence(piled)
    per_sample = genotyping.genotype_likelihoods(
        piled, [*cells, "__mapq2"], [*_strand_columns(), F.sum(F.col("mapq") * F.col("mapq")).alias("__mapq2")]
    )
    summed = (
        per_sample.groupBy(*SITE, "ref", "alleles")
        .agg(
            *genotyping.frequency_sums(),
            F.sum("dp").alias("dp"),
            *[F.sum(c).alias(c) for c in cells],
            F.sqrt(F.sum("__mapq2") / F.sum("dp")).alias("mq"),
        )
        .where(F.col("alt_f") + F.col("alt_r") > 0)
        .withColumn("qual", genotyping.quality_of())
        .withColumn("alt", genotyping.alternatives(F.col("alleles")))
        .select(*SITE, "ref", "alt", "qual", "dp", *cells, "mq")
    )
    annotated = qual_by_depth(fisher_strand(strand_odds_ratio(summed))).drop(*cells)
    site = list(SITE)
    z = lambda df, name, new: df.select(*site, F.col(name).alias(new))
    return annotated.join(z(mapq_rank_sum(piled), "mq_rank_sum", "mqranksum"), site).join(
        z(readpos_rank_sum(piled), "read_pos_rank_sum", "readposranksum"), site
    )
