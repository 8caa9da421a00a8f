"""Genotypes packed as vectors: two bits a call, 32 samples of a site in one long.

A cohort of 61 samples is two rows per site in place of 61 cells, and counts are
bit counts. The four states are no call, homozygous for the reference,
heterozygous and homozygous for an alternative; a call that its state does not
tell, such as `1/2` or a phased one, is listed beside the vector, so that the
cells come back as they were.

Vectors: `chrom, pos, block, calls, others`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varigrove.functions import bases as B
from varigrove.operators.joins import null_safe_join

PER_BLOCK = 32
SITE = ("chrom", "pos")
#: Genotype text of each state but the first, in order of its two bits.
TEXTS = ("0/0", "0/1", "1/1")
NO_CALL = "./."

# Fixed value: the lower bit of each of 32 pairs.
_LOWER = 0x5555555555555555


def slots(roster: DataFrame) -> DataFrame:
    """Places of the samples of `roster`, in order of their names: `sample, block, slot`. A null sample is one of them."""
    names = roster.agg(F.sort_array(F.collect_set(F.struct("sample"))).alias("names"))
    numbered = names.select(F.posexplode("names").alias("n", "key"))
    return numbered.select(
        F.col("key.sample").alias("sample"), F.floor(F.col("n") / PER_BLOCK).cast("int").alias("block"), (F.col("n") % PER_BLOCK).alias("slot")
    )


def _keyed(df: DataFrame) -> DataFrame:
    """A struct of the sample as key: structs compare nulls as equal."""
    return df.withColumn("__key", F.struct("sample"))


def pack(genotypes: DataFrame, roster: DataFrame) -> DataFrame:
    """Vectors of `genotypes(chrom, pos, sample, gt)`, in which a sample has one call per site.

    Calls of samples that `roster` does not list are left out. Bits of a site
    are combined on the map side, so a cell is moved as a share of a long. Only calls
    that their state does not tell are listed, in an aggregate of their own: lists beside the bits
    would have all cells sorted by site.
    """
    state = B.call_state(F.col("gt"))
    code = F.when(state == "hom_ref", 1).when(state == "het", 2).when(state == "hom_alt", 3).otherwise(0)
    placed = _keyed(genotypes.select(*SITE, "sample", "gt")).join(_keyed(slots(roster)).drop("sample"), "__key")
    bits = F.call_function("shiftleft", code.cast("long"), F.col("slot") * 2)
    plain = F.col("gt").isin(NO_CALL, *TEXTS) | F.col("gt").isNull()
    vectors = placed.groupBy(*SITE, "block").agg(F.bit_or(bits).alias("calls"))
    others = placed.where(~plain).groupBy(*SITE, "block").agg(F.sort_array(F.collect_list(F.struct("slot", "gt"))).alias("others"))
    nothing = F.expr("cast(array() as array<struct<slot:int,gt:string>>)")
    joined = null_safe_join(vectors, others, [*SITE, "block"], "left")
    return joined.withColumn("others", F.coalesce("others", nothing))


def _count(vector: Column, state: int) -> Column:
    """Calls of a state (1 to 3) in a vector."""
    lower, upper = vector, F.call_function("shiftrightunsigned", vector, F.lit(1))
    if not state & 1:
        lower = F.bitwise_not(lower)
    if not state & 2:
        upper = F.bitwise_not(upper)
    return F.bit_count(lower.bitwiseAND(upper).bitwiseAND(F.lit(_LOWER)))


def site_counts(vectors: DataFrame, roster: DataFrame) -> DataFrame:
    """`hom_ref, het, hom_alt, missing, f_missing` per site, over all samples of the roster."""
    size = roster.select("sample").distinct().agg(F.count(F.lit(1))).scalar()
    counted = vectors.groupBy(*SITE).agg(
        *[F.sum(_count(F.col("calls"), n)).alias(name) for n, name in enumerate(("hom_ref", "het", "hom_alt"), 1)]
    )
    missing = size - F.col("hom_ref") - F.col("het") - F.col("hom_alt")
    return counted.withColumn("missing", missing).withColumn("f_missing", F.col("missing") / size)


def sample_counts(vectors: DataFrame, roster: DataFrame) -> DataFrame:
    """`called, missing, f_missing` per sample, over all sites of the vectors.

    One aggregate with a sum for each place of a block: a row of it stands for 32 samples.
    """
    sites = vectors.select(*SITE).distinct().agg(F.count(F.lit(1))).scalar()
    pair = lambda n: F.call_function("shiftrightunsigned", F.col("calls"), F.lit(2 * n)).bitwiseAND(F.lit(3))
    sums = vectors.groupBy("block").agg(F.array(*[F.count(F.when(pair(n) != 0, 1)) for n in range(PER_BLOCK)]).alias("sums"))
    placed = slots(roster).join(sums, "block", "left")
    called = F.coalesce(F.get("sums", F.col("slot")), F.lit(0))
    return placed.select(
        "sample",
        called.alias("called"),
        (sites - called).alias("missing"),
        ((sites - called) / F.when(sites > 0, sites)).alias("f_missing"),
    )


def missingness_filter(vectors: DataFrame, roster: DataFrame, limit: float = 0.1) -> DataFrame:
    """Vectors of the sites with at most `limit` missing calls."""
    kept = site_counts(vectors, roster).where(F.col("f_missing") <= limit).select(*SITE)
    return vectors.join(kept, list(SITE), "left_semi")


def unpack(vectors: DataFrame, roster: DataFrame, sites: DataFrame | None = None) -> DataFrame:
    """The cells again, one for each sample of the roster and site: `chrom, pos, sample, gt`, `./.` where there is no call.

    With `sites`, those without any vector have cells too. This is the only step
    with a row per cell, and it makes them where the vector is.
    """
    names = slots(roster).groupBy("block").agg(F.sort_array(F.collect_list(F.struct("slot", "sample"))).alias("names"))
    if sites is not None:
        blocks = names.agg(F.sort_array(F.collect_list("block"))).scalar()
        every = sites.select(*SITE).distinct().withColumn("block", F.explode(blocks))
        vectors = every.join(vectors, [*SITE, "block"], "left")
    cells = vectors.join(names, "block").select(*SITE, "calls", "others", F.inline("names"))
    pair = F.call_function("shiftrightunsigned", F.coalesce("calls", F.lit(0).cast("long")), F.col("slot") * 2).bitwiseAND(F.lit(3))
    text = F.when(pair == 0, NO_CALL)
    for n, gt in enumerate(TEXTS, 1):
        text = text.when(pair == n, gt)
    listed = F.get(F.filter("others", lambda o: o["slot"] == F.col("slot")), F.lit(0))["gt"]
    gt = F.when(F.size("others") > 0, F.coalesce(listed, text)).otherwise(text)
    return cells.select(*SITE, "sample", gt.alias("gt"))
