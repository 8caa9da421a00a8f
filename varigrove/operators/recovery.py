"""Target loci: headers, probes, recovered lengths, reference building.

Contigs: `sample, locus, contig_no, exon_len, supercontig_len, depth`, more
than one row per sample and locus where copies were recovered. Targets:
`header, seq` and, once prepared, `locus`. Matrices are kept long; they turn
wide only where a file is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varigrove.functions import names as N
from varigrove.operators.joins import filled_grid, lookup_join, ordered_index, running_total

KINDS = {"gene": "exon_len", "supercontig": "supercontig_len"}
MEAN_ROW = "MeanLength"
SIZE_CUTOFF = 100_000


# -- targets and probes ------------------------------------------------------

def rewrite_headers(targets: DataFrame, taxon: str = N.TARGET_TAXON) -> DataFrame:
    return targets.withColumn("header", N.rewrite_target_header(F.col("header"), taxon)).withColumn(
        "locus", N.locus_of(F.col("header"))
    )


def target_count_check(targets: DataFrame, taxon: str = N.TARGET_TAXON) -> DataFrame:
    """Records before, records with a proper header after, and whether they agree."""
    proper = N.rewrite_target_header(F.col("header"), taxon).rlike(f"^{taxon}-[0-9]+$")
    return targets.agg(
        F.count(F.lit(1)).alias("records_in"), F.count(F.when(proper, 1)).alias("records_out")
    ).withColumn("ok", F.col("records_in") == F.col("records_out"))


def prepare_targets(targets: DataFrame, taxon: str = N.TARGET_TAXON) -> DataFrame:
    """Targets under their new headers; fails if a header could not be rewritten."""
    check = target_count_check(targets, taxon).first()
    if not check["ok"]:
        raise ValueError(f"{check['records_in']} targets, but {check['records_out']} headers were rewritten")
    return rewrite_headers(targets, taxon)


def check_unique_loci(prepared: DataFrame) -> DataFrame:
    """Headers against distinct loci."""
    return prepared.agg(
        F.count(F.lit(1)).alias("headers"), F.count_distinct("locus").alias("loci")
    ).withColumn("unique", F.col("headers") == F.col("loci"))


def probe_table(probes: DataFrame) -> DataFrame:
    return probes.withColumns(N.probe_fields(F.col("header")))


def probe_tiling(probes: DataFrame) -> DataFrame:
    """Per linkage group: regions, probes, probes per region, length, share of all."""
    parsed = probe_table(probes).withColumn("__len", F.length("seq"))
    per_region = parsed.groupBy("linkage_group", "region_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("__len").alias("bp")
    )
    total = probes.agg(F.count(F.lit(1))).scalar()
    return (
        per_region.groupBy("linkage_group")
        .agg(
            F.count(F.lit(1)).alias("regions"),
            F.sum("n").alias("probes"),
            F.max("n").alias("max_per_region"),
            F.sum("bp").alias("__bp"),
        )
        .select(
            "linkage_group",
            "regions",
            "probes",
            "max_per_region",
            (F.col("probes") / F.col("regions")).alias("mean_per_region"),
            (F.col("__bp") / F.col("probes")).alias("mean_length"),
            (F.col("probes") * 100.0 / total).alias("percent_of_probes"),
        )
    )


def head_of(targets: DataFrame, n: int = 5) -> DataFrame:
    """First headers by locus number, to look at."""
    return targets.orderBy("locus_no").limit(n)


# -- contigs -----------------------------------------------------------------

def best_contig(contigs: DataFrame) -> DataFrame:
    """Contig to keep per sample and locus: longest, then deepest, then first."""
    rank = F.struct(
        (-F.col("exon_len")).alias("a"),
        (-F.col("depth")).alias("b"),
        F.col("contig_no").alias("contig_no"),
        F.col("exon_len").alias("exon_len"),
        F.col("supercontig_len").alias("supercontig_len"),
        F.col("depth").alias("depth"),
    )
    best = contigs.groupBy("sample", "locus").agg(F.min(rank).alias("b"))
    return best.select("sample", "locus", "b.contig_no", "b.exon_len", "b.supercontig_len", "b.depth")


def sample_list(contigs: DataFrame) -> DataFrame:
    return contigs.select("sample").distinct()


def recovered_lengths(contigs: DataFrame, kind: str) -> DataFrame:
    """Length of the kept contig where there is one: `sample, locus, bp`."""
    return best_contig(contigs).select("sample", "locus", F.col(KINDS[kind]).alias("bp"))


def seq_lengths(contigs: DataFrame, loci: DataFrame, kind: str, targets: DataFrame | None = None) -> DataFrame:
    """Recovered length per sample and locus, 0 if there is none.

    With `targets(locus, seq)`, the mean target length per locus is added as a
    row named MeanLength.
    """
    grid = filled_grid(loci, sample_list(contigs), recovered_lengths(contigs, kind), "locus", "sample")
    cells = grid.select(
        F.col("sample").cast("string").alias("sample"),
        "locus",
        F.coalesce("bp", F.lit(0)).cast("double").alias("bp"),
    )
    if targets is None:
        return cells
    return cells.unionByName(
        target_lengths(targets).select(F.lit(MEAN_ROW).alias("sample"), "locus", F.col("ref_len").alias("bp"))
    )


def target_lengths(targets: DataFrame) -> DataFrame:
    return targets.groupBy("locus").agg(F.avg(F.length("seq")).alias("ref_len"))


def recovery_fraction(contigs: DataFrame, targets: DataFrame, kind: str = "gene") -> DataFrame:
    """Recovered over reference length per sample and locus, nothing recovered left out."""
    got = recovered_lengths(contigs, kind)
    return lookup_join(got, target_lengths(targets), ["locus"]).withColumn(
        "fraction", F.col("bp") / F.col("ref_len")
    )


def recovery_stats(fractions: DataFrame) -> DataFrame:
    """Loci with sequence and loci at 25, 50 and 75 percent, per sample."""
    at = lambda x: F.count(F.when(F.col("fraction") >= x, 1))
    return fractions.groupBy("sample").agg(
        F.count(F.when(F.col("bp") > 0, 1)).alias("with_sequence"),
        at(0.25).alias("at_25"),
        at(0.5).alias("at_50"),
        at(0.75).alias("at_75"),
        F.sum("bp").alias("total_bp"),
    )


def locus_recovery(contigs: DataFrame) -> DataFrame:
    """Samples per locus and mean length, loci per sample, and the grand total.

    Both margins come from one pass; a margin has the other key null.
    """
    lengths = recovered_lengths(contigs, "gene")
    return (
        lengths.groupingSets([["sample"], ["locus"], []], "sample", "locus")
        .agg(
            F.grouping_id().alias("__g"),
            F.count(F.lit(1)).alias("cells"),
            F.sum("bp").alias("total_bp"),
            F.avg("bp").alias("mean_bp"),
        )
        .withColumn(
            "margin", F.when(F.col("__g") == 1, "sample").when(F.col("__g") == 2, "locus").otherwise("all")
        )
        .drop("__g")
    )


def intron_lengths(contigs: DataFrame) -> DataFrame:
    """Supercontig minus exon length of the kept contig per sample and locus.

    Both lengths belong to one contig, so no join is needed.
    """
    exon, whole = F.col("exon_len"), F.col("supercontig_len")
    return best_contig(contigs).select(
        "sample", "locus", exon.alias("exon_bp"), whole.alias("supercontig_bp"), (whole - exon).alias("intron_bp")
    )


def retrieve_sequences(contigs: DataFrame, kind: str) -> DataFrame:
    """Kept sequences keyed by locus, ready to be written one file per locus.

    Rows stay rows: a locus is a folder of the written table, not a list in
    one task.
    """
    return recovered_lengths(contigs, kind).select(
        "locus", F.concat(F.lit("sample_"), F.col("sample").cast("string")).alias("header"), "sample", "bp"
    )


def sequence_sets(sequences: DataFrame) -> DataFrame:
    """What each locus file will hold."""
    return sequences.groupBy("locus").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("bp").alias("total_bp"),
        F.max("bp").alias("longest"),
        F.min("sample").alias("first_sample"),
        F.max("sample").alias("last_sample"),
    )


# -- reference ---------------------------------------------------------------

def longest_supercontig(contigs: DataFrame, clean: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Longest sequence per clean locus; the first sample and contig win ties.

    `carry` names further columns to keep, such as the sequence itself.
    """
    rank = F.struct(
        (-F.col("supercontig_len")).alias("a"),
        F.col("sample").alias("sample"),
        F.col("contig_no").alias("contig_no"),
        F.col("supercontig_len").alias("length"),
        *[F.col(c) for c in carry],
    )
    # Reduced to one row per locus first, so the semi-join has no crowded key.
    best = contigs.groupBy("locus").agg(F.min(rank).alias("b"))
    kept = best.join(clean.select("locus").distinct(), "locus", "left_semi")
    return kept.select("locus", "b.sample", "b.contig_no", "b.length", *[F.col(f"b.{c}") for c in carry])


def reference_manifest(reference: DataFrame, block: int = 4096) -> DataFrame:
    """Name, length and running offset of the sequences in order of their locus, a number or a name."""
    placed = ordered_index(reference.select("locus", "length"), ["locus"], "__nth")
    ends = running_total(placed, [], "__nth", "length", block, "end_offset")
    return ends.select(
        F.col("locus").cast("string").alias("name"),
        "length",
        (F.col("end_offset") - F.col("length")).alias("offset"),
        "end_offset",
    )


def loci_without_sequence(loci: DataFrame, sequences: DataFrame) -> DataFrame:
    return loci.select("locus").distinct().join(sequences.select("locus").distinct(), "locus", "left_anti")


def loci_except(loci: DataFrame, flagged: DataFrame) -> DataFrame:
    """All loci but the flagged ones."""
    return loci.select("locus").distinct().exceptAll(flagged.select("locus").distinct())


def loci_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("locus").intersect(b.select("locus"))


# -- assembly ----------------------------------------------------------------

def assembly_stats(seqs: DataFrame) -> DataFrame:
    """Count, bases and share per class of sequence, with a total row."""
    kind = F.when(F.col("name").rlike("^chr[0-9]+$"), "chromosome").otherwise("scaffold")
    whole = seqs.agg(F.sum("length")).scalar()
    return (
        seqs.select(kind.alias("class"), "length")
        .rollup("class")
        .agg(
            F.grouping("class").alias("__all"),
            F.count(F.lit(1)).alias("sequences"),
            F.sum("length").alias("total_bp"),
            F.min("length").alias("min_bp"),
            F.max("length").alias("max_bp"),
            F.avg("length").alias("mean_bp"),
        )
        .select(
            F.when(F.col("__all") == 1, "total").otherwise(F.col("class")).alias("class"),
            "sequences",
            "total_bp",
            "min_bp",
            "max_bp",
            "mean_bp",
            (F.col("total_bp") * 100.0 / whole).alias("percent"),
        )
    )


def size_cutoff(seqs: DataFrame, min_length: int = SIZE_CUTOFF) -> DataFrame:
    """Drop scaffolds up to the cut-off; chromosomes stay."""
    return seqs.where(F.col("name").rlike("^chr[0-9]+$") | (F.col("length") > min_length))
