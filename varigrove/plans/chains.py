"""End-to-end chains, from input tables to the review tables.

Some steps measure or checkpoint a side while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varigrove.operators import calling, genotyping, mapping, reads, recovery, variants
from varigrove.session import ensure_checkpoint_dir


def read_chain(raw: DataFrame, targets: DataFrame) -> DataFrame:
    """Raw reads to reads placed on targets."""
    return mapping.seed_join(reads.trim(raw), targets, step=1)


def evidence_chain(aln: DataFrame, reference: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Alignments to a pileup with reference bases, duplicates out, MAPQ 30 in.

    With read groups (`sample, lb`), duplicates are looked for in each library;
    a sample without one is a library of its own.
    """
    kept = mapping.min_mapq(aln)
    if groups is not None:
        kept = mapping.attach_read_groups(kept, groups.select("sample", F.col("lb").alias("library")))
        kept = kept.withColumn("library", F.coalesce("library", F.concat(F.lit("sample "), F.col("sample").cast("string"))))
    marked = mapping.mark_duplicates(kept)
    return calling.pileup_on(marked, reference)


def site_chain(piled: DataFrame) -> DataFrame:
    """Pileup to tagged biallelic SNPs."""
    return tagged_snps(calling.annotate_sites(piled))


def joint_chain(piled: DataFrame, blocks: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Pileup and reference-confidence intervals to joint genotype counts per site.

    The roster has every sample of the pileup, of the intervals and of `samples`,
    the sample map of the study, if it is given.

    The likelihoods are the per-sample stage of a study. Sites, calls and the
    roster all start from them, so they are checkpointed and the pileup is
    read once.
    """
    ensure_checkpoint_dir(piled.sparkSession)
    likelihoods = genotyping.genotype_likelihoods(piled).checkpoint()
    sites = genotyping.candidate_sites(likelihoods)
    calls = genotyping.call_genotypes(likelihoods)
    roster = likelihoods.select("sample").unionByName(blocks.select("sample"))
    if samples is not None:
        roster = roster.unionByName(samples.select("sample"))
    return calling.joint_counts(calling.known_cells(calls, sites, blocks), sites, roster)


def tagged_snps(sites: DataFrame) -> DataFrame:
    """Sites to tagged biallelic SNPs with their pass label."""
    snps = variants.biallelic(variants.select_snps(sites))
    return variants.pass_label(variants.hard_filter(snps))


def review(sites: DataFrame) -> DataFrame:
    """Attrition and Ti/Tv per contig: the run at a glance."""
    return variants.filter_attrition(sites, by=["chrom"])


def clean_reference(contigs: DataFrame, clean: DataFrame) -> DataFrame:
    """Contigs and clean loci to the manifest of the new reference."""
    best = recovery.longest_supercontig(contigs, clean)
    return recovery.reference_manifest(best.where(F.col("length") > 0))
