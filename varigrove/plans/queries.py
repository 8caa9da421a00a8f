"""Registered queries: each runs one operator over whole tables.

Doubles are rounded at the edge, since sums of doubles depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varigrove.functions import bases as B
from varigrove.functions import names as N
from varigrove.operators import (
    calling,
    cohort,
    genotyping,
    joins,
    mapping,
    packed,
    paralogs,
    reads,
    recovery,
    samples,
    variants,
)
from varigrove.plans import chains
from varigrove.plans.inputs import Inputs
from varigrove.session import scratch_path
from varigrove.sources import alignments, fasta, fastq, tables, vcf

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}

N_SAMPLES = 61  # fixed value: size of the study behind the suggested depth bound
LAST_CHROM = 14
CHROMS = [f"chr{i:02d}" for i in range(1, LAST_CHROM + 1)]


def query(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(Inputs(spark, sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded."""
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


# -- sources, samples, manifests ---------------------------------------------

@query
def sample_discovery(x):
    return samples.discover_samples(x.files())


@query
def annotation_extract(x):
    return vcf.annotation_columns(variants.hard_filter(x.sites()))


# -- files written from a table and read back --------------------------------

@query
def fasta_file(x):
    path = scratch_path(x.spark, "fasta")
    fasta.write_fasta(x.targets(), path)
    return fasta.read_fasta(x.spark, path).select("header", "seq")


@query
def name_list_file(x):
    path = scratch_path(x.spark, "names")
    fasta.write_names(x.loci(), "locus", path)
    return fasta.read_names(x.spark, path)


@query
def fastq_file(x):
    path = scratch_path(x.spark, "fastq")
    record = F.concat_ws("\n", F.concat(F.lit("@"), F.col("read_id"), F.lit(" mate")), "seq", F.lit("+"), "qual")
    x.reads().select(record.alias("value")).write.option("compression", "gzip").text(path)
    return fastq.read_fastq(x.spark, path).select("read_id", "seq", "qual")


@query
def sam_file(x):
    path = scratch_path(x.spark, "sam")
    group = F.concat(F.lit("RG:Z:a_b_"), F.col("sample").cast("string"), F.lit("_lane"))
    fields = ["qname", "flag", "rname", "pos", "mapq", "cigar", F.lit("="), F.lit("0"), F.lit("0"), "seq", "qual", group]
    text = [F.col(f).cast("string") if isinstance(f, str) else f for f in fields]
    lines = x.target_alignments().select(F.concat_ws("\t", *text).alias("value"))
    lines.write.option("compression", "gzip").text(path)
    return alignments.read_sam(x.spark, path).select("rname", "pos", "flag", "cigar", "rnext", "seq", "qual", "sample", "sum_bq")


@query
def vcf_file(x):
    path = scratch_path(x.spark, "vcf")
    vcf.write_vcf(x.sites(), path)
    wanted = ["chrom", "pos", "ref", "alt", "qual", *vcf.INFO_KEYS]
    return vcf.read_vcf(x.spark, path).select(*wanted)


@query
def vcf_genotypes_file(x):
    path = scratch_path(x.spark, "vcf")
    vcf.write_vcf(x.sites(), path, x.genotypes(), compression="gzip")
    names = vcf.sample_columns(x.spark, path)
    return vcf.genotypes(vcf.read_vcf(x.spark, path), names).select("chrom", "pos", "sample", "gt")


@query
def vcf_blocks_file(x):
    """Genotypes by way of block gzip."""
    path = scratch_path(x.spark, "vcf")
    vcf.write_vcf(x.sites(), path, x.genotypes(), blocked=True)
    names = vcf.sample_columns(x.spark, path, blocked=True)
    return vcf.genotypes(vcf.read_vcf(x.spark, path, blocked=True), names).select("chrom", "pos", "sample", "gt")


@query
def vcf_contigs_file(x):
    """Contig lines of a header, from the index of the reference."""
    path = scratch_path(x.spark, "vcf")
    vcf.write_vcf(x.sites(), path, contigs=x.seqs().withColumnRenamed("ord", "rank"))
    return vcf.read_contigs(x.spark, path)


@query
def stats_report_file(x):
    path = scratch_path(x.spark, "stats")
    passed = variants.pass_only(_tagged(x))
    counted = variants.titv(passed).withColumn("records", passed.agg(F.count(F.lit(1))).scalar())
    vcf.write_stats_report(counted, path)
    records = vcf.read_summary_number(x.spark, path, "number of records").select(F.col("value").alias("records"))
    return rounded(vcf.read_titv(x.spark, path).withColumn("records", records.scalar()))


@query
def annotations_file(x):
    path = scratch_path(x.spark, "annotations")
    vcf.export_annotations(variants.hard_filter(x.sites()), path)
    return x.spark.read.csv(path, sep="\t", header=True, schema=vcf.ANNOTATIONS, nullValue=".")


@query
def cohort_file(x):
    path = scratch_path(x.spark, "cohort")
    tables.create_cohort(x.blocks(), path)
    return x.spark.read.parquet(path).select("sample", "chrom", "start", "stop", "gq")


@query
def run_tables_file(x):
    path = scratch_path(x.spark, "runs")
    for name in ("first", "second"):
        tables.append_run(_run(x, name), path, name)
    return tables.read_runs(x.spark, path, "run string, raw_snps long, pass_snps long, pct_removed double")


def _run(x, name):
    """Counts of the first run, and of a second one with a stricter depth."""
    sites = x.sites() if name == "first" else cohort.depth_filter(x.sites(), 610, 3000)
    return variants.filter_attrition(sites).select("raw_snps", "pass_snps", "pct_removed")


@query
def run_append_union(x):
    return variants.append_runs(("first", _run(x, "first")), ("second", _run(x, "second")))


@query
def sample_map(x):
    return samples.sample_map(x.files().where(F.col("side") == "source"))


@query
def interval_list(x):
    return samples.interval_list(x.seqs())


@query
def matrix_unpivot(x):
    """The sample by locus matrix written with all its loci and read back cell by cell."""
    copies = x.contigs().groupBy("sample", "locus").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(x.spark, "matrix")
    tables.write_matrix(copies, path, parts=8, compression="gzip")
    return tables.read_matrix(x.spark, path).select(F.col("sample").cast("long"), F.col("locus").cast("long"), "n")


@query
def manifest_counts(x):
    return samples.manifest_counts(x.files())


@query
def resume_pending(x):
    files = x.files()
    done = files.where(F.col("side") == "dest")
    return samples.pending(files.where(F.col("side") == "source"), done, "path").select("path", "size")


@query
def read_groups(x):
    return samples.read_groups(x.samples())


@query
def sample_names(x):
    return samples.sample_names(x.samples())


@query
def drop_undetermined(x):
    return samples.drop_undetermined(x.samples())


@query
def path_basename(x):
    return x.files().select("side", N.strip_path(F.col("path"), "_1.fq.gz").alias("base"))


@query
def first_samples(x):
    return samples.first_samples(x.samples())


@query
def manifest_reconcile(x):
    files = x.files()
    source, dest = (files.where(F.col("side") == s) for s in ("source", "dest"))
    return samples.reconcile_verdict(samples.reconcile(source, dest))


# -- targets and probes ------------------------------------------------------

@query
def target_headers(x):
    return x.targets().select("locus_no", N.rewrite_target_header(F.col("header")).alias("header"))


@query
def target_locus_ids(x):
    return recovery.rewrite_headers(x.targets()).select("header", "locus")


@query
def target_count_check(x):
    return recovery.target_count_check(x.targets())


@query
def target_uniqueness(x):
    return recovery.check_unique_loci(recovery.rewrite_headers(x.targets()))


@query
def target_head(x):
    return recovery.head_of(x.targets().select("locus_no", "header"))


@query
def probe_headers(x):
    return recovery.probe_table(x.probes()).drop("seq")


@query
def probe_tiling(x):
    return rounded(recovery.probe_tiling(x.probes()))


# -- expressions over sites and calls ----------------------------------------

@query
def region_filter(x):
    return variants.in_regions(x.sites(), CHROMS[:3]).select("chrom", "pos", "ref", "alt")


@query
def main_chrom_filter(x):
    return variants.main_chromosomes(x.sites()).select("chrom", "pos", "ref", "alt")


@query
def pass_label_counts(x):
    tagged = variants.pass_label(variants.hard_filter(x.sites()))
    return tagged.groupBy("pass").agg(F.count(F.lit(1)).alias("sites"))


@query
def non_null_annotations(x):
    return x.sites().dropna(subset=["mqranksum", "readposranksum"]).select(
        "chrom", "pos", "mqranksum", "readposranksum"
    )


@query
def qual_clip(x):
    return cohort.clip_range(x.sites(), "qual", 0, 100).select("chrom", "pos", "qual")


@query
def annotations_long(x):
    tagged = variants.pass_label(variants.hard_filter(x.sites()))
    return cohort.to_long(tagged, ["chrom", "pos", "pass"])


@query
def substitution_classes(x):
    kind = B.substitution_class(F.col("ref"), F.col("alt"))
    return x.sites().groupBy("ref", "alt", kind.alias("class")).agg(F.count(F.lit(1)).alias("sites"))


@query
def phred_probability(x):
    p = B.error_probability(F.col("qual"))
    return x.sites().select(
        "chrom", "pos", "qual", F.round(p, 9).alias("error"), F.round(B.phred_scale(p), 6).alias("phred")
    )


@query
def variant_types(x):
    return variants.classify(x.sites()).select("chrom", "pos", "ref", "alt", "variant_type", "n_alt")


@query
def genotype_states(x):
    # Equal texts first, so that a state is told once for each.
    texts = x.genotypes().groupBy("chrom", "sample", "gt").agg(F.count(F.lit(1)).alias("calls"))
    return texts.groupBy("chrom", "sample", B.call_state(F.col("gt")).alias("state")).agg(F.sum("calls").alias("calls"))


# -- reads -------------------------------------------------------------------

@query
def base_qualities(x):
    phred = B.phred(F.col("qual"))
    return x.reads().select("read_id", "mate", F.array_join(phred.cast("array<string>"), ",").alias("phred"))


@query
def reverse_complement(x):
    return x.reads().select("read_id", "mate", B.reverse_complement(F.col("seq")).alias("seq"))


@query
def mate_pairs(x):
    return reads.pair_mates(x.reads()).select("sample", "read_id", "seq_1", "seq_2")


@query
def unpaired_mates(x):
    return reads.unpaired(x.reads()).select("sample", "read_id", "mate")


@query
def read_basic_stats(x):
    return rounded(reads.basic_stats(x.reads()))


@query
def cycle_quality(x):
    return rounded(reads.cycle_quality(x.reads()))


@query
def read_quality_hist(x):
    return reads.read_quality_hist(x.reads())


@query
def cycle_base_content(x):
    return rounded(reads.cycle_bases(x.reads()))


@query
def gc_histogram(x):
    return reads.gc_hist(x.reads())


@query
def n_content(x):
    return rounded(reads.n_content(x.reads()))


@query
def read_length_hist(x):
    trimmed = reads.trim_adapter(x.reads())
    return reads.length_hist(trimmed)


@query
def sequence_duplication(x):
    return reads.duplication_levels(x.reads())


@query
def overrepresented_sequences(x):
    return rounded(reads.overrepresented(x.reads(), 0.00002), 9)


@query
def adapter_content(x):
    return rounded(reads.adapter_content(x.reads()))


@query
def adapter_detect(x):
    return reads.detect_adapter(x.reads())


@query
def adapter_trim(x):
    return reads.trim_adapter(x.reads()).select("read_id", "mate", "seq", "qual")


@query
def adapters_walked(x):
    """The adapter that tails show, walked from their commonest k-mer."""
    return reads.detect_adapters(x.other_reads())


@query
def adapter_detected_trim(x):
    """Trimming of reads with another adapter, which is found first."""
    return reads.trim(x.other_reads(), adapter=None).select("read_id", "mate", "seq", "qual")


@query
def quality_filter(x):
    return reads.quality_filter(reads.trim_adapter(x.reads())).select("read_id", "mate", "seq")


@query
def length_filter(x):
    cut = reads.quality_filter(reads.trim_adapter(x.reads()))
    return reads.length_filter(cut, 80).select("read_id", "mate", "seq")


@query
def surviving_pairs(x):
    return reads.trim(x.reads()).select("read_id", "mate", F.length("seq").alias("length"))


@query
def trim_report(x):
    return reads.trim_report(x.reads())


@query
def cohort_qc_table(x):
    return rounded(reads.cohort_qc(x.reads()))


# -- mapping -----------------------------------------------------------------

@query
def seed_assign(x):
    return mapping.seed_join(x.reads(), x.loci(), step=1)


@query
def on_target_counts(x):
    return rounded(mapping.on_target_counts(x.reads(), mapping.seed_join(x.reads(), x.loci(), step=1)))


@query
def mapq_filter(x):
    return mapping.min_mapq(x.alignments()).select("sample", "qname", "rname", "pos", "mapq")


@query
def flag_bits(x):
    return mapping.flag_bits(x.alignments())


@query
def attach_read_groups(x):
    groups = samples.read_groups(x.samples()).select("sample", "rgid", "lb")
    return mapping.attach_read_groups(x.alignments(), groups).select("sample", "qname", "rgid", "lb")


@query
def coordinate_rank(x):
    return mapping.coordinate_rank(x.alignments()).select("rname", "pos", "qname", "rank")


def _marked(x):
    return mapping.mark_duplicates(x.template_records())


@query
def flagstat(x):
    return mapping.alignment_counts(_marked(x))


@query
def mark_duplicates(x):
    return _marked(x).select("sample", "library", "qname", "rname", "pos", "flag")


@query
def duplicate_metrics(x):
    return rounded(mapping.duplicate_metrics(_marked(x), by=["sample", "library"]))


@query
def high_duplication_samples(x):
    return rounded(mapping.high_duplication(mapping.duplicate_metrics(_marked(x)), 0.3))


@query
def position_depth(x):
    return mapping.depth(x.alignments(), by=[], block=1024)


@query
def depth_profiles(x):
    return rounded(mapping.depth_profile(mapping.depth_track(x.alignments(), by=[])))


@query
def callable_positions(x):
    """Positions per contig within depth bounds, added up from stretches."""
    mask = mapping.depth_bounds(mapping.depth_track(x.alignments(), by=[], block=1024), 20, 200)
    return mask.groupBy("rname").agg(F.sum(F.col("stop") - F.col("start") + 1).alias("positions"))


@query
def mapq_attrition(x):
    return rounded(mapping.mapq_attrition(x.alignments()))


# -- calling -----------------------------------------------------------------

@query
def pileup_positions(x):
    return (
        calling.pileup(x.alignments())
        .groupBy("chrom", "pos", "strand")
        .agg(
            F.count(F.lit(1)).alias("bases"),
            F.sum("mapq").alias("mapq"),
            F.sum("read_pos").alias("read_pos"),
            F.min("sample").alias("first_sample"),
        )
    )


@query
def pileup_on_reference(x):
    return calling.base_counts(calling.pileup_on(x.target_alignments(), x.masked_reference()))


@query
def allele_counts(x):
    return calling.allele_counts(x.pileup())


def _likelihoods(x):
    return genotyping.genotype_likelihoods(x.pileup())


def _comma(column: str):
    return F.array_join(F.col(column).cast("array<string>"), ",")


@query
def genotype_likelihoods(x):
    """One row per pair of alleles."""
    pairs = _likelihoods(x).select(
        "sample", "chrom", "pos", "ref", genotyping.alternatives(F.col("alleles")).alias("alt"), "dp", F.posexplode("gl").alias("pair", "l")
    )
    return rounded(pairs)


def _calls(x):
    return genotyping.call_genotypes(_likelihoods(x))


@query
def genotype_calls(x):
    alt = genotyping.alternatives(F.col("alleles")).alias("alt")
    return _calls(x).select("sample", "chrom", "pos", "ref", alt, "dp", _comma("ad").alias("ad"), "gt", "gq", _comma("pl").alias("pl"))


@query
def reference_blocks(x):
    return calling.reference_blocks(_calls(x), span=64)


@query
def cohort_combine(x):
    return calling.combine_cohort(_calls(x), x.blocks())


@query
def candidate_sites(x):
    alt = genotyping.alternatives(F.col("alleles")).alias("alt")
    found = genotyping.candidate_sites(_likelihoods(x))
    return found.select("chrom", "pos", "ref", alt, _comma("site_ad").alias("ad"), "max_alt_dp", "dp", "samples_with_alt")


@query
def block_site_join(x):
    return calling.blocks_over_sites(x.blocks(), x.sites())


@query
def cohort_grid(x):
    """The called cells as vectors, and from them every cell again."""
    calls = x.genotypes().where(~B.is_missing(F.col("gt")))
    return packed.unpack(packed.pack(calls, x.roster()), x.roster(), x.sites())


@query
def joint_genotypes(x):
    """One row per alternative of a site."""
    joint = chains.joint_chain(x.pileup(), x.blocks())
    number = F.col("number")
    each = joint.withColumn("number", F.explode(F.sequence(F.lit(1), F.size("ac")))).select(
        "chrom",
        "pos",
        "ref",
        "number",
        F.get("alleles", number).alias("alt"),
        "called",
        "no_call",
        "het",
        "hom_alt",
        F.get("ac", number - 1).alias("ac"),
        "an",
        F.get("af", number - 1).alias("af"),
    )
    return rounded(each)


@query
def site_qual(x):
    return rounded(genotyping.site_quality(_likelihoods(x)), 4)


@query
def site_qd(x):
    quality = genotyping.site_quality(_likelihoods(x))
    return rounded(calling.qual_by_depth(quality), 4)


@query
def strand_table(x):
    return calling.strand_table(x.pileup())


@query
def fisher_strand(x):
    return rounded(calling.fisher_strand(calling.strand_table(x.pileup())), 4)


@query
def strand_odds_ratio(x):
    return rounded(calling.strand_odds_ratio(calling.strand_table(x.pileup())))


@query
def rms_mapq(x):
    return rounded(calling.rms_mapq(x.pileup()))


@query
def mapq_rank_sum(x):
    return rounded(calling.mapq_rank_sum(x.pileup()))


@query
def readpos_rank_sum(x):
    return rounded(calling.readpos_rank_sum(x.pileup()))


@query
def annotated_sites(x):
    """Pileup to tagged sites with every annotation."""
    return rounded(variants.hard_filter(calling.annotate_sites(x.pileup())), 4)


@query
def called_biallelic_snps(x):
    """Pileup to tagged SNPs with one alternative."""
    return rounded(chains.site_chain(x.pileup()).select("chrom", "pos", "ref", "alt", "qual", "dp", "filter", "pass"), 4)


@query
def site_depth(x):
    return calling.site_depth(x.pileup())


# -- variant tables ----------------------------------------------------------

def _tagged(x):
    """Tagged biallelic SNPs with their pass label."""
    return chains.tagged_snps(x.sites())


@query
def select_snps(x):
    return variants.select_snps(x.sites()).select("chrom", "pos", "ref", "alt")


@query
def biallelic_sites(x):
    return variants.biallelic(x.sites()).select("chrom", "pos", "ref", "alt")


@query
def hard_filter_tags(x):
    return variants.hard_filter(x.sites()).select("chrom", "pos", "filter")


@query
def filter_failures(x):
    return variants.filter_failures(_tagged(x))


@query
def pass_sites(x):
    return variants.pass_only(_tagged(x)).select("chrom", "pos", "ref", "alt", "qual")


@query
def filter_attrition(x):
    return rounded(variants.filter_attrition(x.sites()))


@query
def filter_combinations(x):
    return variants.filter_combinations(_tagged(x))


@query
def filter_counts_table(x):
    return variants.filter_counts_table(_tagged(x))


@query
def titv_ratio(x):
    return rounded(variants.titv(variants.pass_only(_tagged(x)), by=["chrom"]))


@query
def variant_stats(x):
    return variants.variant_stats(x.sites())


@query
def interval_semi_join(x):
    long_contigs = x.seqs().where(F.col("length") > 45_000_000).select(F.col("name").alias("chrom"))
    return joins.restrict_to(x.sites(), long_contigs, "chrom").select("chrom", "pos")


@query
def run_comparison(x):
    runs = variants.append_runs(("first", _run(x, "first")), ("second", _run(x, "second")))
    return variants.compare_runs(runs, "first", "second")


# -- cohort QC ---------------------------------------------------------------

@query
def site_missingness(x):
    return rounded(cohort.site_missingness(x.genotypes()))


@query
def sample_missingness(x):
    return rounded(cohort.sample_missingness(x.genotypes()))


@query
def packed_site_counts(x):
    return rounded(packed.site_counts(packed.pack(x.genotypes(), x.roster()), x.roster()))


@query
def packed_sample_counts(x):
    return rounded(packed.sample_counts(packed.pack(x.genotypes(), x.roster()), x.roster()))


@query
def missingness_sweep(x):
    return cohort.missingness_sweep(x.genotypes(), {"chr01": CHROMS[:1], "chr01-chr14": CHROMS})


@query
def missingness_filter(x):
    return rounded(cohort.missingness_filter(x.genotypes()))


@query
def depth_summary(x):
    return rounded(cohort.depth_summary(_tagged(x), N_SAMPLES), 4)


@query
def depth_clip(x):
    return cohort.depth_clip(x.sites()).select("chrom", "pos", "dp")


@query
def depth_bounds_filter(x):
    return cohort.depth_filter(x.sites(), 610, 3000).select("chrom", "pos", "dp")


@query
def annotation_vs_threshold(x):
    return cohort.threshold_review(cohort.to_long(_tagged(x)))


@query
def annotation_clip(x):
    long = cohort.to_long(_tagged(x), ["chrom", "pos", "pass"])
    return cohort.annotation_clip(long).select("chrom", "pos", "annotation", "value")


@query
def qual_histogram(x):
    return cohort.histogram(cohort.clip_range(_tagged(x), "qual", 0, 100), "qual", ["pass"])


@query
def dp_histogram(x):
    return cohort.histogram(cohort.depth_clip(_tagged(x)), "dp", ["pass"])


@query
def annotation_histograms(x):
    clipped = cohort.annotation_clip(cohort.to_long(_tagged(x))).drop("lo", "hi")
    return cohort.histogram(clipped, "value", ["pass"], by=["annotation"])


@query
def snp_density(x):
    return cohort.snp_density(_tagged(x))


@query
def density_gaps(x):
    return cohort.density_gaps(cohort.snp_density(_tagged(x), width=10_000))


@query
def run_qc_summary(x):
    return rounded(cohort.run_qc_summary(_tagged(x), "first", N_SAMPLES, with_date=False))


@query
def hash_sample(x):
    return cohort.hash_sample(x.sites(), ["chrom", "pos"], 1000).select("chrom", "pos", "qual")


# -- recovery and paralogs ---------------------------------------------------

@query
def best_contigs(x):
    return recovery.best_contig(x.contigs())


@query
def assembled_samples(x):
    return recovery.sample_list(x.contigs())


@query
def seq_lengths(x):
    return recovery.seq_lengths(x.contigs(), x.loci(), "gene", x.loci())


@query
def supercontig_lengths(x):
    return recovery.seq_lengths(x.contigs(), x.loci(), "supercontig")


@query
def recovery_matrix(x):
    return rounded(recovery.recovery_fraction(x.contigs(), x.loci()))


@query
def recovery_stats(x):
    return recovery.recovery_stats(recovery.recovery_fraction(x.contigs(), x.loci()))


@query
def locus_recovery(x):
    return rounded(recovery.locus_recovery(x.contigs()))


@query
def locus_sequence_sets(x):
    return recovery.sequence_sets(recovery.retrieve_sequences(x.contigs(), "supercontig"))


@query
def intron_lengths(x):
    return recovery.intron_lengths(x.contigs())


@query
def copy_counts(x):
    return paralogs.copy_counts(x.contigs())


@query
def paralog_warnings_long(x):
    return paralogs.paralog_long(x.contigs(), x.loci())


@query
def paralog_warnings_depth(x):
    return paralogs.paralog_depth(x.contigs())


@query
def paralog_summary(x):
    return rounded(paralogs.paralog_summary(x.contigs(), x.loci()))


@query
def paralog_report(x):
    return rounded(paralogs.paralog_report(x.contigs(), 0.01))


@query
def clean_loci(x):
    return paralogs.clean_loci(x.contigs())


@query
def paralog_loci(x):
    return paralogs.paralog_loci(x.contigs())


@query
def lenient_loci(x):
    return rounded(paralogs.lenient_loci(x.contigs()))


@query
def missing_loci(x):
    # Sequences below 60 bases stand for loci that gave none.
    sequences = recovery.longest_supercontig(x.contigs(), paralogs.clean_loci(x.contigs()))
    return recovery.loci_without_sequence(x.loci(), sequences.where(F.col("length") >= 60))


@query
def loci_except(x):
    return recovery.loci_except(x.contigs(), paralogs.paralog_loci(x.contigs()))


@query
def loci_intersect(x):
    return recovery.loci_intersect(paralogs.clean_loci(x.contigs()), x.loci())


@query
def supercontig_reference(x):
    return recovery.longest_supercontig(x.contigs(), paralogs.clean_loci(x.contigs()))


@query
def reference_manifest(x):
    return chains.clean_reference(x.contigs(), paralogs.clean_loci(x.contigs()))


@query
def assembly_stats(x):
    return rounded(recovery.assembly_stats(x.seqs()))


@query
def scaffold_cutoff(x):
    return recovery.size_cutoff(x.seqs()).select("name", "length")
