"""Published numbers and formats."""

import pytest
from pyspark.sql import functions as F

from varigrove.functions import bases as B
from varigrove.functions import names as N
from varigrove.functions import numbers


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "kept, total, percent",
    [
        (1_176_855, 1_212_145, 97.0),
        (13_168_342, 13_662_332, 96.3),
        (12_077_197, 13_662_332, 88.3),
        (1_195_784, 1_212_145, 98.6),
        (1_108_361, 1_212_145, 91.4),
        (13_462_101, 13_662_332, 98.5),
    ],
)
def test_percent_kept_is_cut_off(spark, kept, total, percent):
    assert value(spark, numbers.pct_trunc1(F.lit(kept), F.lit(total))) == percent


@pytest.mark.parametrize(
    "part, total, percent",
    [
        (1_363_777, 16_021_590, 8.51),
        (75_218, 16_021_590, 0.47),
        (518_874, 16_021_590, 3.24),
        (801_726, 16_021_590, 5.0),
        (16_021_590 - 13_672_054, 16_021_590, 14.66),
        (15_330_896 - 13_710_712, 15_330_896, 10.57),
    ],
)
def test_percent_of_total_is_rounded(spark, part, total, percent):
    assert value(spark, numbers.pct_round2(F.lit(part), F.lit(total))) == percent


def test_percent_of_nothing_is_null(spark):
    assert value(spark, numbers.pct_round2(F.lit(0), F.lit(0))) is None
    assert value(spark, numbers.pct_trunc1(F.lit(0), F.lit(0))) is None


def test_read_group(spark):
    base = F.lit("Plant_2013_110_LIB250009714-1A_FLOW1_L2")
    got = spark.range(1).select(*[c.alias(n) for n, c in N.read_group(base).items()]).first().asDict()
    assert got == {
        "sm": "Plant_2013_110",
        "lb": "LIB250009714-1A",
        "pl": "ILLUMINA",
        "pu": "FLOW1_L2",
        "rgid": "Plant_2013_110_FLOW1_L2",
    }


@pytest.mark.parametrize(
    "raw, locus",
    [
        ("NC_033804.1_LG_01_1244349_1244570_ID_7271", "7271"),
        ("NC_033804.1_LG_01_1244349_1244570_ID_7901.merged", "7901"),
        ("NA_LG_Scaffold098279_1_187_ID_243", "243"),
    ],
)
def test_target_header(spark, raw, locus):
    new = N.rewrite_target_header(F.lit(raw))
    assert value(spark, new) == f"Cajanus_cajan-{locus}"
    assert value(spark, N.locus_of(new)) == locus


def test_probe_header(spark):
    got = spark.range(1).select(
        *[c.alias(n) for n, c in N.probe_fields(F.lit("dalb_8218__CcLG01__482599_482818_p_2")).items()]
    )
    assert tuple(got.first()) == (8218, "CcLG01", 482599, 482818, 2)


@pytest.mark.parametrize(
    "ref, alt, kind",
    [
        ("A", "G", "SNP"),
        ("A", "G,T", "SNP"),
        ("A", "AG", "INDEL"),
        ("AG", "A", "INDEL"),
        ("A", "G,AT", "MIXED"),
        ("AC", "GT", "MNP"),
        ("A", "*", "SYMBOLIC"),
        ("A", "G,<NON_REF>", "SYMBOLIC"),
    ],
)
def test_variant_type(spark, ref, alt, kind):
    assert value(spark, B.variant_type(F.lit(ref), F.lit(alt))) == kind


@pytest.mark.parametrize(
    "gt, state",
    [
        ("./.", "missing"),
        (".", "missing"),
        ("0/.", "missing"),
        (None, "missing"),
        ("0|0", "hom_ref"),
        ("0/1", "het"),
        ("1/2", "het"),
        ("2/2", "hom_alt"),
    ],
)
def test_call_state(spark, gt, state):
    assert value(spark, B.call_state(F.lit(gt).cast("string"))) == state


@pytest.mark.parametrize(
    "cigar, flag, five",
    [("100M", 0, 50), ("5S95M", 0, 45), ("3H5S92M", 0, 42), ("100M", 16, 149), ("90M2D5M5S", 16, 151), ("5S95M", 16, 144)],
)
def test_unclipped_start(spark, cigar, flag, five):
    assert value(spark, B.unclipped_start(F.lit(50), F.lit(cigar), F.lit(flag))) == five


def test_aligned_blocks(spark):
    got = value(spark, B.aligned_blocks(F.lit("2H3S10M2I5M4D6M1S")))
    assert [(b.op, b.len, b.ref_off, b.read_off) for b in got] == [("M", 10, 0, 3), ("M", 5, 10, 15), ("M", 6, 19, 20)]


def test_bases_below(spark):
    qual = "I5!4&#'>^]"
    for limit in (1, 5, 20, 21, 60, 80):
        low = sum(ord(c) - 33 < limit for c in qual)
        assert value(spark, B.bases_below(F.lit(qual), limit)) == low


def test_letter_runs(spark):
    got = value(spark, B.letter_runs(F.lit("II##I.")))
    assert [tuple(r) for r in got] == [("I", 0, 2), ("#", 2, 4), ("I", 4, 5), (".", 5, 6)]


def test_mates(spark):
    for name, mate in (("a/x_1.fq.gz", 1), ("x_2.trim.fq.gz", 2), ("x_3.fq.gz", None), ("x_1.txt", None)):
        assert value(spark, N.mate_number(F.lit(name))) == mate


def test_strip_path(spark):
    assert value(spark, N.strip_path(F.lit("a/b/x_1.fq.gz"), "_1.fq.gz")) == "x"
    assert value(spark, N.strip_path(F.lit("a/b/x.bam"), "_1.fq.gz")) == "x.bam"
