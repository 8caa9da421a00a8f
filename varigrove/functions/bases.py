"""Expressions over bases, qualities, alleles, genotypes, flags and CIGAR text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of the alignment flag.
PAIRED = 1
PROPER = 2
UNMAPPED = 4
MATE_UNMAPPED = 8
REVERSE = 16
FIRST_MATE = 64
SECOND_MATE = 128
SECONDARY = 256
QC_FAIL = 512
DUPLICATE = 1024
SUPPLEMENTARY = 2048

PHRED_OFFSET = 33


# -- qualities ---------------------------------------------------------------

def phred(qual: Column) -> Column:
    """Quality text as an array of integers."""
    return F.transform(F.split(qual, ""), lambda c: F.ascii(c) - PHRED_OFFSET)


def phred_sum(qual: Column) -> Column:
    """Sum of the qualities, run by run of equal letters."""
    runs = F.regexp_extract_all(qual, F.lit(r"(?s)((.)\2*)"), F.lit(1))
    total = F.aggregate(runs, F.lit(0), lambda acc, r: acc + (F.ascii(r) - PHRED_OFFSET) * F.length(r))
    # An empty text counts as one letter without a code, as it does in `phred`.
    return F.when(qual == "", -PHRED_OFFSET).otherwise(total)


def bases_below(qual: Column, min_phred: int) -> Column:
    """How many bases are under `min_phred`, without building an array or matching a pattern."""
    return count_bases(qual, "".join(map(chr, range(PHRED_OFFSET, PHRED_OFFSET + min_phred))))


def letter_runs(text: Column) -> Column:
    """Runs of one letter as array<struct<letter, start, stop>>, from 0, stop excluded."""
    runs = F.regexp_extract_all(text, F.lit(r"((.)\2*)"), F.lit(1))
    edges = F.aggregate(
        runs, F.array(F.lit(0)), lambda acc, r: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(r)))
    )
    return F.transform(
        F.arrays_zip(runs.alias("r"), F.slice(edges, F.lit(2), F.size(runs)).alias("e")),
        lambda z: F.struct(
            F.substring(z["r"], 1, 1).alias("letter"),
            (z["e"] - F.length(z["r"])).alias("start"),
            z["e"].alias("stop"),
        ),
    )


def error_probability(q: Column) -> Column:
    return F.pow(F.lit(10.0), -q / 10.0)


def phred_scale(p: Column) -> Column:
    return F.log10(p) * -10.0


# -- sequences ---------------------------------------------------------------

def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTN", "TGCAN"))


def count_bases(seq: Column, letters: str) -> Column:
    others = seq
    if len(letters) > 4:
        others = F.translate(seq, letters, "")
    else:
        # A few letters are faster found one after the other.
        for letter in letters:
            others = F.replace(others, F.lit(letter), F.lit(""))
    return F.length(seq) - F.length(others)


# -- alleles -----------------------------------------------------------------

def alleles(alt: Column) -> Column:
    """Alternate alleles of a comma list."""
    return F.split(alt, ",")


def variant_type(ref: Column, alt: Column) -> Column:
    """SNP, MNP, INDEL, MIXED or SYMBOLIC."""
    alts = alleles(alt)
    symbolic = F.exists(alts, lambda a: a.startswith("<") | (a == "*"))
    one_base = F.forall(alts, lambda a: F.length(a) == 1) & (F.length(ref) == 1)
    same = F.forall(alts, lambda a: F.length(a) == F.length(ref))
    differ = F.forall(alts, lambda a: F.length(a) != F.length(ref))
    return (
        F.when(symbolic, "SYMBOLIC").when(one_base, "SNP").when(same, "MNP").when(differ, "INDEL").otherwise("MIXED")
    )


def is_transition(ref: Column, alt: Column) -> Column:
    return F.concat(ref, alt).isin("AG", "GA", "CT", "TC")


def substitution_class(ref: Column, alt: Column) -> Column:
    """`transition` or `transversion` for one-base substitutions, else null."""
    single = (F.length(ref) == 1) & (F.length(alt) == 1) & (ref != alt)
    return F.when(single & is_transition(ref, alt), "transition").when(single, "transversion")


def is_missing(gt: Column) -> Column:
    """A call with any `.` allele is missing."""
    return F.instr(gt, ".") > 0


def call_state(gt: Column) -> Column:
    parts = F.split(gt, r"[/|]")
    # Most calls are one of these texts, which need no splitting.
    return (
        F.when(gt.isin("0/0", "0|0"), "hom_ref")
        .when(gt.isin("0/1", "0|1", "1|0"), "het")
        .when(gt.isin("1/1", "1|1"), "hom_alt")
        .when(gt.isNull() | is_missing(gt), "missing")
        .when(F.forall(parts, lambda a: a == "0"), "hom_ref")
        .when(F.size(F.array_distinct(parts)) > 1, "het")
        .otherwise("hom_alt")
    )


# -- flags -------------------------------------------------------------------

def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def set_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseOR(F.lit(bit))


def clear_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(~bit))


def is_mapped(flag: Column) -> Column:
    return ~has_flag(flag, UNMAPPED)


def is_evidence(flag: Column) -> Column:
    """Mapped, primary or supplementary, and neither failed nor a duplicate.

    A supplementary record holds other bases of its read than the primary one,
    so it counts; a secondary record repeats bases, so it doesn't.
    """
    return is_mapped(flag) & ~has_flag(flag, SECONDARY | QC_FAIL | DUPLICATE)


# -- CIGAR -------------------------------------------------------------------

def _cigar_sum(cigar: Column, ops: str) -> Column:
    found = F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{ops}]"), F.lit(1))
    return F.aggregate(found, F.lit(0), lambda acc, n: acc + n.cast("int"))


def reference_length(cigar: Column) -> Column:
    """Reference bases spanned."""
    return _cigar_sum(cigar, "MDN=X")


def leading_clip(cigar: Column) -> Column:
    """Bases clipped before the first aligned one (soft and hard)."""
    clip = _cigar_sum(F.regexp_extract(cigar, r"^(?:[0-9]+[SH])*", 0), "SH")
    return F.when(~cigar.rlike("^[0-9]+[SH]"), 0).otherwise(clip)


def trailing_clip(cigar: Column) -> Column:
    """Bases clipped after the last aligned one (soft and hard)."""
    clip = _cigar_sum(F.regexp_extract(cigar, r"(?:[0-9]+[SH])*$", 0), "SH")
    return F.when(~cigar.rlike("[0-9][SH]$"), 0).otherwise(clip)


def unclipped_start(pos: Column, cigar: Column, flag: Column) -> Column:
    """5' position of the read on the reference, clips added back."""
    forward = pos - leading_clip(cigar)
    backward = pos + reference_length(cigar) - 1 + trailing_clip(cigar)
    return F.when(has_flag(flag, REVERSE), backward).otherwise(forward)


def aligned_blocks(cigar: Column) -> Column:
    """Gap-free stretches as array<struct<len, ref_off, read_off>>.

    Offsets count from 0: `ref_off` on the reference, `read_off` in the read.
    """
    text = F.regexp_extract_all(cigar, F.lit("([0-9]+[MIDNSHP=X])"), F.lit(1))
    ops = F.transform(
        text,
        lambda t: F.struct(
            F.regexp_extract(t, "[0-9]+", 0).cast("int").alias("len"),
            F.substring(t, -1, 1).alias("op"),
        ),
    )

    def consumed(index: Column, letters: tuple[str, ...]) -> Column:
        before = F.slice(ops, F.lit(1), index)
        return F.aggregate(
            before, F.lit(0), lambda acc, o: acc + F.when(o["op"].isin(*letters), o["len"]).otherwise(F.lit(0))
        )

    placed = F.transform(
        ops,
        lambda o, i: F.struct(
            o["op"].alias("op"),
            o["len"].alias("len"),
            consumed(i, ("M", "D", "N", "=", "X")).alias("ref_off"),
            consumed(i, ("M", "I", "S", "=", "X")).alias("read_off"),
        ),
    )
    return F.filter(placed, lambda b: b["op"].isin("M", "=", "X"))
