"""Read QC, trimming and pairing.

Input: `sample, read_id, mate, seq, qual`. Per-file reports are grouped by
`(sample, mate)`; a file may own most of the reads, so every report combines
on the map side and no window spans a whole file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from varigrove.functions import bases as B
from varigrove.operators import tails
from varigrove.operators.joins import gathered, null_safe_join

FILE = ("sample", "mate")

# Fixed value: start of the common sequencing adapter.
ADAPTER = "AGATCGGAAGAGCACACGTCTGAACTCCAG"
ADAPTER_SEED = 12
# Bases of the adapter that must be left at the end of a read.
ADAPTER_OVERLAP = 4
MIN_PHRED = 20
MAX_BAD_PERCENT = 40
MIN_LENGTH = 50


# -- reports -----------------------------------------------------------------

def basic_stats(reads: DataFrame, by: Sequence[str] = FILE) -> DataFrame:
    size = F.length("seq")
    gc = B.count_bases(F.col("seq"), "GC")
    return (
        reads.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("reads"),
            F.sum(size).alias("bases"),
            F.min(size).alias("min_length"),
            F.max(size).alias("max_length"),
            F.sum(gc).alias("__gc"),
        )
        .select(
            *by,
            "reads",
            "bases",
            "min_length",
            "max_length",
            (F.col("bases") / F.col("reads")).alias("mean_length"),
            (F.col("__gc") * 100.0 / F.col("bases")).alias("gc_percent"),
        )
    )


def cycle_phred_counts(reads: DataFrame, by: Sequence[str] = FILE) -> DataFrame:
    """Bases per file, cycle and phred value: at most 94 rows per cycle.

    Qualities come in runs, so a read is written as the starts and ends of its
    runs and not as one row per base. Reads are gathered by file before that, since
    every map task has reads of nearly all files. Events are summed per cycle first; the
    running sum then covers one row per cycle, file and value.
    """
    run = F.col("__r")
    event = lambda at, d: F.struct(at.alias("cycle"), F.lit(d).alias("d"))
    each = gathered(reads.select(*by, "qual"), by).select(*by, "__salt", F.explode(B.letter_runs(F.col("qual"))).alias("__r"))
    parts = (
        each.select(
            *by,
            "__salt",
            run["letter"].alias("letter"),
            F.inline(F.array(event(run["start"] + 1, 1), event(run["stop"] + 1, -1))),
        )
        .groupBy(*by, "__salt", "letter", "cycle")
        .agg(F.sum("d").alias("d"))
    )
    events = parts.groupBy(*by, "letter", "cycle").agg(F.sum("d").alias("d"))
    along = Window.partitionBy(*by, "letter").orderBy("cycle")
    steps = events.withColumn("n", F.sum("d").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    steps = steps.withColumn("__next", F.lead("cycle").over(along)).where(F.col("n") > 0)
    return steps.select(
        *by,
        F.explode(F.sequence("cycle", F.col("__next") - 1)).alias("cycle"),
        (F.ascii("letter") - B.PHRED_OFFSET).alias("phred"),
        "n",
    )


def cycle_quality(reads: DataFrame, by: Sequence[str] = FILE) -> DataFrame:
    """Mean and quartiles of quality per cycle."""
    counts = cycle_phred_counts(reads, by)
    quartile = lambda p: F.percentile("phred", F.lit(p), F.col("n"))
    return counts.groupBy(*by, "cycle").agg(
        F.sum("n").alias("bases"),
        (F.sum(F.col("phred") * F.col("n")) / F.sum("n")).alias("mean_phred"),
        quartile(0.25).alias("q1"),
        quartile(0.5).alias("median"),
        quartile(0.75).alias("q3"),
    )


def read_quality_hist(reads: DataFrame, by: Sequence[str] = FILE) -> DataFrame:
    """Reads by floor of their mean phred."""
    mean = F.floor(B.phred_sum(F.col("qual")) / F.length("qual"))
    return reads.groupBy(*by, mean.alias("mean_phred")).agg(F.count(F.lit(1)).alias("reads"))


def cycle_bases(reads: DataFrame, by: Sequence[str] = FILE) -> DataFrame:
    """A, C, G, T and N counts and shares per cycle.

    A file has a group per cycle, and every map task has reads of nearly all
    files, so reads are gathered by file before they become rows per base.
    """
    each = gathered(reads.select(*by, "seq"), by).select(*by, "__salt", F.posexplode(F.split("seq", "")).alias("__i", "base"))
    # Numeric grouping keys only: they keep the map-side hash table fast.
    tally = lambda b: F.count(F.when(F.col("base") == b, 1))
    counted = {"bases": F.count(F.lit(1)), **{f"n_{b.lower()}": tally(b) for b in "ACGTN"}}
    parts = each.groupBy(*by, "__salt", (F.col("__i") + 1).alias("cycle")).agg(*[c.alias(n) for n, c in counted.items()])
    out = parts.groupBy(*by, "cycle").agg(*[F.sum(n).alias(n) for n in counted])
    return out.select(
        "*", *[(F.col(f"n_{b}") * 100.0 / F.col("bases")).alias(f"pct_{b}") for b in "acgtn"]
    )


def n_content(reads: DataFrame, by: Sequence[str] = FILE) -> DataFrame:
    """Share of N per cycle.

    Only reads with an N give rows of their own; how many reads reach a cycle
    follows from the lengths.
    """
    lengths = length_hist(reads, by).withColumnRenamed("length", "cycle")
    longest = lengths.groupBy(*by).agg(F.max("cycle").alias("__last"))
    cycles = longest.select(*by, F.explode(F.sequence(F.lit(1), "__last")).alias("cycle"))
    reach = Window.partitionBy(*by).orderBy(F.desc("cycle")).rowsBetween(Window.unboundedPreceding, 0)
    bases = cycles.join(lengths, [*by, "cycle"], "left").select(
        *by, "cycle", F.sum(F.coalesce("reads", F.lit(0))).over(reach).alias("bases")
    )
    found = (
        reads.where(F.instr("seq", "N") > 0)
        .select(*by, F.posexplode(F.split("seq", "")).alias("__i", "base"))
        .where(F.col("base") == "N")
        .groupBy(*by, (F.col("__i") + 1).alias("cycle"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n = F.coalesce("n", F.lit(0))
    return bases.join(found, [*by, "cycle"], "left").select(
        *by, "cycle", "bases", n.alias("n_n"), (n * 100.0 / F.col("bases")).alias("pct_n")
    )


def gc_hist(reads: DataFrame, by: Sequence[str] = FILE) -> DataFrame:
    """Reads by floor of their GC percent; N counts as a base of the read."""
    gc = F.floor(B.count_bases(F.col("seq"), "GC") * 100 / F.length("seq"))
    return reads.groupBy(*by, gc.alias("gc_percent")).agg(F.count(F.lit(1)).alias("reads"))


def length_hist(reads: DataFrame, by: Sequence[str] = FILE) -> DataFrame:
    return reads.groupBy(*by, F.length("seq").alias("length")).agg(F.count(F.lit(1)).alias("reads"))


def duplication_levels(reads: DataFrame, by: Sequence[str] = FILE) -> DataFrame:
    """How many sequences occur once, twice, ... and the reads they make up."""
    copies = reads.groupBy(*by, "seq").agg(F.count(F.lit(1)).alias("copies"))
    return copies.groupBy(*by, "copies").agg(
        F.count(F.lit(1)).alias("sequences"), F.sum("copies").alias("reads")
    )


def overrepresented(reads: DataFrame, min_share: float) -> DataFrame:
    """Sequences above a share of all reads; at most 1/min_share rows."""
    copies = reads.groupBy("seq").agg(F.count(F.lit(1)).alias("reads"))
    total = reads.agg(F.count(F.lit(1))).scalar()
    return copies.where(F.col("reads") > total * min_share).select(
        "seq", "reads", (F.col("reads") * 100.0 / total).alias("percent")
    )


def adapter_content(
    reads: DataFrame, adapter: str = ADAPTER, seed: int = ADAPTER_SEED, by: Sequence[str] = FILE
) -> DataFrame:
    """Percent of reads with the adapter at or before each cycle.

    Reads are first reduced to counts per start cycle, so the running sum
    covers one row per cycle and file.
    """
    at = F.instr(F.col("seq"), F.lit(adapter[:seed]))
    starts = reads.groupBy(*by, at.alias("cycle")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.length("seq")).alias("len")
    )
    files = starts.groupBy(*by).agg(F.sum("n").alias("reads"), F.max("len").alias("len"))
    cycles = files.select(*by, "reads", F.explode(F.sequence(F.lit(1), F.col("len"))).alias("cycle"))
    upto = Window.partitionBy(*by).orderBy("cycle").rowsBetween(Window.unboundedPreceding, 0)
    return (
        cycles.join(starts.select(*by, "cycle", "n"), [*by, "cycle"], "left")
        .withColumn("with_adapter", F.sum(F.coalesce("n", F.lit(0))).over(upto))
        .select(*by, "cycle", "with_adapter", (F.col("with_adapter") * 100.0 / F.col("reads")).alias("percent"))
    )


def detect_adapter(reads: DataFrame, k: int = ADAPTER_SEED, tail: int = 30) -> DataFrame:
    """Most common k-mer of the read tails, per mate; ties by k-mer text.

    K-mers of the fuller buckets are counted one by one, until the most common of them is as
    common as any bucket left out. These jobs run while the plan is built; their result is a row per mate.
    """
    held = {mate: n for mate, (_, n) in tails.bucket_counts(reads, k, tail).items() if n.any()}
    wanted = {mate: n * 2 >= n.max() for mate, n in held.items()}
    best: dict[object, tuple[int, str]] = {}
    while wanted:
        rank = F.min(F.struct((-F.col("n")).alias("rank"), "kmer")).alias("b")
        found = tails.kmers_of(reads, wanted, k, tail).groupBy("mate").agg(rank).select("mate", "b.rank", "b.kmer")
        best |= {mate: (-rank, kmer) for mate, rank, kmer in found.collect()}
        short = {mate: held[mate] >= best[mate][0] for mate in wanted}
        wanted = {mate: more for mate, more in short.items() if (more & ~wanted[mate]).any()}
    schema = StructType([reads.schema["mate"], StructField("kmer", StringType()), StructField("n", LongType())])
    return reads.sparkSession.createDataFrame([(mate, kmer, n) for mate, (n, kmer) in best.items()], schema)


def detect_adapters(
    reads: DataFrame,
    k: int = ADAPTER_SEED,
    tail: int = 30,
    min_share: float = 0.005,
    step_share: float = 0.5,
    longest: int = 64,
) -> DataFrame:
    """The adapter of each mate as far as read tails tell it: `mate, adapter, n`, null where there is none.

    The walk starts from the commonest k-mer of the tails, which must stand in `min_share` of
    the reads, and goes on base by base, first to the right and then to the left,
    with the commonest k-mer that overlaps by k - 1 (ties by text), as long as
    it is at least `step_share` as common as the first one. Where the adapter
    begins, the bases before it differ and none is.

    Only k-mers that a walk may use are listed, in one row per mate: a read has
    `tail - k + 1` of them, so they are at most that over both shares. Of the others,
    only those are counted that share a bucket with as many k-mers.
    """
    held = tails.bucket_counts(reads, k, tail)
    least = min_share * min(step_share, 1)
    counts = tails.kmers_of(reads, {mate: n >= max(size * least, 1) for mate, (size, n) in held.items()}, k, tail)
    sizes = reads.groupBy("mate").agg(F.count(F.lit(1)).alias("reads"))
    first = counts.groupBy("mate").agg(F.min(F.struct((-F.col("n")).alias("r"), "kmer")).alias("b"))
    start = null_safe_join(sizes, first, ["mate"], "left").select(
        "mate", F.col("b.kmer").alias("seed"), (-F.col("b.r")).alias("most"), (F.col("reads") * min_share).alias("least")
    ).withColumn("seed", F.when(F.col("most") >= F.col("least"), F.col("seed")))
    usable = null_safe_join(counts, start, ["mate"]).where(
        F.col("seed").isNotNull() & (F.col("n") >= F.col("most") * step_share)
    )
    listed = usable.groupBy("mate").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("r"), "kmer"))).alias("list"))
    walked = null_safe_join(start, listed, ["mate"], "left")

    def walk(text: Column, right: bool) -> Column:
        def on(acc: Column, _: Column) -> Column:
            edge = F.substring(acc, -(k - 1), k - 1) if right else F.substring(acc, 1, k - 1)
            part = lambda s: F.substring(s["kmer"], 1, k - 1) if right else F.substring(s["kmer"], 2, k - 1)
            found = F.get(F.filter("list", lambda s: part(s) == edge), F.lit(0))["kmer"]
            base = F.substring(found, k, 1) if right else F.substring(found, 1, 1)
            longer = F.concat(acc, base) if right else F.concat(base, acc)
            return F.when(F.length(acc) < longest, F.coalesce(longer, acc)).otherwise(acc)

        return F.aggregate(F.sequence(F.lit(1), F.lit(longest)), text, on)

    return (
        walked.withColumn("__right", walk(F.col("seed"), True))
        .withColumn("adapter", F.when(F.col("seed").isNotNull(), walk(F.col("__right"), False)))
        .select("mate", "adapter", F.when(F.col("seed").isNotNull(), F.col("most")).alias("n"))
    )


# -- trimming ----------------------------------------------------------------

def adapter_pattern(adapter: str, overlap: int = ADAPTER_OVERLAP) -> str:
    """The whole adapter, or at the end of a read as much of it as fits, `overlap` bases at least."""
    rest = ""
    for letter in reversed(adapter[overlap:]):
        rest = f"(?:{letter}{rest})?"
    return f"{adapter}|{adapter[:overlap]}{rest}$"


def _cut(reads: DataFrame, at: Column) -> DataFrame:
    """Bases and qualities before position `at`; whole where it is 0 or null.

    The position comes out of a generator, or each later mention of a cut column, filters
    too, would look for the adapter again.
    """
    placed = reads.select("*", F.explode(F.array(at)).alias("__at"))
    cut = lambda c: F.when(F.col("__at") > 0, F.substring(F.col(c), F.lit(1), F.col("__at") - 1)).otherwise(F.col(c))
    return placed.withColumns({"seq": cut("seq"), "qual": cut("qual")}).drop("__at")


def trim_adapter(reads: DataFrame, adapter: str = ADAPTER, overlap: int = ADAPTER_OVERLAP) -> DataFrame:
    """Cut bases and qualities at the leftmost start of the adapter.

    The adapter counts as a whole where the read goes on behind it, and by the
    bases that fit where the read ends in it; a chance match of its first bases
    is no adapter.
    """
    return _cut(reads, F.regexp_instr(F.col("seq"), F.lit(adapter_pattern(adapter, overlap))))


def trim_detected(reads: DataFrame, adapters: DataFrame | None = None, overlap: int = ADAPTER_OVERLAP) -> DataFrame:
    """As `trim_adapter`, with the adapter of each mate (`mate, adapter`), by default the one that the reads show.

    A mate without an adapter is left as it is.
    """
    found = adapters if adapters is not None else detect_adapters(reads)
    letters = F.split(F.substring("adapter", overlap + 1, 1 << 20), "")
    rest = F.aggregate(F.reverse(letters), F.lit(""), lambda acc, x: F.when(x == "", acc).otherwise(F.concat(F.lit("(?:"), x, acc, F.lit(")?"))))
    pattern = F.concat(F.col("adapter"), F.lit("|"), F.substring("adapter", 1, overlap), rest, F.lit("$"))
    # One entry per mate, so the patterns travel as a map.
    patterns = found.where(F.col("mate").isNotNull() & F.col("adapter").isNotNull()).agg(
        F.map_from_entries(F.collect_list(F.struct("mate", pattern.alias("pattern"))))
    ).scalar()
    # A branch for each mate keeps its pattern compiled.
    at = lambda mate: F.regexp_instr(F.col("seq"), F.try_element_at(patterns, F.lit(mate)))
    place = F.when(F.col("mate") == 1, at(1)).when(F.col("mate") == 2, at(2))
    return _cut(reads, place)


def low_quality(min_phred: int = MIN_PHRED, max_bad_percent: float = MAX_BAD_PERCENT):
    """True for reads with too large a share of bases under `min_phred`.

    A filter puts in the whole cut for each mention of `qual`, pattern and all, so it is named once.
    """
    bad = lambda q: B.bases_below(q, min_phred) * 100 > F.length(q) * F.lit(max_bad_percent)
    return F.exists(F.array("qual"), bad)


def quality_filter(
    reads: DataFrame, min_phred: int = MIN_PHRED, max_bad_percent: float = MAX_BAD_PERCENT
) -> DataFrame:
    return reads.where(~low_quality(min_phred, max_bad_percent))


def length_filter(reads: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    return reads.where(F.length("seq") >= min_length)


def has_mate():
    """Both mates of a read name are present; a group has two rows."""
    pair = Window.partitionBy("sample", "read_id")
    return F.min("mate").over(pair) != F.max("mate").over(pair)


def keep_pairs(reads: DataFrame) -> DataFrame:
    """Reads whose mate is still there."""
    return reads.withColumn("__ok", has_mate()).where("__ok").drop("__ok")


def trim(reads: DataFrame, adapter: str | None = ADAPTER) -> DataFrame:
    """Adapter cut, quality filter, length filter, then whole pairs only; without an adapter, the one the reads show."""
    cut = trim_adapter(reads, adapter) if adapter else trim_detected(reads)
    return keep_pairs(length_filter(quality_filter(cut)))


def trim_report(reads: DataFrame) -> DataFrame:
    """Reads and bases before and after, and reads lost by reason, per sample."""
    cut = trim_adapter(reads.withColumn("__before", F.length("seq"))).withColumn(
        "__after", F.length("seq")
    )
    reason = F.when(low_quality(), "quality").when(F.col("__after") < MIN_LENGTH, "length")
    judged = cut.select("sample", "read_id", "mate", "__before", "__after", reason.alias("__why"))
    # A read that passed is lost if its mate is missing or did not pass.
    kept_mate = F.when(F.col("__why").isNull(), F.col("mate"))
    pair = Window.partitionBy("sample", "read_id")
    both = F.coalesce(F.min(kept_mate).over(pair) != F.max(kept_mate).over(pair), F.lit(False))
    judged = judged.withColumn("__kept", F.col("__why").isNull() & both)
    count = lambda cond: F.count(F.when(cond, 1))
    why = F.col("__why")
    return judged.groupBy("sample").agg(
        F.count(F.lit(1)).alias("reads_before"),
        F.sum("__before").alias("bases_before"),
        count(F.col("__after") < F.col("__before")).alias("adapter_trimmed"),
        count(why == "quality").alias("low_quality"),
        count(why == "length").alias("too_short"),
        count(why.isNull() & ~F.col("__kept")).alias("mate_lost"),
        count(F.col("__kept")).alias("reads_after"),
        F.coalesce(F.sum(F.when(F.col("__kept"), F.col("__after"))), F.lit(0)).alias("bases_after"),
    )


def cohort_qc(reads: DataFrame) -> DataFrame:
    """One row per sample over all metrics."""
    size = F.sum(F.length("seq"))
    basic = reads.groupBy("sample").agg(
        F.count(F.lit(1)).alias("reads"),
        size.alias("bases"),
        F.avg(F.length("seq")).alias("mean_length"),
        (F.sum(B.count_bases(F.col("seq"), "GC")) * 100.0 / size).alias("gc_percent"),
        (F.sum(B.phred_sum(F.col("qual"))) / F.sum(F.length("qual"))).alias("mean_phred"),
    )
    levels = duplication_levels(reads, ["sample"])
    repeats = levels.groupBy("sample").agg(
        (100.0 - F.sum("sequences") * 100.0 / F.sum("reads")).alias("duplicate_percent")
    )
    kept = trim_report(reads).select(
        "sample",
        (F.col("reads_after") * 100.0 / F.col("reads_before")).alias("kept_percent"),
        "adapter_trimmed",
    )
    return null_safe_join(null_safe_join(basic, repeats, ["sample"]), kept, ["sample"])


# -- pairing -----------------------------------------------------------------

def pair_mates(reads: DataFrame) -> DataFrame:
    """First mates with their second mates; a null sample is a sample."""
    one, two = (
        reads.where(F.col("mate") == m).select(
            "sample", "read_id", F.col("seq").alias(f"seq_{m}"), F.col("qual").alias(f"qual_{m}")
        )
        for m in (1, 2)
    )
    return null_safe_join(one, two, ["sample", "read_id"])


def unpaired(reads: DataFrame) -> DataFrame:
    """First mates without a second one."""
    two = reads.where(F.col("mate") == 2).select("sample", "read_id")
    return null_safe_join(reads.where(F.col("mate") == 1), two, ["sample", "read_id"], "left_anti")
