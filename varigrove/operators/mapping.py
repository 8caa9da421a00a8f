"""Seed placement of reads on targets and operators over alignment tables.

Alignments: `sample, qname, flag, rname, pos, mapq, cigar, pnext` and, where a
step needs them, `seq, qual, sum_bq`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varigrove.functions import bases as B
from varigrove.operators import seeds
from varigrove.operators.joins import block_carry, exact_quantiles, lookup_join, null_safe_join, ordered_index

MIN_MAPQ = 30
SEED = 31
SEED_STEP = 23
DEPTH_BLOCK = 1 << 16

READ = ("sample", "read_id", "mate")


# -- seeds -------------------------------------------------------------------

def _coded_windows(df: DataFrame, offsets: Column, k: int, columns: list[str]) -> DataFrame:
    """Rows with `seq` as `columns, at, last, kmer, flip`, one for each offset: the window there, packed, of whichever strand packs lower.

    A base is two bits, so up to 31 of them are one long, and `flip` tells that
    it is the other strand's. Windows with other letters than A, C, G and T are
    left out. Both strands become digits once per sequence, and windows are coded
    before they become rows.
    """
    if not (k % 2 and 0 < k <= 31):
        raise ValueError("k must be odd, so that no window equals its other strand, and at most 31")
    strands = df.withColumns({"__digits": F.translate("seq", "ACGT0123", "0123xxxx"), "__odd": F.col("seq").rlike("[^ACGT]")})
    strands = strands.withColumn("__back", F.reverse(F.translate("__digits", "0123", "3210"))).where(F.length("seq") >= k)
    last = F.length("__digits") - k
    cut = lambda text, at: F.substring(F.col(text), at + 1, F.lit(k))
    code = lambda text, at: F.conv(cut(text, at), 4, 10).cast("long")
    plain = lambda at: ~F.col("__odd") | ~cut("__digits", at).rlike("[^0-3]")
    coded = F.transform(
        F.filter(offsets, plain),
        lambda at: F.struct(at.alias("at"), code("__digits", at).alias("ahead"), code("__back", last - at).alias("back")),
    )
    packed = F.transform(
        coded, lambda w: F.struct(w["at"], F.least(w["ahead"], w["back"]).alias("kmer"), (w["back"] < w["ahead"]).alias("flip"))
    )
    return strands.select(*columns, last.alias("last"), F.inline(packed))


def target_kmers(targets: DataFrame, k: int = SEED) -> DataFrame:
    """Every k-mer of every target with its place: `locus, t_off, kmer, t_flip`."""
    every = F.sequence(F.lit(0), F.length("seq") - k)
    # A short table whose rows become many: dealt before they do.
    coded = _coded_windows(targets.repartition("locus"), every, k, ["locus"])
    return coded.select("locus", F.col("at").alias("t_off"), "kmer", F.col("flip").alias("t_flip"))


def read_seeds(reads: DataFrame, k: int = SEED, step: int = SEED_STEP) -> DataFrame:
    """Every `step`-th k-mer of each read, counted from either end, so of both strands: `kmer, flip, r_off, back_off`.

    Where the two counts meet, one k-mer serves both strands. `r_off` is its
    place on the read, `back_off` on the other strand; null where it is not counted.
    """
    last = F.length("seq") - k
    steps = F.sequence(F.lit(0), last, F.lit(step))
    ends = F.when(last % step == 0, steps).otherwise(F.array_union(steps, F.transform(steps, lambda i: last - i)))
    counted = lambda c: F.when(c % step == 0, c)
    return _coded_windows(reads, ends, k, list(READ)).select(
        *READ, "kmer", "flip", counted(F.col("at")).alias("r_off"), counted(F.col("last") - F.col("at")).alias("back_off")
    )


def seed_join(reads: DataFrame, targets: DataFrame, k: int = SEED, step: int = SEED_STEP) -> DataFrame:
    """Reads that share seeds with a target, each at its best locus.

    Score = seeds on one diagonal; best by score, then locus, diagonal and
    strand. `second_score` is the best score among all other placements, 0 if
    there is none. With a `step` of 1 every window of a read is a seed.

    Every window is found by way of an index of the targets (`seeds.placements`), which no read is moved for. The few
    seeds of a larger step meet by a merge join on packed k-mers, whose crowded partitions adaptive
    execution splits. The k-mers are never broadcast: there are as many as bases in all targets, while
    the planner takes them for as small as the targets. Placements go by read once, for the scores and for the window.
    A read, and not a k-mer or a locus, is the group of the window: its rows are its own placements.
    """
    if step == 1:
        placed = seeds.placements(reads, targets, READ, k)
    else:
        met = read_seeds(reads, k, step).join(target_kmers(targets, k).hint("merge"), "kmer")
        same = F.col("flip") == F.col("t_flip")
        offset = F.when(same, F.col("r_off")).otherwise(F.col("back_off"))
        placed = met.select(
            *READ, "locus", F.when(same, "+").otherwise("-").alias("strand"), (F.col("t_off") - offset).alias("diag"), F.lit(1).alias("score")
        ).where(F.col("diag").isNotNull())
    placed = placed.repartition(*READ).groupBy(*READ, "locus", "diag", "strand").agg(F.sum("score").alias("score"))
    ranked = Window.partitionBy(*READ).orderBy(F.desc("score"), "locus", "diag", "strand")
    return (
        placed.withColumn("second_score", F.coalesce(F.lead("score").over(ranked), F.lit(0)))
        .withColumn("__r", F.row_number().over(ranked))
        .where(F.col("__r") == 1)
        .select(*READ, "locus", "diag", "strand", "score", "second_score")
    )


def on_target_counts(reads: DataFrame, placed: DataFrame) -> DataFrame:
    """Reads, reads on a target, and their share, per sample."""
    total = reads.groupBy("sample").agg(F.count(F.lit(1)).alias("reads"))
    hits = placed.groupBy("sample").agg(F.count(F.lit(1)).alias("n"))
    on = F.coalesce("n", F.lit(0))
    return total.join(hits, "sample", "left").select(
        "sample", "reads", on.alias("on_target"), (on * 100.0 / F.col("reads")).alias("percent")
    )


# -- alignments --------------------------------------------------------------

def min_mapq(aln: DataFrame, threshold: int = MIN_MAPQ) -> DataFrame:
    return aln.where(F.col("mapq") >= threshold)


def flag_bits(aln: DataFrame) -> DataFrame:
    """Flag bits as booleans, and the flag with the duplicate bit set."""
    flag = F.col("flag")
    return aln.select(
        "sample",
        "qname",
        "flag",
        B.has_flag(flag, B.PAIRED).alias("paired"),
        B.has_flag(flag, B.PROPER).alias("proper"),
        B.is_mapped(flag).alias("mapped"),
        B.has_flag(flag, B.REVERSE).alias("reverse"),
        B.has_flag(flag, B.FIRST_MATE).alias("first_mate"),
        B.set_flag(flag, B.DUPLICATE).alias("as_duplicate"),
    )


def attach_read_groups(aln: DataFrame, groups: DataFrame) -> DataFrame:
    """Alignments with the read group of their sample; without one its columns are null."""
    return lookup_join(aln, groups, ["sample"], "left")


def coordinate_sort(aln: DataFrame, order: Sequence[str] = ("rname", "pos", "qname", "flag")) -> DataFrame:
    """Globally sorted alignments; the name splits piles at one position."""
    return aln.orderBy(*order)


def coordinate_rank(aln: DataFrame, order: Sequence[str] = ("rname", "pos", "qname", "flag")) -> DataFrame:
    """Place of each alignment in coordinate order, from 1."""
    return ordered_index(aln, order, "rank")


def alignment_counts(aln: DataFrame) -> DataFrame:
    """Records per sample by class of flag.

    Where the records name the mate's contig (`rnext`, `=` for the same), pairs
    mapped to two contigs are counted too.
    """
    flag = F.col("flag")
    count = lambda cond: F.count(F.when(cond, 1))
    both = B.has_flag(flag, B.PAIRED) & B.is_mapped(flag) & ~B.has_flag(flag, B.MATE_UNMAPPED)
    elsewhere = []
    if "rnext" in aln.columns:
        elsewhere = [count(both & ~F.col("rnext").isin("=", "*") & (F.col("rnext") != F.col("rname"))).alias("mate_elsewhere")]
    return aln.groupBy("sample").agg(
        F.count(F.lit(1)).alias("total"),
        count(B.is_mapped(flag)).alias("mapped"),
        count(B.has_flag(flag, B.PAIRED)).alias("paired"),
        count(B.has_flag(flag, B.PROPER) & B.is_mapped(flag)).alias("properly_paired"),
        count(B.has_flag(flag, B.FIRST_MATE)).alias("first_mates"),
        count(B.has_flag(flag, B.SECOND_MATE)).alias("second_mates"),
        count(B.has_flag(flag, B.DUPLICATE)).alias("duplicates"),
        count(B.has_flag(flag, B.SECONDARY)).alias("secondary"),
        count(B.has_flag(flag, B.SUPPLEMENTARY)).alias("supplementary"),
        count(B.has_flag(flag, B.PAIRED) & B.is_mapped(flag) & B.has_flag(flag, B.MATE_UNMAPPED)).alias("singletons"),
        *elsewhere,
    )


def templates(aln: DataFrame, library: str | None = None) -> DataFrame:
    """One row per template, the records of one name in a sample and library: `__t, lib, low, high, score`.

    `low` and `high` are the ends of its mates in order: contig, 5' position with
    clips added back, and strand, of the primary mapped records. A template with
    one end has no `high`, one without any has neither. `score` adds up their
    base qualities. Should a mate stand there more than once, its first end counts.
    """
    flag = F.col("flag")
    name = library or _library(aln)
    primary = B.is_mapped(flag) & ~B.has_flag(flag, B.SECONDARY | B.SUPPLEMENTARY)
    end = F.struct(
        F.col("rname").alias("rname"),
        B.unclipped_start(F.col("pos"), F.col("cigar"), flag).alias("five"),
        B.has_flag(flag, B.REVERSE).alias("reverse"),
    )
    second = B.has_flag(flag, B.SECOND_MATE)
    # The name comes first: names tell rows apart when they are sorted for the aggregate.
    per = aln.groupBy("qname", "sample", F.col(name).alias("lib")).agg(
        F.min(F.when(primary & ~second, end)).alias("one"),
        F.min(F.when(primary & second, end)).alias("two"),
        F.sum(F.when(primary, F.col("sum_bq"))).alias("score"),
    )
    return per.select(
        F.struct("sample", "lib", "qname").alias("__t"),
        "lib",
        F.least("one", "two").alias("low"),
        F.when(F.col("one").isNotNull() & F.col("two").isNotNull(), F.greatest("one", "two")).alias("high"),
        F.coalesce("score", F.lit(0)).alias("score"),
    )


def _library(aln: DataFrame) -> str:
    return "library" if "library" in aln.columns else "sample"


def mark_duplicates(aln: DataFrame, library: str | None = None) -> DataFrame:
    """Set the duplicate bit on all records of all but the best template of each duplicate set.

    Pairs are duplicates if they share library and both ends (contig, unclipped
    5' position and strand of each mate). A template with one mapped end is a
    duplicate of any pair with an end there, else of other such templates with
    that end. The best has the highest sum of base qualities, then the smallest
    name and sample. Secondary and supplementary records follow their template; unmapped
    records, and templates without a primary mapped record, are never
    duplicates. Rows in are rows out, whatever they have in common. The library is the
    column `library` if there is one, else the sample; a null equals a null.

    Templates are made once and go by one aggregate that combines on the map side, so
    a set may hold any share of all templates: a pair stands for its set and, without a rank,
    for either end; a lone template stands for its end, where a pair comes first. The templates
    that stay are then looked up by name, a key of one template each.
    """
    named = library or _library(aln)
    null = lambda c: F.lit(None).cast(kinds[c])
    found = templates(aln, named)
    kinds = {f.name: f.dataType for f in found.withColumn("rank", _template_rank()).schema}
    # set, kind and rank; `own` makes a set of each template without an end.
    stands = lambda low, high, own, kind, rank: F.struct(
        low.alias("low"), high.alias("high"), own.alias("own"), F.lit(kind).alias("kind"), rank.alias("rank")
    )
    low, high = F.col("low"), F.col("high")
    own = F.when(low.isNull(), F.col("__t")).otherwise(null("__t"))
    itself = stands(low, high, own, 1, _template_rank())
    at_end = lambda end: stands(end, null("high"), null("__t"), 0, null("rank"))
    sets = found.select(
        "lib", F.inline(F.when(high.isNotNull(), F.array(itself, at_end(low), at_end(high))).otherwise(F.array(itself)))
    )
    # The place alone is enough to tell most sets apart, and is sorted by as a number.
    best = sets.groupBy(F.col("low.five").alias("__five"), "lib", "low", "high", "own").agg(F.min(F.struct("kind", "rank")).alias("f"))
    stays = best.where(F.col("f.kind") == 1).select(
        F.col("f.rank.q").alias("qname"), F.col("f.rank.s").alias("sample"), F.col("lib").alias("__lib"), F.lit(True).alias("__stays")
    )

    flag = F.col("flag")
    duplicate = B.is_mapped(flag) & F.col("__stays").isNull()
    return (
        null_safe_join(aln.withColumn("__lib", F.col(named)), stays, ["qname", "sample", "__lib"], "left")
        .withColumn("flag", F.when(duplicate, B.set_flag(flag, B.DUPLICATE)).otherwise(B.clear_flag(flag, B.DUPLICATE)))
        .select(*aln.columns)
    )


def _template_rank() -> Column:
    """Smallest for the best template of a set, which are all of one library."""
    return F.struct((-F.col("score")).alias("r"), F.col("__t.qname").alias("q"), F.col("__t.sample").alias("s"))


def duplicate_metrics(marked: DataFrame, by: Sequence[str] = ("sample",)) -> DataFrame:
    """Primary mapped records examined, alone and in pairs, duplicates among them and their share; and what was not examined."""
    flag = F.col("flag")
    other = B.has_flag(flag, B.SECONDARY | B.SUPPLEMENTARY)
    primary = B.is_mapped(flag) & ~other
    paired = B.has_flag(flag, B.PAIRED) & ~B.has_flag(flag, B.MATE_UNMAPPED)
    count = lambda cond: F.count(F.when(cond, 1))
    return (
        marked.groupBy(*by)
        .agg(
            count(primary).alias("examined"),
            count(primary & paired).alias("in_pairs"),
            count(primary & B.has_flag(flag, B.DUPLICATE)).alias("duplicates"),
            count(other).alias("secondary_or_supplementary"),
            count(~B.is_mapped(flag) & ~other).alias("unmapped"),
        )
        .withColumn("share", F.col("duplicates") / F.when(F.col("examined") > 0, F.col("examined")))
    )


def high_duplication(metrics: DataFrame, limit: float = 0.3) -> DataFrame:
    return metrics.where(F.col("share") > limit)


def mapq_attrition(aln: DataFrame, threshold: int = MIN_MAPQ) -> DataFrame:
    """Records before and after the MAPQ step per sample."""
    kept = F.count(F.when(F.col("mapq") >= threshold, 1))
    return (
        aln.groupBy("sample")
        .agg(F.count(F.lit(1)).alias("before"), kept.alias("after"))
        .withColumn("kept_percent", F.col("after") * 100.0 / F.col("before"))
    )


def aligned_stretches(aln: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Gap-free stretches of records that are evidence, see `bases.is_evidence`.

    Where the records hold bases, those without any (`*`) are left out.
    """
    usable = aln.where(B.is_evidence(F.col("flag")))
    if "seq" in aln.columns:
        usable = usable.where(F.col("seq").isNotNull() & ~F.col("seq").isin("*", ""))
    return usable.select(*keep, F.explode(B.aligned_blocks(F.col("cigar"))).alias("__b"))


def depth_track(aln: DataFrame, by: Sequence[str] = ("sample",), block: int = DEPTH_BLOCK) -> DataFrame:
    """Reads over covered stretches: `start, stop, depth`, positions from start to stop.

    A row ends where a read begins or ends or a block is full, so rows follow
    events and not bases. A stretch is two events, +1 at its start and -1 after its end, summed per
    position before any window. Running sums stay inside `block` positions;
    what enters a block is carried in, and a zero event at the start of every
    block a stretch runs into makes sure there is a row to carry it to.
    """
    keys = [*by, "rname"]
    spans = aligned_stretches(aln, [*keys, "pos"]).select(
        *keys,
        (F.col("pos") + F.col("__b.ref_off")).alias("start"),
        (F.col("pos") + F.col("__b.ref_off") + F.col("__b.len")).alias("end"),
    )
    first, last = F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block)
    event = lambda at, d: F.struct(at.cast("long").alias("at"), F.lit(d).cast("long").alias("d"))
    entered = F.when(
        last > first, F.transform(F.sequence(first + 1, last), lambda b: event(b * block, 0))
    ).otherwise(F.array().cast("array<struct<at:bigint,d:bigint>>"))
    events = spans.select(
        *keys, F.inline(F.concat(F.array(event(F.col("start"), 1), event(F.col("end"), -1)), entered))
    )
    steps = (
        events.groupBy(*keys, "at")
        .agg(F.sum("d").alias("d"))
        .withColumn("__block", F.floor(F.col("at") / block))
    )
    inside = Window.partitionBy(*keys, "__block").orderBy("at")
    runs = (
        steps.withColumn("__in", F.sum("d").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("__next", F.coalesce(F.lead("at").over(inside), (F.col("__block") + 1) * block))
        .alias("steps")
    )
    carry = block_carry(steps, keys, "d").alias("carry")
    met = reduce(Column.__and__, (F.col(f"steps.{k}").eqNullSafe(F.col(f"carry.{k}")) for k in [*keys, "__block"]))
    runs = (
        runs.join(carry, met)
        .select("steps.*", "carry.__carry")
        .withColumn("depth", F.col("__in") + F.col("__carry"))
        .where(F.col("depth") > 0)
    )
    return runs.select(*keys, F.col("at").alias("start"), (F.col("__next") - 1).alias("stop"), "depth")


def depth(aln: DataFrame, by: Sequence[str] = ("sample",), block: int = DEPTH_BLOCK) -> DataFrame:
    """Reads over each covered position: the stretches of `depth_track`, a row per position."""
    track = depth_track(aln, by, block)
    return track.select(*by, "rname", F.explode(F.sequence("start", "stop")).alias("pos"), "depth")


def depth_profile(track: DataFrame, by: Sequence[str] = ("rname",)) -> DataFrame:
    """Covered positions, mean, largest and median depth and quartiles over a track, each stretch weighing its length."""
    width = F.col("stop") - F.col("start") + 1
    sized = track.withColumn("__width", width)
    sums = sized.groupBy(*by).agg(
        F.sum("__width").alias("covered"),
        (F.sum(F.col("__width") * F.col("depth")) / F.sum("__width")).alias("mean_depth"),
        F.max("depth").alias("max_depth"),
    )
    marks = exact_quantiles(sized, "depth", {"q1": 0.25, "median_depth": 0.5, "q3": 0.75}, by, weight="__width")
    return null_safe_join(sums, marks, by)


def depth_bounds(track: DataFrame, low: float, high: float) -> DataFrame:
    """The stretches with a depth between two bounds: a mask of callable positions."""
    return track.where(F.col("depth").between(low, high))
