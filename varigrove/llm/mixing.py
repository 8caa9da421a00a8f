"""Mixing sources to target weights: exact block quotas split among output shards.

The documents of a source fall into blocks by hash. A source's target is filled
with whole blocks in permuted order, and from the block that is too long on with
those rows that fit. The blocks drawn are dealt to output shards by a splitting tree: each
node holds one quota per source and gives its left child a multivariate
hypergeometric draw of half of its blocks. So a shard's mixture is distributed
as if all blocks had been shuffled at once, and no step sorts them all.

Everything is a DataFrame expression. What is not split further is one row per
source (targets) and one array entry per source (quotas): a recipe names its
sources, so neither grows with the documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varigrove.llm.common import free_name, quoted, saved

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Blocks of a source: one per so many words, and never more than MAX_BLOCKS;
#: beyond that, blocks grow and nothing else changes.
BLOCK_WORDS = 50_000
MAX_BLOCKS = 1 << 20
#: Words of an output shard, about 50 MB; their number is the next power of two.
SHARD_WORDS = 8_000_000
#: Shards of a small mix, so that it too can be read by several tasks.
LEAST_SHARDS = 8
#: Sources that are broadcast at most, about 100 bytes each.
BROADCAST_SOURCES = 100_000
#: Levels of the splitting tree in one plan; after as many, what is split is written and spread.
LEVELS = 6
SEED = 7


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target of a table (source, size).

    Sources in code point order, null last, weigh `weights`, repeating, and
    share `share` times all sizes. A target stops at `most` times its source;
    the excess goes to the others by weight. That is filling vessels to one
    level: a source under it is full, every other holds level x weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("nth", F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("nth") + 1))
        .withColumn("full", F.col("source_size") * F.lit(float(most)))
    )
    by_level = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    filled = F.coalesce(F.sum("full").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(every) * F.lit(float(share)) - filled) / open_weight
    return (
        weighed.withColumn("level", level)
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("full"))
        .withColumn("level", F.min_by(F.when(F.col("fits"), F.col("level")), F.when(F.col("fits"), F.col("full") / F.col("weight"))).over(every))
        .select(
            "source",
            "source_size",
            F.least(F.col("full"), F.coalesce(F.col("level") * F.col("weight"), F.col("full"))).alias("target"),
        )
    )


def _chance(*parts: Column) -> Column:
    """A number in (0, 1) that depends on `parts` only."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def hypergeometric(good: Column, bad: Column, draws: Column, chance: Column) -> Column:
    """How many of `good` are among `draws` taken from `good` + `bad`: the quantile at `chance`.

    The probabilities follow from their neighbours' by a ratio, from 12 standard
    deviations under the mean to 12 above; what lies beyond weighs under 1e-30.
    """
    total = (good + bad).cast("double")
    mean = draws * good / F.greatest(total, F.lit(1.0))
    spread = F.sqrt(
        F.greatest(mean * bad / F.greatest(total, F.lit(1.0)) * (total - draws) / F.greatest(total - 1, F.lit(1.0)), F.lit(0.0))
    )
    low = F.greatest(F.lit(0), draws - bad, F.floor(mean - 12 * spread - 10)).cast("long")
    high = F.greatest(low, F.least(good, draws, F.ceil(mean + 12 * spread + 10)).cast("long"))

    def ratio(x: Column) -> Column:
        return (good - x).cast("double") * (draws - x) / ((x + 1).cast("double") * (bad - draws + x + 1))

    steps = F.when(high > low, F.sequence(low, high - 1)).otherwise(F.expr("cast(array() as array<bigint>)"))
    one = F.lit(1.0)
    total_weight = F.aggregate(
        steps,
        F.struct(one.alias("w"), one.alias("sum")),
        lambda a, x: F.struct((a.w * ratio(x)).alias("w"), (a["sum"] + a.w * ratio(x)).alias("sum")),
        lambda a: a["sum"],
    )
    return F.aggregate(
        steps,
        F.struct(one.alias("w"), one.alias("sum"), low.alias("at"), (total_weight * chance).alias("goal")),
        lambda a, x: F.struct(
            (a.w * ratio(x)).alias("w"),
            (a["sum"] + a.w * ratio(x)).alias("sum"),
            F.when(a["sum"] < a.goal, x + 1).otherwise(a["at"]).alias("at"),
            a.goal.alias("goal"),
        ),
        lambda a: a["at"],
    )


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """source, shard, quota: the blocks `quota` of each source dealt to `shards` shards.

    `shards` is a power of two. Shards differ by one block at most, and the
    quotas of a source add up to its own.
    """
    levels = shards.bit_length() - 1
    if 1 << levels != shards:
        raise ValueError("the number of shards is a power of two")
    entry = F.struct(F.col("source").isNull().alias("none"), F.col("source"), F.col("quota").cast("long").alias("quota"))
    tree = quotas.agg(F.array_sort(F.collect_list(entry)).alias("held")).select(F.lit(0).cast("long").alias("node"), "held")
    for level in range(levels):
        if level and level % LEVELS == 0:
            tree = saved(tree.repartition("node"), "mix-tree")
        all_of = F.aggregate("held", F.lit(0).cast("long"), lambda a, e: a + e.quota)
        empty = F.expr("cast(array() as array<bigint>)")
        drawn = F.aggregate(
            "held",
            F.struct(
                F.floor((F.col("total") + F.pmod(F.col("node"), F.lit(2))) / 2).cast("long").alias("need"),
                F.col("total").alias("rest"),
                empty.alias("left"),
            ),
            lambda a, e: F.aggregate(
                F.array(hypergeometric(e.quota, a.rest - e.quota, a.need, _chance(F.lit(seed), F.lit(level), F.col("node"), e.source, e.none))),
                a,
                lambda _, x: F.struct(
                    (a.need - x).alias("need"), (a.rest - e.quota).alias("rest"), F.concat(a.left, F.array(x)).alias("left")
                ),
            ),
            lambda a: a.left,
        )
        half = F.zip_with("held", "left", lambda e, x: F.struct(e.none.alias("none"), e.source.alias("source"), x.alias("quota")))
        rest = F.zip_with(
            "held", "left", lambda e, x: F.struct(e.none.alias("none"), e.source.alias("source"), (e.quota - x).alias("quota"))
        )
        tree = (
            tree.withColumn("total", all_of)
            .withColumn("left", drawn)
            .select(
                F.inline(
                    F.array(
                        F.struct((F.col("node") * 2).alias("node"), half.alias("held")),
                        F.struct((F.col("node") * 2 + 1).alias("node"), rest.alias("held")),
                    )
                )
            )
        )
    return tree.select(F.col("node").alias("shard"), F.inline("held")).select("source", "shard", "quota").where("quota > 0")


def _bits(number: Column | str) -> Column:
    """Length of a number in binary digits, 0 for what is under 1."""
    number = F.col(number) if isinstance(number, str) else number
    return F.when(number >= 1, F.length(F.bin(F.floor(number)))).otherwise(0)


def _at(nth: str, row: Column) -> Column:
    """Place of a row in its source: blocks in permuted order, rows by number."""
    return F.col(nth).cast("long") * F.lit(1 << 32) + row


def _inside(spans: str, bits: Column, at: Column) -> Column:
    return F.exists(spans, lambda p: (bits <= p.bits) & (at < p.end))


def _walked(held: Column | str, goal: Column) -> Column:
    """open, spans: `held` rows (at, size, bits) taken in order up to `goal` words, and what is left of it.

    At the first row that does not fit, those of as many binary digits as what
    is left are set aside, so all that go on being met fit by themselves; the
    next that does not fit is larger than what is then left, and so on. `spans`
    has the most digits taken up to each such place.
    """

    def step(a: Column, x: Column) -> Column:
        asked = x.bits <= a.bits
        taken = asked & (x.size <= a.open)
        left = F.when(taken, a.open - x.size).otherwise(a.open)
        over, done = asked & ~taken, taken & (left < 1)
        span = F.struct(a.bits.alias("bits"), F.when(done, x["at"] + 1).otherwise(x["at"]).alias("end"))
        return F.struct(
            left.alias("open"),
            F.when(done, 0).when(over, F.greatest(_bits(left) - 1, F.lit(0))).otherwise(a.bits).alias("bits"),
            F.when(over | done, F.concat(a.spans, F.array(span))).otherwise(a.spans).alias("spans"),
        )

    nothing = F.expr("cast(array() as array<struct<bits:int,end:bigint>>)")
    start = F.struct(goal.alias("open"), (_bits(goal) + 1).alias("bits"), nothing.alias("spans"))
    end = F.coalesce(F.try_element_at(held, F.lit(-1))["at"] + 1, F.lit(0).cast("long"))
    return F.aggregate(
        held,
        start,
        step,
        lambda a: F.struct(a.open.alias("open"), F.concat(a.spans, F.array(F.struct(a.bits.alias("bits"), end.alias("end")))).alias("spans")),
    )


def _filled(rows: DataFrame, sums: DataFrame, placed: DataFrame) -> DataFrame:
    """source, nth, spans, extra, back: how blocks are taken in part.

    From the cut block on, rows are taken in order (`spans`). At the end, rows set
    aside are no shorter than the highest binary digit of what is left: one may
    fit yet, and then one may come nearer from above (`extra`). Where too little
    stands behind a long row to fill what it was set aside for, it is taken
    instead, and rows are given back for it from the end on (`back`), if that
    comes nearer.

    Rows of as many digits are needed only until their words reach what is left
    at the cut: by then all is filled or they are set aside. In front of the cut
    it is the longest row that they have to reach. So what one task walks over
    follows from the words of a block and of a row, not from those of the source.
    """
    cut = placed.where("left > 0 and words > left").select("source", F.col("nth").alias("first"), F.col("left").alias("open"))
    longest = sums.groupBy("source").agg(F.pow(F.lit(2.0), F.max("bits")).alias("longest"))
    near = sums.where("bits > 0").join(placed.select("source", "block", "nth"), ["source", "block"]).join(cut.join(longest, "source"), "source")
    behind = F.col("nth") >= F.col("first")
    before = (
        Window.partitionBy("source", "bits", behind)
        .orderBy(F.abs(F.col("nth") - F.col("first")))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    wanted = (
        near.withColumn("met", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .where(F.col("met") < F.when(behind, F.col("open")).otherwise(F.col("longest")))
        .select("source", "block", "bits", "nth", "first", "open")
    )
    entry = F.struct(_at("nth", F.col("nth_row")).alias("at"), "size", "bits")
    no_rows, no_spans = F.expr("cast(array() as array<bigint>)"), F.expr("cast(array() as array<struct<bits:int,end:bigint>>)")
    walked = (
        rows.join(wanted, ["source", "block", "bits"])
        .groupBy("source", "first", "open")
        .agg(F.array_sort(F.collect_list(entry)).alias("held"))
        .withColumn("ahead", F.filter("held", lambda x: x["at"] < _at("first", F.lit(0))))
        .withColumn("held", F.filter("held", lambda x: x["at"] >= _at("first", F.lit(0))))
        .withColumn("walk", _walked("held", F.col("open")))
        .select("source", "first", "ahead", "held", "walk.spans", "walk.open")
        .withColumn("aside", F.filter("held", lambda x: ~_inside("spans", x.bits, x["at"])))
        .withColumn("extra", no_rows)
        .withColumn("off", F.col("open"))
    )
    for _ in ("from below", "from above"):
        gaps = F.transform(
            F.filter("aside", lambda x: ~F.array_contains("extra", x["at"])),
            lambda x: F.struct(F.abs(x.size - F.col("off")).alias("gap"), x["at"].alias("at"), x.size.alias("size")),
        )
        walked = (
            walked.withColumn("nearest", F.array_min(gaps))
            .withColumn("comes", F.coalesce(F.col("nearest.gap") < F.col("off"), F.lit(False)))
            .withColumn("extra", F.when(F.col("comes"), F.concat("extra", F.array("nearest.at"))).otherwise(F.col("extra")))
            .withColumn("off", F.when(F.col("comes"), F.col("off") - F.col("nearest.size")).otherwise(F.col("off")))
        )
    longer = F.transform(F.filter("aside", lambda x: x.size > F.col("open")), lambda x: F.struct(x.size.alias("size"), x["at"].alias("at")))
    given = F.filter(F.concat("ahead", "held"), lambda x: (x["at"] < _at("first", F.lit(0))) | _inside("spans", x.bits, x["at"]))
    backwards = F.transform(F.reverse(given), lambda x: F.struct((-x["at"]).alias("at"), x.size.alias("size"), x.bits.alias("bits")))
    walked = (
        walked.withColumn("long", F.array_min(longer))
        .withColumn("given", backwards)
        .withColumn("walk", F.when(F.col("long").isNotNull(), _walked("given", F.col("long.size") - F.col("open"))))
        .withColumn("better", F.coalesce(F.col("walk.open") < F.abs("off"), F.lit(False)))
        .withColumn("extra", F.when(F.col("better"), F.array("long.at")).otherwise(F.col("extra")))
        .withColumn("back", F.when(F.col("better"), F.col("walk.spans")).otherwise(no_spans))
    )
    touched = F.filter(
        F.concat("ahead", "held"),
        lambda x: F.array_contains("extra", x["at"])
        | F.when(x["at"] < _at("first", F.lit(0)), _inside("back", x.bits, -x["at"])).otherwise(_inside("spans", x.bits, x["at"])),
    )
    hit = F.array_distinct(F.transform(touched, lambda x: F.floor(x["at"] / F.lit(1 << 32)).cast("int")))
    return walked.select("source", F.explode(hit).alias("nth"), "spans", "extra", "back")


def draw(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: Sequence[str] | None = None,
    shards: int | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> tuple[DataFrame, list[str], int]:
    """Each row of `docs` with what the mix takes of it; the names of the four columns added; the number of shards.

    The columns: size (words), source_size, target, and an array with the shard
    of each copy taken. Of `docs` the columns `keep` are returned, all by
    default; a name among them that is taken gets a `_` in front. Null texts have
    size 0 and a null source is a source of its own. A text longer than what a
    source still needs is left to other rows, whatever its length. Equal rows are
    drawn one by one. Empty tables give no rows.
    """
    keep = docs.columns if keep is None else list(keep)
    names = [free_name(keep, n) for n in ("size", "source_size", "target", "shards")]
    packed = docs.select(
        F.struct(*[quoted(c) for c in keep]).alias("row"),
        # Keeps the order of code points, and null last, without nulls to join on.
        F.coalesce(F.concat(F.lit("s"), quoted(source).cast("string")), F.lit("t")).alias("source"),
        word_count(quoted(text)).alias("size"),
        F.xxhash64(F.lit(seed), quoted(key), quoted(text)).alias("place"),
        quoted(key).alias("id"),
    )
    goal = saved(targets(packed.select("source", "size"), weights, share, most), "mix-targets").withColumn(
        "blocks", F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("source_size") / block_words) + 1).cast("int")
    )
    held = goal.agg(F.count(F.lit(1)).alias("sources"), F.sum("target").alias("words")).first()
    if shards is None:
        shards = max(LEAST_SHARDS, 1 << int((held.words or 0) / SHARD_WORDS).bit_length())
    # One row per source. So many that they don't fit are met by a plain join instead, with the same rows.
    near = F.broadcast(goal) if held.sources <= BROADCAST_SOURCES else goal
    sized = packed.join(near, "source").withColumn("block", F.pmod("place", "blocks").cast("int"))

    # A table of a few numbers per row: rows of a block are numbered in order of their hash.
    in_block = F.row_number().over(Window.partitionBy("source", "block").orderBy("place", "size"))
    rows = saved(sized.select("source", "block", "size", _bits("size").alias("bits"), in_block.alias("nth_row")), "mix-rows")
    sums = saved(rows.groupBy("source", "block", "bits").agg(F.sum("size").alias("words")), "mix-sums")

    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    permuted = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), F.lit("block"), "block"), "block")
    ahead = F.coalesce(F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = saved(
        sums.groupBy("source", "block")
        .agg(F.sum("words").alias("words"))
        .join(near, "source")
        .withColumn("full", whole.cast("int"))
        .withColumn("left", F.col("target") - F.col("full") * F.col("source_size") - ahead)
        .select("source", "block", "words", "full", "left", F.row_number().over(permuted).alias("nth")),
        "mix-blocks",
    )
    filled = saved(_filled(rows, sums, placed), "mix-filled")
    parts = (
        placed.join(filled, ["source", "nth"], "left")
        .withColumn("all", (F.col("left") > 0) & (F.col("words") <= F.col("left")))
        .withColumn("tickets", F.col("full") + (F.col("all") | F.col("spans").isNotNull()).cast("int"))
        .select("source", "block", "full", "all", "nth", "spans", "extra", "back", "tickets")
    )

    # Tickets of a source are numbered copy by copy in permuted order; its shards draw runs of that order.
    quotas = split_quotas(parts.groupBy("source").agg(F.sum("tickets").alias("quota")), shards, seed)
    numbered = Window.partitionBy("source").orderBy
    dealt = quotas.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.col("quota")))).select(
        "source", "shard", F.row_number().over(numbered("shard", "one")).alias("ticket")
    )
    tickets = (
        parts.where("tickets > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("tickets"))))
        .select("source", "block", "copy", F.row_number().over(numbered("copy", "nth")).alias("ticket"))
        .join(dealt, ["source", "ticket"])
        .groupBy("source", "block")
        .agg(F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("to"))
    )
    blocks = parts.join(tickets, ["source", "block"], "left").select("source", "block", "full", "all", "nth", "spans", "extra", "back", "to")

    # The join has dealt the rows by block, so numbering them again moves nothing more.
    met = sized.join(blocks, ["source", "block"]).withColumn("at", _at("nth", in_block)).withColumn("bits", _bits("size"))
    worded = F.col("size") > 0
    some = F.coalesce(worded & _inside("spans", F.col("bits"), F.col("at")), F.lit(False))
    returned = F.coalesce(worded & _inside("back", F.col("bits"), -F.col("at")), F.lit(False))
    chosen = F.coalesce(F.array_contains("extra", F.col("at")), F.lit(False))
    met = met.withColumn("partly", chosen | ((F.col("all") | some) & ~returned))
    copies = F.col("full") + F.col("partly").cast("int")
    none = F.expr("cast(array() as array<bigint>)")
    to = F.when(copies > 0, F.slice(F.transform("to", lambda t: t.shard), 1, copies)).otherwise(none)
    drawn = met.select(
        *[F.col("row").getField(c).alias(c) for c in keep],
        *[F.col(c).alias(n) for c, n in zip(("size", "source_size", "target"), names)],
        to.alias(names[3]),
    )
    return drawn, names, shards


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is drawn, in its shards, shuffled inside each.

    A partition holds one or more shards whole; rows come in the order of a hash.
    Options as for `draw`. The columns are those of `docs`.
    """
    seed = options.get("seed", SEED)
    drawn, (_, _, _, to), shards = draw(docs, **options)
    shard, place = free_name(drawn.columns, "shard"), free_name(drawn.columns, "place")
    key = options.get("key", "doc_id")
    return (
        drawn.select("*", F.posexplode(quoted(to)).alias(place, shard))
        .withColumn(place, F.xxhash64(F.lit(seed), F.lit("order"), quoted(key), quoted(place)))
        .repartition(shards, quoted(shard))
        .sortWithinPartitions(shard, place)
        .select(*[quoted(c) for c in docs.columns])
    )
