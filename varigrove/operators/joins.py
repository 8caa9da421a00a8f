"""Joins and orderings that hold when one key owns a large part of the rows.

Nothing here drops, caps or samples rows. Where a side is broadcast, its size
was measured first or follows from the way it was made.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varigrove.session import ensure_checkpoint_dir

HOT_SHARE = 0.01
SALTS = 32
ROSTER_SHARD = 50_000
# Entries of a roster that one row of a grid holds.
GRID_SHARD = 4096

_SALT = "__salt"
_HOT = "__hot"


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that own more than `share` of all rows.

    At most 1/share keys can, whatever the data, so the result may always be
    broadcast. The count combines on the map side.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    return counts.where(F.col("__n") > total * share).select(*keys, F.lit(True).alias(_HOT))


def salted_join(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Equi-join in which hot keys of `facts` are spread over `salts` tasks.

    Only hot keys are salted, and only their rows in `lookup` are repeated.
    Works for joins that keep or drop rows of `facts` (inner, left, semi, anti).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"not a salted join: {how}")
    hot = F.broadcast(hot_keys(facts, keys))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in _hashable(facts)]), F.lit(salts)).cast("int")
    left = (
        facts.join(hot, list(keys), "left")
        .withColumn(_SALT, F.when(F.col(_HOT), spread).otherwise(F.lit(0)))
        .drop(_HOT)
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    right = (
        lookup.join(hot, list(keys), "left")
        .withColumn(_SALT, F.explode(F.when(F.col(_HOT), every).otherwise(F.array(F.lit(0)))))
        .drop(_HOT)
    )
    return left.join(right, [*keys, _SALT], how).drop(_SALT)


def gathered(df: DataFrame, keys: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Rows of equal `keys` in one task, those of hot keys in `salts` tasks, with the column `__salt` beside the keys.

    For aggregates with many groups to a key, of which each map task would else
    write nearly all. A group by keys and salt stays in its task; one by the keys alone must follow.
    Tasks are not merged again for being small, as rows that pack well become many.
    """
    hot = hot_keys(df, keys).withColumnRenamed(_HOT, _SALT)
    marked = null_safe_join(df, F.broadcast(hot), keys, "left")
    spread_out = F.pmod(F.xxhash64(*[F.col(c) for c in _hashable(df)]), F.lit(salts)).cast("int")
    return spread(marked.withColumn(_SALT, F.when(F.col(_SALT), spread_out).otherwise(F.lit(0))), *keys, _SALT)


def gathered_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Inner equi-join that leaves rows of equal `keys` in one task, those of hot keys of `facts` in `salts` tasks, with the column `__salt`.

    The salt is -1 where the key is not hot. So a group by keys, salt and more is made where
    the rows are, and is whole for a salt of -1; only hot keys need another group by the rest.
    """
    hot = F.broadcast(hot_keys(facts, keys))
    spread_out = F.pmod(F.xxhash64(*[F.col(c) for c in _hashable(facts)]), F.lit(salts)).cast("int")
    left = facts.join(hot, list(keys), "left").withColumn(_SALT, F.when(F.col(_HOT), spread_out).otherwise(F.lit(-1))).drop(_HOT)
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    listed = F.explode(F.when(F.col(_HOT), every).otherwise(F.array(F.lit(-1))))
    right = lookup.join(hot, list(keys), "left").withColumn(_SALT, listed).drop(_HOT)
    return spread(left, *keys, _SALT).join(right, [*keys, _SALT])


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join to a side that is small as a rule.

    Adaptive execution measures the side when it is there, broadcasts it within
    its bound (`spark.sql.adaptive.autoBroadcastJoinThreshold`), and else shuffles
    both and splits partitions in which a key is crowded. Nothing is counted while the plan is built.
    """
    return facts.join(lookup, list(keys), how)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key equals a null; the keys come from `left`, which `how` must keep or drop (inner, left, semi, anti)."""
    met = reduce(Column.__and__, (F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys))
    joined = left.alias("l").join(right.alias("r"), met, how)
    added = [] if how in ("left_semi", "left_anti") else [F.col(f"r.`{c}`") for c in right.columns if c not in keys]
    return joined.select("l.*", *added)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows over all shuffle partitions, for a short table whose rows become many.

    A stated number is not merged again for being small, as AQE would do.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def with_roster(
    df: DataFrame, roster: DataFrame, column: str, shard_rows: int = ROSTER_SHARD
) -> DataFrame:
    """Each row of `df` once per distinct entry of `roster[column]`.

    The roster travels as an array and is exploded in place, so the rows of
    `df` stay where they are. A roster larger than `shard_rows` is cut into
    shards by hash, and each shard travels alone.
    """
    names = roster.select(column).distinct()
    shards = max(1, -(-names.count() // shard_rows))

    def part(shard: int) -> DataFrame:
        mine = names
        if shards > 1:
            mine = names.where(F.pmod(F.xxhash64(column), F.lit(shards)) == shard)
        # Structs, since a list of plain values leaves out a null.
        entries = mine.agg(F.sort_array(F.collect_list(F.struct(column)))).scalar()
        return df.select("*", F.explode(entries).alias("__entry")).withColumn(column, F.col("__entry").getField(column)).drop("__entry")

    return reduce(DataFrame.unionByName, (part(s) for s in range(shards)))


def filled_grid(keys: DataFrame, roster: DataFrame, cells: DataFrame, key: str, column: str, shard_rows: int = GRID_SHARD) -> DataFrame:
    """Each row of `keys[key]` once per distinct entry of `roster[column]`, with the further columns of `cells`, null where it has no such pair.

    The grid is never moved. Cells, of which a pair has one at most, are collected by key and
    shard of the roster; the entries of the shard that are not among them are added in place. So the shuffle holds
    the cells, and a row at most one shard. Nulls are a key and an entry of their own.
    """
    others = [f for f in cells.schema.fields if f.name not in (key, column)]
    names = roster.select(column).distinct()
    shards = max(1, -(-names.count() // shard_rows))
    shard = F.pmod(F.xxhash64(column), F.lit(shards)).alias("__shard")
    # Structs, since a list of plain values leaves out a null.
    listed = F.transform(F.collect_list(F.struct(column)), lambda e: e[column]).alias("__names")
    entries = names.groupBy(shard).agg(listed)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("__shard")
    cell = F.struct(column, *[f.name for f in others]).alias("__cell")
    placed = cells.select(key, shard, cell).unionByName(keys.select(key, every), allowMissingColumns=True)
    # A cell is a struct that is never null, so the nulls are the rows of `keys`.
    collected = spread(placed, key, "__shard").groupBy(key, "__shard").agg(
        F.count(F.when(F.col("__cell").isNull(), 1)).alias("__copies"), F.collect_list("__cell").alias("__cells")
    )
    met = collected.where(F.col("__copies") > 0).join(F.broadcast(entries), "__shard")
    met = met.select(key, "__cells", "__names", F.explode(F.sequence(F.lit(1).cast("long"), "__copies")))
    absent = met.select(key, F.explode(F.array_except("__names", F.col("__cells").getField(column))).alias(column))
    # Apart, since plain values explode faster than structs; both read one shuffle.
    return absent.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in others]).unionByName(met.select(key, F.inline("__cells")))


def ordered_index(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """Number the rows 1..n in the order of `order`, with no single-task window.

    A range shuffle sorts the rows over all tasks; each task numbers its own
    stretch, and the lengths of the stretches before it are added. The sorted
    rows are checkpointed, so both steps see the same stretches even if an
    executor is lost in between. `order` should identify a row: then the sort
    can split any run of equal positions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()).checkpoint()
    # The id holds the task number in its upper bits, the row number below.
    task = F.shiftright("__at", 33)
    row = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    stretch = placed.groupBy(task.alias("__task")).agg((F.max(row) + 1).alias("__n"))
    # One row per task: as many as shuffle partitions, never as many as rows.
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offset = stretch.select(
        "__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    return (
        placed.withColumn("__task", task)
        .join(F.broadcast(offset), "__task")
        .withColumn(name, row + F.col("__before") + 1)
        .drop("__at", "__task", "__before")
    )


def running_total(
    df: DataFrame, by: Sequence[str], order: str, value: str, block: int, name: str
) -> DataFrame:
    """Inclusive running sum of `value` by integer `order`, in blocks.

    A window over a whole group would put that group into one task. Here the
    window covers `block` order values; sums of whole blocks are carried in.
    `order` must be unique within `by`.
    """
    cut = df.withColumn("__block", F.floor(F.col(order) / block))
    carried = block_carry(cut, by, value)
    inside = Window.partitionBy(*by, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.withColumn("__inside", F.sum(value).over(inside))
        .join(carried, [*by, "__block"])
        .withColumn(name, F.col("__inside") + F.col("__carry"))
        .drop("__block", "__inside", "__carry")
    )


def block_carry(cut: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """For each `(by, __block)`, the sum of `value` over the blocks before."""
    before = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*by, "__block").agg(F.sum(value).alias("__total"))
    return totals.select(
        *by, "__block", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__carry")
    )


def interval_join(
    intervals: DataFrame, points: DataFrame, key: str, start: str, stop: str, at: str, finest: int = 10, coarsest: int = 28
) -> DataFrame:
    """Points inside closed intervals of the same `key`, as an equi-join on bins of several widths.

    Widths go from 2^`finest` to 2^`coarsest` in powers of 64. An interval is listed in
    bins of the first width that is a 16th of its length or more, so in 17 at
    most; only beyond 16 of the widest bins are there more. A point is listed
    once in its bin of every width, so each pair meets exactly once. Which side
    travels is left to adaptive execution, which measures both and splits bins
    crowded by intervals or points. A null bound or position meets nothing.
    """
    levels = list(range(finest, coarsest + 1, 6))
    length = F.col(stop) - F.col(start)
    level = F.lit(levels[-1])
    for bits in reversed(levels[:-1]):
        level = F.when(length < (16 << bits), bits).otherwise(level)
    bin_of = lambda c, bits: F.call_function("shiftright", F.col(c).cast("long"), bits)
    listed = (
        intervals.where(F.col(start) <= F.col(stop))
        .withColumn("__level", level)
        .withColumn("__bin", F.explode(F.sequence(bin_of(start, F.col("__level")), bin_of(stop, F.col("__level")))))
    )
    each = F.array(*[F.struct(F.lit(bits).alias("__level"), bin_of(at, F.lit(bits)).alias("__bin")) for bits in levels])
    placed = points.where(F.col(at).isNotNull()).select("*", F.inline(each))
    met = listed.join(placed, [key, "__level", "__bin"])
    return met.where(F.col(at).between(F.col(start), F.col(stop))).drop("__level", "__bin")


def restrict_to(df: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """Rows whose `column` is in the list `names[column]`."""
    return lookup_join(df, names.select(column).distinct(), [column], "left_semi")


def _leading_bits(value: Column, bits: int) -> Column:
    """An integer that orders as doubles do, from the exponent and the first `bits` bits of the fraction; NaN last."""
    size = F.abs(value)
    # In doubles, since infinity has no exponent that a long holds.
    exponent = F.floor(F.log2(size)).cast("double")
    # Should the logarithm round up, the fraction is negative and the number that of the bin below.
    fraction = F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * (1 << bits)).cast("double")
    place = (exponent + 1100) * (1 << bits) + fraction
    top = F.lit(float(1 << (bits + 12)))
    kind = F.when(F.isnan(value), top * 2).when(size == float("inf"), top).when(size == 0, 0.0).otherwise(place)
    # Never null, so that no filter for it sinks into the counts and makes each pass read the data anew.
    return F.coalesce(F.when(value < 0, -kind).otherwise(kind).cast("long"), F.lit(0).cast("long"))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    passes: Sequence[int] = (10, 26),
    weight: str | None = None,
) -> DataFrame:
    """Exact interpolated quantiles, one row per `by`, a column per entry of `probs`.

    With `weight`, a whole number, a row counts as so many. A null in `by` is a group of its own, and null values are left out. Equal
    values are counted once, and every pass reads those counts. A pass
    adds them up by the leading bits of the value, fixed by `passes`, and keeps the bins that hold a
    wanted rank; the values of the last bins are then ranked one by one. So no
    task sees all values of a group: only its bins, and in the end values that agree in 26 bits of
    their fraction. A quantile between two equal values is that value.
    """
    by = list(by)
    # Structs compare nulls as equal. Without groups all rows have one key, which is no
    # literal, since a join on a literal would become a product.
    group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.pmod(F.xxhash64(value), F.lit(1)).alias("all"))
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(group.alias("__g"), F.col(value).cast("double").alias("__v"))
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("__c"))
    )
    spots = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(p)).alias("p")) for k, p in probs.items()])
    total = counts.groupBy("__g").agg(F.sum("__c").alias("__all"))
    at = F.col("__s.p") * (F.col("__all") - 1)
    # The two ranks around each quantile, counted from 0 in the bin they are in; at first that is the whole group.
    wanted = (
        total.withColumn("__s", F.explode(spots))
        .select("__g", F.col("__s.k").alias("__k"), at.alias("__at"))
        .withColumn("__rank", F.explode(F.array_distinct(F.array(F.floor("__at"), F.ceil("__at")))))
        .withColumn("__bin", F.lit(0).cast("long"))
    )
    inside = F.lit(0).cast("long")
    for bits in [*passes, None]:
        step = F.col("__v") if bits is None else _leading_bits(F.col("__v"), bits)
        near = counts.withColumn("__bin", inside).join(wanted.select("__g", "__bin").distinct(), ["__g", "__bin"])
        bins = near.groupBy("__g", "__bin", step.alias("__step")).agg(F.sum("__c").alias("__n"))
        upto = Window.partitionBy("__g", "__bin").orderBy("__step").rowsBetween(Window.unboundedPreceding, 0)
        ranked = bins.withColumn("__to", F.sum("__n").over(upto))
        found = ranked.join(wanted, ["__g", "__bin"]).where(
            (F.col("__rank") < F.col("__to")) & (F.col("__rank") >= F.col("__to") - F.col("__n"))
        )
        if bits is not None:
            rank = F.col("__rank") - (F.col("__to") - F.col("__n"))
            wanted = found.select("__g", "__k", "__at", rank.alias("__rank"), F.col("__step").alias("__bin"))
            inside = step
    low, high = F.min("__step"), F.max("__step")
    part = F.max("__at") - F.floor(F.max("__at"))
    blended = found.groupBy("__g", "__k").agg(F.when(low == high, low).otherwise(low + (high - low) * part).alias("__q"))
    return blended.groupBy("__g").agg(*[F.max(F.when(F.col("__k") == k, F.col("__q"))).alias(k) for k in probs]).select(
        *[F.col("__g").getField(c).alias(c) for c in by], *probs
    )
