"""Hard negatives by windows of scores over Hilbert-ordered blocks with zone maps.

Vectors become integers. Rows of one label are laid out along a Hilbert curve and
cut into blocks; each block has a zone map, the smallest and largest value of
every dimension. Interval arithmetic on a zone map bounds the inner product of an
anchor with any row of the block, from both sides. A window is a range of scores
that an anchor looks for; only blocks whose bounds meet one of its windows are read.

First each anchor looks for its positives, in blocks of its label that can beat
what its own block holds. Each positive then opens a window below its score, in
blocks of other labels. All rows are in blocks and no window is cut short: the
bounds are exact, so results are those of a comparison with every row.

Anchors travel in batches of at most `BATCH_ANCHORS`, candidates in groups of at
most 64 blocks, and a task holds one group and 64 batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varigrove.llm.common import quoted, saved

BLOCK_ROWS = 512
BATCH_ANCHORS = 512
#: Blocks of a group and groups of a pack of zone maps, as powers of two.
GROUP_BITS, PACK_BITS = 6, 6
BATCHES_AT_ONCE = 64

#: Integers per unit of a component; larger components than `LARGEST` units of it count as that.
LEVELS = 256
LARGEST = 1 << 28
#: Bits of a dimension along the curve.
CURVE_BITS = 3

_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places of integer points (rows, dimensions) on the Hilbert curve with `bits` bits a dimension.

    The points are turned into the transposed index, top bits first, by undoing
    the rotations of each level, then Gray code; keys order as bytes.
    """
    x = cells.T.astype(np.uint32).copy()
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(len(x)):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, np.uint32(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(flip, below, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turn
    spread = np.stack([(x >> np.uint32(level)) & 1 for level in range(bits - 1, -1, -1)])  # (bits, dims, rows)
    packed = np.packbits(spread.reshape(-1, x.shape[1]).astype(np.uint8), axis=0)
    return [row.tobytes() for row in packed.T]


def _integers(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, integer vectors) for each number of dimensions, without rows that take no part."""
    vectors = batch.column("vector")
    flat = np.asarray(vectors.flatten().cast(pa.float64()).fill_null(np.nan))
    sizes = np.asarray(vectors.value_lengths().fill_null(0)).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == dim)
        values = flat[begins[rows, None] + np.arange(dim)]
        whole = np.isfinite(values).all(axis=1)
        scaled = np.clip(np.floor(LEVELS * values[whole]), -LARGEST, LARGEST)
        yield rows[whole], scaled.astype(np.int64)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = squares = 0.0
    for batch in batches:
        for _, values in _integers(batch):
            n, squares = n + values.size, squares + float((values.astype(float) ** 2).sum())
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([squares])], ["n", "squares"])


def _encoded(width: float):
    """Rows `id, label, anchor, dim, curve, vector` of those that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, values in _integers(batch):
                cells = np.clip(np.floor((values / width + 2) * (1 << CURVE_BITS) / 4), 0, (1 << CURVE_BITS) - 1)
                taken = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(taken) for c in ("id", "label", "anchor")),
                        pa.array(np.full(len(rows), values.shape[1]), pa.int32()),
                        pa.array(hilbert_keys(cells, CURVE_BITS), pa.binary()),
                        pa.array([v.tobytes() for v in values.astype(np.int32)], pa.binary()),
                    ],
                    ["id", "label", "anchor", "dim", "curve", "vector"],
                )

    return run


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; doubles where they hold them."""
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if reach < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def _matrix(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.int32).reshape(-1, dim).astype(np.int64)


_BLOCK = "dim int, label long, ids array<long>, vectors binary, low binary, high binary, anchors array<int>, floors array<long>"


def _cut(positives: int):
    """Blocks of at most `BLOCK_ROWS` rows of one label, from rows in order, with what their anchors find inside."""

    def block(dim: int, label: int, rows: list[tuple]) -> dict:
        values = _matrix(b"".join(v for _, _, v in rows), dim)
        anchors = [i for i, (_, is_anchor, _) in enumerate(rows) if is_anchor]
        floors = []
        scores = _dot(values[anchors], values) if anchors else None
        for n, a in enumerate(anchors):
            others = [int(s) for s, (d, _, _) in zip(scores[n], rows) if d != rows[a][0]]
            floors.append(sorted(others)[-positives] if len(others) >= positives else int(_LOW))
        return {
            "dim": dim,
            "label": label,
            "ids": [d for d, _, _ in rows],
            "vectors": values.astype(np.int32).tobytes(),
            "low": values.min(axis=0).astype(np.int32).tobytes(),
            "high": values.max(axis=0).astype(np.int32).tobytes(),
            "anchors": anchors,
            "floors": floors,
        }

    schema = pa.schema(
        [
            ("dim", pa.int32()),
            ("label", pa.int64()),
            ("ids", pa.list_(pa.int64())),
            ("vectors", pa.binary()),
            ("low", pa.binary()),
            ("high", pa.binary()),
            ("anchors", pa.list_(pa.int32())),
            ("floors", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, held = None, []
        for batch in batches:
            for dim, label, *row in zip(*(batch.column(c).to_pylist() for c in ("dim", "label", "id", "anchor", "vector"))):
                if held and (kind != (dim, label) or len(held) == BLOCK_ROWS):
                    yield pa.RecordBatch.from_pylist([block(*kind, held)], schema=schema)
                    held = []
                kind = (dim, label)
                held.append(tuple(row))
        if held:
            yield pa.RecordBatch.from_pylist([block(*kind, held)], schema=schema)

    return run


_WINDOWS = "array<struct<a:int,w:int,lo:long,hi:long>>"
_BATCH = f"dim int, ids array<long>, labels array<long>, vectors binary, windows {_WINDOWS}"


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of the blocks in batches, each with one window: what beats its own block."""
    window = pa.list_(pa.struct([("a", pa.int32()), ("w", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64())]))
    schema = pa.schema(
        [("dim", pa.int32()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("vectors", pa.binary()), ("windows", window)]
    )

    def packed(dim: int, rows: list[tuple]) -> pa.RecordBatch:
        windows = [{"a": a, "w": 0, "lo": floor, "hi": int(_HIGH)} for a, (_, _, _, floor) in enumerate(rows)]
        line = {
            "dim": dim,
            "ids": [r[0] for r in rows],
            "labels": [r[1] for r in rows],
            "vectors": b"".join(r[2] for r in rows),
            "windows": windows,
        }
        return pa.RecordBatch.from_pylist([line], schema=schema)

    at, held = 0, []
    for batch in batches:
        for line in batch.to_pylist():
            dim, width = line["dim"], line["dim"] * 4
            if held and at != dim:
                yield packed(at, held)
                held = []
            at = dim
            for i, floor in zip(line["anchors"], line["floors"]):
                held.append((line["ids"][i], line["label"], line["vectors"][i * width : (i + 1) * width], floor))
                if len(held) == BATCH_ANCHORS:
                    yield packed(dim, held)
                    held = []
    if held:
        yield packed(at, held)


class _Anchors:
    """A batch of anchors with their windows as arrays (anchors, windows); one that is not open ends before it begins."""

    def __init__(self, line: dict):
        self.vectors = _matrix(line["vectors"], line["dim"])
        self.dim, self.ids = line["dim"], line["ids"]
        self.labels = np.array(line["labels"], np.int64)
        wide = max((w["w"] for w in line["windows"]), default=0) + 1
        self.lo = np.full((len(self.ids), wide), _HIGH, np.int64)
        self.hi = np.full((len(self.ids), wide), _LOW, np.int64)
        for w in line["windows"]:
            self.lo[w["a"], w["w"]], self.hi[w["a"], w["w"]] = w["lo"], w["hi"]
        self.rising, self.falling = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score of each anchor (rows) with any row of each block (columns)."""
        return (
            _dot(self.rising, low) + _dot(self.falling, high),
            _dot(self.rising, high) + _dot(self.falling, low),
        )

    def needs(self, low: np.ndarray, high: np.ndarray, labels: np.ndarray, same: bool) -> np.ndarray:
        """Whether each anchor has a window that rows of each block may meet."""
        least, most = self.bounds(low, high)
        met = np.zeros(least.shape, bool)
        for lo, hi in zip(self.lo.T, self.hi.T):
            met |= (lo <= hi)[:, None] & (most >= lo[:, None]) & (least <= hi[:, None])
        return met & ((self.labels[:, None] == labels) == same)


def _chosen(same: bool):
    """Pairs (batch, group) in which some anchor must read some block, from zone maps alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = []
            for line in batch.to_pylist():
                asking = _Anchors(line)
                zones = [z for z in line["zones"] if z["dim"] == asking.dim]
                if zones:
                    low, high = (_matrix(b"".join(z[side] for z in zones), asking.dim) for side in ("low", "high"))
                    needed = asking.needs(low, high, np.array([z["label"] for z in zones]), same).any(axis=0)
                    pairs += [(line["batch"], g) for g in sorted({z["grp"] for z, n in zip(zones, needed) if n})]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.int64()) for i in range(2)], ["batch", "grp"]
            )

    return run


def _tops(same: bool, top: int):
    """The first `top` rows of every window of the batches among the blocks of a group."""
    schema = pa.schema([("batch", pa.int64()), ("a", pa.int32()), ("w", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])

    def best_of(asking: _Anchors, blocks: list[dict]) -> np.ndarray:
        """Columns a, w, score, id is null, id."""
        low, high = (_matrix(b"".join(b[side] for b in blocks), asking.dim) for side in ("low", "high"))
        needed = asking.needs(low, high, np.array([b["label"] for b in blocks]), same)
        most = asking.bounds(low, high)[1]
        floor = asking.lo.copy()
        kept = np.zeros((0, 5), np.int64)
        # The most promising block first, so that the windows are soon full.
        for n in np.argsort(-np.where(needed, most, _LOW).max(axis=0), kind="stable"):
            rows = np.flatnonzero(needed[:, n] & (most[:, n, None] >= floor).any(axis=1))
            if not len(rows):
                continue
            block = blocks[n]
            scores = _dot(asking.vectors[rows], _matrix(block["vectors"], asking.dim))
            nulls = np.array([d is None for d in block["ids"]])
            ids = np.array([0 if d is None else d for d in block["ids"]], np.int64)
            new = []
            for w in range(floor.shape[1]):
                a, r = np.nonzero((scores >= floor[rows, w][:, None]) & (scores <= asking.hi[rows, w][:, None]))
                new.append(np.column_stack([rows[a], np.full(len(a), w), scores[a, r], nulls[r], ids[r]]))
            found = np.concatenate(new)
            if same:
                own = np.array(asking.ids, np.int64)
                found = found[(found[:, 3] == 1) | (found[:, 4] != own[found[:, 0]])]
            if not len(found):
                continue
            kept = np.concatenate([kept, found])
            kept = kept[np.lexsort((kept[:, 4], kept[:, 3], -kept[:, 2], kept[:, 1], kept[:, 0]))]
            window = kept[:, 0] * floor.shape[1] + kept[:, 1]
            place = np.arange(len(kept)) - np.searchsorted(window, window)
            kept, place = kept[place < top], place[place < top]
            full = kept[place == top - 1]
            floor[full[:, 0], full[:, 1]] = np.maximum(floor[full[:, 0], full[:, 1]], full[:, 2])
        return kept

    def run(blocks: pa.Table, batches: pa.Table) -> pa.Table:
        held = blocks.to_pylist()
        out = []
        for line in batches.to_pylist():
            asking = _Anchors(line)
            mine = [b for b in held if b["dim"] == asking.dim]
            if mine:
                kept = best_of(asking, mine)
                columns = [np.full(len(kept), line["batch"]), kept[:, 0], kept[:, 1], kept[:, 2]]
                arrays = [pa.array(c).cast(f.type) for c, f in zip(columns, schema)]
                out.append(pa.table([*arrays, pa.array(kept[:, 4], pa.int64(), mask=kept[:, 3] == 1)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def _windows(blocks: DataFrame, asking: DataFrame, same: bool, top: int) -> DataFrame:
    """`batch, a, w, place, score, id`: the first `top` rows of every window, best score first, then smallest id."""
    zones = blocks.groupBy("pack").agg(F.collect_list(F.struct("grp", "dim", "label", "low", "high")).alias("zones"))
    packs = zones.agg(F.sort_array(F.collect_list("pack"))).scalar()
    # Every batch meets every pack of zone maps; a pack stands for up to 2,000,000 rows.
    asked = asking.withColumn("pack", F.explode(packs)).join(zones, "pack")
    chosen = saved(asked.mapInArrow(_chosen(same), "batch long, grp long"), "negatives-chosen")
    slices = asking.select(F.ceil(F.count(F.lit(1)) / BATCHES_AT_ONCE)).scalar()
    keyed = chosen.withColumn("part", F.pmod(F.xxhash64("batch"), F.greatest(slices, F.lit(1))))
    left = blocks.select("grp", "dim", "label", "ids", "vectors", "low", "high").join(keyed.select("grp", "part").distinct(), "grp")
    right = asking.join(keyed.select("batch", F.col("grp").alias("to_grp"), F.col("part").alias("to_part")), "batch")
    found = (
        left.groupBy("grp", "part")
        .cogroup(right.groupBy("to_grp", "to_part"))
        .applyInArrow(_tops(same, top), "batch long, a int, w int, score long, id long")
    )
    order = Window.partitionBy("batch", "a", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    label: str | Column = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    share: int = 80,
) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score` for the rows where `anchors` holds.

    Components become floor(256 * x), and a score is the integer inner product
    with the anchor. An anchor's positives are its first `positives` rows of its label
    under another id; a positive's negatives are the first `negatives` rows of other labels that score
    between `share` percent of the positive's score and that score. Higher
    scores come first, ties by smaller id, null last.

    Rows with a null label or vector, or a null or non-finite component, take no
    part; nor do empty vectors. Vectors meet those of their own length only. Rows that repeat
    count as often as they stand there, an anchor too. Ids and labels are
    integers; other columns are not read. An empty table gives none.
    """
    named = quoted(label) if isinstance(label, str) else label
    shown = vectors.select(
        quoted(key).cast("long").alias("id"),
        named.cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        quoted(vector).cast("array<double>").alias("vector"),
    ).where(F.col("label").isNotNull() & F.col("vector").isNotNull())
    n, squares = shown.mapInArrow(_moments, "n double, squares double").agg(F.sum("n"), F.sum("squares")).first()
    width = (squares / n) ** 0.5 if n and squares else 1.0
    rows = saved(
        shown.mapInArrow(_encoded(width), "id long, label long, anchor boolean, dim int, curve binary, vector binary"),
        "negatives-rows",
    )
    order = ["dim", "label", "curve", "id"]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_cut(positives), _BLOCK)
    number = F.monotonically_increasing_id()
    numbered = laid.withColumn("block", number)
    blocks = saved(
        numbered.withColumn("grp", F.shiftright("block", GROUP_BITS)).withColumn("pack", F.shiftright("block", GROUP_BITS + PACK_BITS)),
        "negatives-blocks",
    )
    with_anchors = blocks.where(F.size("anchors") > 0).select("dim", "label", "ids", "vectors", "anchors", "floors")
    asking = saved(with_anchors.mapInArrow(_batches, _BATCH).withColumn("batch", F.monotonically_increasing_id()), "negatives-anchors")

    first = saved(_windows(blocks, asking, True, positives).select("batch", "a", "place", "score", "id"), "negatives-positives")
    lowest = F.ceil(F.col("score") * share / F.lit(100).cast("decimal(3, 0)")).cast("long")
    window = F.struct(F.col("a"), (F.col("place") - 1).alias("w"), lowest.alias("lo"), F.col("score").alias("hi"))
    opened = first.groupBy("batch").agg(F.collect_list(window).cast(_WINDOWS).alias("windows"))
    second = _windows(blocks, saved(asking.drop("windows").join(opened, "batch"), "negatives-windows"), False, negatives)
    names = asking.select("batch", F.posexplode("ids").alias("a", "anchor_id"))
    return (
        second.select("batch", "a", (F.col("w") + 1).alias("place"), F.col("place").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(first.withColumnsRenamed({"id": "positive_id", "score": "positive_score"}), ["batch", "a", "place"])
        .join(names, ["batch", "a"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
