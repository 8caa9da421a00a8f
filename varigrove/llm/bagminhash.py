"""Near duplicates by BagMinHash signatures of word shingles.

A document is a bag of five-word shingles. Every shingle owns a Poisson process
of marked points (time, slot, height); a bag sees the points under the height of
its weight, and its signature is the earliest time in each slot. Two bags agree
in a slot with exactly their weighted Jaccard similarity, the sum of the smaller
weights over the sum of the larger.

The process is drawn by layers: heights are cut at 1, 2, 4, 8 ..., and a layer
is a process of its own whose rate is its width. A bag reads the layers wholly
under its weight and thins the one its weight ends in, so a heavy shingle costs
the logarithm of its weight. Points come in order of time, and no shingle is
read beyond the time at which all slots are sure to be taken.

Texts of equal words are one class before any signature is compared. Signatures
are cut into bands; texts that agree in a band are compared with one member of
the bucket by their whole bags; those that this leaves outside the bucket's
largest component are compared with all of the bucket, in blocks that put out
links only. Classes are the connected components of the links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varigrove.llm.common import KEPT, free_name, give_back, quoted, row_key, saved, words

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 20
ROWS = 5
SLOTS = BANDS * ROWS
#: Documents whose signatures are drawn together, and words of them at most (one document may have more).
BATCH_DOCS = 512
BATCH_WORDS = 300_000
#: Texts on either side of a block of comparisons.
BLOCK_TEXTS = 512
#: Word hashes kept within a task: memory, not results, depends on it.
KEPT_WORDS = 300_000

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_FACTORS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], _U)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finisher of the splitmix64 generator."""
    x = (x ^ x >> _U(30)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> _U(27)) * _U(0x94D049BB133111EB)
    return x ^ x >> _U(31)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < KEPT_WORDS:
            self[word] = found
        return found


_WORDS = WordHashes()
KEPT.append(_WORDS)


def shingles(line: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of `size` words, in order; a shorter text is one shingle."""
    if not line:
        return np.zeros(0, np.uint64)
    of_word = np.fromiter(map(_WORDS.__getitem__, line), np.uint64, len(line))
    n = min(size, len(line))
    out = np.full(len(line) - n + 1, n, np.uint64)
    for k in range(n):
        out = mixed(out * _GOLD + of_word[k : len(line) - n + 1 + k] * _FACTORS[k % len(_FACTORS)])
    return out


def signatures(ids: np.ndarray, weights: np.ndarray, owner: np.ndarray, bags: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures, one row per bag, of elements (`ids`, `weights` > 0, `owner`); an empty bag has infinities."""
    out = np.full((bags, slots), np.inf)
    total = np.bincount(owner, weights, bags)
    reach = slots * (np.log(slots) + 3)
    todo = total > 0
    while todo.any():
        # All points of a bag before `until` are drawn; a bag with an empty slot is drawn again for longer.
        until = np.where(todo, reach / np.maximum(total, 1), 0.0)
        mine = todo[owner]
        _draw(ids[mine], weights[mine], owner[mine], until, out)
        todo &= np.isinf(out).any(axis=1)
        reach *= 2
    return out


def _draw(ids: np.ndarray, weights: np.ndarray, owner: np.ndarray, until: np.ndarray, out: np.ndarray) -> None:
    flat, slots = out.reshape(-1), out.shape[1]
    layer = 0
    while len(ids):
        low, high = (0, 1) if layer == 0 else (1 << layer - 1, 1 << layer)
        rate = high - low
        seed, top, bag = mixed(ids + _U(layer * int(_GOLD) % 2**64)), weights, owner
        time = np.zeros(len(ids))
        block, drawn = 1, 0
        while len(seed):
            # A block of points for every process that has not run out of time.
            nth = np.arange(drawn + 1, drawn + block + 1, dtype=np.uint64) * _GOLD
            random = mixed(seed[:, None] + nth)
            gaps = -np.log((_as_float(random)))
            gaps /= rate
            gaps[:, 0] += time
            times = np.cumsum(gaps, axis=1)
            marks = mixed(random ^ _FACTORS[2])
            height = low + rate * _as_float(mixed(marks ^ _FACTORS[3]))
            seen = times < until[bag][:, None]
            if rate > 1:
                seen &= height < top[:, None]
            row, col = np.nonzero(seen)
            slot = (marks[row, col] >> _U(32)) * _U(slots) >> _U(32)
            np.minimum.at(flat, bag[row] * slots + slot.astype(np.int64), times[row, col])
            alive = times[:, -1] < until[bag]
            seed, top, bag, time = seed[alive], top[alive], bag[alive], times[alive, -1]
            drawn += block
            block = min(block * 4, 64)
        more = weights > high
        ids, weights, owner = ids[more], weights[more], owner[more]
        layer += 1


def _as_float(x: np.ndarray) -> np.ndarray:
    """In (0, 1)."""
    return ((x >> _U(12)).astype(np.float64) + 0.5) / float(1 << 52)


def band_keys(found: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per bag and band."""
    bits = found.view(np.uint64).reshape(len(found), bands, -1)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), bits.shape[:2]).copy()
    for k in range(bits.shape[2]):
        key = mixed(key * _GOLD + bits[:, :, k])
    return key


def _described(lines: list[list[bytes]], texts: list[str | None], ids: pa.Array, keys: pa.Array) -> pa.RecordBatch:
    ids_of, weights, owner, counts, content = [], [], [], [], []
    for n, line in enumerate(lines):
        found, times = np.unique(shingles(line), return_counts=True)
        ids_of.append(found)
        weights.append(times)
        owner.append(np.full(len(found), n))
        counts.append(int(times.sum()))
        # Texts without words are alike only if they are equal; null is empty.
        same = b" ".join(line) if line else b"\0" + (texts[n] or "").encode("utf-8", "surrogatepass")
        content.append(hashlib.md5(same).digest())
    keyed = band_keys(signatures(np.concatenate(ids_of), np.concatenate(weights), np.concatenate(owner), len(lines)))
    bands = [k if c else [] for k, c in zip(keyed.view(np.int64), counts, strict=True)]
    return pa.RecordBatch.from_arrays(
        [ids, keys.field("a"), keys.field("b"), pa.array(content, pa.binary()), pa.array(counts, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
        names=["id", "a", "b", "content", "n", "bands"],
    )


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2).to_pylist()
        start, lines, held = 0, [], 0
        for n, text in enumerate(texts):
            lines.append(words(text.lower()) if text else [])
            held += len(lines[-1])
            if len(lines) == BATCH_DOCS or held >= BATCH_WORDS or n == len(texts) - 1:
                part = batch.slice(start, len(lines))
                yield _described(lines, texts[start : n + 1], part.column(0), part.column(1))
                start, lines, held = n + 1, [], 0
        batch = texts = text = part = None
    give_back()  # workers are used again, by other stages too


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bags as sets: the k-th copy of a shingle is an element of its own."""
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            out = []
            for text in part.column(1).to_pylist():
                found, times = np.unique(shingles(words(text.lower())), return_counts=True)
                first = np.cumsum(times) - times
                copy = np.arange(times.sum()) - np.repeat(first, times)
                out.append(mixed(np.repeat(found, times) + copy.astype(np.uint64) * _FACTORS[4]).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.list_(pa.int64()))], names=["content", "bag"])
        batch = part = out = None
    give_back()


def _near_in_block(threshold: float):  # noqa: ANN202
    """Of the texts of a block, the pairs (u, v) of an asking and another one that are near and not in one component."""

    def compare(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        asks = block.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        own = np.unique(np.array(block.column("own").to_pylist(), dtype=object), return_inverse=True)[1]
        names = block.column("content").to_pylist()
        bags = block.column("bag").chunk(0)
        cuts, flat = bags.offsets.to_numpy(), bags.values.to_numpy()
        sizes = np.diff(cuts)
        others = np.flatnonzero(~asks)
        element = np.concatenate([flat[cuts[i] : cuts[i + 1]] for i in others] or [flat[:0]])
        order = np.argsort(element, kind="stable")
        element, holder = element[order], np.repeat(np.arange(len(others)), sizes[others])[order]
        found: set[tuple[bytes, bytes]] = set()
        for i in np.flatnonzero(asks):
            mine = flat[cuts[i] : cuts[i + 1]]
            low, high = np.searchsorted(element, mine, "left"), np.searchsorted(element, mine, "right")
            n = high - low
            places = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(holder[places], minlength=len(others))
            near = both >= threshold * (sizes[i] + sizes[others] - both)
            for k in others[near & (own[others] != own[i])]:
                found.add((max(names[i], names[k]), min(names[i], names[k])))
        pairs = sorted(found)
        return pa.table({"u": pa.array([u for u, _ in pairs], pa.binary()), "v": pa.array([v for _, v in pairs], pa.binary())})

    return compare


def _similarity(a: str, b: str) -> F.Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes of undirected `edges` (u, v): the smallest node of each component.

    Large and small stars in turn: a node's neighbours are linked to the
    smallest node around it, until all stars are one deep. Every step combines
    on the map side, and what it leaves is written.
    """
    now = saved(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")

    def measure(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = measure(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = saved(small.select("e.u", "e.v").where("u != v").distinct(), "edges")
        after = measure(now)
        if after == before:
            break
        before = after
    roots = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: id, a, b (a key of the whole row), class_id, class_rows, first.

    Rows are in one class if they are linked by texts whose bags of five-word
    shingles have a weighted Jaccard similarity of `threshold` or more; words
    are runs of letters, digits and what lies beyond ASCII, in lower case, and a
    text of fewer than five words is one shingle. Texts without words, null ones
    as empty ones, are alike if they are equal. class_id is the smallest id of
    the class (null only if all are), and `first` marks the row that stays: the
    one with the smallest id, nulls last, then the smallest key. Rows equal in
    every column share a key, so all of them are `first` or none is.
    """
    shown = docs.select(quoted(key).alias("id"), row_key(docs).alias("row"), quoted(text).cast("string").alias("text"))
    kind = shown.schema["id"].dataType.simpleString()
    rows = saved(
        shown.mapInArrow(_describe, f"id {kind}, a long, b long, content binary, n long, bands array<bigint>"), "near-rows"
    )
    first = F.struct(F.col("id").isNull().alias("none"), "id", "a", "b")
    texts = saved(
        rows.groupBy("content").agg(F.min(first).alias("first"), F.max("n").alias("n"), F.first("bands").alias("bands")), "near-texts"
    )
    linked = _linked(shown, texts, threshold)
    heads = (
        texts.select("content", "first")
        .join(linked, F.col("content") == F.col("node"), "left")
        .select("content", "first", F.coalesce("root", "content").alias("root"))
    )
    best = heads.groupBy("root").agg(F.min("first").alias("best"))
    of_text = heads.join(best, "root").select("content", "root", "best")
    sizes = rows.groupBy("content").agg(F.count(F.lit(1)).alias("k")).join(of_text, "content").groupBy("root").agg(F.sum("k").alias("class_rows"))
    # Written, so that the join below is of two plain shuffles and a text with many copies can be split.
    classes = saved(of_text.join(sizes, "root").select("content", "best", "class_rows"), "near-classes")
    return rows.join(classes, "content").select(
        "id",
        "a",
        "b",
        F.col("best.id").alias("class_id"),
        "class_rows",
        ((F.col("a") == F.col("best.a")) & (F.col("b") == F.col("best.b"))).alias("first"),
    )


def _linked(shown: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(node, root) of the contents that are linked to another: the smallest content of their component."""
    placed = texts.where("n > 0").select("content", "n", F.posexplode("bands").alias("band", "bucket"))
    # The member that others are compared with is another one in every band.
    lead = F.min(F.struct(F.xxhash64("content", "band").alias("h"), "content", "n")).alias("lead")
    crowded = placed.groupBy("band", "bucket").agg(lead, F.count(F.lit(1)).alias("members")).where("members > 1")
    members = saved(
        placed.join(saved(crowded, "near-buckets"), ["band", "bucket"])
        .where(F.col("content") != F.col("lead.content"))
        .select("band", "bucket", "members", "content", "n", F.col("lead.content").alias("lead"), F.col("lead.n").alias("lead_n")),
        "near-members",
    )
    enough = lambda x, y: F.least(x, y) >= F.greatest(x, y) * threshold
    pairs = members.where(enough(F.col("n"), F.col("lead_n"))).select(F.col("content").alias("u"), F.col("lead").alias("v")).distinct()

    wanted = (
        members.select("content").unionByName(members.select(F.col("lead").alias("content"))).distinct().join(texts, "content")
        .select("content", F.col("first.a").alias("a"), F.col("first.b").alias("b"))
    )
    keyed = shown.select(F.col("row.a").alias("a"), F.col("row.b").alias("b"), "text")
    # Rows that are equal in all columns share a key; one of them is enough.
    fetched = keyed.join(wanted, ["a", "b"]).select("content", "text")
    bags = saved(fetched.mapInArrow(_bags, "content binary, bag array<bigint>").dropDuplicates(["content"]), "near-bags")

    def verified(pairs: DataFrame) -> DataFrame:
        left = bags.select(F.col("content").alias("u"), F.col("bag").alias("x"))
        right = bags.select(F.col("content").alias("v"), F.col("bag").alias("y"))
        return pairs.join(left, "u").join(right, "v").select("u", "v", _similarity("x", "y").alias("j"))

    judged = saved(verified(pairs), "near-judged")
    roots = saved(components(judged.where(F.col("j") >= threshold).select("u", "v")), "near-roots")

    def rooted(df: DataFrame, node: str, name: str) -> DataFrame:
        of = roots.select(F.col("node").alias(node), F.col("root").alias("__root"))
        return df.join(of, node, "left").withColumn(name, F.coalesce("__root", node)).drop("__root")

    # Texts that agree in a band and are in different components may still be near
    # to each other. In a bucket, at least one of two such texts is outside its
    # largest component: those texts are compared with all others, in blocks.
    # Buckets of two have no such pair, and leads were compared with all.
    scored = rooted(members.where("members > 2"), "content", "own").select("band", "bucket", "content", "own")
    shares = scored.groupBy("band", "bucket", "own").agg(F.count(F.lit(1)).alias("k"))
    largest = shares.groupBy("band", "bucket").agg(
        F.max(F.struct("k", "own"))["own"].alias("most"), F.sum("k").alias("all"), F.max("k").alias("k")
    )
    mixed_buckets = saved(largest.where(F.col("k") < F.col("all")), "near-mixed")
    placed_in = saved(scored.join(mixed_buckets, ["band", "bucket"]), "near-scored")
    asks = F.ceil((F.col("all") - F.col("k")) / BLOCK_TEXTS).cast("int")
    told = F.ceil(F.col("all") / BLOCK_TEXTS).cast("int")
    block = lambda of: F.pmod(F.xxhash64("content"), of).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), of - 1))
    asking = placed_in.where("own != most").select(
        "band", "bucket", block(asks).alias("row"), every(told).alias("col"), F.lit(True).alias("asks"), "content", "own"
    )
    answering = placed_in.select(
        "band", "bucket", every(asks).alias("row"), block(told).alias("col"), F.lit(False).alias("asks"), "content", "own"
    )
    blocks = asking.unionByName(answering).join(bags, "content").groupBy("band", "bucket", "row", "col")
    late = saved(blocks.applyInArrow(_near_in_block(threshold), "u binary, v binary").distinct(), "near-late")
    met = saved(components(rooted(rooted(late, "u", "a"), "v", "b").select(F.col("a").alias("u"), F.col("b").alias("v"))), "near-met")
    # Roots that met late take the smallest of them along.
    moved = met.select(F.col("node").alias("root"), F.col("root").alias("to"))
    once = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return once.unionByName(met.join(roots, "node", "left_anti"))


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with one row of each class; see `near_classes`. Of rows equal in every column one stays."""
    a, b = free_name(docs.columns, "near_a"), free_name(docs.columns, "near_b")
    stays = near_classes(docs, key, text, threshold).where("first").select(F.col("a").alias(a), F.col("b").alias(b)).distinct()
    whole = F.struct(*[quoted(c) for c in docs.columns])
    keyed = docs.select(row_key(docs)["a"].alias(a), row_key(docs)["b"].alias(b), whole.alias("row"))
    # The join deals rows by their key already, so keeping one of each moves nothing more.
    once = keyed.join(stays, [a, b]).groupBy(a, b).agg(F.first("row").alias("row"))
    return once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
