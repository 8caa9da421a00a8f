"""Fingerprints of documents by a randomised embedding of edits, and searches with them.

A walk reads a text: at every step it puts out the character it stands on, and a
random bit of the step and the character says whether it moves on. All texts
share the bits, so two texts walk alike as long as they are equal, and after an
insertion or deletion they soon fall into step again: edits become places in
which the walks differ. A walk ends with its text.

A fingerprint holds `PLACES` steps of a walk, those of the smallest hash among
all steps it took, with four random bits of the character at each. Whatever the
two lengths, the steps held of the longer walk that the shorter one took as well
are held of that one too, so their share of equal characters tells how alike the
walks are. Bands of few steps serve as keys of a search, and likeness verifies
what meets in a band.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from varigrove.llm.common import in_slices, quoted, saved

PLACES = 256
BANDS = 32
#: Steps of a band; texts that differ in a fifth of all steps agree in some band with a probability of 0.99.
BAND_STEPS = 6
#: Characters that are walked at once.
STRETCH = 1 << 16

# The bits are a table: characters in 32 classes, steps modulo 16,384.
_CLASS_BITS, _PERIOD = 5, 1 << 14
_FIRST, _SECOND, _THIRD = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """64 bits scattered one to one."""
    x = x.astype(np.uint64) * _FIRST
    x ^= x >> np.uint64(30)
    x *= _SECOND
    x ^= x >> np.uint64(27)
    x *= _THIRD
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _moves() -> list[bytes]:
    """For each class of characters and step, how many steps pass until the walk has moved on."""
    classes, steps = np.arange(1 << _CLASS_BITS, dtype=np.uint64), np.arange(_PERIOD, dtype=np.uint64)
    moves = (_mix((classes[:, None] << np.uint64(32)) + steps + np.uint64(1)) >> np.uint64(63)).astype(np.int64)
    wait = np.zeros(moves.shape, np.int64)
    ahead = np.zeros(len(classes), np.int64)
    for _ in range(2):  # the second time knows what follows the end of the period
        for step in range(_PERIOD - 1, -1, -1):
            ahead = np.where(moves[:, step] == 1, 1, ahead + 1)
            wait[:, step] = ahead
    return [np.minimum(row, 255).astype(np.uint8).tobytes() for row in wait]


class Walk:
    """A walk over a text that comes in parts; it holds the steps of smallest hash."""

    def __init__(self) -> None:
        self.steps = 0
        self.held = np.zeros(0, np.int64)
        self.letters = np.zeros(0, np.uint32)

    def copy(self) -> Walk:
        other = Walk()
        other.steps, other.held, other.letters = self.steps, self.held, self.letters
        return other

    def feed(self, letters: np.ndarray) -> Walk:
        """Walk on over code points."""
        waits, last = _moves(), _PERIOD - 1
        for start in range(0, len(letters), STRETCH):
            part = letters[start : start + STRETCH]
            classes = ((part * np.uint32(2654435761)) >> np.uint32(32 - _CLASS_BITS)).astype(np.uint8).tobytes()
            step = self.steps
            ends = np.array([step := step + waits[c][step & last] for c in classes], np.int64)
            taken = np.arange(self.steps, step, dtype=np.int64)
            if len(self.held) == PLACES:
                taken = taken[_mix(taken) < _mix(self.held[-1:])]
            self.held = np.r_[self.held, taken]
            self.letters = np.r_[self.letters, part[np.searchsorted(ends, taken, side="right")]]
            order = np.argsort(_mix(self.held), kind="stable")[:PLACES]
            self.held, self.letters, self.steps = self.held[order], self.letters[order], step
        return self

    def fingerprint(self) -> str:
        """`steps:digits`, a hexadecimal digit for each step that is held, in order of hash."""
        digits = _mix(self.held.astype(np.uint64) * np.uint64(1 << 21) + self.letters) >> np.uint64(60)
        return f"{self.steps}:" + "".join("0123456789abcdef"[d] for d in digits.tolist())


def letters_of(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def fingerprint(text: str | None) -> str:
    """The fingerprint of a whole text; null is empty."""
    return Walk().feed(letters_of(text)).fingerprint()


@lru_cache(maxsize=64)
def _low_hashes(level: int) -> np.ndarray:
    """Steps below 2^level in order of hash: enough of them that any upper half of the level finds its places."""
    share = min(1.0, 16 * PLACES / (1 << level))
    limit = np.uint64(min(int(share * 2**64), 2**64 - 1))
    found = []
    for start in range(0, 1 << level, 1 << 20):
        steps = np.arange(start, min(start + (1 << 20), 1 << level), dtype=np.int64)
        found.append(steps[_mix(steps) <= limit])
    steps = np.concatenate(found)
    return steps[np.argsort(_mix(steps), kind="stable")]


@lru_cache(maxsize=4096)
def places(steps: int) -> np.ndarray:
    """The steps that a fingerprint of a walk of `steps` steps holds, in its order."""
    low = _low_hashes(max(steps, 1).bit_length())
    held = low[low < steps][:PLACES]
    if len(held) < min(steps, PLACES):  # hashes this uneven are not known
        held = np.arange(steps, dtype=np.int64)
        held = held[np.argsort(_mix(held), kind="stable")][:PLACES]
    return held


def _parsed(mark: str) -> tuple[int, np.ndarray]:
    steps, digits = mark.split(":")
    return int(steps), np.frombuffer(digits.encode(), np.uint8)


def likeness(a: str, b: str) -> float:
    """Share, 0 to 1, of the longer walk's steps at which both walks stand on equal characters.

    Digits that agree by chance are taken off. Two empty texts are equal.
    """
    if a == b:
        return 1.0
    (short, x), (long, y) = sorted((_parsed(a), _parsed(b)), key=lambda p: p[0])
    if not len(x):
        return 0.0
    both = y[places(long) < short]
    equal = float((both == x[: len(both)]).sum()) / len(y)
    return max(0.0, (equal - 1 / 16) * 16 / 15)


def bands(mark: str) -> list[int]:
    """A key for each band, of its first steps and their digits; an empty walk has none."""
    steps, digits = _parsed(mark)
    held = places(steps)
    band = (_mix(held + (1 << 62)) % np.uint64(BANDS)).astype(np.int64)
    order = np.argsort(band, kind="stable")
    band, held, digits = band[order], held[order], digits[order]
    first = np.arange(len(band)) - np.searchsorted(band, band) < BAND_STEPS
    band, parts = band[first], _mix(held[first].astype(np.uint64) * np.uint64(256) + digits[first])
    starts = np.flatnonzero(np.r_[True, band[1:] != band[:-1]]) if len(band) else np.zeros(0, np.int64)
    keys = np.add.reduceat(parts, starts) if len(starts) else parts
    return _mix(keys + band[starts].astype(np.uint64)).astype(np.int64).tolist()


def _described(batch: pa.RecordBatch) -> pa.RecordBatch:
    marks = [fingerprint(t) for t in batch.column(1).to_pylist()]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(marks, pa.string()), pa.array([bands(m) for m in marks], pa.list_(pa.int64()))],
        ["id", "fingerprint", "bands"],
    )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`id, fingerprint, bands` for every row of `docs`.

    Whole texts are walked in stretches, so a very long one needs no memory of
    its length beyond itself. Null counts as empty, and an empty text has no bands. Equal texts have equal
    fingerprints, rows that repeat are described as often, and other columns are not read.
    """
    shown = docs.select(quoted(key).alias("id"), quoted(text).cast("string").alias("text"))
    kind = shown.schema["id"].dataType.simpleString()
    return shown.mapInArrow(in_slices(_described), f"id {kind}, fingerprint string, bands array<long>")


def similar(asked: DataFrame, docs: DataFrame, least: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`asked_id, doc_id, likeness`: the documents that are at least as like as `least` to each row of `asked`.

    Candidates share a band, of either side's distinct fingerprints, and are
    verified by their likeness; then the ids come back. Copies are one
    fingerprint until then, so no group of them is compared with itself. Texts
    that are `least` alike and share no band are missed: at 0.8, one in two hundred.
    Empty texts have no bands and meet none. Ids may be null, and rows that repeat come back as often.
    """
    left = saved(fingerprints(asked, key, text), "fingerprints-asked")
    right = saved(fingerprints(docs, key, text), "fingerprints-docs")

    def banded(rows: DataFrame, name: str) -> DataFrame:
        once = rows.groupBy("fingerprint").agg(F.first("bands").alias("bands"))
        return once.select(F.col("fingerprint").alias(name), F.posexplode("bands").alias("band", "bucket"))

    pairs = banded(left, "a").join(banded(right, "b"), ["band", "bucket"]).select("a", "b").distinct()

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (batch.column(c).to_pylist() for c in ("a", "b"))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(map(likeness, x, y)))], ["a", "b", "likeness"])

    judged = pairs.mapInArrow(in_slices(judge), "a string, b string, likeness double").where(F.col("likeness") >= least)
    return (
        judged.join(left.select(F.col("fingerprint").alias("a"), F.col("id").alias("asked_id")), "a")
        .join(right.select(F.col("fingerprint").alias("b"), F.col("id").alias("doc_id")), "b")
        .select("asked_id", "doc_id", "likeness")
    )


Judge = Callable[[str, str], tuple]


def with_next(docs: DataFrame, judge: Judge, schema: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and what `judge(text, next text)` says of each row of `docs`, in columns of `schema`.

    The next row is that of the next smaller key, null last, equal keys in order
    of text; the row after the last is the first. Rows are sorted over
    all tasks, and a task judges neighbours as it reads them. Only its first and
    last rows are written with their texts, and the ends of tasks meet in a
    second, small step. Null counts as empty.
    """
    shown = docs.select(quoted(key).alias("id"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    kind = shown.schema["id"].dataType.simpleString()
    down = F.desc_nulls_last("id")
    # The hash lets a range end between rows of equal keys.
    laid = shown.repartitionByRange(down, F.xxhash64("text")).sortWithinPartitions(down, F.xxhash64("text"), "text")
    said_type = to_arrow_type(StructType.fromDDL(schema))
    judged = saved(laid.mapInArrow(_neighbours(judge, said_type), f"id {kind}, said struct<{schema}>, part int, first string, last string"), "next")

    ends = judged.where(F.col("part").isNotNull())
    # A row per task, of numbers alone.
    tasks = ends.where(F.col("first").isNotNull()).select("part")
    head = tasks.agg(F.min("part")).scalar()
    following = tasks.withColumn("to", F.coalesce(F.lead("part").over(Window.orderBy("part")), head))
    firsts = ends.where(F.col("first").isNotNull()).select(F.col("part").alias("to"), F.col("first").alias("text_next"))
    lasts = ends.where(F.col("last").isNotNull()).select("id", "part", F.col("last").alias("text"))

    def late(batch: pa.RecordBatch) -> pa.RecordBatch:
        said = [judge(a, b) for a, b in zip(batch.column("text").to_pylist(), batch.column("text_next").to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column("id"), _structs(said, said_type)], ["id", "said"])

    edges = lasts.join(following, "part").join(firsts, "to").select("id", "text", "text_next")
    whole = judged.where(F.col("part").isNull()).select("id", "said").unionByName(
        edges.mapInArrow(in_slices(late), f"id {kind}, said struct<{schema}>")
    )
    return whole.select(F.col("id").alias(key), "said.*")


def _structs(said: list[tuple | None], kind: pa.DataType) -> pa.Array:
    names = [f.name for f in kind]
    return pa.array([None if s is None else dict(zip(names, s)) for s in said], kind)


def _neighbours(judge: Judge, kind: pa.DataType):
    """Judged rows, and the first and last row of the task with their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text").to_pylist()
            if not texts:
                continue
            if before is None:
                yield _rows(ids[:1], None, part, texts[0], None)
            else:
                yield _rows(before[0], [judge(before[1], texts[0])], None, None, None)
            for start in range(0, len(texts) - 1, 256):
                stop = min(start + 256, len(texts) - 1)
                yield _rows(ids[start:stop], [judge(texts[i], texts[i + 1]) for i in range(start, stop)], None, None, None)
            before = ids[len(texts) - 1 :], texts[-1]
        if before is not None:
            yield _rows(before[0], None, part, None, before[1])

    def _rows(ids: pa.Array, said: list[tuple] | None, part: int | None, first: str | None, last: str | None) -> pa.RecordBatch:
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [
                ids,
                _structs(said or [None] * n, kind),
                pa.array([part] * n, pa.int32()),
                pa.array([first] * n, pa.string()),
                pa.array([last] * n, pa.string()),
            ],
            ["id", "said", "part", "first", "last"],
        )

    return run
