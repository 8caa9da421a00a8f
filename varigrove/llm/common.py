"""Small helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varigrove.session import ensure_checkpoint_dir

#: Rows that a Python task holds as objects at once; Arrow batches are cut to it.
PYTHON_ROWS = 512

#: What a Python worker keeps of one operator and the tasks of others drop: memory, not results, depends on it.
KEPT: list[dict] = []

#: Characters counted as white space by the contracts.
BLANK = r"[\x20\x09-\x0D]"

#: Bytes of a lower-cased UTF-8 text that are not 0-9, a-z or above ASCII become a blank.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text whose A-Z are lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder in the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again: its lineage ends there."""
    folder = scratch(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def free_name(taken: Iterable[str], wish: str) -> str:
    """`wish`, with underscores in front until no column is called so (in any case)."""
    names = {n.lower() for n in taken}
    while wish.lower() in names:
        wish = "_" + wish
    return wish


def row_key(df: DataFrame) -> Column:
    """128 bits of all columns but maps: equal rows have equal keys, null differs from empty."""
    parts: list[Column] = []
    for f in df.schema.fields:
        if "map<" not in f.dataType.simpleString():
            parts += [F.col(f"`{f.name}`"), F.col(f"`{f.name}`").isNull()]
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"))


def trim() -> None:
    """Memory that is free in this Python worker goes back to the system: workers wait beside others, for further tasks."""
    pa.default_memory_pool().release_unused()
    if release := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        release(0)


def give_back() -> None:
    """For the end of a task: what other operators keep in this worker is dropped, and free memory given back."""
    for known in KEPT:
        known.clear()
    trim()


@contextmanager
def short_batches(spark: SparkSession, rows: int = PYTHON_ROWS) -> Iterator[None]:
    """Arrow batches of at most `rows` rows for what the session runs inside; executor and Python worker both hold a batch whole."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def in_slices(
    convert: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = PYTHON_ROWS
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for `mapInArrow` that converts at most `rows` rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield convert(batch.slice(start, rows))
        batch = None
        give_back()

    return run


def joined_spans(spans: Sequence[tuple[int, str, int, int]]) -> str:
    """`kind:start:end`, comma-joined, of (start, kind, rank, end) in order of start, rank and end."""
    return ",".join(f"{k}:{s}:{e}" for s, k, _, e in sorted(spans, key=lambda x: (x[0], x[2], x[3])))


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def compiled(pattern: str, flags: int = 0) -> re.Pattern[str]:
    return re.compile(pattern, flags)
