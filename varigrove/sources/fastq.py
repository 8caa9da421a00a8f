"""FASTQ files as rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varigrove.functions import names as N

_LINES = "path string, read_no long, name string, seq string, qual string"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold lines into records of four; a new path starts a new file.

    Lines of one file come in order and in one task, over many batches. At
    most three lines wait between batches.
    """
    path, number, held = None, 0, None
    for batch in batches:
        for at, lines in _runs(batch):
            if at != path:
                if held is not None and len(held):
                    raise ValueError(f"{path}: ends inside a record")
                path, number, held = at, 0, lines[:0]
            lines = pa.concat_arrays([held, lines])
            n = len(lines) // 4
            held = pa.concat_arrays([lines[n * 4 :]])
            if n:
                yield _folded(path, number, lines[: n * 4])
            number += n
    if held is not None and len(held):
        raise ValueError(f"{path}: ends inside a record")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """The stretches of a batch that come from one file."""
    paths = pc.run_end_encode(batch.column(0))
    start = 0
    for path, stop in zip(paths.values.to_pylist(), paths.run_ends.to_pylist()):
        yield path, batch.column(1)[start:stop]
        start = stop


def _folded(path: str, number: int, lines: pa.Array) -> pa.RecordBatch:
    head, seq, plus, qual = (lines.take(pa.array(np.arange(i, len(lines), 4))) for i in range(4))
    starts = pc.and_(pc.starts_with(head, "@"), pc.starts_with(plus, "+"))
    names = pc.utf8_ltrim_whitespace(pc.utf8_slice_codeunits(head, 1))
    fine = pc.and_(pc.and_(starts, pc.equal(pc.utf8_length(seq), pc.utf8_length(qual))), pc.not_equal(names, ""))
    if not pc.all(fine).as_py():
        raise ValueError(f"{path}: record {number + pc.index(fine, False).as_py()} is not FASTQ")
    name = pc.list_element(pc.utf8_split_whitespace(names, max_splits=1), 0)
    count = len(head)
    columns = [pa.repeat(pa.scalar(path), count), pa.array(np.arange(number, number + count)), name, seq, qual]
    return pa.RecordBatch.from_arrays(columns, names=["path", "read_no", "name", "seq", "qual"])


def read_fastq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """`file, base, sample, mate, read_no, read_id, seq, qual` of gzipped FASTQ files.

    Spark reads and unzips the lines. A gzip file is never split, so a task
    sees whole files; land the result as Parquet to spread one large file over
    many tasks for the steps that follow.
    """
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    plain = [p for p in lines.inputFiles() if not p.endswith(".gz")]
    if plain:
        raise ValueError(f"only gzip files keep a record in one task: {plain[0]}")
    found = lines.mapInArrow(_records, _LINES)
    base = N.fastq_base(F.col("path"))
    # The two mates of a pair share a name up to an optional /1 or /2.
    read_id = F.regexp_replace("name", "/[12]$", "")
    return found.select(
        F.col("path").alias("file"),
        base.alias("base"),
        N.sample_name(base).alias("sample"),
        N.mate_number(F.col("path")).alias("mate"),
        "read_no",
        read_id.alias("read_id"),
        "seq",
        "qual",
    )


def land_reads(reads: DataFrame, path: str, files: int | None = None) -> None:
    """Parquet, spread by read name so that no sample ends up in one task."""
    parts = ["sample", "read_id"]
    spread = reads.repartition(files, *parts) if files else reads.repartition(*parts)
    spread.write.mode("overwrite").parquet(path)
