"""Land new files only: the stream form of skipping what is done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def land_new_files(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    checkpoint: str,
    step: Callable[[DataFrame], DataFrame] = lambda df: df,
    file_format: str = "parquet",
) -> None:
    """Process files that no earlier call has seen, then stop.

    The checkpoint folder remembers the files, and the file sink commits each
    batch once: a run that dies midway is repeated without doubled rows. Both
    folders must be on storage that all executors share. `step` must work row
    by row.
    """
    new = spark.readStream.schema(schema).format(file_format).load(source)
    query = (
        step(new)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
