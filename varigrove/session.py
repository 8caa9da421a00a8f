"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sides are measured after their shuffle, so a larger one may still be broadcast.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "128m",
    # Split a skewed join partition even where an aggregate follows on the
    # same key; the extra shuffle is cheaper than one straggler.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Many steps turn a row into hundreds, so a small shuffle must not end in
    # one task. Large shuffles are cut by parallelism and do not notice.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(master: str | None = None, app: str = "varigrove", **conf: str) -> SparkSession:
    """A session with the defaults above; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in `spark.checkpoint.dir`.

    Only a local master may fall back to a scratch folder of its own: on a
    cluster a machine-local folder is lost with its executor.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return
    if sc.getCheckpointDir() is not None:
        return
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="varigrove-checkpoint-"))
