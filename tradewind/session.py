"""Session settings the operators are written for, and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Spark's own defaults stay in force for everything not listed here.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot key of a sort-merge join even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "tradewind", master: str | None = None, **extra: str) -> SparkSession:
    """A session with SETTINGS; `master` is left to spark-submit when not given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Taken from the context or from `spark.checkpoint.dir`. Only a local master may
    fall back to a temporary folder: on a cluster that folder would be lost with
    its executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tradewind-checkpoint-")
    context.setCheckpointDir(configured)
    return configured
