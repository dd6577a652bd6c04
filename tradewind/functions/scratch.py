"""Frames written once to the shared scratch folder, for work that reads them several times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tradewind.session import ensure_checkpoint_dir


def written_once(frame: DataFrame, name: str) -> DataFrame:
    """The frame as files below the checkpoint folder: joins behind it run once, readers take single columns.

    Like a reliable checkpoint it stays there until the folder goes; unlike one it is columnar and compressed.
    """
    spark = frame.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
