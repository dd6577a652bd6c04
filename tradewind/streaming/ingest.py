"""Incremental ingest: each raw file is loaded once, however often the load runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tradewind.schema import SOURCES
from tradewind.sources.raw import raw_path


def ingest_new_files(spark: SparkSession, table: str, source: str, target: str, checkpoint: str) -> DataFrame:
    """Appends the rows of files not loaded before to `target` (parquet) and returns the table.

    A stream with an available-now trigger: it takes the files present, records them in the
    checkpoint together with the files it wrote, and stops. A run that dies is resumed
    without loss or duplicates. Files are known by path: a changed file of the same name is
    not loaded again, so new data must come in new files.

    A stream has to know its columns beforehand; each file's header is checked against
    them and a file with other columns, or another order, fails the load.
    """
    stream = (
        spark.readStream.schema(SOURCES[table].raw_schema())
        .option("header", True)
        .option("enforceSchema", False)
        .csv(source)
    )
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(SOURCES[table].raw_schema()).parquet(target)


def ingest_all_new_files(
    spark: SparkSession, root: str, target: str, checkpoints: str, tables: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """Incremental ingest of every raw table below one folder."""
    wanted = SOURCES if tables is None else tables
    return {
        t: ingest_new_files(
            spark, t, raw_path(root, SOURCES[t]), f"{target.rstrip('/')}/{t}",
            f"{checkpoints.rstrip('/')}/{t}",
        )
        for t in wanted
    }
