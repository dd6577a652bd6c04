"""Derived tables on storage: full replacement per run, and the appended metric history."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tradewind.operators.metrics import HISTORY_SCHEMA

VERSION = re.compile(r"v\d{8,}")


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str, bool]]:
    """(number, folder, complete) of a table's versions in order; Spark marks a complete write."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    return sorted(
        (int(n[1:]), f"{path}/{n}", files.exists(hadoop.Path(f"{path}/{n}/_SUCCESS")))
        for n in names if VERSION.fullmatch(n)
    )


def current_path(spark: SparkSession, root: str, layer: str, table: str) -> str:
    """The folder of the table's newest complete version; the table's own if it has no versions."""
    path = table_path(root, layer, table)
    complete = [folder for _, folder, done in _versions(spark, path) if done]
    return complete[-1] if complete else path


def write_table(frame: DataFrame, root: str, layer: str, table: str) -> DataFrame:
    """Replaces the table with the frame and returns the stored table.

    The rows go to a new version folder, which readers take once Spark has marked it complete. A
    write that fails leaves the table as it was, and a frame may read the table it replaces. The
    version before stays for those who still read it; older ones and failed ones are removed
    after success. Reading back cuts the lineage at files every executor can reach. One writer
    for a table at a time: a second one fails on the folder that the first has made.
    """
    spark, path = frame.sparkSession, table_path(root, layer, table)
    before = _versions(spark, path)
    made = f"{path}/v{before[-1][0] + 1 if before else 1:08d}"
    frame.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(made)
    kept = [folder for _, folder, done in before if done][-1:]
    hadoop = spark._jvm.org.apache.hadoop.fs
    for _, folder, _ in before:
        if folder not in kept:
            old = hadoop.Path(folder)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return spark.read.schema(frame.schema).parquet(made)


def write_layer(tables: Mapping[str, DataFrame], root: str, layer: str) -> dict[str, DataFrame]:
    """Replaces each table of a layer."""
    return {name: write_table(frame, root, layer, name) for name, frame in tables.items()}


def read_table(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, root, layer, table))


def metrics_append(rows: DataFrame, path: str) -> None:
    """Adds metric rows to the history, one partition per run; a run stored before is replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def read_history(spark: SparkSession, path: str, schema: StructType | str = HISTORY_SCHEMA) -> DataFrame:
    """The metric history, or another one by its schema; empty if no run has been recorded yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
