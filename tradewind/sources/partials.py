"""Partial aggregates on storage: one folder per load, next to the derived tables.

A load that is repeated after a failure has the same number and replaces what it left, so that
every row counts once. Keys of distinct counts are kept by their first key column, and a load
reads only the range of it that its own rows fall into.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.rollups import Rollup, counted, keyed_values, partial, together, unseen
from tradewind.sources.layers import table_path


def _loads(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_partials(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Partials of all loads, with the number of the load as `load`."""
    return spark.read.parquet(table_path(root, "partials", name))


def add_load(rows: DataFrame, root: str, name: str, rollup: Rollup, load: int) -> None:
    """Stores the partials of one load's typed rows."""
    spark = rows.sparkSession
    parts = [partial(rows, rollup)]
    for count, column in rollup.distinct.items():
        path = table_path(root, "partials", f"{name}-{count}-keys")
        keys = keyed_values(rows, rollup, column).distinct()
        first = rollup.key_names()[0]
        seen = _loads(spark, path)
        if seen is not None:
            low, high = keys.agg(F.min(first), F.max(first)).first()
            near = F.col(first).isNull() | F.col(first).between(F.lit(low), F.lit(high))
            keys = unseen(keys, seen.where((F.col("load") < load) & near).drop("load"), rollup)
        made = f"{path}/load={load:08d}"
        # `first` is also a folder name below, so that ranges of it are found without reading.
        keys.write.mode("overwrite").partitionBy(first).parquet(made)
        stored = spark.read.schema(keys.schema).parquet(made)
        parts.append(counted(stored, rollup, count))
    together(parts).write.mode("overwrite").parquet(f"{table_path(root, 'partials', name)}/load={load:08d}")
