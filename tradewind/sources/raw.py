"""Raw CSV files as all-string tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tradewind.schema import SOURCES, Source


def read_raw(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The CSV files under `path` as the raw table, every column a string.

    Columns are matched by the header, whatever their order. The header of each file is
    checked while reading, so files that disagree fail instead of shifting columns.
    """
    source = SOURCES[table]
    # No schema inference: this reads one header line, and makes every column a string.
    frame = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    absent = [f.name for f in source.fields if f.name not in frame.columns]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent} of {table}")
    return frame.select(*[f.name for f in source.fields])


def raw_path(root: str, source: Source) -> str:
    """Folder of one source: <root>/<table>/ with any number of CSV files."""
    return f"{root.rstrip('/')}/{source.raw}"


def read_all_raw(
    spark: SparkSession, root: str, tables: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """All raw tables below one folder."""
    wanted = SOURCES if tables is None else tables
    return {t: read_raw(spark, t, raw_path(root, SOURCES[t])) for t in wanted}
