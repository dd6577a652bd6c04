"""Raw files loaded by a ledger of their path, length and time, columns by each file's own header."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.schema import SOURCES
from tradewind.sources.layers import read_history
from tradewind.sources.raw import raw_path

LEDGER = "file string, path string, length bigint, modified bigint, load bigint"
# What to do with a file that differs from what was loaded under its name.
CHANGED = ("refuse", "reload")
HEADER_READERS = 16


class ChangedFiles(RuntimeError):
    """Files that were loaded before now have another length or time."""


def present_files(spark: SparkSession, source: str) -> DataFrame:
    """(file, path, length, modified) of the files below a folder, empty ones left out; no content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    return listed.select(
        F.col("_metadata.file_path").alias("file"), "path", "length", F.unix_micros("modificationTime").alias("modified"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One row per file and load; empty before the first load."""
    return read_history(spark, ledger, LEDGER)


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names in a file's first line, which may be compressed; none for an empty file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        content = stream if codec is None else codec.createInputStream(stream)
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([line.removeprefix("\ufeff")]), ())) if line else ()


def by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Paths grouped by their header. One line of each new file is read, by the driver that lists them."""
    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_READERS) as readers:
        for path, header in zip(paths, readers.map(lambda p: header_of(spark, p), paths)):
            found.setdefault(header, []).append(path)
    return found


def read_by_header(spark: SparkSession, table: str, paths: Sequence[str]) -> DataFrame:
    """The rows of CSV files as the raw table, with `_file`; each file's columns go by name.

    Columns may stand in any order and more may be there. A file without one of the table's
    columns, or with one twice, fails the load; empty files have no rows.
    """
    names = [f.name for f in SOURCES[table].fields]
    frame = spark.createDataFrame([], SOURCES[table].raw_schema().add("_file", T.StringType()))
    for header, files in by_header(spark, paths).items():
        if not header:
            continue
        wrong = [n for n in names if header.count(n) != 1]
        if wrong:
            raise ValueError(f"{files[0]} must have each of the columns {wrong} of {table} once")
        # Other columns are only counted off, so their names may repeat.
        schema = T.StructType([
            T.StructField(n if n in names else f"_other{i}", T.StringType()) for i, n in enumerate(header)])
        rows = spark.read.schema(schema).option("header", True).csv(files)
        frame = frame.unionByName(rows.select(*names, F.col("_metadata.file_path").alias("_file")))
    return frame


def loaded_rows(spark: SparkSession, table: str, target: str, ledger: str) -> DataFrame:
    """The raw table: the rows of the last load of each file in the ledger.

    Rows of a load that is not in the ledger, since it died, are not seen.
    """
    schema = SOURCES[table].raw_schema().add("_file", T.StringType()).add("load", T.LongType())
    rows = read_history(spark, target, schema)
    loads = read_ledger(spark, ledger)
    state = loads.agg(F.max("load").alias("last"), F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files")).first()
    rows = rows.where(F.col("load") <= F.lit(state["last"] or 0))
    if state["n"] > state["files"]:
        newest = loads.groupBy("file").agg(F.max("load").alias("_last"))
        old = loads.join(newest, "file").where("load < _last").select(F.col("file").alias("_file"), "load")
        rows = rows.join(old, ["_file", "load"], "left_anti")
    return rows.select(*[f.name for f in SOURCES[table].fields])


def load_new_files(
    spark: SparkSession, table: str, source: str, target: str, ledger: str, *, changed: str = "refuse"
) -> DataFrame:
    """Loads the files that the ledger does not hold and returns the raw table.

    Files are known by path, length and modification time. A changed file is refused before
    anything is written, or with `changed="reload"` loaded again, and its former rows are no
    longer part of the table. The rows of a load are written first and its ledger entry last:
    a load that dies in between is invisible and done again under the same number. Files that
    were removed stay loaded. One loader for a table at a time.
    """
    if changed not in CHANGED:
        raise ValueError(f"changed must be one of {', '.join(CHANGED)}, not {changed!r}")
    known = read_ledger(spark, ledger)
    newest = known.groupBy("file").agg(F.max_by(F.struct("length", "modified"), "load").alias("_before"))
    unseen = present_files(spark, source).join(newest, "file", "left").where(
        ~F.struct("length", "modified").eqNullSafe(F.col("_before")))
    fresh = unseen.orderBy("path").collect()
    again = [r["path"] for r in fresh if r["_before"] is not None]
    if again and changed == "refuse":
        raise ChangedFiles(f"{len(again)} loaded files have changed, such as {again[0]}")
    if fresh:
        load = (known.agg(F.max("load")).first()[0] or 0) + 1
        read_by_header(spark, table, [r["path"] for r in fresh]).write.mode("overwrite").parquet(f"{target}/load={load}")
        entries = spark.createDataFrame(
            [(r["file"], r["path"], r["length"], r["modified"]) for r in fresh], LEDGER.rpartition(",")[0])
        entries.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/load={load}")
    return loaded_rows(spark, table, target, ledger)


def load_all_new_files(
    spark: SparkSession, root: str, target: str, ledgers: str, tables: Iterable[str] | None = None, *, changed: str = "refuse"
) -> dict[str, DataFrame]:
    """`load_new_files` for every raw table below one folder."""
    return {
        t: load_new_files(
            spark, t, raw_path(root, SOURCES[t]), f"{target.rstrip('/')}/{t}", f"{ledgers.rstrip('/')}/{t}", changed=changed)
        for t in (SOURCES if tables is None else tables)
    }
