"""What several text operators share: words, scratch tables, checked broadcasts, components."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.functions.joins import rows_at_most
from tradewind.session import ensure_checkpoint_dir

# The white space that separates words: U+0020 and U+0009 to U+000D. Fixed value.
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
NOT_SPACE = r"[^\x20\x09-\x0D]"

# Rows of a key table (a few longs each, so some megabytes) that may be broadcast.
BROADCAST_KEYS = 200_000


def ship(module: str) -> None:
    """Sends a module's functions to Python workers by value, so workers need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def worker_state(name: str) -> dict:
    """A dictionary that lives as long as this Python worker, for what each task would load anew."""
    holder = sys.modules.setdefault("_tradewind_worker_state", types.ModuleType("_tradewind_worker_state"))
    return holder.__dict__.setdefault(name, {})


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of a sample table; other columns are never looked at."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def words(text: Column) -> Column:
    """Words of a text in order; a null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def once(frame: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row, whatever refers to them later.

    Projections that follow one another are merged by the optimizer, and a filter moves below
    them, so a costly array would be built again for each reference. It does not look through
    a generator: each value comes out of an array of one.
    """
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    one = frame.select("*", F.explode(F.array(packed)).alias("_once"))
    return one.select("*", *[F.col(f"_once.{n}").alias(n) for n in columns]).drop("_once")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back.

    Cuts the lineage as a reliable checkpoint does (a lost executor costs only tasks of the
    job at hand), but in columnar, compressed form.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    out = spark.read.schema(frame.schema).parquet(path)
    out._stored_at = path
    return out


def discard(frame: DataFrame) -> None:
    """Removes the files of a frame from `stored` that nothing reads any more."""
    spark = frame.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(frame._stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(frame: DataFrame, name: str) -> DataFrame:
    """Adds `number`, 0 to rows - 1, in the order of partitions and of rows within them.

    The rows are stored with their partition and their place in it, which fixes the numbers. The
    only window runs over one row per partition.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(frame.select("*", F.spark_partition_id().alias("_part"), place.alias("_place")), name)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return placed.join(small_or_shuffled(offsets), "_part").withColumn(
        "number", F.col("_offset") + F.col("_place")).drop("_part", "_place", "_offset")


def small_or_shuffled(frame: DataFrame, bound: int = BROADCAST_KEYS) -> DataFrame:
    """Marks a narrow table for broadcast if it is counted to be within the bound.

    Beyond it the join shuffles, with the same rows. Give tables that are stored already.
    """
    return F.broadcast(frame) if rows_at_most(frame, bound) else frame


def _all_stars(edges: DataFrame) -> bool:
    """True if no node of distinct edges (a, b), b < a, has two smaller ends or one and a larger one."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    between = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return between.where("up > 1 or (up = 1 and down = 1)").limit(1).count() == 0


def components(edges: DataFrame, *, rounds: int = 50) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (node, component), smallest member.

    Two alternating steps until every component is a star around its smallest member: every node
    hangs its larger neighbours, then its smaller ones, on the least node it knows. Labels reach
    over doubling distances, so the rounds grow with the logarithm of a component's diameter.
    Every step is one aggregation that combines before its shuffle and one join; the edges never
    leave the executors. Only nodes with an edge are returned. Null nodes and loops are ignored.
    """
    current = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a is not null and b is not null and a <> b").distinct(), "edges")
    for _ in range(rounds):
        if _all_stars(current):
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where("a <> b").unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        current = stored(small, "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
