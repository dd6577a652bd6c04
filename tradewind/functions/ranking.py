"""Exact ntile over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import ensure_checkpoint_dir


def global_ntile(
    frame: DataFrame,
    value: Column,
    tie_break: str,
    tiles: int,
    name: str,
    *,
    descending: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Adds `name`: the tile (1..tiles) of each row by (value, tie_break), as `ntile` gives it.

    `ntile` over an unpartitioned window sorts the table in one task. Here the rows are
    range-partitioned on (value, tie_break), so one very common value still splits over
    several partitions by the tie-break. The partition number is checkpointed, which
    fixes it against re-planning and lost executors; each row's rank is then its
    position within its partition plus the rows in earlier partitions. The table of
    those offsets has one row per partition and is broadcast.
    """
    spark = frame.sparkSession
    ensure_checkpoint_dir(spark)
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    order_value = F.col("_value").desc_nulls_last() if descending else F.col("_value").asc_nulls_first()
    order = [order_value, F.col(tie_break).asc()]
    placed = (
        frame.withColumn("_value", value)
        .repartitionByRange(count, *order)
        .withColumn("_part", F.spark_partition_id())
        .checkpoint()
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # At most `count` rows, so these two windows are small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_offset")
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, tile_of_rank(rank, F.col("_total"), tiles))
        .drop("_part", "_offset", "_total", "_value")
    )


def tile_of_rank(rank: Column, total: Column, tiles: int) -> Column:
    """Tile of a 1-based rank: the first total % tiles tiles hold one row more."""
    short = F.floor(total / tiles)
    longer = total % tiles
    in_longer = longer * (short + 1)
    return (
        F.when(rank <= in_longer, F.ceil(rank / (short + 1)))
        .otherwise(longer + F.ceil((rank - in_longer) / F.greatest(short, F.lit(1))))
        .cast("int")
    )
