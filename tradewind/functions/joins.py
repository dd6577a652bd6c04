"""Attribute lookups from a fact to a dimension that stay safe under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import ensure_checkpoint_dir

BROADCAST_ROWS = 200_000
# Rows of one key that one task of a shuffled lookup joins.
TASK_ROWS = 1_000_000
# Rows of a fact that one task of a sized join sorts.
PART_ROWS = 500_000
HOT_SHARE = 0.001
SALTS = 64


def rows_at_most(frame: DataFrame, bound: int) -> bool:
    """Checks the size of a frame without counting past the bound."""
    return frame.limit(bound + 1).count() <= bound


def lookup_join(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    *,
    salt_by: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner join fact to dimension on `key`.

    A dimension checked to hold at most `broadcast_rows` rows is broadcast, so the
    fact is not shuffled at all. A larger one is joined by shuffle, with the fact's
    hot keys spread as planned over `salt_by`. Give the dimension only with the columns needed.
    """
    if rows_at_most(dimension, broadcast_rows):
        return fact.join(F.broadcast(dimension), key)
    return planned_join(fact, dimension, key, salt_by=salt_by)


def skew_plan(fact: DataFrame, key: str, *, task_rows: int = TASK_ROWS, most: int = BROADCAST_ROWS) -> DataFrame:
    """(key, salts): tasks that each key with more than `task_rows` rows is to be spread over.

    One pass over the key column, combined map-side. The plan is stored, and thinned to keys of
    twice as many rows (four times, ...) until it has at most `most` rows.
    """
    ensure_checkpoint_dir(fact.sparkSession)
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > task_rows).checkpoint()
    while not rows_at_most(hot, most):
        task_rows *= 2
        hot = hot.where(F.col("_n") > task_rows)
    return hot.select(key, F.ceil(F.col("_n") / task_rows).cast("int").alias("salts"))


def planned_join(
    fact: DataFrame, dimension: DataFrame, key: str, *, salt_by: Sequence[str], task_rows: int = TASK_ROWS
) -> DataFrame:
    """Inner join by shuffle in which no task gets many more than `task_rows` rows of one key.

    A key is spread over as many tasks as its rows need, whatever its share of the fact, and the
    dimension repeats its row as often. The salt is a hash of `salt_by`, hence the same on a
    task retry; rows that are equal in it stay together. Rows without a key match nothing and go
    before the shuffle.
    """
    plan = F.broadcast(skew_plan(fact, key, task_rows=task_rows))
    salts = F.coalesce("salts", F.lit(1))
    spread = fact.where(F.col(key).isNotNull()).join(plan, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*salt_by), salts).cast("int")).drop("salts")
    copies = dimension.join(plan, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return spread.join(copies, [key, "_salt"]).drop("_salt")


def sized_join(fact: DataFrame, dimension: DataFrame, key: str, *, rows: int, part_rows: int = PART_ROWS) -> DataFrame:
    """Inner join by shuffle in which a task sorts about `part_rows` rows of the fact, however many it has.

    `rows` is the size of the fact. The session's number of shuffle partitions stays the same for larger
    inputs, and adaptive execution only joins partitions up, so a task's memory would grow with the fact. Facts
    that the cores at hand hold in parts of this size are joined as Spark sees fit.
    """
    parts = -(-rows // part_rows)
    if parts <= fact.sparkSession.sparkContext.defaultParallelism:
        return fact.join(dimension, key)
    return fact.repartition(parts, key).join(dimension.repartition(parts, key), key)


def salted_join(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    *,
    salt_by: Sequence[str],
    hot_share: float = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    """Inner join by shuffle in which each hot key of the fact is spread over `salts` tasks.

    Hot keys are those with more than `hot_share` of the fact's rows, so at most
    1 / hot_share of them exist: that bounds the broadcast list and the rows the
    dimension repeats. The salt is a hash of `salt_by`, hence the same on a task retry.
    """
    per_key = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = fact.agg(F.count(F.lit(1))).scalar()
    hot = per_key.where(F.col("_n") > total * F.lit(hot_share)).select(key, F.lit(True).alias("_hot"))
    is_hot = F.coalesce(F.col("_hot"), F.lit(False))

    salted_fact = fact.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")).otherwise(0)
    )
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_dimension = dimension.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.explode(copies)
    )
    return salted_fact.drop("_hot").join(salted_dimension.drop("_hot"), [key, "_salt"]).drop("_salt")
