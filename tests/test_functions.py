"""Building blocks: ntile, salted joins, trend, ratios, bands, checkpoint folder."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewind.functions import joins, measures, trend
from tradewind.functions.ranking import global_ntile, tile_of_rank
from tradewind.session import ensure_checkpoint_dir


def expected_tile(rank: int, total: int, tiles: int) -> int:
    sizes = [total // tiles + (1 if t < total % tiles else 0) for t in range(tiles)]
    for tile, size in enumerate(sizes, 1):
        if rank <= size:
            return tile
        rank -= size
    raise AssertionError


@pytest.mark.parametrize("total", [1, 2, 3, 4, 5, 7, 8, 103])
def test_tile_of_rank(spark, total):
    ranks = spark.range(1, total + 1).select(
        "id", tile_of_rank(F.col("id"), F.lit(total), 4).alias("tile")
    )
    assert {r["id"]: r["tile"] for r in ranks.collect()} == {
        k: expected_tile(k, total, 4) for k in range(1, total + 1)
    }


@settings(max_examples=4, deadline=None)
@given(
    values=st.lists(st.one_of(st.none(), st.integers(0, 3)), min_size=1, max_size=60),
    descending=st.booleans(),
    partitions=st.integers(1, 5),
)
def test_global_ntile_equals_window(spark, values, descending, partitions):
    frame = spark.createDataFrame(list(enumerate(values)), "id long, v int")
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    single = frame.withColumn("tile", F.ntile(4).over(Window.orderBy(order, "id")))
    spread = global_ntile(frame, F.col("v"), "id", 4, "tile", descending=descending, partitions=partitions)
    assert sorted(map(tuple, spread.select("id", "v", "tile").collect())) == sorted(map(tuple, single.collect()))


def test_global_ntile_splits_one_common_value(spark):
    """A third of the rows share one value; text ids break the tie."""
    frame = spark.range(3000).select(
        F.format_string("c%05d", "id").alias("id"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("v"),
    )
    single = frame.withColumn("t", F.ntile(4).over(Window.orderBy("v", "id")))
    spread = global_ntile(frame, F.col("v"), "id", 4, "t", partitions=6)
    assert spread.select("id", "t").exceptAll(single.select("id", "t")).isEmpty()
    assert spread.count() == 3000


@pytest.fixture(scope="module")
def hot(spark):
    """At least a third of the fact rows hold key 1; some keys are unknown or missing."""
    fact = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 7, F.lit(None)).otherwise(F.col("id") % 400)
        .alias("key"),
    )
    dimension = spark.range(350).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    return fact, dimension


@pytest.mark.parametrize("share", [0.0001, 0.01, 0.9])
def test_salted_join_equals_plain_join(hot, share):
    fact, dimension = hot
    salted = joins.salted_join(fact, dimension, "key", salt_by=["id"], hot_share=share, salts=8)
    plain = fact.join(dimension, "key")
    assert salted.select("id", "key", "name").exceptAll(plain.select("id", "key", "name")).isEmpty()
    assert salted.count() == plain.count()


def test_salted_join_spreads_the_hot_key(spark, hot):
    fact, dimension = hot
    salted = joins.salted_join(fact, dimension, "key", salt_by=["id"], hot_share=0.1, salts=8)
    by_task = salted.where("key = 1").groupBy(F.spark_partition_id()).count().count()
    assert salted.where("key = 1").count() == fact.where("key = 1").count() >= 1000
    assert by_task > 1
    assert "_salt" not in salted.columns


@pytest.mark.parametrize("bound", [10, 1000])
def test_lookup_join_both_ways(hot, bound):
    fact, dimension = hot
    found = joins.lookup_join(fact, dimension, "key", salt_by=["id"], broadcast_rows=bound)
    assert found.count() == fact.join(dimension, "key").count()


def test_ratios_are_null_safe(spark):
    row = spark.range(1).select(
        measures.pct(F.lit(1), F.lit(0)).alias("zero"),
        measures.pct(F.lit(1), F.lit(None).cast("int")).alias("missing"),
        measures.pct(F.lit(1), F.lit(8)).alias("ok"),
        measures.ratio(F.lit(1), F.lit(4)).alias("r"),
    ).first()
    assert (row["zero"], row["missing"], row["ok"], row["r"]) == (None, None, 12.5, 0.25)


def test_months(spark):
    dates = ["2000-12-31", "2001-01-01", "1999-02-03"]
    frame = spark.createDataFrame([(d,) for d in dates], "d string").select(F.col("d").cast("date"))
    back = frame.select(
        F.date_format(measures.month_start(F.col("d")), "yyyy-MM-dd").alias("a"),
        F.date_format(measures.month_from_number(measures.month_number(F.col("d"))), "yyyy-MM-dd").alias("b"),
    )
    assert [(r["a"], r["b"]) for r in back.collect()] == [
        ("2000-12-01",) * 2, ("2001-01-01",) * 2, ("1999-02-01",) * 2,
    ]


def test_not_blank(spark):
    frame = spark.createDataFrame([("a",), (" ",), ("",), (None,)], "k string")
    assert [r[0] for r in frame.select(measures.not_blank(F.col("k"))).collect()] == [True, False, False, False]


def series(spark, rows):
    return spark.createDataFrame(rows, "key string, m string, y double").select(
        "key", F.col("m").cast("date").alias("m"), "y"
    )


def test_trend_per_series(spark):
    frame = series(spark, [
        ("line", "2001-11-01", 10.0), ("line", "2001-12-01", 12.0), ("line", "2002-01-01", 14.0),
        ("short", "2001-01-01", 1.0), ("short", "2001-02-01", 3.0),
        ("noisy", "2001-01-01", 1.0), ("noisy", "2001-02-01", 5.0), ("noisy", "2001-03-01", 2.0),
    ])
    found = {
        (r["key"], str(r["month"])): r
        for r in trend.forecast_months(frame, ["key"], "m", "y", 2).collect()
    }
    assert len(found) == 6
    line = found["line", "2002-02-01"]
    assert line["forecast"] == pytest.approx(16.0) and line["lower"] == pytest.approx(16.0)
    short = found["short", "2001-03-01"]
    assert short["forecast"] == pytest.approx(5.0) and short["lower"] is None
    noisy = found["noisy", "2001-04-01"]
    assert noisy["lower"] < noisy["forecast"] < noisy["upper"]
    # By hand: mean 8/3, slope 0.5, SSE = 8.667 - 0.5 = 8.1667, n = 3, Sxx = 2, offset 2.
    half = 1.96 * math.sqrt(8.166666667) * math.sqrt(1 + 1 / 3 + 4 / 2)
    assert noisy["upper"] - noisy["forecast"] == pytest.approx(half)


def test_trend_gaps(spark):
    frame = series(spark, [("a", "2001-01-01", 3.0), ("a", "2001-02-01", 3.0), ("a", "2001-04-01", 3.0)])
    skipped = trend.forecast_months(frame, ["key"], "m", "y", 1).first()
    filled = trend.forecast_months(frame, ["key"], "m", "y", 1, fill="zero").first()
    assert skipped["forecast"] == pytest.approx(3.0)
    assert filled["forecast"] == pytest.approx(2.25 - 0.3 * 2.5)
    with pytest.raises(ValueError):
        trend.forecast_months(frame, ["key"], "m", "y", 1, fill="mean")


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    found = ensure_checkpoint_dir(spark)
    assert found
    if configured:
        assert configured.rstrip("/") in found


def test_sized_join_takes_as_many_parts_as_the_rows_need(spark):
    fact = spark.range(1000).select((F.col("id") % 100).alias("k"), "id")
    dimension = spark.range(90).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = joins.sized_join(fact, dimension, "k", rows=1000)
    sized = joins.sized_join(fact, dimension.hint("merge"), "k", rows=1000, part_rows=50)
    assert sized.rdd.getNumPartitions() == 20 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, sized.collect())) == sorted(map(tuple, small.collect()))
    assert sized.count() == 900
