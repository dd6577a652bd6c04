"""Incremental refresh, distributed selection, planned joins and alerts over several runs."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from check import differences
from test_plans import plan
from tradewind.functions import joins
from tradewind.functions.selection import Tile, keys_at, tile_ends, with_tiles
from tradewind.operators import patterns, rollups
from tradewind.operators.metrics import Alert, freshness
from tradewind.plans import gold
from tradewind.plans.pipeline import Pipeline
from tradewind.plans.refresh import refresh
from tradewind.plans.sample_star import SampleStar
from tradewind.schema import SOURCES
from tradewind.sources.partials import add_load, read_partials

AS_OF = "2001-08-01"


# -- refresh -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def raw(spark, sample):
    """Raw tables of the sample, with small numbers in the declared columns that it lacks."""
    found, small = SampleStar(spark, sample).raw(), {}
    for t, s in SOURCES.items():
        number = F.pmod(F.xxhash64(s.key), F.lit(3)).cast("string")
        small[t] = found[t].select(*[F.col(f.name) if f.name in found[t].columns else number.alias(f.name) for f in s.fields])
    return small


def write_half(raw, root, half):
    for table, frame in raw.items():
        mine = F.pmod(F.xxhash64(*frame.columns), F.lit(2)) if table != "products" else F.lit(0)
        part = frame.where(mine == half)
        part.write.mode("append").option("header", True).csv(f"{root}/raw/{table}")


@pytest.fixture(scope="module")
def refreshed(spark, raw, tmp_path_factory):
    root = tmp_path_factory.mktemp("refresh")
    pipeline = Pipeline(spark, f"{root}/raw", f"{root}/out", F.lit(AS_OF).cast("date"))
    counts = []
    for half in (0, 1):
        write_half(raw, root, half)
        made = refresh(pipeline)
        counts.append(dict(pipeline.loaded))
    return pipeline, made, counts, root


def test_two_loads_give_the_rows_of_a_rebuild(spark, raw, refreshed):
    pipeline, made, _, _ = refreshed
    star = {s.typed: spark.read.parquet(f"{pipeline.out_root}/bronze/{t}") for t, s in SOURCES.items()}
    from tradewind.operators.conform import conform

    star = {s.typed: conform(t, star[s.typed], pipeline.as_of) for t, s in SOURCES.items()}
    whole = gold.context(star, pipeline.as_of)
    assert set(made) == set(rollups.ROLLUPS)
    for name, frame in made.items():
        expected = whole.table(name)
        assert frame.columns == expected.columns
        rows = [tuple(r) for r in frame.collect()]
        assert rows and differences(
            frame.columns, rows, expected.columns, [tuple(r) for r in expected.collect()]) is None, name


def test_the_second_refresh_reads_new_rows_only(raw, refreshed):
    _, _, (first, second), _ = refreshed
    for fact in {r.fact for r in rollups.ROLLUPS.values()}:
        table = next(t for t, s in SOURCES.items() if s.typed == fact)
        assert first[fact] + second[fact] == raw[table].count() and min(first[fact], second[fact]) > 0


def test_derived_tables_read_partials_alone(spark, refreshed):
    pipeline, _, _, _ = refreshed
    for name, rollup in rollups.ROLLUPS.items():
        merged = rollups.merge(read_partials(spark, pipeline.out_root, name), rollup)
        assert all("/partials/" in f for f in merged.inputFiles())


def test_a_refresh_without_new_files_changes_nothing(refreshed):
    pipeline, made, _, _ = refreshed
    before = {n: sorted(map(str, f.collect())) for n, f in made.items()}
    again = refresh(pipeline)
    assert set(pipeline.loaded.values()) == {0}
    assert {n: sorted(map(str, f.collect())) for n, f in again.items()} == before


def test_a_repeated_load_counts_once(spark, tmp_path):
    """A load that failed half-way is run again under its number; keys of it are first seen again."""
    rollup, root = rollups.ROLLUPS["revenue_trends"], str(tmp_path)
    schema = "order_id string, customer_id string, order_date date, order_status string, final_amount double"

    def load(*rows):
        return spark.createDataFrame([(o, c, None, "Delivered", 1.0) for o, c in rows], schema).withColumn(
            "order_date", F.lit("2001-03-04").cast("date"))

    add_load(load(("o1", "c1"), ("o2", "c1")), root, "t", rollup, 0)
    for _ in range(2):
        add_load(load(("o2", "c1"), ("o3", "c2"), ("o4", None)), root, "t", rollup, 1)
    row, = rollups.finished(read_partials(spark, root, "t"), rollup).collect()
    assert (row.orders, row.unique_customers, row.revenue, row.delivered_orders) == (4, 2, 5.0, 5)


@pytest.mark.parametrize("name", sorted(rollups.ROLLUPS))
def test_partials_of_any_split_add_up(star, name):
    rollup = rollups.ROLLUPS[name]
    fact = star[rollup.fact]
    found = []
    for loads in (1, 4):
        by = F.pmod(F.xxhash64(*fact.columns), F.lit(loads))
        frame = rollups.finished(rollups.partials_of_loads(fact, rollup, by), rollup, star=star)
        found.append((frame.columns, [tuple(r) for r in frame.collect()]))
    assert differences(*found[0], *found[1]) is None


# -- selection ---------------------------------------------------------------------------------


@settings(max_examples=8, deadline=None)
@given(
    values=st.lists(st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5, -3.0, float("nan")])), min_size=1, max_size=40),
    descending=st.booleans(), tiles=st.integers(2, 5))
def test_tiles_equal_ntile(spark, values, descending, tiles):
    frame = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    single = frame.select("id", F.ntile(tiles).over(Window.orderBy(order, "id")).alias("t"))
    spread = with_tiles(frame, "id", tiles, [Tile("v", "t", descending)], sample=7).select("id", "t")
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, single.collect()))


@pytest.mark.parametrize("descending", [False, True])
def test_selection_narrows_under_a_common_value(spark, descending):
    """Two thirds of 30,000 rows share a value; brackets close on text ids."""
    frame = spark.range(30_000).select(
        F.concat(F.lit("é"), F.format_string("%05d", F.pmod(F.xxhash64("id"), F.lit(10 ** 9)))).alias("h"), "id",
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 1000).cast("int").alias("v"),
    ).select(F.concat_ws("-", "h", "id").alias("id"), "v")
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    single = frame.select("id", F.ntile(4).over(Window.orderBy(order, "id")).alias("t"))
    spread = with_tiles(frame, "id", 4, [Tile("v", "t", descending)], sample=400).select("id", "t")
    assert spread.exceptAll(single).isEmpty() and spread.count() == 30_000


def test_borders_of_small_tables(spark):
    assert [tile_ends(n, 4) for n in (0, 1, 2, 7, 8)] == [[0, 0, 0], [1, 1, 1], [1, 2, 2], [2, 4, 6], [2, 4, 6]]
    empty = with_tiles(spark.createDataFrame([], "id long, v int"), "id", 4, [Tile("v", "t")])
    assert empty.columns == ["id", "v", "t"] and empty.count() == 0
    frame = spark.range(100).select(F.col("id"), F.col("id").alias("v"))
    found = keys_at(frame, Tile("v", "t").key("id"), [1, 50, 100], 100, sample=9)
    assert [frame.where(Tile("v", "t").key("id") <= found[r]).count() for r in (1, 50, 100)] == [1, 50, 100]


def test_rfm_scores_neither_sort_nor_shuffle_the_customers(star, as_of):
    text = plan(patterns.rfm_scores(star["fact_orders"], as_of))
    tree = text.split("\n\n")[0]
    assert "Window" not in tree and "Exchange" not in tree and "Sort" not in tree


# -- planned joins -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    fact = spark.range(6000).select(
        "id", F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 50 == 7, F.lit(None)).otherwise(F.col("id") % 300).alias("key"))
    return fact, spark.range(250).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.mark.parametrize("task_rows", [1, 100, 10_000])
def test_planned_join_equals_plain_join(skewed, task_rows):
    fact, dimension = skewed
    found = joins.planned_join(fact, dimension, "key", salt_by=["id"], task_rows=task_rows).select("id", "key", "name")
    expected = fact.join(dimension, "key").select("id", "key", "name")
    assert found.exceptAll(expected).isEmpty() and found.count() == expected.count()


def test_no_task_gets_many_more_rows_than_planned(spark, skewed):
    fact, dimension = skewed
    plan_rows = {r.key: r.salts for r in joins.skew_plan(fact, "key", task_rows=200).collect()}
    assert plan_rows == {1: 16}
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        found = joins.planned_join(fact, dimension, "key", salt_by=["id"], task_rows=200)
        per_task = [r["count"] for r in found.where("key = 1").groupBy(F.spark_partition_id().alias("p"), "key").count().collect()]
        assert sum(per_task) > 3000 and max(r for r in per_task) <= 3 * 200
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_plan_with_too_many_keys_is_thinned(skewed):
    fact, _ = skewed
    assert joins.skew_plan(fact, "key", task_rows=2, most=5).count() <= 5
    assert joins.skew_plan(fact, "key", task_rows=2).count() > 100


# -- alerts ------------------------------------------------------------------------------------


def test_alerts_over_three_runs(spark, refreshed):
    pipeline, _, _, _ = refreshed
    latest = pipeline.load_times().agg(F.max("loaded_at")).first()[0]
    seen = []
    for run, hours in (("r1", 1), ("r2", 40), ("r3", 2), ("r3", 2)):
        pipeline.now = F.lit(latest) + F.expr(f"INTERVAL {hours if run != 'r3' else 41} HOURS")
        limit = 36.0 if run != "r3" else 48.0
        alerts = [Alert("stale", freshness("load_times", "loaded_at", pipeline.now), "GREATER_THAN", limit)]
        found = pipeline.alert_check(run, alerts)
        assert found["alert_evaluations"].count() == 1
        seen.append([r.transition for r in found["alert_transitions"].collect()])
    assert seen == [[], ["BREACH"], ["RECOVERY"], ["RECOVERY"]]
    history = spark.read.parquet(pipeline.alerts_path())
    assert sorted((r.run_id, r.breached) for r in history.collect()) == [("r1", False), ("r2", True), ("r3", False)]
