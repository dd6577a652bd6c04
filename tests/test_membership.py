"""Exact membership in bitmaps, against plain sets, and orphans found without a shuffle of rows."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.functions.membership import key_blocks, with_membership
from tradewind.operators.audit import orphan_counts

from conftest import rows_of

EDGES = [0, 1, -1, 7, 8, 32_767, 32_768, -32_768, -32_769, 2**63 - 1, -2**63]
TEXTS = ["", "0", "00", "000", "C-1", "C-01", "C-32767", "C-32768", "C", "C-", "1C", "1\n", "1", "x\n12", "é9", "٣",
         "9" * 18, "9" * 19, "0" * 40, "9" * 19 + "a", " 1", "1 "]


def members(spark, known, asked, kind):
    parent = spark.createDataFrame([(v,) for v in known], f"`a key` {kind}")
    child = spark.createDataFrame([(v,) for v in asked], f"`a key` {kind}")
    blocks = key_blocks(parent, "a key")
    return {(r[0], r[1]) for r in with_membership(child, "a key", blocks, "known").collect()}


@pytest.mark.parametrize("kind, values", [("long", EDGES), ("string", TEXTS)])
def test_every_value_is_told_from_every_other(spark, kind, values):
    for part in (values[::2], values[1::2], values):
        expected = {(v, v in part) for v in values} | {(None, None)}
        assert members(spark, [*part, *part, None], [*values, None], kind) == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("a0129 \n", max_size=4), max_size=30, unique=True),
    st.lists(st.text("a0129 \n", max_size=4), min_size=1, max_size=30, unique=True))
def test_texts_against_a_set(spark, known, asked):
    assert members(spark, known, asked, "string") == {(v, v in known) for v in asked}


def test_whole_blocks(spark):
    parent = spark.range(0, 100_000, 3).toDF("k")
    blocks = key_blocks(parent, "k")
    assert blocks.count() == 4
    told = with_membership(spark.range(-10, 100_010).toDF("k"), "k", blocks, "known")
    assert told.where("known").count() == 33_334
    assert told.where("known <> (k >= 0 AND k < 100000 AND k % 3 = 0)").count() == 0


def test_scattered_keys_and_other_types_build_no_blocks(spark):
    assert key_blocks(spark.range(100).select((F.col("id") * 1_000_000).alias("k")), "k", most=50) is None
    assert key_blocks(spark.range(5).select(F.col("id").cast("double").alias("k")), "k") is None
    assert key_blocks(spark.range(0).toDF("k"), "k").count() == 0


@pytest.mark.parametrize("most_blocks", [0, 16])
def test_planted_orphans(spark, most_blocks):
    parent = spark.createDataFrame([(f"C-{i:04d}",) for i in range(0, 50)] + [(None,), ("C-0001",)], "id string")
    hot = spark.range(3_000).select(F.lit("C-0007").alias("who"))
    visits = hot.unionByName(spark.createDataFrame([("C-7",), ("C-0050",), ("C-0050",), (None,), ("",)], "who string"))
    empty = spark.createDataFrame([], "who string")
    numbers = spark.createDataFrame([(1,), (2,)], "who long")
    found = rows_of(orphan_counts(
        [("visits", "who", visits), ("empty", "who", empty), ("numbers", "who", numbers)], parent, "id",
        most_blocks=most_blocks), "table_name")
    assert [(r["table_name"], r["affected_rows"], r["total_rows"]) for r in found] == [
        ("empty", 0, 0), ("numbers", 2, 2), ("visits", 4, 3_005)]


def test_no_child_row_is_shuffled(spark):
    parent, child = spark.range(1_000).toDF("id"), spark.range(5_000).toDF("id")
    plan = orphan_counts([("child", "id", child)], parent, "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
