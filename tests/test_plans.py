"""What the physical plans must and must not contain."""

from __future__ import annotations

import contextlib
import io

import pytest

from tradewind.operators import conform, patterns
from tradewind.plans import gold
from tradewind.plans.registry import gold_context


def plan(frame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def stored(spark, sample, tmp_path_factory):
    """The typed star as parquet, as the pipeline keeps it."""
    from tradewind.plans.sample_star import SampleStar
    from tradewind.sources.layers import write_layer

    root = str(tmp_path_factory.mktemp("stored"))
    return write_layer(dict(SampleStar(spark, sample).star()), root, "silver")


@pytest.fixture()
def shuffled_joins(spark):
    """No automatic broadcast: the plan that large inputs get."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(gold.BUILDERS))
def test_no_cross_join_and_no_single_task_window(name, stored, as_of, shuffled_joins):
    text = plan(gold.context(stored, as_of).table(name))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text
    # Second orders use a window per customer; the ntile offsets have one row per partition.
    if name not in ("repeat_purchase_timing", "rfm_segmentation"):
        assert ") Window" not in text


@pytest.mark.parametrize("name, exchanges", [
    ("state_performance", 2),            # aggregate, sort
    ("product_true_profitability", 2),   # one ledger, the product side
    ("delay_impact_on_experience", 2),   # one ledger, the small aggregate
])
def test_number_of_shuffles(name, exchanges, stored, as_of, shuffled_joins):
    text = plan(gold.context(stored, as_of).table(name))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == exchanges


def test_distinct_counts_do_not_multiply_rows(stored, as_of):
    assert "Expand" not in plan(gold.context(stored, as_of).table("revenue_trends"))


def test_only_needed_columns_are_read(stored, as_of):
    text = plan(gold.context(stored, as_of).table("state_performance"))
    assert "ReadSchema: struct<delivery_state:string,final_amount:double>" in text


def test_filters_reach_the_scan(stored, as_of):
    text = plan(gold.context(stored, as_of).table("seasonality_patterns"))
    assert "Not(EqualTo(order_status,Cancelled))" in text
    text = plan(gold.context(stored, as_of).table("channel_performance"))
    assert "IsNotNull(marketing_channel)" in text


def test_second_order_is_limited_before_the_shuffle(stored):
    text = plan(patterns.days_to_second_order(stored["fact_orders"]))
    assert text.count("WindowGroupLimit") >= 2


def test_conform_is_one_narrow_stage(spark, sample, as_of):
    from tradewind.plans.sample_star import SampleStar

    raw = SampleStar(spark, sample).raw()["orders"]
    assert "Exchange" not in plan(conform.conform("orders", raw, as_of, missing="skip"))


def test_reports_use_top_k(spark, sample):
    from tradewind.operators import reports

    context = gold_context(spark, sample)
    text = plan(reports.report("loss_makers", spark, context.table))
    assert "TakeOrderedAndProject" in text
