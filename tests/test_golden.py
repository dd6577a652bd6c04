"""Known values on the larger sample, computed beforehand on two engines."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tradewind.functions.measures import FINE
from tradewind.operators import forecast, opportunities, patterns, quality, rules
from tradewind.operators.conform import conform_all
from tradewind.plans.sample_star import SampleStar

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def shop(spark):
    return SampleStar(spark, FOLDER)


@pytest.fixture(scope="module")
def typed(shop):
    return shop.star()


def by(frame, key, value):
    return {r[key]: r[value] for r in frame.collect()}


def test_quality_counts(typed, as_of):
    found = by(quality.data_quality(typed, as_of), "check_name", "affected_rows")
    assert found == {
        "orders_without_payment": 300,
        "delivered_without_shipment": 74,
        "failed_orders_with_payment": 4696,
        "delivery_before_dispatch": 29157,
        "duplicate_return_ids": 1644,
        "refund_exceeds_item_revenue": 19011,
        "orphaned_order_items": 0,
        "zero_final_amount": 0,
        "future_dated_orders": 0,
        "duplicate_order_ids": 0,
    }


def test_join_safety(typed):
    found = {
        (r["table_name"], r["candidate_key"]): r["fanout_rows"]
        for r in quality.join_safety(typed).collect()
    }
    assert found["fact_order_items", "order_item_id"] == 14168
    assert found["fact_order_items", "order_id"] == 45257
    assert found["fact_reviews", "order_id"] == 1360


def test_delay_impact_differs_from_the_naive_join(typed):
    found = {
        r["delivery_outcome"]: r
        for r in opportunities.delay_impact_on_experience(
            typed["fact_shipments"], typed["fact_reviews"], typed["fact_returns"], rounding=FINE
        ).collect()
    }
    on_time, late = found["On-time"], found["Delayed"]
    assert (on_time["orders"], on_time["orders_reviewed"], on_time["orders_returned"]) == (3266, 585, 2154)
    assert (late["orders"], late["orders_reviewed"], late["orders_returned"]) == (11477, 1977, 8904)
    assert on_time["avg_rating"] == pytest.approx(2.9071225, abs=1e-6)
    assert late["avg_rating"] == pytest.approx(2.9435171, abs=1e-6)
    orders = typed["fact_shipments"].groupBy("order_id").agg(F.max("delayed_flag").alias("late"))
    naive = (
        orders.join(typed["fact_reviews"], "order_id", "left")
        .join(typed["fact_returns"].select("order_id", "return_id"), "order_id", "left")
        .groupBy("late").agg(F.avg("rating").alias("rating"))
    )
    wrong = by(naive, "late", "rating")
    assert wrong[0] == pytest.approx(2.9216966, abs=1e-6)
    assert wrong[1] == pytest.approx(2.9486174, abs=1e-6)


def test_repeat_timing(typed):
    row = patterns.repeat_purchase_timing(
        typed["fact_orders"], typed["dim_customer"], rounding=FINE
    ).first()
    assert row["customers_with_2nd_order"] == 1483
    assert row["avg_days_to_2nd_order"] == pytest.approx(334.76534, abs=1e-4)
    assert (row["median_days_to_2nd_order"], row["p25_days"], row["p75_days"]) == (237.0, 99.5, 457.5)


def test_targeting(typed):
    found = opportunities.campaign_targeting_precision(
        typed["fact_orders"], typed["dim_campaign"], typed["dim_customer"]
    )
    assert {(r[0], r[1], r[2]) for r in found.collect()} == {
        ("AUTOMOBILE", 2000, 398), ("BUILDING", 2000, 387), ("FURNITURE", 2000, 403),
        ("HOUSEHOLD", 2000, 376), ("MACHINERY", 1000, 212),
    }


def test_statuses_and_net_losses(typed):
    counts = by(typed["dim_customer"].groupBy("customer_status").count(), "customer_status", "count")
    assert counts == {"Active": 597, "Churned": 832, "Never Purchased": 71}
    profit = opportunities.product_true_profitability(
        typed["fact_order_items"], typed["fact_returns"], typed["dim_product"], rounding=FINE
    )
    assert profit.count() == 2000
    assert profit.where("net_profit_after_refunds < 0").count() == 203


def test_validation(shop, as_of):
    raw = shop.raw()
    log = {
        (r["source_table"], r["column_name"], r["rule"]): r["failed_rows"]
        for r in rules.validation_log(raw, as_of, missing="skip").collect()
    }
    assert len(log) == 19
    assert log["orders", "order_id", "not_null_or_blank"] == 302
    assert log["orders", "order_date", "parses_as_date"] == 169
    assert log["orders", "final_amount", "parses_as_nonneg_double"] == 393
    assert log["orders", "discount_percentage", "parses_as_pct_0_100"] == 224
    kept = by(rules.validation_rejects(raw, as_of, missing="skip"), "silver_table", "silver_rows")
    assert kept == {
        "dim_customer": 1484, "dim_product": 1563, "dim_campaign": 88, "fact_orders": 13437,
        "fact_order_items": 51887, "fact_payments": 13989, "fact_shipments": 14249,
        "fact_returns": 4599, "fact_reviews": 6611,
    }


def test_casts(shop, as_of):
    typed = conform_all(shop.raw(), as_of, missing="skip")
    assert typed["dim_customer"].where("age IS NOT NULL").count() == 1272
    assert typed["dim_campaign"].where("clicks IS NOT NULL").count() == 66
    assert typed["fact_reviews"].where("verified_purchase IS NOT NULL").count() == 4960


def test_forecast_value(typed):
    cutoff = F.lit("2001-01-01").cast("date")
    from tradewind.functions.trend import forecast_months

    series = forecast.monthly_series(typed["fact_orders"].where(F.col("order_date") < cutoff))
    row = forecast_months(series, ["series"], "month", "value", 1).where("series = 'revenue'").first()
    assert str(row["month"]) == "2001-01-01"
    assert row["forecast"] == pytest.approx(49_459_410, abs=1)
    assert row["upper"] - row["forecast"] == pytest.approx(8_296_883.2, abs=0.1)
