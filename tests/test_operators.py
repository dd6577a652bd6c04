"""Operators on hand-written rows, against values worked out by hand or by brute force."""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tradewind.functions.measures import FINE
from tradewind.operators import descriptive, forecast, opportunities, patterns, quality


def dated(spark, rows, schema, *dates):
    frame = spark.createDataFrame(rows, schema)
    for d in dates:
        frame = frame.withColumn(d, F.col(d).cast("date"))
    return frame


@pytest.fixture()
def small_star(spark):
    return {
        "fact_orders": dated(spark, [
            (1, 10, "2001-01-05", "Delivered", 100.0), (2, 10, "2001-01-05", "Failed", 0.0),
            (3, 11, "2001-02-01", "Failed", 50.0), (3, 11, "2001-02-01", "Delivered", 50.0),
            (None, 12, "2001-09-01", "Delivered", 5.0),
        ], "order_id long, customer_id long, order_date string, order_status string, final_amount double",
            "order_date"),
        "fact_payments": spark.createDataFrame(
            [(1, 1, "Success"), (2, 3, "Success"), (3, 3, "Success"), (4, 3, "Failed"), (5, None, "Success")],
            "payment_id long, order_id long, payment_status string"),
        "fact_shipments": dated(spark, [
            (1, 3, "2001-01-02", "2001-01-01", 1), (2, 3, "2001-01-02", None, None),
            (3, None, "2001-01-02", "2001-01-01", 0),
        ], "shipment_id long, order_id long, dispatch_date string, actual_delivery_date string, delayed_flag int",
            "dispatch_date", "actual_delivery_date"),
        "fact_returns": spark.createDataFrame(
            [("r1", 1, 7, 60.0), ("r1", 1, 7, 50.0), ("r2", 2, 7, None), (None, 9, 9, 1.0), (None, None, 7, 99.0)],
            "return_id string, order_id long, product_id long, refund_amount double"),
        "fact_order_items": spark.createDataFrame(
            [("a", 1, 7, 60.0), ("b", 1, 7, 48.0), ("c", 2, 7, 0.0), ("d", 3, 99, 5.0), ("e", 3, None, 5.0),
             ("f", None, 7, 1.0)],
            "order_item_id string, order_id long, product_id long, item_revenue double"),
        "dim_product": spark.createDataFrame([(7,), (None,)], "product_id long"),
        "fact_reviews": spark.createDataFrame(
            [(1, 1, 7), (2, 1, None), (3, None, None), (4, None, None)],
            "review_id long, order_id long, product_id long"),
    }


def test_quality_by_hand(small_star, as_of):
    found = {r["check_name"]: (r["affected_rows"], r["pct_affected"])
             for r in quality.data_quality(small_star, as_of, rounding=FINE).collect()}
    assert found["orders_without_payment"] == (2, 40.0)  # order 2 and the one without id
    assert found["delivered_without_shipment"] == (2, pytest.approx(66.666667))
    assert found["failed_orders_with_payment"] == (2, 100.0)  # one failed row, two payments
    assert found["zero_final_amount"] == (1, 20.0)
    assert found["future_dated_orders"] == (1, 20.0)
    assert found["delivery_before_dispatch"] == (2, pytest.approx(66.666667))
    assert found["duplicate_order_ids"] == (1, 20.0)
    assert found["duplicate_return_ids"] == (2, 40.0)  # r1 and the missing id
    assert found["refund_exceeds_item_revenue"] == (1, 20.0)  # 110 > 108 + 1
    assert found["orphaned_order_items"] == (2, pytest.approx(33.333333))


def test_quality_on_empty_tables(small_star, as_of):
    empty = {name: frame.limit(0) for name, frame in small_star.items()}
    for row in quality.data_quality(empty, as_of).collect():
        assert (row["affected_rows"], row["pct_affected"]) == (0, None)


def test_join_safety_with_missing_parts(small_star):
    found = {(r["table_name"], r["candidate_key"]): (r["rows"], r["distinct_keys"], r["fanout_rows"])
             for r in quality.join_safety(small_star).collect()}
    assert found["fact_reviews", "order_id"] == (4, 1, 3)
    assert found["fact_reviews", "order_id + product_id"] == (4, 3, 1)
    assert found["fact_orders", "order_id"] == (5, 3, 2)


def test_profit_zero_and_negative(spark):
    items = spark.createDataFrame([(1, 2, 0.0), (2, 1, -10.0), (3, 1, 40.0), (3, 1, 10.0)],
                                  "product_id long, quantity int, profit double")
    returns = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 60.0), (4, 9.0)], "product_id long, refund_amount double")
    products = spark.createDataFrame([(k, f"p{k}", "c", "b") for k in (1, 2, 3, 4)],
                                     "product_id long, product_name string, category string, brand string")
    found = opportunities.product_true_profitability(items, returns, products, ordered=True).collect()
    assert [(r["product_id"], r["refund_pct_of_profit"]) for r in found] == [(3, 120.0), (2, -50.0), (1, None)]
    assert found[0]["net_profit_after_refunds"] == -10.0 and found[0]["units_sold"] == 2


def test_unknown_delay_flag_stays_apart(spark):
    shipments = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None)], "order_id long, delayed_flag int")
    reviews = spark.createDataFrame([(1, 5), (1, 2), (9, 1)], "order_id long, rating int")
    returns = spark.createDataFrame([(1,), (1,), (3,)], "order_id long")
    found = {r["delivery_outcome"]: r for r in opportunities.delay_impact_on_experience(
        shipments, reviews, returns, unknown="Unknown").collect()}
    assert found["Delayed"]["avg_rating"] == 3.5 and found["Delayed"]["orders_returned"] == 1
    assert found["Unknown"]["return_rate_pct"] == 100.0 and found["On-time"]["orders_reviewed"] == 0


def test_discount_bands(spark):
    orders = spark.createDataFrame(
        [(-0.0, 1.0, "Cancelled"), (0.0, 3.0, "x"), (9.9, 1.0, "x"), (10.0, 1.0, "x"), (20.0, 1.0, "x"), (None, 1.0, "x")],
        "discount_percentage double, final_amount double, order_status string")
    found = {r["discount_band"]: (r["orders"], r["cancel_rate_pct"])
             for r in opportunities.discount_effectiveness(orders).collect()}
    assert found == {"1. No discount": (2, 50.0), "2. 1-10%": (1, 0.0), "3. 10-20%": (1, 0.0), "4. 20%+": (2, 0.0)}


def test_segment_rates_sum_to_rows(star):
    customers = star["dim_customer"]
    found = descriptive.segment_performance(customers)
    assert found.agg(F.sum("customers")).first()[0] == customers.count()


def test_cohorts(spark):
    customers = dated(spark, [(1, "2001-01-15"), (2, "2001-01-20"), (3, "2001-05-01"), (4, None)],
                      "customer_id long, signup_date string", "signup_date")
    orders = dated(spark, [
        (1, "2001-02-01", "x"), (1, "2001-02-09", "x"), (1, "2001-04-01", "x"), (2, "2001-02-01", "Cancelled"),
        (2, "2001-07-01", "x"), (8, "2001-02-01", "x"),
    ], "customer_id long, order_date string, order_status string", "order_date")
    found = {str(r["cohort_month"]): r for r in patterns.cohort_retention(customers, orders).collect()}
    january = found["2001-01-01"]
    assert (january["cohort_size"], january["active_month_1"], january["active_month_3"], january["active_month_6"]) == (2, 1, 1, 1)
    assert january["retention_m1_pct"] == 50.0
    assert found["2001-05-01"]["active_month_1"] == 0
    assert found["None"]["cohort_size"] == 1


def test_second_order_of_a_hot_customer(spark):
    """One customer has a third of all orders; ties on a day count as a gap of 0."""
    orders = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("customer_id"),
        F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") / 6).cast("int")).alias("order_date"),
        F.lit("x").alias("order_status"),
    )
    found = patterns.days_to_second_order(orders).collect()
    assert [(r["customer_id"], r["days_to_repeat"]) for r in found] == [(0, 0)]


def test_affinity_by_brute_force(spark):
    lines = [(o, (o * 7 + i * i) % 11) for o in range(60) for i in range(o % 5)]
    lines += [(None, 1), (5, None), (5, 99)]
    items = spark.createDataFrame(lines, "order_id long, product_id long")
    products = spark.createDataFrame([(p, "abcd"[p % 4]) for p in range(11)], "product_id long, category string")
    sets = {}
    for order, product in lines:
        if order is not None and product is not None and product < 11:
            sets.setdefault(order, set()).add("abcd"[product % 4])
    expected = Counter(pair for held in sets.values() for pair in combinations(sorted(held), 2))
    found = {(r["category_a"], r["category_b"]): r["orders_together"]
             for r in patterns.category_affinity(items, products).collect()}
    assert found == dict(expected)


def test_reactivation_edges(spark):
    orders = dated(spark, [
        (1, "2001-01-01", 10.0), (1, "2001-01-11", 10.0),  # gap 10, 20 days since: ratio 2
        (2, "2001-01-05", 5.0), (2, "2001-01-05", 5.0),    # gap 0: left out
        (3, "2001-01-31", 1.0),                            # one order: left out
        (4, "2001-01-01", 1.0), (4, "2001-01-31", 1.0),    # due today: ratio 0
    ], "customer_id long, order_date string, final_amount double", "order_date")
    customers = spark.createDataFrame([(k, "s", "t", "u") for k in (1, 2, 3, 4)],
                                      "customer_id long, customer_segment string, loyalty_tier string, state string")
    found = {r["customer_id"]: (r["overdue_ratio"], r["reactivation_tier"])
             for r in forecast.reactivation_targets(orders, customers).collect()}
    assert found == {1: (2.0, "3. High risk (2-3x overdue)"), 4: (0.0, "0. On cadence")}


def test_forecast_accuracy_covers_every_month(spark):
    rows = [(f"{y}-{m:02d}-15", float(100 + 12 * (y - 1999) + m)) for y in (1999, 2000, 2001) for m in range(1, 13)]
    orders = dated(spark, rows, "order_date string, final_amount double", "order_date")
    found = forecast.forecast_accuracy(orders, F.lit("2001-01-01").cast("date"), rounding=FINE).collect()
    assert len(found) == 12 and found[-1]["eval_month"] == "2001-12"
    assert all(r["abs_pct_error"] < 1e-6 for r in found)


@pytest.mark.parametrize("name", ["fact_order_items", "fact_orders"])
def test_results_do_not_depend_on_input_order(star, name):
    shuffled = dict(star)
    shuffled[name] = star[name].orderBy(F.rand(3)).repartition(7)
    for make in (
        lambda s: opportunities.product_true_profitability(s["fact_order_items"], s["fact_returns"], s["dim_product"], rounding=FINE),
        lambda s: patterns.category_affinity(s["fact_order_items"], s["dim_product"]),
        lambda s: patterns.repeat_purchase_timing(s["fact_orders"], s["dim_customer"], rounding=FINE),
        lambda s: forecast.reactivation_targets(s["fact_orders"], s["dim_customer"], rounding=FINE),
    ):
        assert sorted(map(str, make(star).collect())) == sorted(map(str, make(shuffled).collect()))
