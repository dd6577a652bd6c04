"""Rules, typed tables and reject accounting on hand-written rows."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tradewind.operators import conform, rules
from tradewind.plans.sample_star import SampleStar
from tradewind.schema import SOURCES


def raw(spark, table, rows, columns):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


@pytest.fixture()
def orders(spark):
    columns = ["order_id", "customer_id", "order_date", "order_time", "final_amount",
               "discount_percentage", "coupon_code", "campaign_id"]
    return raw(spark, "orders", [
        ("1", "a", "2001-07-01", "09:08:07", "10", "0", "", ""),
        ("2", "a", "2001-07-01", None, "10.5", "100", "C1", "k"),
        ("3", "a", "2001-07-01", "25:61:00", "0", "-0.0", None, None),
        (" ", "a", "2001-07-01", "09:08:07", "10", "0", "", ""),
        ("5", None, "2001-07-01", "09:08:07", "10", "0", "", ""),
        ("6", "a", "not-a-date", "09:08:07", "10", "0", "", ""),
        ("7", "a", None, "09:08:07", "10", "0", "", ""),
        ("8", "a", "2001-08-02", "09:08:07", "10", "0", "", ""),
        ("9", "a", "2001-07-01", "09:08:07", None, "0", "", ""),
        ("10", "a", "2001-07-01", "09:08:07", "NaN", "0", "", ""),
        ("11", "a", "2001-07-01", "09:08:07", "-1", "0", "", ""),
        ("12", "a", "2001-07-01", "09:08:07", "1", "100.1", "", ""),
    ], columns)


def test_orders_conform(orders, as_of):
    typed = {r["order_id"]: r for r in conform.conform("orders", orders, as_of, missing="skip").collect()}
    assert sorted(typed) == ["1", "2", "3"]
    assert str(typed["1"]["order_timestamp"]) == "2001-07-01 09:08:07"
    assert typed["2"]["order_timestamp"] is None and typed["3"]["order_timestamp"] is None
    assert typed["1"]["coupon_code"] is None and typed["2"]["coupon_code"] == "C1"
    assert typed["1"]["campaign_id"] is None and typed["2"]["campaign_id"] == "k"


def test_rejects_are_explained_and_conserved(orders, as_of):
    tables = {"orders": orders}
    total = rules.validation_rejects(tables, as_of, missing="skip").first()
    assert (total["bronze_rows"], total["silver_rows"], total["rejected_rows"]) == (12, 3, 9)
    reasons = {
        (r["column_name"], r["rule"]): r["rejected_rows"]
        for r in rules.rejects_by_rule(tables, as_of, missing="skip").collect()
    }
    assert sum(reasons.values()) == 9
    assert reasons["order_date", "parses_as_date"] == 2
    assert reasons["order_date", "not_in_future"] == 1
    assert reasons["final_amount", "parses_as_nonneg_double"] == 3
    assert reasons["customer_id", "not_null_or_blank"] == 1


def test_log_ignores_missing_values(orders, as_of):
    log = {
        (r["column_name"], r["rule"]): r["failed_rows"]
        for r in rules.validation_log({"orders": orders}, as_of, missing="skip").collect()
    }
    # A missing amount is rejected but not logged; NaN and -1 are logged.
    assert log["final_amount", "parses_as_nonneg_double"] == 2
    assert log["order_date", "parses_as_date"] == 1


def test_age_and_boolean(spark, as_of):
    customers = raw(spark, "customers", [("1", "44.0", "2024-02-30"), ("2", "old", "2024-02-28")],
                    ["customer_id", "age", "customer_signup_date"])
    typed = {r["customer_id"]: r for r in conform.conform("customers", customers, as_of, missing="skip").collect()}
    assert typed["1"]["age"] == 44 and typed["2"]["age"] is None
    assert typed["1"]["signup_date"] is None and str(typed["2"]["signup_date"]) == "2024-02-28"
    reviews = raw(spark, "customer_reviews",
                  [("1", "o", "5", "maybe"), ("2", "o", "1", "true"), ("3", "o", "0", "true"), ("4", "o", "five", "1")],
                  ["review_id", "order_id", "rating", "verified_purchase"])
    kept = conform.conform("customer_reviews", reviews, as_of, missing="skip").collect()
    assert {(r["review_id"], r["rating"], r["verified_purchase"]) for r in kept} == {("1", 5, None), ("2", 1, True)}


def test_optional_values_may_be_missing(spark, as_of):
    shipments = raw(spark, "shipments", [("1", "o", None), ("2", "o", "-2"), ("3", "o", "soon"), ("4", "o", "1.5")],
                    ["shipment_id", "order_id", "delivery_days"])
    kept = conform.conform("shipments", shipments, as_of, missing="skip")
    assert sorted(r["shipment_id"] for r in kept.collect()) == ["1", "4"]


def test_missing_columns_are_an_error_by_default(orders, as_of):
    with pytest.raises(ValueError, match="lacks the columns"):
        conform.conform("orders", orders, as_of)


def test_rule_list_is_complete():
    assert sum(r.logged for r in rules.RULES) == 19
    assert sum(r.filters and not r.logged for r in rules.RULES) == 9
    for rule in rules.RULES:
        assert rule.column in [f.name for f in SOURCES[rule.table].fields]


def test_empty_table(spark, as_of):
    empty = raw(spark, "payments", [], ["payment_id", "order_id", "amount_paid"])
    row = rules.validation_rejects({"payments": empty}, as_of, missing="skip").first()
    assert (row["bronze_rows"], row["silver_rows"], row["rejected_rows"]) == (0, 0, 0)
    assert rules.validation_log({"payments": empty}, as_of, missing="skip").agg(F.sum("failed_rows")).first()[0] == 0


def test_a_rule_without_its_column_is_an_error(spark, as_of):
    import pytest

    orders = spark.createDataFrame([("1",)], "order_id string")
    for report in (rules.validation_log, rules.validation_rejects, rules.rejects_by_rule):
        with pytest.raises(ValueError, match="absent columns"):
            report({"orders": orders}, as_of)


def test_infinite_amounts_and_tables_without_active_rules(spark, as_of):
    rule = next(r for r in rules.RULES if r.kind == "parses_as_nonneg_double")
    values = spark.createDataFrame([("Infinity",), ("-Infinity",), ("NaN",), ("3",)], f"{rule.column} string")
    assert [r[0] for r in values.select(rules.holds(rule, as_of)).collect()] == [False, False, False, True]
    bare = spark.createDataFrame([("x",)], "other string")
    assert rules.rejects_by_rule({"orders": bare}, as_of, missing="skip").count() == 0


def test_rejects_are_counted_by_the_write(spark, sample, as_of, tmp_path):
    raw = dict(SampleStar(spark, sample).raw())
    raw["payments"] = raw["payments"].limit(0)
    raw["returns"] = spark.createDataFrame([], raw["returns"].schema)
    raw["orders"] = raw["orders"].withColumn("order_id", F.when(F.crc32("order_id") % 7 != 0, F.col("order_id")))
    seen = {t: Observation() for t in raw}
    for table, frame in raw.items():
        kept = rules.watched(table, frame, as_of, seen[table]).where(rules.keep(table, frame, as_of))
        kept.write.parquet(str(tmp_path / table))
    totals, by_rule = rules.rejects_seen(raw, seen)
    expected = rules.validation_rejects(raw, as_of, missing="skip")
    assert [tuple(r) for r in totals.collect()] == [tuple(r) for r in expected.collect()]
    assert totals.first()["rejected_rows"] > 0
    assert sorted(map(tuple, by_rule.collect())) == sorted(
        map(tuple, rules.rejects_by_rule(raw, as_of, missing="skip").collect()))
