"""Seasons by year, revenue forecast with its backtest, and overdue customers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.measures import PUBLISHED, Rounding, banded, month_start, pct, rows
from tradewind.functions.trend import forecast_months, inside

# Overdue tiers and their labels.
OVERDUE_TIERS: tuple[tuple[Callable[[Column], Column], str], ...] = (
    (lambda r: r >= 3.0, "4. Likely lost (3x+ overdue)"),
    (lambda r: r >= 2.0, "3. High risk (2-3x overdue)"),
    (lambda r: r >= 1.5, "2. Slipping (1.5-2x overdue)"),
    (lambda r: r >= 1.0, "1. Just due (1-1.5x)"),
)
ON_CADENCE = "0. On cadence"


def seasonality_by_year(orders: DataFrame, *, rounding: Rounding = PUBLISHED) -> DataFrame:
    """Orders and revenue per year and month, all statuses included."""
    date = F.col("order_date")
    return (
        orders.groupBy(
            F.year(date).alias("order_year"),
            F.month(date).alias("month_num"),
            F.date_format(date, "MMMM").alias("month_name"),
        )
        .agg(
            rows().alias("orders"),
            rounding.to_crore(F.sum("final_amount")).alias("revenue_cr"),
            rounding.to_money(F.avg("final_amount")).alias("avg_order_value"),
        )
        .orderBy("order_year", "month_num")
    )


def monthly_series(orders: DataFrame) -> DataFrame:
    """Revenue and order count per month, as two series in long form."""
    monthly = orders.groupBy(month_start(F.col("order_date")).alias("month")).agg(
        F.sum("final_amount").alias("revenue"), rows().cast("double").alias("orders")
    )
    return monthly.unpivot("month", ["revenue", "orders"], "series", "value")


def revenue_forecast(
    orders: DataFrame, *, periods: int = 6, fill: str = "none", rounding: Rounding = PUBLISHED
) -> DataFrame:
    """Revenue and order count for the months after the last one, with 95 % intervals."""
    ahead = forecast_months(monthly_series(orders), ["series"], "month", "value", periods, fill=fill)

    def of(series: str, column: str) -> Column:
        return F.max(F.when(F.col("series") == series, F.col(column)))

    return (
        ahead.groupBy("month")
        .agg(
            *[
                rounding.to_crore(of("revenue", c)).alias(f"revenue_cr_{c}")
                for c in ("forecast", "lower", "upper")
            ],
            *[
                rounding.to_money(of("orders", c)).alias(f"orders_{c}")
                for c in ("forecast", "lower", "upper")
            ],
        )
        .orderBy("month")
        .select(
            F.date_format("month", "yyyy-MM").alias("forecast_month"),
            "revenue_cr_forecast",
            "revenue_cr_lower",
            "revenue_cr_upper",
            "orders_forecast",
            "orders_lower",
            "orders_upper",
        )
    )


def forecast_accuracy(
    orders: DataFrame,
    cutoff: Column,
    *,
    periods: int = 12,
    fill: str = "none",
    rounding: Rounding = PUBLISHED,
) -> DataFrame:
    """Backtest: fit on months before the cutoff, compare the next months with what happened.

    Both halves come from one monthly aggregate. Covers `periods` months after the
    training data, as far as actual values exist.
    """
    monthly = orders.groupBy(month_start(F.col("order_date")).alias("month")).agg(
        F.sum(F.when(F.col("order_date") < cutoff, F.col("final_amount"))).alias("_train"),
        F.sum(F.when(F.col("order_date") >= cutoff, F.col("final_amount"))).alias("actual"),
        F.count_if(F.col("order_date") < cutoff).alias("_trained"),
        F.count_if(F.col("order_date") >= cutoff).alias("_seen"),
    )
    training = monthly.where(F.col("_trained") > 0).select("month", "_train")
    ahead = forecast_months(training, [], "month", "_train", periods, fill=fill)
    error = F.abs(F.col("forecast") - F.col("actual"))
    return (
        monthly.where(F.col("_seen") > 0)
        .join(ahead, "month")
        .orderBy("month")
        .select(
            F.date_format("month", "yyyy-MM").alias("eval_month"),
            rounding.to_crore(F.col("actual")).alias("actual_cr"),
            rounding.to_crore(F.col("forecast")).alias("forecast_cr"),
            rounding.to_mean(pct(error, F.col("actual")), 1).alias("abs_pct_error"),
            inside(F.col("actual"), F.col("lower"), F.col("upper")).alias("inside_95_interval"),
        )
    )


def forecast_accuracy_summary(accuracy: DataFrame, *, rounding: Rounding = PUBLISHED) -> DataFrame:
    """Mean absolute percentage error and the share of months inside the interval."""
    return accuracy.agg(
        rows().alias("months"),
        rounding.to_mean(F.avg("abs_pct_error"), 1).alias("mape"),
        F.count_if("inside_95_interval").alias("months_inside"),
        rounding.to_mean(pct(F.count_if("inside_95_interval"), rows()), 1).alias("inside_pct"),
    )


def reactivation_targets(
    orders: DataFrame,
    customers: DataFrame,
    *,
    as_of: Column | None = None,
    exclude_status: str | None = None,
    tiers: Sequence[tuple[Callable[[Column], Column], str]] = OVERDUE_TIERS,
    on_cadence: str = ON_CADENCE,
    rounding: Rounding = PUBLISHED,
    ordered: bool = False,
) -> DataFrame:
    """Customers with at least two orders, by how overdue they are against their own rhythm.

    The rhythm is (last - first) / (orders - 1) days; customers whose orders all fall on
    one day have none and are left out. `as_of` defaults to the latest order date.
    One row per customer, hence the sort is optional.
    """
    counted = orders if exclude_status is None else orders.where(F.col("order_status") != exclude_status)
    today = as_of if as_of is not None else counted.agg(F.max("order_date")).scalar()
    span = F.datediff(F.max("order_date"), F.min("order_date")).cast("double")
    per_customer = (
        counted.groupBy("customer_id")
        .agg(
            rows().alias("orders"),
            F.max("order_date").alias("last_order_date"),
            F.sum("final_amount").alias("_value"),
            F.try_divide(span, (rows() - 1).cast("double")).alias("_gap"),
        )
        .where((F.col("orders") >= 2) & (F.col("_gap") > 0))
        .withColumn("days_since_last_order", F.datediff(today, F.col("last_order_date")))
        .withColumn("_ratio", F.col("days_since_last_order") / F.col("_gap"))
    )
    profile = customers.select("customer_id", "customer_segment", "loyalty_tier", "state")
    result = per_customer.join(profile, "customer_id").select(
        "customer_id",
        "customer_segment",
        "loyalty_tier",
        "state",
        "orders",
        "last_order_date",
        "days_since_last_order",
        rounding.to_money(F.col("_gap")).alias("avg_gap_days"),
        rounding.to_mean(F.col("_ratio")).alias("overdue_ratio"),
        rounding.to_money(F.col("_value")).alias("lifetime_value"),
        banded(F.col("_ratio"), tiers, on_cadence).alias("reactivation_tier"),
    )
    if not ordered:
        return result
    return result.orderBy(F.desc("overdue_ratio"), F.desc("lifetime_value"), "customer_id")


def reactivation_summary(targets: DataFrame, *, rounding: Rounding = PUBLISHED) -> DataFrame:
    """Size and value of each overdue tier."""
    return (
        targets.groupBy("reactivation_tier")
        .agg(
            rows().alias("customers"),
            rounding.to_crore(F.sum("lifetime_value"), 1).alias("lifetime_value_cr"),
            rounding.to_money(F.avg("lifetime_value")).alias("avg_lifetime_value"),
            rounding.to_money(F.avg("days_since_last_order")).alias("avg_days_since_order"),
        )
        .orderBy("reactivation_tier")
    )
