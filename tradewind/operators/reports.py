"""Report datasets: small projections and top-k lists over the derived tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.measures import PUBLISHED, Rounding

Tables = Callable[[str], DataFrame]
Selected = Callable[[Rounding], list]


@dataclass(frozen=True)
class Report:
    """A projection of one derived table, filtered, sorted and optionally cut to the top k.

    `order` lists columns, descending with a leading "-". It ends in the table's key, so
    that a top k is the same on every run.
    """

    table: str
    columns: Selected
    order: tuple[str, ...]
    where: str | None = None
    top: int | None = None

    def build(self, tables: Tables, rounding: Rounding, top: int | None = None) -> DataFrame:
        frame = tables(self.table)
        if self.where is not None:
            frame = frame.where(self.where)
        frame = frame.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in self.order])
        limit = top or self.top
        return (frame.limit(limit) if limit else frame).select(*self.columns(rounding))


def _plain(*names: str) -> Selected:
    return lambda r: list(names)


def _pair(first: str, second: str, mark: str) -> Column:
    return F.concat(first, F.lit(mark), second)


def _two_digits(column: str) -> Column:
    return F.lpad(F.col(column).cast("string"), 2, "0")


DOT = " · "
LOSS = "refund_pct_of_profit > 100"

# Which columns each report shows, its order and its length.
REPORTS: dict[str, Report] = {
    "revenue_trend": Report(
        "revenue_trends", lambda r: ["month", r.to_crore(F.col("revenue")).alias("revenue_cr"), "orders"],
        ("month",)),
    "category_top10": Report(
        "category_performance",
        lambda r: ["category", r.to_crore(F.col("revenue"), 1).alias("revenue_cr"), "margin_pct"],
        ("-revenue", "category"), top=10),
    "segment": Report(
        "segment_performance",
        lambda r: [
            "customer_segment",
            r.to_mean(F.col("avg_lifetime_spend") / 1000, 1).alias("avg_lifetime_spend_k"),
            "churn_rate_pct",
        ], ("customer_segment",)),
    "channel": Report(
        "channel_performance",
        lambda r: ["marketing_channel", r.to_crore(F.col("revenue"), 1).alias("revenue_cr")],
        ("-revenue", "marketing_channel")),
    "delivery_top12": Report(
        "delivery_performance",
        lambda r: [_pair("warehouse_city", "shipping_method", DOT).alias("route"), "delay_rate_pct"],
        ("-delay_rate_pct", "warehouse_city", "shipping_method"), top=12),
    "payment": Report(
        "payment_performance", _plain("payment_method", "failure_rate_pct"),
        ("-failure_rate_pct", "payment_method")),
    "returns_top10": Report(
        "return_analysis", lambda r: [_pair("category", "return_reason", DOT).alias("reason"), "returns"],
        ("-returns", "category", "return_reason"), top=10),
    "state_top10": Report(
        "state_performance",
        lambda r: ["delivery_state", r.to_crore(F.col("revenue"), 1).alias("revenue_cr")],
        ("-revenue", "delivery_state"), top=10),
    "campaigns_top10": Report(
        "campaign_roi", lambda r: ["campaign_name", r.to_mean(F.col("roi")).alias("roi")],
        ("-roi", "campaign_id"), top=10),
    "dq": Report(
        "data_quality", _plain("check_name", "description", "affected_rows", "pct_affected"),
        ("-pct_affected", "check_name")),
    "loss_makers": Report(
        "product_true_profitability",
        _plain("product_name", "category", "gross_profit", "total_refunded", "refund_pct_of_profit"),
        ("-refund_pct_of_profit", "product_id"), where=LOSS, top=10),
    "loss_makers_top15": Report(
        "product_true_profitability",
        _plain("product_name", "category", "gross_profit", "total_refunded",
               "net_profit_after_refunds", "refund_pct_of_profit"),
        ("-refund_pct_of_profit", "product_id"), where=LOSS, top=15),
    "targeting": Report(
        "campaign_targeting_precision", _plain("target_segment", "targeting_precision_pct"),
        ("targeting_precision_pct", "target_segment")),
    "targeting_detail": Report(
        "campaign_targeting_precision",
        _plain("target_segment", "total_orders", "matched_orders", "targeting_precision_pct"),
        ("targeting_precision_pct", "target_segment")),
    "delay_impact": Report(
        "delay_impact_on_experience", _plain("delivery_outcome", "avg_rating", "return_rate_pct"),
        ("delivery_outcome",)),
    "delay_detail": Report(
        "delay_impact_on_experience",
        _plain("delivery_outcome", "orders", "avg_rating", "return_rate_pct"), ("delivery_outcome",)),
    "chan_eff": Report(
        "channel_efficiency", _plain("channel", "revenue_per_rupee_spent"),
        ("-revenue_per_rupee_spent", "channel")),
    "chan_eff_detail": Report(
        "channel_efficiency",
        _plain("channel", "total_cost", "total_revenue_generated", "revenue_per_rupee_spent"),
        ("-revenue_per_rupee_spent", "channel")),
    "discount_eff": Report(
        "discount_effectiveness", _plain("discount_band", "cancel_rate_pct", "avg_order_value"),
        ("discount_band",)),
    "discount_detail": Report(
        "discount_effectiveness",
        _plain("discount_band", "orders", "avg_order_value", "cancel_rate_pct"), ("discount_band",)),
    "cohort": Report(
        "cohort_retention", _plain("cohort_month", "retention_m1_pct", "retention_m3_pct"),
        ("cohort_month",)),
    "rfm": Report(
        "rfm_segmentation",
        _plain("customer_segment", "avg_recency_score", "avg_frequency_score", "avg_monetary_score"),
        ("-avg_monetary_score", "customer_segment")),
    "affinity_top8": Report(
        "category_affinity",
        lambda r: [_pair("category_a", "category_b", " + ").alias("pair"), "orders_together"],
        ("-orders_together", "category_a", "category_b"), top=8),
    "season": Report(
        "seasonality_patterns",
        lambda r: [
            F.concat(_two_digits("month_num"), F.lit(" - "), "month_name").alias("month_name"), "orders",
        ], ("month_num",)),
    "season_by_year": Report(
        "seasonality_by_year",
        lambda r: [
            F.concat(F.col("order_year").cast("string"), F.lit("-"), _two_digits("month_num")).alias("ym"),
            "orders",
        ], ("order_year", "month_num")),
    "repeat_timing": Report(
        "repeat_purchase_timing",
        _plain("pct_repeat_at_least_once", "avg_days_to_2nd_order", "median_days_to_2nd_order"),
        ("total_customers",)),
    "sentiment_rate_top8": Report(
        "sentiment_by_category", _plain("category", "avg_rating", "pct_negative"),
        ("-pct_negative", "category"), top=8),
    "sentiment_volume_top8": Report(
        "sentiment_by_category", _plain("category", "negative_reviews"),
        ("-negative_reviews", "category"), top=8),
    "loyalty": Report(
        "loyalty_tier_parity", _plain("loyalty_tier", "avg_spend", "delay_pct", "churn_pct"),
        ("-avg_spend", "loyalty_tier")),
    "acq_funnel": Report(
        "acquisition_channel_funnel",
        _plain("acquisition_channel", "never_purchased_pct", "avg_lifetime_spend"),
        ("-never_purchased_pct", "acquisition_channel")),
    "fc": Report(
        "revenue_forecast",
        _plain("forecast_month", "revenue_cr_forecast", "revenue_cr_lower", "revenue_cr_upper",
               "orders_forecast"), ("forecast_month",)),
    "fc_acc": Report("forecast_accuracy", _plain("eval_month", "abs_pct_error"), ("eval_month",)),
    "react": Report(
        "reactivation_summary", _plain("reactivation_tier", "customers", "lifetime_value_cr"),
        ("reactivation_tier",)),
}

REPORT_NAMES = ("kpi", *REPORTS)


def kpi(spark: SparkSession, tables: Tables, rounding: Rounding = PUBLISHED) -> DataFrame:
    """One row: revenue, orders, customers, same-day delay."""
    trend = tables("revenue_trends")
    same_day = tables("delivery_performance").where(F.col("shipping_method") == "Same-Day")
    customers = tables("dim_customer").agg(F.count(F.lit(1)))
    delay = same_day.agg(rounding.to_mean(F.avg("delay_rate_pct"), 1))
    return trend.agg(
        rounding.to_crore(F.sum("revenue"), 1).alias("revenue_cr"),
        F.sum("orders").alias("total_orders"),
    ).select(
        "revenue_cr",
        "total_orders",
        customers.scalar().alias("total_customers"),
        delay.scalar().alias("same_day_delay_pct"),
    )


def report(
    name: str,
    spark: SparkSession,
    tables: Tables,
    *,
    rounding: Rounding = PUBLISHED,
    top: int | None = None,
) -> DataFrame:
    """The named report; `top` overrides the length of a top-k list."""
    if name == "kpi":
        return kpi(spark, tables, rounding)
    if name not in REPORTS:
        raise KeyError(f"unknown report {name!r}; choose from {', '.join(REPORT_NAMES)}")
    return REPORTS[name].build(tables, rounding, top)
