"""Descriptive aggregates: what happened, by month, category, segment, channel and so on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.joins import BROADCAST_ROWS, lookup_join
from tradewind.functions.measures import (
    PUBLISHED,
    Rounding,
    month_start,
    pct,
    rows,
    share_pct,
)


def revenue_trends(
    orders: DataFrame,
    *,
    cancelled: str = "Cancelled",
    failed: str = "Failed",
    delivered: str = "Delivered",
    rounding: Rounding = PUBLISHED,
) -> DataFrame:
    """Orders, customers, revenue and status counts per month.

    Two aggregates with one distinct count each, joined by month: two distinct counts in one
    aggregate would send every order through the shuffle three times.
    """
    status = F.col("order_status")
    month = month_start(F.col("order_date"))
    totals = orders.groupBy(month.alias("month")).agg(
        F.count_distinct("order_id").alias("orders"),
        rounding.to_money(F.sum("final_amount")).alias("revenue"),
        rounding.to_money(F.avg("final_amount")).alias("avg_order_value"),
        F.count_if(status == cancelled).alias("cancelled_orders"),
        F.count_if(status == failed).alias("failed_orders"),
        F.count_if(status == delivered).alias("delivered_orders"),
        rounding.to_mean(share_pct(status == delivered)).alias("delivered_pct"),
    )
    customers = orders.groupBy(month.alias("_month")).agg(
        F.count_distinct("customer_id").alias("unique_customers"))
    return (
        totals.join(customers, F.col("month").eqNullSafe(F.col("_month")))
        .select(
            "month", "orders", "unique_customers", "revenue", "avg_order_value",
            "cancelled_orders", "failed_orders", "delivered_orders", "delivered_pct",
        )
        .orderBy("month")
    )


def category_performance(
    items: DataFrame, products: DataFrame, *, broadcast_rows: int = BROADCAST_ROWS, rounding: Rounding = PUBLISHED
) -> DataFrame:
    """Orders, units, revenue, margin and (line-weighted) rating per product category."""
    lines = items.select("order_id", "product_id", "quantity", "item_revenue", "profit")
    labels = products.select("product_id", "category", "rating_average")
    profit, revenue = F.sum("profit"), F.sum("item_revenue")
    return (
        lookup_join(lines, labels, "product_id", salt_by=["order_id"], broadcast_rows=broadcast_rows)
        .groupBy("category")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("quantity").alias("units_sold"),
            rounding.to_money(revenue).alias("revenue"),
            rounding.to_money(profit).alias("profit"),
            rounding.to_mean(pct(profit, revenue)).alias("margin_pct"),
            rounding.to_mean(F.avg("rating_average")).alias("avg_rating"),
        )
        .orderBy(F.desc("revenue"), "category")
    )


def segment_performance(
    customers: DataFrame, *, churned: str = "Churned", rounding: Rounding = PUBLISHED
) -> DataFrame:
    """Spend, order and churn averages per customer segment."""
    lost = F.col("customer_status") == churned
    return (
        customers.groupBy("customer_segment")
        .agg(
            rows().alias("customers"),
            rounding.to_money(F.avg("total_spend")).alias("avg_lifetime_spend"),
            rounding.to_mean(F.avg("total_orders"), 1).alias("avg_orders"),
            rounding.to_money(F.avg("average_order_value")).alias("avg_order_value"),
            F.count_if(lost).alias("churned"),
            rounding.to_mean(share_pct(lost)).alias("churn_rate_pct"),
        )
        .orderBy(F.desc("avg_lifetime_spend"), "customer_segment")
    )


def channel_performance(orders: DataFrame, *, rounding: Rounding = PUBLISHED) -> DataFrame:
    """Orders and revenue per marketing channel; orders without a channel are left out."""
    return (
        orders.where(F.col("marketing_channel").isNotNull())
        .groupBy("marketing_channel")
        .agg(
            rows().alias("orders"),
            rounding.to_money(F.sum("final_amount")).alias("revenue"),
            rounding.to_money(F.avg("final_amount")).alias("avg_order_value"),
            rounding.to_mean(F.avg("discount_percentage")).alias("avg_discount_pct"),
        )
        .orderBy(F.desc("revenue"), "marketing_channel")
    )


def campaign_roi(
    campaigns: DataFrame, *, rounding: Rounding = PUBLISHED, ordered: bool = False
) -> DataFrame:
    """Click-through and conversion rates per campaign.

    One row per campaign, so the global sort by return is optional.
    """
    names = ["campaign_id", "campaign_name", "channel", "campaign_type", "target_segment"]
    result = campaigns.select(
        *[n for n in names if n in campaigns.columns],
        "conversions",
        "impressions",
        "clicks",
        rounding.to_mean(pct(F.col("clicks"), F.col("impressions")), 3).alias("ctr_pct"),
        rounding.to_mean(pct(F.col("conversions"), F.col("clicks"))).alias("conversion_pct"),
        rounding.to_money(F.col("campaign_cost")).alias("campaign_cost"),
        rounding.to_money(F.col("revenue_generated")).alias("revenue_generated"),
        "roi",
    )
    return result.orderBy(F.desc("roi"), "campaign_id") if ordered else result


def delivery_performance(shipments: DataFrame, *, rounding: Rounding = PUBLISHED) -> DataFrame:
    """Delivery days and delay rate per warehouse and method; an unknown flag counts as a shipment."""
    delayed = F.sum("delayed_flag")
    return (
        shipments.groupBy("warehouse_city", "shipping_method")
        .agg(
            rows().alias("shipments"),
            rounding.to_mean(F.avg("delivery_days")).alias("avg_delivery_days"),
            delayed.alias("delayed_shipments"),
            rounding.to_mean(pct(delayed, rows())).alias("delay_rate_pct"),
        )
        .orderBy(F.desc("delay_rate_pct"), "warehouse_city", "shipping_method")
    )


def return_analysis(
    returns: DataFrame, products: DataFrame, *, rounding: Rounding = PUBLISHED
) -> DataFrame:
    """Returns, refunds and the baseline return rate per category and reason.

    Returns are folded to (product, reason) before the join, so a product with very many
    returns crosses the shuffle as one row per map task.
    """
    folded = returns.groupBy("product_id", "return_reason").agg(
        rows().alias("_n"), F.sum("refund_amount").alias("_refund")
    )
    labels = products.select("product_id", "category", "return_rate_baseline")
    known = F.when(F.col("return_rate_baseline").isNotNull(), F.col("_n"))
    baseline = F.try_divide(
        F.sum(F.col("return_rate_baseline") * F.col("_n")), F.sum(known).cast("double")
    )
    return (
        folded.join(labels, "product_id")
        .groupBy("category", "return_reason")
        .agg(
            F.sum("_n").alias("returns"),
            rounding.to_money(F.sum("_refund")).alias("refunded_amount"),
            rounding.to_mean(baseline * 100).alias("baseline_return_rate_pct"),
        )
        .orderBy(F.desc("returns"), "category", "return_reason")
    )


def payment_performance(
    payments: DataFrame,
    *,
    success: str = "Success",
    failed: str = "Failed",
    rounding: Rounding = PUBLISHED,
) -> DataFrame:
    """Failure rate, fees and refunds per payment method."""
    status = F.col("payment_status")
    return (
        payments.groupBy("payment_method")
        .agg(
            rows().alias("payments"),
            F.count_if(status == success).alias("successful"),
            F.count_if(status == failed).alias("failed"),
            rounding.to_mean(share_pct(status == failed)).alias("failure_rate_pct"),
            rounding.to_mean(F.avg("transaction_fee")).alias("avg_transaction_fee"),
            rounding.to_money(F.sum("refund_amount")).alias("total_refunded"),
        )
        .orderBy(F.desc("failure_rate_pct"), "payment_method")
    )


def state_performance(orders: DataFrame, *, rounding: Rounding = PUBLISHED) -> DataFrame:
    """Orders and revenue per delivery state."""
    return (
        orders.groupBy("delivery_state")
        .agg(
            rows().alias("orders"),
            rounding.to_money(F.sum("final_amount")).alias("revenue"),
            rounding.to_money(F.avg("final_amount")).alias("avg_order_value"),
        )
        .orderBy(F.desc("revenue"), "delivery_state")
    )


def review_integrity(reviews: DataFrame, *, rounding: Rounding = PUBLISHED) -> DataFrame:
    """Reviews and rating by verified purchase and sentiment."""
    return (
        reviews.groupBy("verified_purchase", "review_sentiment")
        .agg(rows().alias("reviews"), rounding.to_mean(F.avg("rating")).alias("avg_rating"))
        .orderBy(F.desc("verified_purchase"), F.desc("reviews"), "review_sentiment")
    )
