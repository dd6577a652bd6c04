"""Diagnostic analyses: where money or goodwill is lost."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.joins import lookup_join
from tradewind.functions.ledger import stack_sources, with_keys
from tradewind.functions.measures import (
    PUBLISHED,
    Rounding,
    banded,
    pct,
    ratio,
    rows,
    share_pct,
)

# Discount bands and their labels.
DISCOUNT_BANDS: tuple[tuple[Callable[[Column], Column], str], ...] = (
    (lambda d: d == 0, "1. No discount"),
    (lambda d: d < 10, "2. 1-10%"),
    (lambda d: d < 20, "3. 10-20%"),
)
DEEPEST_DISCOUNT = "4. 20%+"


def product_true_profitability(
    items: DataFrame,
    returns: DataFrame,
    products: DataFrame,
    *,
    rounding: Rounding = PUBLISHED,
    ordered: bool = False,
) -> DataFrame:
    """Gross profit of each sold product, its refunds, and what remains.

    Items and returns are summed in one ledger by product, so neither multiplies the
    other. The share of profit refunded is NULL at profit 0 and negative below it.
    One row per product, hence the sort is optional.
    """
    one = F.lit(1).cast("long")
    ledger = (
        stack_sources(
            [
                (with_keys(items, ["product_id"]), {
                    "_sold": one, "_units": F.col("quantity"), "_profit": F.col("profit"),
                }),
                (with_keys(returns, ["product_id"]), {
                    "_returned": one, "_refund": F.col("refund_amount"),
                }),
            ],
            ["product_id"],
        )
        .groupBy("product_id")
        .agg(
            F.max("_sold").alias("_sold"),
            F.sum("_units").alias("units_sold"),
            F.sum("_profit").alias("_profit"),
            F.coalesce(F.sum("_returned"), F.lit(0)).alias("return_count"),
            F.coalesce(F.sum("_refund"), F.lit(0.0)).alias("_refund"),
        )
        .where(F.col("_sold").isNotNull())
    )
    result = ledger.join(
        products.select("product_id", "product_name", "category", "brand"), "product_id"
    ).select(
        "product_id",
        "product_name",
        "category",
        "brand",
        "units_sold",
        rounding.to_money(F.col("_profit")).alias("gross_profit"),
        "return_count",
        rounding.to_money(F.col("_refund")).alias("total_refunded"),
        rounding.to_money(F.col("_profit") - F.col("_refund")).alias("net_profit_after_refunds"),
        rounding.to_mean(pct(F.col("_refund"), F.col("_profit")), 1).alias("refund_pct_of_profit"),
    )
    if not ordered:
        return result
    return result.orderBy(F.desc_nulls_last("refund_pct_of_profit"), "product_id")


def campaign_targeting_precision(
    orders: DataFrame,
    campaigns: DataFrame,
    customers: DataFrame,
    *,
    untargeted: str = "All",
    rounding: Rounding = PUBLISHED,
) -> DataFrame:
    """Share of a targeted campaign's orders that came from the segment it targeted.

    Orders of targeted campaigns alone go on: the list of campaigns is joined first. They fold
    to (customer, target) before customers are joined, so that join sees at most one row per
    customer and targeted segment, however many orders a customer or campaign has.
    """
    targeted = campaigns.where(F.col("target_segment") != untargeted).select("campaign_id", "target_segment")
    aimed = lookup_join(
        with_keys(orders, ["customer_id", "campaign_id"]).select("customer_id", "campaign_id"), targeted, "campaign_id",
        salt_by=["customer_id"])
    per_customer = aimed.groupBy("customer_id", "target_segment").agg(rows().alias("_n"))
    hit = F.col("customer_segment") == F.col("target_segment")
    matched = F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0))
    return (
        per_customer.join(customers.select("customer_id", "customer_segment"), "customer_id")
        .groupBy("target_segment")
        .agg(F.sum("_n").alias("total_orders"), matched.alias("matched_orders"))
        .withColumn(
            "targeting_precision_pct",
            rounding.to_mean(pct(F.col("matched_orders"), F.col("total_orders"))),
        )
        .orderBy(F.desc("targeting_precision_pct"), "target_segment")
    )


def delay_impact_on_experience(
    shipments: DataFrame,
    reviews: DataFrame,
    returns: DataFrame,
    *,
    unknown: str = "Unknown",
    rounding: Rounding = PUBLISHED,
) -> DataFrame:
    """Ratings and return rate of delayed against other orders, at order level.

    One ledger by order: ratings are averaged per order first, and a return counts once
    per order, so reviews and returns cannot multiply each other. Orders whose delay flag
    is unknown stay a group of their own; `unknown` is that group's label.
    """
    one = F.lit(1)
    key = ["order_id"]
    per_order = (
        stack_sources(
            [
                (shipments, {"_shipped": one, "_delayed": F.col("delayed_flag")}),
                (with_keys(reviews, key), {"_reviewed": one, "_rating": F.col("rating")}),
                (with_keys(returns, key), {"_returned": one}),
            ],
            key,
        )
        .groupBy("order_id")
        .agg(
            F.max("_shipped").alias("_shipped"),
            F.max("_delayed").alias("_delayed"),
            F.max("_reviewed").alias("_reviewed"),
            F.avg("_rating").alias("_rating"),
            F.max("_returned").alias("_returned"),
        )
        .where(F.col("_shipped").isNotNull())
    )
    label = (
        F.when(F.col("_delayed") == 1, "Delayed")
        .when(F.col("_delayed").isNull(), unknown)
        .otherwise("On-time")
    )
    returned = F.count("_returned")
    return (
        per_order.groupBy("_delayed")
        .agg(
            rows().alias("orders"),
            F.count("_reviewed").alias("orders_reviewed"),
            rounding.to_mean(F.avg("_rating")).alias("avg_rating"),
            returned.alias("orders_returned"),
            rounding.to_mean(pct(returned, rows())).alias("return_rate_pct"),
        )
        .select(
            label.alias("delivery_outcome"),
            "orders",
            "orders_reviewed",
            "avg_rating",
            "orders_returned",
            "return_rate_pct",
        )
    )


def channel_efficiency(campaigns: DataFrame, *, rounding: Rounding = PUBLISHED) -> DataFrame:
    """Revenue per unit of campaign cost, by channel."""
    cost, revenue = F.sum("campaign_cost"), F.sum("revenue_generated")
    return (
        campaigns.groupBy("channel")
        .agg(
            rows().alias("campaigns"),
            rounding.to_money(cost).alias("total_cost"),
            rounding.to_money(revenue).alias("total_revenue_generated"),
            rounding.to_mean(ratio(revenue, cost)).alias("revenue_per_rupee_spent"),
        )
        .orderBy(F.desc("revenue_per_rupee_spent"), "channel")
    )


def discount_effectiveness(
    orders: DataFrame,
    *,
    bands: Sequence[tuple[Callable[[Column], Column], str]] = DISCOUNT_BANDS,
    deepest: str = DEEPEST_DISCOUNT,
    cancelled: str = "Cancelled",
    rounding: Rounding = PUBLISHED,
) -> DataFrame:
    """Order value and cancellation rate by discount band; an unknown discount falls in the last."""
    return (
        orders.groupBy(
            banded(F.col("discount_percentage"), bands, deepest).alias("discount_band")
        )
        .agg(
            rows().alias("orders"),
            rounding.to_money(F.avg("final_amount")).alias("avg_order_value"),
            rounding.to_mean(share_pct(F.col("order_status") == cancelled)).alias("cancel_rate_pct"),
        )
        .orderBy("discount_band")
    )
