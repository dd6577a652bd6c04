"""The derived tables by layer, each as a function of the typed star."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.measures import PUBLISHED, Rounding
from tradewind.operators import descriptive as d
from tradewind.operators import forecast as f
from tradewind.operators import opportunities as o
from tradewind.operators import patterns as p
from tradewind.operators import quality as q

Star = Mapping[str, DataFrame]


@dataclass
class Context:
    """Arguments shared by the derived tables of one run."""

    star: Star
    as_of: Column
    cutoff: Column
    rounding: Rounding = PUBLISHED
    made: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        """A derived table, built on first use; a table already written is used as it is."""
        if name not in self.made:
            self.made[name] = BUILDERS[name](self)
        return self.made[name]


Builder = Callable[[Context], DataFrame]

GOLD: dict[str, Builder] = {
    "revenue_trends": lambda x: d.revenue_trends(x.star["fact_orders"], rounding=x.rounding),
    "category_performance": lambda x: d.category_performance(
        x.star["fact_order_items"], x.star["dim_product"], rounding=x.rounding),
    "segment_performance": lambda x: d.segment_performance(x.star["dim_customer"], rounding=x.rounding),
    "channel_performance": lambda x: d.channel_performance(x.star["fact_orders"], rounding=x.rounding),
    "campaign_roi": lambda x: d.campaign_roi(x.star["dim_campaign"], rounding=x.rounding),
    "delivery_performance": lambda x: d.delivery_performance(x.star["fact_shipments"], rounding=x.rounding),
    "return_analysis": lambda x: d.return_analysis(
        x.star["fact_returns"], x.star["dim_product"], rounding=x.rounding),
    "payment_performance": lambda x: d.payment_performance(x.star["fact_payments"], rounding=x.rounding),
    "state_performance": lambda x: d.state_performance(x.star["fact_orders"], rounding=x.rounding),
    "review_integrity": lambda x: d.review_integrity(x.star["fact_reviews"], rounding=x.rounding),
    "data_quality": lambda x: q.data_quality(x.star, x.as_of, rounding=x.rounding),
    "join_safety": lambda x: q.join_safety(x.star),
}

OPPORTUNITIES: dict[str, Builder] = {
    "product_true_profitability": lambda x: o.product_true_profitability(
        x.star["fact_order_items"], x.star["fact_returns"], x.star["dim_product"], rounding=x.rounding),
    "campaign_targeting_precision": lambda x: o.campaign_targeting_precision(
        x.star["fact_orders"], x.star["dim_campaign"], x.star["dim_customer"], rounding=x.rounding),
    "delay_impact_on_experience": lambda x: o.delay_impact_on_experience(
        x.star["fact_shipments"], x.star["fact_reviews"], x.star["fact_returns"], rounding=x.rounding),
    "channel_efficiency": lambda x: o.channel_efficiency(x.star["dim_campaign"], rounding=x.rounding),
    "discount_effectiveness": lambda x: o.discount_effectiveness(x.star["fact_orders"], rounding=x.rounding),
}

PATTERNS: dict[str, Builder] = {
    "cohort_retention": lambda x: p.cohort_retention(
        x.star["dim_customer"], x.star["fact_orders"], rounding=x.rounding),
    "rfm_segmentation": lambda x: p.rfm_segmentation(
        x.star["fact_orders"], x.star["dim_customer"], x.as_of, rounding=x.rounding),
    "category_affinity": lambda x: p.category_affinity(x.star["fact_order_items"], x.star["dim_product"]),
    "seasonality_patterns": lambda x: p.seasonality_patterns(x.star["fact_orders"], rounding=x.rounding),
    "repeat_purchase_timing": lambda x: p.repeat_purchase_timing(
        x.star["fact_orders"], x.star["dim_customer"], rounding=x.rounding),
    "sentiment_by_category": lambda x: p.sentiment_by_category(
        x.star["fact_reviews"], x.star["dim_product"], rounding=x.rounding),
    "loyalty_tier_parity": lambda x: p.loyalty_tier_parity(
        x.star["dim_customer"], x.star["fact_orders"], x.star["fact_shipments"], rounding=x.rounding),
    "acquisition_channel_funnel": lambda x: p.acquisition_channel_funnel(
        x.star["dim_customer"], rounding=x.rounding),
}

FORECAST: dict[str, Builder] = {
    "seasonality_by_year": lambda x: f.seasonality_by_year(x.star["fact_orders"], rounding=x.rounding),
    "revenue_forecast": lambda x: f.revenue_forecast(x.star["fact_orders"], rounding=x.rounding),
    "forecast_accuracy": lambda x: f.forecast_accuracy(x.star["fact_orders"], x.cutoff, rounding=x.rounding),
    "forecast_accuracy_summary": lambda x: f.forecast_accuracy_summary(
        x.table("forecast_accuracy"), rounding=x.rounding),
    "reactivation_targets": lambda x: f.reactivation_targets(
        x.star["fact_orders"], x.star["dim_customer"], as_of=x.as_of, rounding=x.rounding),
    "reactivation_summary": lambda x: f.reactivation_summary(
        x.table("reactivation_targets"), rounding=x.rounding),
}

BUILDERS: dict[str, Builder] = {**GOLD, **OPPORTUNITIES, **PATTERNS, **FORECAST}


def context(
    star: Star, as_of: Column | None = None, cutoff: Column | None = None,
    rounding: Rounding = PUBLISHED,
) -> Context:
    """Defaults: as-of is the latest order date, the backtest holds out that date's year."""
    latest = star["fact_orders"].agg(F.max("order_date"))
    today = as_of if as_of is not None else latest.scalar()
    start = cutoff if cutoff is not None else F.trunc(today, "year")
    return Context(star, today, start, rounding)
