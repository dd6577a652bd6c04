"""Derived tables as mergeable partial aggregates, so that new rows alone bring them up to date.

A rollup splits a derived table into three steps: `partial` folds some rows to sums and counts per
key, `merge` adds partials up, and `finish` turns the sums into the table. Sums and counts of
two loads add up whatever the split. Distinct counts do not; for these the keys seen before are
kept, and a load counts only the keys it brings for the first time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.measures import PUBLISHED, Rounding, banded, month_start, pct, ratio, rows
from tradewind.operators.opportunities import DEEPEST_DISCOUNT, DISCOUNT_BANDS
from tradewind.operators.patterns import EXCLUDED_STATUS

Columns = Callable[[], dict[str, Column]]
Finish = Callable[[DataFrame, Rounding, Mapping[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class Rollup:
    """A derived table over one fact. `distinct` names a count and the column it counts."""

    fact: str
    keys: Columns
    sums: Columns
    finish: Finish
    distinct: Mapping[str, str] = field(default_factory=dict)
    where: Callable[[], Column] | None = None

    def rows_of(self, fact: DataFrame) -> DataFrame:
        return fact if self.where is None else fact.where(self.where())

    def key_names(self) -> list[str]:
        return list(self.keys())


def partial(fact: DataFrame, rollup: Rollup, by: Sequence[Column] = ()) -> DataFrame:
    """Sums and counts of these rows per key (and per `by`), without the distinct counts."""
    keys = [c.alias(n) for n, c in rollup.keys().items()]
    return rollup.rows_of(fact).groupBy(*by, *keys).agg(*[c.alias(n) for n, c in rollup.sums().items()])


def keyed_values(fact: DataFrame, rollup: Rollup, column: str, *more: Column) -> DataFrame:
    """Key columns and `_value`, one row per row with a value."""
    keys = [c.alias(n) for n, c in rollup.keys().items()]
    return rollup.rows_of(fact).where(F.col(column).isNotNull()).select(*keys, F.col(column).alias("_value"), *more)


def counted(keys: DataFrame, rollup: Rollup, name: str, by: Sequence[str] = ()) -> DataFrame:
    """First-seen keys as a partial of the distinct count `name`."""
    return keys.groupBy(*by, *rollup.key_names()).agg(rows().alias(name))


def together(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def unseen(keys: DataFrame, seen: DataFrame, rollup: Rollup) -> DataFrame:
    """Keyed values that `seen` does not hold."""
    a, b = keys.alias("a"), seen.alias("b")
    same = [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in rollup.key_names()]
    return a.join(b, reduce(Column.__and__, same, F.col("a._value") == F.col("b._value")), "left_anti")


def partials_of_loads(fact: DataFrame, rollup: Rollup, load: Column) -> DataFrame:
    """The partials that loads of the fact leave, one load per value of `load`, smaller values first."""
    parts = [partial(fact, rollup, [load.alias("_load")])]
    for name, column in rollup.distinct.items():
        values = keyed_values(fact, rollup, column, load.alias("_at"))
        first = values.groupBy(*rollup.key_names(), "_value").agg(F.min("_at").alias("_load"))
        parts.append(counted(first, rollup, name, ["_load"]))
    return together(parts)


def merge(partials: DataFrame, rollup: Rollup) -> DataFrame:
    """One row per key: the partials added up. Distinct counts without a partial are 0."""
    sums = [F.sum(n).alias(n) for n in rollup.sums()]
    counts = [F.coalesce(F.sum(n), F.lit(0).cast("long")).alias(n) for n in rollup.distinct]
    return partials.groupBy(*rollup.key_names()).agg(*sums, *counts)


def finished(
    partials: DataFrame, rollup: Rollup, *, star: Mapping[str, DataFrame] | None = None, rounding: Rounding = PUBLISHED
) -> DataFrame:
    """The derived table of all partials; `star` has the dimensions that the table needs."""
    return rollup.finish(merge(partials, rollup), rounding, star or {})


# -- the tables --------------------------------------------------------------------------------


def _equal(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


def _amounts() -> dict[str, Column]:
    return {"_rows": rows(), "_total": F.sum("final_amount"), "_valued": F.count("final_amount")}


def _mean(total: str, n: str) -> Column:
    return ratio(F.col(total), F.col(n))


def _revenue_trends(t: DataFrame, r: Rounding, star) -> DataFrame:
    return t.select(
        "month", "orders", "unique_customers", r.to_money(F.col("_total")).alias("revenue"),
        r.to_money(_mean("_total", "_valued")).alias("avg_order_value"), "cancelled_orders", "failed_orders", "delivered_orders",
        r.to_mean(pct(F.col("delivered_orders"), F.col("_rows"))).alias("delivered_pct")).orderBy("month")


def _channel_performance(t: DataFrame, r: Rounding, star) -> DataFrame:
    return t.select(
        "marketing_channel", F.col("_rows").alias("orders"), r.to_money(F.col("_total")).alias("revenue"),
        r.to_money(_mean("_total", "_valued")).alias("avg_order_value"),
        r.to_mean(_mean("_discount", "_discounted")).alias("avg_discount_pct")).orderBy(F.desc("revenue"), "marketing_channel")


def _state_performance(t: DataFrame, r: Rounding, star) -> DataFrame:
    return t.select(
        "delivery_state", F.col("_rows").alias("orders"), r.to_money(F.col("_total")).alias("revenue"),
        r.to_money(_mean("_total", "_valued")).alias("avg_order_value")).orderBy(F.desc("revenue"), "delivery_state")


def _discount_effectiveness(t: DataFrame, r: Rounding, star) -> DataFrame:
    return t.select(
        "discount_band", F.col("_rows").alias("orders"), r.to_money(_mean("_total", "_valued")).alias("avg_order_value"),
        r.to_mean(pct(F.col("_cancelled"), F.col("_rows"))).alias("cancel_rate_pct")).orderBy("discount_band")


def _seasonality_patterns(t: DataFrame, r: Rounding, star) -> DataFrame:
    return t.select(
        "month_num", "month_name", F.col("_rows").alias("orders"), r.to_money(_mean("_total", "_valued")).alias("avg_order_value"),
        r.to_crore(F.col("_total"), 1).alias("revenue_cr")).orderBy("month_num")


def _seasonality_by_year(t: DataFrame, r: Rounding, star) -> DataFrame:
    return t.select(
        "order_year", "month_num", "month_name", F.col("_rows").alias("orders"), r.to_crore(F.col("_total")).alias("revenue_cr"),
        r.to_money(_mean("_total", "_valued")).alias("avg_order_value")).orderBy("order_year", "month_num")


def _delivery_performance(t: DataFrame, r: Rounding, star) -> DataFrame:
    return t.select(
        "warehouse_city", "shipping_method", F.col("_rows").alias("shipments"),
        r.to_mean(_mean("_days", "_timed")).alias("avg_delivery_days"), "delayed_shipments",
        r.to_mean(pct(F.col("delayed_shipments"), F.col("_rows"))).alias("delay_rate_pct")).orderBy(
            F.desc("delay_rate_pct"), "warehouse_city", "shipping_method")


def _payment_performance(t: DataFrame, r: Rounding, star) -> DataFrame:
    return t.select(
        "payment_method", F.col("_rows").alias("payments"), "successful", "failed",
        r.to_mean(pct(F.col("failed"), F.col("_rows"))).alias("failure_rate_pct"),
        r.to_mean(_mean("_fees", "_charged")).alias("avg_transaction_fee"),
        r.to_money(F.col("_refunds")).alias("total_refunded")).orderBy(F.desc("failure_rate_pct"), "payment_method")


def _review_integrity(t: DataFrame, r: Rounding, star) -> DataFrame:
    return t.select(
        "verified_purchase", "review_sentiment", F.col("_rows").alias("reviews"),
        r.to_mean(_mean("_rating", "_rated")).alias("avg_rating")).orderBy(
            F.desc("verified_purchase"), F.desc("reviews"), "review_sentiment")


def _return_analysis(t: DataFrame, r: Rounding, star) -> DataFrame:
    labels = star["dim_product"].select("product_id", "category", "return_rate_baseline")
    known = F.when(F.col("return_rate_baseline").isNotNull(), F.col("_rows"))
    baseline = F.try_divide(F.sum(F.col("return_rate_baseline") * F.col("_rows")), F.sum(known).cast("double"))
    return (
        t.join(labels, "product_id")
        .groupBy("category", "return_reason")
        .agg(
            F.sum("_rows").alias("returns"), r.to_money(F.sum("_refund")).alias("refunded_amount"),
            r.to_mean(baseline * 100).alias("baseline_return_rate_pct"))
        .orderBy(F.desc("returns"), "category", "return_reason")
    )


def _same(*names: str) -> Columns:
    return lambda: {n: F.col(n) for n in names}


def _calendar(*, year: bool) -> Columns:
    def keys():
        date = F.col("order_date")
        found = {"order_year": F.year(date)} if year else {}
        return found | {"month_num": F.month(date), "month_name": F.date_format(date, "MMMM")}

    return keys


ROLLUPS: dict[str, Rollup] = {
    "revenue_trends": Rollup(
        "fact_orders", lambda: {"month": month_start(F.col("order_date"))},
        lambda: _amounts() | {
            "cancelled_orders": _equal("order_status", "Cancelled"), "failed_orders": _equal("order_status", "Failed"),
            "delivered_orders": _equal("order_status", "Delivered")},
        _revenue_trends, {"orders": "order_id", "unique_customers": "customer_id"}),
    "channel_performance": Rollup(
        "fact_orders", _same("marketing_channel"),
        lambda: _amounts() | {"_discount": F.sum("discount_percentage"), "_discounted": F.count("discount_percentage")},
        _channel_performance, where=lambda: F.col("marketing_channel").isNotNull()),
    "state_performance": Rollup("fact_orders", _same("delivery_state"), _amounts, _state_performance),
    "discount_effectiveness": Rollup(
        "fact_orders", lambda: {"discount_band": banded(F.col("discount_percentage"), DISCOUNT_BANDS, DEEPEST_DISCOUNT)},
        lambda: _amounts() | {"_cancelled": _equal("order_status", "Cancelled")}, _discount_effectiveness),
    "seasonality_patterns": Rollup(
        "fact_orders", _calendar(year=False), _amounts, _seasonality_patterns, where=lambda: F.col("order_status") != EXCLUDED_STATUS),
    "seasonality_by_year": Rollup("fact_orders", _calendar(year=True), _amounts, _seasonality_by_year),
    "delivery_performance": Rollup(
        "fact_shipments", _same("warehouse_city", "shipping_method"),
        lambda: {"_rows": rows(), "_days": F.sum("delivery_days"), "_timed": F.count("delivery_days"),
                 "delayed_shipments": F.sum("delayed_flag")},
        _delivery_performance),
    "payment_performance": Rollup(
        "fact_payments", _same("payment_method"),
        lambda: {"_rows": rows(), "successful": _equal("payment_status", "Success"), "failed": _equal("payment_status", "Failed"),
                 "_fees": F.sum("transaction_fee"), "_charged": F.count("transaction_fee"), "_refunds": F.sum("refund_amount")},
        _payment_performance),
    "review_integrity": Rollup(
        "fact_reviews", _same("verified_purchase", "review_sentiment"),
        lambda: {"_rows": rows(), "_rating": F.sum("rating"), "_rated": F.count("rating")}, _review_integrity),
    "return_analysis": Rollup(
        "fact_returns", _same("product_id", "return_reason"), lambda: {"_rows": rows(), "_refund": F.sum("refund_amount")},
        _return_analysis),
}
