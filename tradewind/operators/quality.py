"""Cross-table quality checks and the join-key safety map."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.ledger import rows_from_columns, stack_sources, with_keys
from tradewind.functions.measures import PUBLISHED, Rounding, pct, rows

# Names of the checks. The descriptions are free text.
CHECKS: dict[str, str] = {
    "orders_without_payment": "Orders that have no payment at all",
    "delivered_without_shipment": "Delivered orders that have no shipment",
    "failed_orders_with_payment": "Pairs of a failed order and a successful payment for it",
    "zero_final_amount": "Orders whose final amount is zero",
    "future_dated_orders": "Orders dated after the as-of date",
    "delivery_before_dispatch": "Shipments delivered before they were dispatched",
    "duplicate_order_ids": "order_id values that occur on more than one order",
    "duplicate_return_ids": "return_id values that occur on more than one return",
    "refund_exceeds_item_revenue": "Order and product pairs refunded beyond their revenue",
    "orphaned_order_items": "Order items whose product is unknown",
}

# The candidate keys tested per table.
JOIN_KEYS: dict[str, tuple[tuple[str, ...], ...]] = {
    "fact_orders": (("order_id",),),
    "fact_order_items": (("order_item_id",), ("order_id", "product_id"), ("order_id",)),
    "fact_payments": (("order_id",),),
    "fact_shipments": (("order_id",),),
    "fact_returns": (("order_id", "product_id"), ("order_id",)),
    "fact_reviews": (("order_id", "product_id"), ("order_id",)),
}


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("long")


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


def _order_checks(
    orders: DataFrame, payments: DataFrame, shipments: DataFrame, as_of: Column, delivered: str,
    failed: str, success: str,
) -> DataFrame:
    """Counts of all checks keyed by order: one shuffle over the three tables."""
    status = F.col("order_status")
    one = F.lit(1).cast("long")
    # A NULL key matches nothing, so it may not meet the orders; it still is a row.
    keyed = _flag(F.col("order_id").isNotNull())
    late = F.col("actual_delivery_date") < F.col("dispatch_date")
    per_order = (
        stack_sources(
            [
                (orders, {
                    "orders": one,
                    "delivered": _flag(status == delivered),
                    "failed": _flag(status == failed),
                    "zero": _flag(F.col("final_amount") == 0),
                    "future": _flag(F.col("order_date") > as_of),
                }),
                (with_keys(payments, ["order_id"]), {
                    "paid": one,
                    "paid_ok": _flag(F.col("payment_status") == success),
                }),
                (shipments, {"shipped": keyed, "shipments": one, "late": _flag(late)}),
            ],
            ["order_id"],
        )
        .groupBy("order_id")
        .agg(*[
            _total(m).alias(m)
            for m in (
                "orders", "delivered", "failed", "zero", "future",
                "paid", "paid_ok", "shipped", "shipments", "late",
            )
        ])
    )
    return per_order.agg(
        _total("orders").alias("orders"),
        _total("delivered").alias("delivered"),
        _total("failed").alias("failed"),
        _total("zero").alias("zero"),
        _total("future").alias("future"),
        _total("shipments").alias("shipments"),
        _total("late").alias("late"),
        F.coalesce(F.sum(F.when(F.col("paid") == 0, F.col("orders"))), F.lit(0)).alias("unpaid"),
        F.coalesce(F.sum(F.when(F.col("shipped") == 0, F.col("delivered"))), F.lit(0)).alias("unshipped"),
        F.coalesce(F.sum(F.col("failed") * F.col("paid_ok")), F.lit(0)).alias("failed_paid"),
        F.count_if(F.col("orders") > 1).alias("repeated"),
    )


def _refund_checks(returns: DataFrame, items: DataFrame, tolerance: float) -> DataFrame:
    """(order, product) pairs refunded beyond their revenue; both sides summed before they meet."""
    pair = ["order_id", "product_id"]
    one = F.lit(1)
    per_pair = (
        stack_sources(
            [
                (with_keys(returns, pair), {"returned": one, "refund": F.col("refund_amount")}),
                (with_keys(items, pair), {"sold": one, "revenue": F.col("item_revenue")}),
            ],
            pair,
        )
        .groupBy(*pair)
        .agg(
            F.max("returned").alias("returned"),
            F.max("sold").alias("sold"),
            F.sum("refund").alias("refund"),
            F.sum("revenue").alias("revenue"),
        )
    )
    both = (F.col("returned") == 1) & (F.col("sold") == 1)
    return per_pair.agg(F.count_if(both & (F.col("refund") > F.col("revenue") + tolerance)).alias("over"))


def _repeated_returns(returns: DataFrame) -> DataFrame:
    per_id = returns.groupBy("return_id").agg(rows().alias("n"))
    return per_id.agg(F.count_if(F.col("n") > 1).alias("repeated"), _total("n").alias("returns"))


def _orphaned_items(items: DataFrame, products: DataFrame) -> DataFrame:
    one = F.lit(1).cast("long")
    per_product = (
        stack_sources(
            [(items, {"items": one}), (with_keys(products, ["product_id"]), {"known": one})],
            ["product_id"],
        )
        .groupBy("product_id")
        .agg(_total("items").alias("items"), F.max("known").alias("known"))
    )
    orphaned = F.sum(F.when(F.col("known").isNull(), F.col("items")))
    return per_product.agg(
        F.coalesce(orphaned, F.lit(0)).alias("orphaned"), _total("items").alias("items")
    )


def data_quality(
    star: Mapping[str, DataFrame],
    as_of: Column,
    *,
    delivered: str = "Delivered",
    failed: str = "Failed",
    success: str = "Success",
    tolerance: float = 1.0,
    rounding: Rounding = PUBLISHED,
) -> DataFrame:
    """Ten checks as (check_name, description, affected_rows, pct_affected).

    Each percentage has its own base: all orders, delivered or failed orders, shipments,
    returns or items. A base of 0 gives NULL.
    """
    by_order = _order_checks(
        star["fact_orders"], star["fact_payments"], star["fact_shipments"], as_of, delivered,
        failed, success,
    )
    by_pair = _refund_checks(star["fact_returns"], star["fact_order_items"], tolerance)
    by_return = _repeated_returns(star["fact_returns"])
    by_product = _orphaned_items(star["fact_order_items"], star["dim_product"])

    def check(affected: Column, base: Column) -> dict[str, Column]:
        return {"affected_rows": affected.cast("long"), "_base": base.cast("long")}

    c = F.col
    checks = rows_from_columns(by_order, "check_name", [
        ("orders_without_payment", check(c("unpaid"), c("orders"))),
        ("delivered_without_shipment", check(c("unshipped"), c("delivered"))),
        ("failed_orders_with_payment", check(c("failed_paid"), c("failed"))),
        ("zero_final_amount", check(c("zero"), c("orders"))),
        ("future_dated_orders", check(c("future"), c("orders"))),
        ("delivery_before_dispatch", check(c("late"), c("shipments"))),
        ("duplicate_order_ids", check(c("repeated"), c("orders"))),
    ]).unionByName(rows_from_columns(by_return, "check_name", [
        ("duplicate_return_ids", check(c("repeated"), c("returns"))),
    ])).unionByName(rows_from_columns(
        by_pair.withColumn("returns", by_return.select("returns").scalar()), "check_name",
        [("refund_exceeds_item_revenue", check(c("over"), c("returns")))],
    )).unionByName(rows_from_columns(by_product, "check_name", [
        ("orphaned_order_items", check(c("orphaned"), c("items"))),
    ]))
    describe = F.create_map(*[F.lit(x) for pair in CHECKS.items() for x in pair])
    return checks.select(
        "check_name",
        F.element_at(describe, F.col("check_name")).alias("description"),
        "affected_rows",
        rounding.to_mean(pct(c("affected_rows"), c("_base"))).alias("pct_affected"),
    ).orderBy(F.desc("pct_affected"), "check_name")


def key_chains(keys: Sequence[Sequence[str]]) -> list[list[Sequence[str]]]:
    """Candidate keys in chains, finest first, in which each key is part of the one before."""
    chains: list[list[Sequence[str]]] = []
    for key in sorted(keys, key=len, reverse=True):
        chain = next((c for c in chains if set(key) < set(c[-1])), None)
        if chain is None:
            chains.append([key])
        else:
            chain.append(key)
    return chains


def key_safety(table: str, frame: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """Rows, distinct keys and their difference for each candidate key of one table.

    Keys that contain one another are counted together: the rows are grouped by the finest, its
    groups by the next coarser one, and so on, each step carrying the numbers of groups before
    it. That takes one scan a chain, and every shuffle after the first carries groups, combined
    map-side, so a value with very many rows stays one row per map task. A value of a single
    column must be present to count; a combination counts also with missing parts.
    """
    parts = []
    for chain in key_chains(keys):
        grouped = frame.groupBy(*chain[0]).agg(rows().alias("_n"))
        for i, columns in enumerate(chain):
            if i:
                grouped = grouped.groupBy(*columns).agg(
                    F.sum("_n").alias("_n"), *[F.sum(f"_d{j}").alias(f"_d{j}") for j in range(i)])
            present = F.col(columns[0]).isNotNull() if len(columns) == 1 else F.lit(True)
            grouped = grouped.withColumn(f"_d{i}", present.cast("long"))
        totals = grouped.agg(_total("_n").alias("_n"), *[_total(f"_d{i}").alias(f"_d{i}") for i in range(len(chain))])
        parts.append(rows_from_columns(totals, "candidate_key", [
            (" + ".join(columns), {
                "rows": F.col("_n"),
                "distinct_keys": F.col(f"_d{i}"),
                "fanout_rows": F.col("_n") - F.col(f"_d{i}"),
            })
            for i, columns in enumerate(chain)
        ]).select(F.lit(table).alias("table_name"), "candidate_key", "rows", "distinct_keys", "fanout_rows"))
    return reduce(DataFrame.unionByName, parts)


def join_safety(
    star: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[Sequence[str]]] = JOIN_KEYS,
) -> DataFrame:
    """Which keys may be joined on directly: fan-out 0 is safe, more means aggregate first."""
    parts = [key_safety(t, star[t], k) for t, k in keys.items()]
    return reduce(DataFrame.unionByName, parts).orderBy(
        F.desc("fanout_rows"), "table_name", "candidate_key"
    )
