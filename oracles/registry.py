"""All oracle queries by name."""

from __future__ import annotations

from oracles.audit import audit_sql
from oracles.gold import gold_sql
from oracles.reporting import reporting_sql


# Tables that a second query gives in another way: from merged loads, or by a shuffled lookup.
INCREMENTAL = (
    "revenue_trends channel_performance state_performance discount_effectiveness seasonality_patterns seasonality_by_year "
    "delivery_performance payment_performance review_integrity return_analysis"
).split()
SHUFFLED = ("category_performance", "category_affinity")


def oracle_queries() -> dict[str, str]:
    gold = gold_sql()
    again = {f"incremental_{n}": gold[n] for n in INCREMENTAL} | {f"{n}_shuffled": gold[n] for n in SHUFFLED}
    return {**gold, **again, **audit_sql(), **reporting_sql()}
