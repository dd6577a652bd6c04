"""Oracle SQL of the audit: the profile and each kind of finding, on the star and the raw tables."""

from __future__ import annotations

import re
from itertools import combinations

from oracles.base import STAR, with_tables

AS_OF = "DATE '2001-08-01'"

# table -> column: type
STAR_COLUMNS = {
    "dim_customer": {
        "customer_id": "bigint", "signup_date": "date", "state": "string", "customer_segment": "string",
        "acquisition_channel": "string", "total_orders": "int", "total_spend": "double",
        "last_order_date": "date", "average_order_value": "double", "customer_status": "string",
        "loyalty_tier": "string"},
    "dim_product": {
        "product_id": "bigint", "product_name": "string", "category": "string", "brand": "string",
        "price": "double", "cost_price": "double", "rating_average": "double",
        "return_rate_baseline": "double"},
    "dim_campaign": {
        "campaign_id": "bigint", "campaign_name": "string", "channel": "string",
        "target_segment": "string", "conversions": "bigint", "impressions": "bigint",
        "clicks": "bigint", "campaign_cost": "double", "revenue_generated": "double", "roi": "double"},
    "fact_orders": {
        "order_id": "bigint", "customer_id": "bigint", "order_date": "date", "order_status": "string",
        "delivery_state": "string", "discount_percentage": "double", "marketing_channel": "string",
        "final_amount": "double", "campaign_id": "bigint"},
    "fact_order_items": {
        "order_item_id": "string", "order_id": "bigint", "product_id": "bigint", "quantity": "int",
        "unit_price": "double", "discount_percentage": "double", "item_revenue": "double",
        "item_cost": "double", "profit": "double"},
    "fact_payments": {
        "payment_id": "bigint", "order_id": "bigint", "payment_date": "date",
        "payment_method": "string", "payment_status": "string", "amount_paid": "double",
        "transaction_fee": "double", "refund_amount": "double"},
    "fact_shipments": {
        "shipment_id": "string", "order_id": "bigint", "warehouse_city": "string",
        "shipping_method": "string", "dispatch_date": "date", "actual_delivery_date": "date",
        "delivery_days": "double", "delayed_flag": "int"},
    "fact_returns": {
        "return_id": "string", "order_id": "bigint", "customer_id": "bigint", "product_id": "bigint",
        "return_date": "date", "return_reason": "string", "refund_amount": "double"},
    "fact_reviews": {
        "review_id": "bigint", "order_id": "bigint", "customer_id": "bigint", "product_id": "bigint",
        "review_date": "date", "rating": "int", "review_sentiment": "string",
        "verified_purchase": "boolean"},
}

SAMPLE_COLUMNS = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {
        "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
        "c_mktsegment": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {
        "p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
        "p_size": "int", "p_retailprice": "double"},
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
        "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
        "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
        "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
    "events": {
        "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
        "value": "double", "props": "string"},
    "documents": {
        "doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "embeddings": {"vec_id": "bigint", "embedding": "array", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
}

SAMPLE_FOREIGN_KEYS = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("labels", "doc_id", "documents", "doc_id"),
]

NUMBERS = {"int", "bigint", "double"}
DATES = {"date", "timestamp_ntz"}
AMOUNT = "amount|price|revenue|cost|spend|profit|fee|refund|value|qty|quantity|count|orders|sessions|units"
PERCENT = "_pct|percent|percentage|_rate$|rate_pct"


class Audited:
    """Oracle text for one set of tables."""

    def __init__(self, columns: dict[str, dict[str, str]], ids: str, foreign_keys=None):
        self.columns = columns
        self.ids = ids
        self.foreign_keys = foreign_keys

    def is_id(self, column: str) -> bool:
        return re.search(self.ids, column) is not None

    def base(self, body: str) -> str:
        names = [t for t in self.columns if t in STAR]
        return with_tables(" ".join(names), body) if names else body

    def profile(self) -> str:
        parts = []
        for table, columns in self.columns.items():
            for at, (column, kind) in enumerate(columns.items()):
                is_id = "TRUE" if self.is_id(column) else "FALSE"
                parts.append(
                    f"SELECT '{table}' AS table_name, '{column}' AS column_name, {at} AS position,"
                    f" '{kind}' AS data_type, COUNT(*) AS total, COUNT({column}) AS filled,"
                    f" COUNT(DISTINCT {column}) AS kinds, {is_id} AS is_id FROM {table}"
                )
        return "\nUNION ALL\n".join(parts)

    def profile_query(self) -> str:
        return self.base(f"""
            SELECT table_name, column_name, position, data_type, total AS rows, filled AS non_null,
                   kinds AS "distinct" FROM ({self.profile()})""")

    def _rows(self, severity: int, kind: str, table: str, column: str, hit: str, total: str, detail: str) -> str:
        return (
            f"SELECT {severity} AS severity, '{kind}' AS kind, {table} AS table_name, {column} AS column_name,"
            f" {hit} AS affected_rows, {total} AS total_rows, {detail} AS detail"
        )

    def from_profile(self) -> dict[str, str]:
        r = self._rows
        return {
            "PK": r(4, "PK", "table_name", "column_name", "total", "total", "'unique and never null'")
            + " FROM prof WHERE total > 0 AND filled = total AND kinds = total",
            "NO-PK": r(2, "NO-PK", "table_name", "'-'", "MAX(total)", "MAX(total)", "'no single column is unique'")
            + " FROM prof GROUP BY table_name HAVING NOT BOOL_OR(total > 0 AND filled = total AND kinds = total)",
            "CONSTANT": r(3, "CONSTANT", "table_name", "column_name", "filled", "total", "'one value only'")
            + " FROM prof WHERE kinds = 1",
            "NULLS": r(3, "NULLS", "table_name", "column_name", "total - filled", "total", "'mostly null'")
            + " FROM prof WHERE total > 0 AND filled < 0.5 * total",
            "NEAR-KEY": r(2, "NEAR-KEY", "table_name", "column_name", "total - kinds", "total",
                          "'almost unique, but repeats'")
            + " FROM prof WHERE is_id AND kinds < total AND kinds > 0.9 * total",
            "CARTESIAN": self.cartesian(),
        }

    def cartesian(self) -> str:
        order = list(self.columns)
        position = " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(order))
        return (
            self._rows(1, "CARTESIAN", "x.table_name || ' x ' || y.table_name", "x.column_name",
                       "CAST(NULL AS BIGINT)", "CAST(NULL AS BIGINT)",
                       "'repeats in both tables: aggregate each side before joining'")
            + f""" FROM prof x JOIN prof y ON x.column_name = y.column_name AND x.is_id AND y.is_id
                   AND x.kinds < x.total AND y.kinds < y.total
                   AND CASE x.table_name {position} END < CASE y.table_name {position} END"""
        )

    def fanout(self) -> str:
        parts = []
        for table, columns in self.columns.items():
            for a, b in combinations([c for c in columns if self.is_id(c)], 2):
                parts.append(self._rows(
                    2, "FANOUT", f"'{table}'", f"'{a} + {b}'", f"COUNT(*) - COUNT(DISTINCT ({a}, {b}))",
                    "COUNT(*)", "'pair does not identify a row'") + f" FROM {table}")
        return "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE affected_rows > 0"

    def orphans(self) -> str:
        declared = self.foreign_keys is not None
        keys = self.foreign_keys if declared else [
            (t, c, p, c)
            for t, columns in self.columns.items() for c in columns if self.is_id(c)
            for p in self.columns if p != t and c in self.columns[p]
        ]
        parts = []
        for child, column, parent, key in keys:
            condition = (
                f"{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"
            )
            parts.append(
                self._rows(1, "ORPHAN", f"'{child}'", f"'{column}'", f"COUNT(*) FILTER (WHERE {condition})",
                           "COUNT(*)", f"'no row in {parent}'")
                + f", '{parent}' AS parent, '{key}' AS parent_key FROM {child} c"
            )
        body = (
            "SELECT severity, kind, table_name, column_name, affected_rows, total_rows, detail FROM ("
            + "\nUNION ALL\n".join(parts) + ") WHERE affected_rows > 0"
        )
        if declared:
            return body
        # Only a parent's own primary key counts: the first unique id column, else the first unique one.
        return body + """ AND (parent, parent_key) IN (
            SELECT (table_name, ARG_MIN(column_name, position + CASE WHEN is_id THEN 0 ELSE 1000 END))
            FROM prof WHERE total > 0 AND filled = total AND kinds = total GROUP BY table_name)"""

    def values(self, kind: str) -> str:
        label = {"NEGATIVE": "below zero", "RANGE": "outside 0 to 100", "FUTURE": "after the as-of date"}
        parts = []
        for table, columns in self.columns.items():
            for column, data_type in columns.items():
                percent = re.search(PERCENT, column) is not None
                amount = re.search(AMOUNT, column) is not None and not percent
                test = {
                    "NEGATIVE": f"{column} < 0" if data_type in NUMBERS and amount else None,
                    "RANGE": f"{column} NOT BETWEEN 0 AND 100" if data_type in NUMBERS and percent else None,
                    "FUTURE": f"{column} > {AS_OF}" if data_type in DATES else None,
                }[kind]
                if test:
                    parts.append(self._rows(
                        2, kind, f"'{table}'", f"'{column}'", f"COUNT(*) FILTER (WHERE {test})", "COUNT(*)",
                        f"'{label[kind]}'") + f" FROM {table}")
        if not parts:
            return self._rows(2, kind, "''", "''", "0", "0", "''") + " WHERE FALSE"
        return "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE affected_rows > 0"

    def kind(self, kind: str) -> str:
        bodies = {
            **self.from_profile(), "FANOUT": self.fanout(), "ORPHAN": self.orphans(),
            **{k: self.values(k) for k in ("NEGATIVE", "RANGE", "FUTURE")},
        }
        return bodies[kind]

    def query(self, *kinds: str, summary: bool = False) -> str:
        union = "\nUNION ALL\n".join(f"({self.kind(k)})" for k in kinds)
        body = f"SELECT * FROM ({union})"
        if summary:
            body = f"SELECT severity, kind, COUNT(*) AS findings FROM ({union}) GROUP BY severity, kind"
        return self.base(f"WITH prof AS ({self.profile()})\n{body}")


ALL = ("ORPHAN", "CARTESIAN", "FANOUT", "NEAR-KEY", "NO-PK", "NEGATIVE", "RANGE", "FUTURE", "CONSTANT", "NULLS", "PK")


def audit_sql() -> dict[str, str]:
    star = Audited(STAR_COLUMNS, r"(_id$|^id$)")
    sample = Audited(SAMPLE_COLUMNS, r"(_id$|^id$|key$)", SAMPLE_FOREIGN_KEYS)
    out = {f"audit_{k.lower().replace('-', '_')}": star.query(k) for k in ALL}
    out["audit_model"] = star.query(*ALL)
    out["audit_summary"] = star.query(*ALL, summary=True)
    out["audit_sample_tables"] = sample.query(*ALL)
    out["profile_tables"] = sample.profile_query()
    out["profile_star"] = star.profile_query()
    return out
