"""Column tags, table properties and comments, and the inventory of tagged columns.

Tags describe columns; they mask nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Tagged columns and tables.
COLUMN_TAGS: dict[tuple[str, str], dict[str, str]] = {
    ("dim_customer", "customer_id"): {"pii": "pseudonymous_id", "sensitivity": "confidential"},
    ("dim_customer", "city"): {"pii": "location", "sensitivity": "internal"},
    ("dim_customer", "pincode_prefix"): {"pii": "location", "sensitivity": "internal"},
    ("fact_orders", "customer_id"): {"pii": "pseudonymous_id", "sensitivity": "confidential"},
}
TABLE_TAGS: dict[str, dict[str, str]] = {
    "dim_customer": {"layer": "silver", "domain": "customer", "contains_pii": "true"},
    "segment_performance": {"layer": "gold", "domain": "customer", "contains_pii": "false"},
}

TABLE_COMMENTS: dict[str, str] = {
    "fact_order_items": (
        "One row per order_item_id. A product may stand on several lines of one order: sum to "
        "(order_id, product_id) before joining on that pair."
    ),
    "product_true_profitability": (
        "One row per product. Above 100 in refund_pct_of_profit, refunds exceed the profit."
    ),
    "campaign_targeting_precision": (
        "One row per target segment: the share of its campaigns' orders that came from it."
    ),
    "delay_impact_on_experience": "One row per delivery outcome, counted by order.",
    "channel_efficiency": "Campaign revenue per unit of campaign cost, by channel.",
    "discount_effectiveness": "Order value and cancellation rate by discount band.",
    "cohort_retention": "Signup-month cohorts and their activity 1, 3 and 6 months later.",
    "rfm_segmentation": "Average recency, frequency and monetary quartile by customer segment.",
    "category_affinity": "Orders that hold both categories of a pair.",
    "seasonality_patterns": "Calendar months over all years: read next to seasonality_by_year.",
    "repeat_purchase_timing": "Days from first to second order.",
    "sentiment_by_category": "Rating and negative share of reviews by category.",
    "loyalty_tier_parity": "Spend, churn and shipment delay by loyalty tier.",
    "acquisition_channel_funnel": "Signups that never bought, and lifetime value, by channel.",
    "seasonality_by_year": "Orders and revenue by month of each year.",
    "revenue_forecast": "Next months with 95 % intervals: read next to forecast_accuracy.",
    "forecast_accuracy": "Backtest of the forecast by month.",
    "reactivation_targets": "Repeat customers against their own order rhythm.",
    "reactivation_summary": "Size and value of each overdue tier.",
    "join_safety": "Rows against distinct keys: fan-out above 0 means aggregate before joining.",
    "validation_log": "Raw rows that fail each rule; raw rows are never dropped.",
    "validation_rejects": "Raw rows, kept rows and rejects per typed table.",
}


def tag_columns(
    tables: Mapping[str, DataFrame], tags: Mapping[tuple[str, str], Mapping[str, str]] = COLUMN_TAGS
) -> dict[str, DataFrame]:
    """The tables with the tags in their column metadata; absent tables and columns are skipped.

    Metadata follows a column through select, filter and parquet.
    """
    tagged = dict(tables)
    for (table, column), values in tags.items():
        if table in tagged and column in tagged[table].columns:
            old = tagged[table].schema[column].metadata
            tagged[table] = tagged[table].withMetadata(column, {**old, **values})
    return tagged


def pii_inventory(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, pii, sensitivity) of every tagged column, from the schemas alone."""
    found = [
        (name, f.name, f.metadata["pii"], f.metadata.get("sensitivity"))
        for name, frame in tables.items()
        for f in frame.schema.fields
        if "pii" in f.metadata
    ]
    return spark.createDataFrame(
        found, "table_name string, column_name string, pii string, sensitivity string"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(identifier: str) -> str:
    return ".".join(f"`{part}`" for part in identifier.split("."))


def tag_tables(
    spark: SparkSession, identifiers: Mapping[str, str], tags: Mapping[str, Mapping[str, str]] = TABLE_TAGS
) -> None:
    """Sets table properties on catalog tables; `identifiers` maps our names to catalog names."""
    for table, values in tags.items():
        if table in identifiers:
            listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in values.items())
            spark.sql(f"ALTER TABLE {_name(identifiers[table])} SET TBLPROPERTIES ({listed})")


def comment_tables(
    spark: SparkSession, identifiers: Mapping[str, str], comments: Mapping[str, str] = TABLE_COMMENTS
) -> None:
    """Sets comments on catalog tables."""
    for table, text in comments.items():
        if table in identifiers:
            spark.sql(f"COMMENT ON TABLE {_name(identifiers[table])} IS {_quoted(text)}")
