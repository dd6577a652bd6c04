"""The nine source tables: raw column names, typed targets, keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """A source column. `kind` names its conversion, `to` its typed name if it differs."""

    name: str
    kind: str = "text"
    to: str | None = None

    @property
    def target(self) -> str:
        return self.to or self.name


@dataclass(frozen=True)
class Source:
    raw: str
    typed: str
    key: str
    fields: tuple[Field, ...]

    def raw_schema(self) -> T.StructType:
        """All strings: casting at ingest would destroy the evidence of a bad value."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])


def _fields(*specs: str) -> tuple[Field, ...]:
    out = []
    for spec in specs:
        name, _, rest = spec.partition(":")
        kind, _, to = rest.partition(">")
        out.append(Field(name, kind or "text", to or None))
    return tuple(out)


# Table and column names of the data model, in source order.
# "name:kind>typed_name"; no kind means text.
CUSTOMERS = Source("customers", "dim_customer", "customer_id", _fields(
    "customer_id", "customer_signup_date:date>signup_date", "gender", "age:int_from_decimal",
    "age_group", "state", "city", "pincode_prefix", "customer_segment", "preferred_device",
    "preferred_payment_method", "acquisition_channel", "total_orders:int",
    "total_spend:double", "last_order_date:date", "average_order_value:double",
    "customer_status", "loyalty_tier",
))
PRODUCTS = Source("products", "dim_product", "product_id", _fields(
    "product_id", "product_name", "category", "subcategory", "brand", "price:double",
    "cost_price:double", "discount_range", "rating_average:double", "rating_count:int",
    "stock_quantity:int", "product_launch_date:date", "product_type",
    "return_rate_baseline:double",
))
ORDERS = Source("orders", "fact_orders", "order_id", _fields(
    "order_id", "customer_id", "order_date:date", "order_time", "order_status",
    "shipping_method", "delivery_city", "delivery_state", "coupon_code:blank_to_null",
    "discount_percentage:double", "marketing_channel", "subtotal:double",
    "shipping_fee:double", "tax_amount:double", "final_amount:double",
    "campaign_id:blank_to_null",
))
ORDER_ITEMS = Source("order_items", "fact_order_items", "order_item_id", _fields(
    "order_item_id", "order_id", "product_id", "quantity:int", "unit_price:double",
    "discount_percentage:double", "item_revenue:double", "item_cost:double", "profit:double",
))
PAYMENTS = Source("payments", "fact_payments", "payment_id", _fields(
    "payment_id", "order_id", "payment_date:date", "payment_method", "payment_status",
    "amount_paid:double", "transaction_fee:double", "refund_amount:double",
))
SHIPMENTS = Source("shipments", "fact_shipments", "shipment_id", _fields(
    "shipment_id", "order_id", "warehouse_city", "delivery_city", "shipping_method",
    "dispatch_date:date", "expected_delivery_date:date", "actual_delivery_date:date",
    "delivery_days:double", "delivery_status", "delayed_flag:int",
))
RETURNS = Source("returns", "fact_returns", "return_id", _fields(
    "return_id", "order_id", "customer_id", "product_id", "return_date:date",
    "return_reason", "refund_amount:double", "return_status",
))
REVIEWS = Source("customer_reviews", "fact_reviews", "review_id", _fields(
    "review_id", "order_id", "customer_id", "product_id", "review_date:date", "rating:int",
    "review_sentiment", "verified_purchase:boolean",
))
CAMPAIGNS = Source("marketing_campaigns", "dim_campaign", "campaign_id", _fields(
    "campaign_id", "campaign_name", "channel", "campaign_start_date:date",
    "campaign_end_date:date", "campaign_type", "target_segment",
    "discount_percentage:double", "conversions:int", "revenue_generated:double",
    "impressions:int", "clicks:int", "campaign_cost:double", "roi:double",
))

SOURCES: dict[str, Source] = {
    s.raw: s
    for s in (
        CUSTOMERS, PRODUCTS, CAMPAIGNS, ORDERS, ORDER_ITEMS, PAYMENTS, SHIPMENTS, RETURNS, REVIEWS,
    )
}
