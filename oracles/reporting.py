"""Oracle SQL of metrics, drift, alerts and reports, over the analytic tables' oracles."""

from __future__ import annotations

from oracles.base import with_tables
from oracles.gold import BODY, crore, mean

CURRENT_RUN = "2001-08"
NOW = "TIMESTAMP '2001-08-02 12:00:00'"


def over(tables: str, body: str, extra: str = "") -> str:
    """`body` over derived tables, with the base tables they need."""
    names = tables.split()
    needed = sorted({b for n in names for b in BODY[n][0].split()} | set(extra.split()))
    made = ",\n".join(f"{n} AS ({BODY[n][1].strip()})" for n in names)
    body = body.strip()
    body = f", {body[5:]}" if body.upper().startswith("WITH ") else f"\n{body}"
    return with_tables(" ".join(needed), f"WITH {made}{body}")


HEADLINE = {
    "total_orders": "(SELECT CAST(SUM(orders) AS DOUBLE) FROM revenue_trends)",
    "total_revenue_cr": f"(SELECT {crore('SUM(revenue)')} FROM revenue_trends)",
    "same_day_avg_delay_pct":
        f"(SELECT {mean('AVG(delay_rate_pct)')} FROM delivery_performance WHERE shipping_method = 'Same-Day')",
    "avg_delay_rating":
        "(SELECT avg_rating FROM delay_impact_on_experience WHERE delivery_outcome = 'Delayed')",
    "targeting_precision_worst_pct":
        "(SELECT MIN(targeting_precision_pct) FROM campaign_targeting_precision)",
    "cancel_rate_no_discount_pct":
        "(SELECT cancel_rate_pct FROM discount_effectiveness WHERE discount_band LIKE '1.%')",
    "cancel_rate_20pct_discount":
        "(SELECT cancel_rate_pct FROM discount_effectiveness WHERE discount_band LIKE '4.%')",
    "retention_m1_avg_pct": f"(SELECT {mean('AVG(retention_m1_pct)')} FROM cohort_retention)",
    "repeat_purchase_pct": "(SELECT pct_repeat_at_least_once FROM repeat_purchase_timing)",
    "dq_worst_check_pct": "(SELECT MAX(pct_affected) FROM data_quality)",
}
HEADLINE_TABLES = (
    "revenue_trends delivery_performance delay_impact_on_experience campaign_targeting_precision "
    "discount_effectiveness cohort_retention repeat_purchase_timing data_quality"
)

# Each month of the revenue trend as one run of the metric history.
HISTORY = """history AS (
    SELECT metric_name, value, month AS snapshot_ts, strftime(month, '%Y-%m') AS run_id
    FROM (SELECT month, CAST(orders AS DOUBLE) AS orders, revenue, avg_order_value, delivered_pct FROM revenue_trends)
    UNPIVOT (value FOR metric_name IN (orders, revenue, avg_order_value, delivered_pct)))"""
PREVIOUS = f"""
    SELECT metric_name, ARG_MAX(value, snapshot_ts) AS previous FROM history
    WHERE run_id <> '{CURRENT_RUN}' GROUP BY metric_name"""

# name -> (table, select list, where, order, top)
LISTS = {
    "revenue_trend": ("revenue_trends", f"month, {crore('revenue')} AS revenue_cr, orders", "", "", 0),
    "category_top10": ("category_performance", f"category, {crore('revenue', 1)} AS revenue_cr, margin_pct", "",
                       "revenue DESC, category", 10),
    "segment": ("segment_performance",
                f"customer_segment, {mean('avg_lifetime_spend / 1000', 1)} AS avg_lifetime_spend_k, churn_rate_pct",
                "", "", 0),
    "channel": ("channel_performance", f"marketing_channel, {crore('revenue', 1)} AS revenue_cr", "", "", 0),
    "delivery_top12": ("delivery_performance", "warehouse_city || ' · ' || shipping_method AS route, delay_rate_pct",
                       "", "delay_rate_pct DESC, warehouse_city, shipping_method", 12),
    "payment": ("payment_performance", "payment_method, failure_rate_pct", "", "", 0),
    "returns_top10": ("return_analysis", "category || ' · ' || return_reason AS reason, returns", "",
                      "returns DESC, category, return_reason", 10),
    "state_top10": ("state_performance", f"delivery_state, {crore('revenue', 1)} AS revenue_cr", "",
                    "revenue DESC, delivery_state", 10),
    "campaigns_top10": ("campaign_roi", f"campaign_name, {mean('roi')} AS roi", "",
                        "roi DESC NULLS LAST, campaign_id", 10),
    "dq": ("data_quality", "check_name, description, affected_rows, pct_affected", "", "", 0),
    "loss_makers": ("product_true_profitability",
                    "product_name, category, gross_profit, total_refunded, refund_pct_of_profit",
                    "WHERE refund_pct_of_profit > 100", "refund_pct_of_profit DESC, product_id", 10),
    "loss_makers_top15": ("product_true_profitability",
                          "product_name, category, gross_profit, total_refunded, net_profit_after_refunds, refund_pct_of_profit",
                          "WHERE refund_pct_of_profit > 100", "refund_pct_of_profit DESC, product_id", 15),
    "targeting": ("campaign_targeting_precision", "target_segment, targeting_precision_pct", "", "", 0),
    "targeting_detail": ("campaign_targeting_precision",
                         "target_segment, total_orders, matched_orders, targeting_precision_pct", "", "", 0),
    "delay_impact": ("delay_impact_on_experience", "delivery_outcome, avg_rating, return_rate_pct", "", "", 0),
    "delay_detail": ("delay_impact_on_experience", "delivery_outcome, orders, avg_rating, return_rate_pct", "", "", 0),
    "chan_eff": ("channel_efficiency", "channel, revenue_per_rupee_spent", "", "", 0),
    "chan_eff_detail": ("channel_efficiency",
                        "channel, total_cost, total_revenue_generated, revenue_per_rupee_spent", "", "", 0),
    "discount_eff": ("discount_effectiveness", "discount_band, cancel_rate_pct, avg_order_value", "", "", 0),
    "discount_detail": ("discount_effectiveness", "discount_band, orders, avg_order_value, cancel_rate_pct", "", "", 0),
    "cohort": ("cohort_retention", "cohort_month, retention_m1_pct, retention_m3_pct", "", "", 0),
    "rfm": ("rfm_segmentation", "customer_segment, avg_recency_score, avg_frequency_score, avg_monetary_score",
            "", "", 0),
    "affinity_top8": ("category_affinity", "category_a || ' + ' || category_b AS pair, orders_together", "",
                      "orders_together DESC, category_a, category_b", 8),
    "season": ("seasonality_patterns",
               "lpad(CAST(month_num AS VARCHAR), 2, '0') || ' - ' || month_name AS month_name, orders", "", "", 0),
    "season_by_year": ("seasonality_by_year",
                       "CAST(order_year AS VARCHAR) || '-' || lpad(CAST(month_num AS VARCHAR), 2, '0') AS ym, orders",
                       "", "", 0),
    "repeat_timing": ("repeat_purchase_timing",
                      "pct_repeat_at_least_once, avg_days_to_2nd_order, median_days_to_2nd_order", "", "", 0),
    "sentiment_rate_top8": ("sentiment_by_category", "category, avg_rating, pct_negative", "",
                            "pct_negative DESC, category", 8),
    "sentiment_volume_top8": ("sentiment_by_category", "category, negative_reviews", "",
                              "negative_reviews DESC, category", 8),
    "loyalty": ("loyalty_tier_parity", "loyalty_tier, avg_spend, delay_pct, churn_pct", "", "", 0),
    "acq_funnel": ("acquisition_channel_funnel", "acquisition_channel, never_purchased_pct, avg_lifetime_spend",
                   "", "", 0),
    "fc": ("revenue_forecast",
           "forecast_month, revenue_cr_forecast, revenue_cr_lower, revenue_cr_upper, orders_forecast", "", "", 0),
    "fc_acc": ("forecast_accuracy", "eval_month, abs_pct_error", "", "", 0),
    "react": ("reactivation_summary", "reactivation_tier, customers, lifetime_value_cr", "", "", 0),
}


def listing(table: str, columns: str, where: str, order: str, top: int) -> str:
    inner = f"SELECT * FROM {table} {where}"
    if top:
        inner += f" ORDER BY {order} LIMIT {top}"
    return over(table, f"SELECT {columns} FROM ({inner})")


def reporting_sql() -> dict[str, str]:
    out = {f"report_{n}": listing(*spec) for n, spec in LISTS.items()}
    out["report_kpi"] = over("revenue_trends delivery_performance", f"""
        SELECT {crore('SUM(revenue)', 1)} AS revenue_cr, CAST(SUM(orders) AS BIGINT) AS total_orders,
               (SELECT COUNT(*) FROM dim_customer) AS total_customers,
               (SELECT {mean('AVG(delay_rate_pct)', 1)} FROM delivery_performance
                WHERE shipping_method = 'Same-Day') AS same_day_delay_pct
        FROM revenue_trends""", "dim_customer")
    out["headline_metrics"] = over(HEADLINE_TABLES, "\nUNION ALL\n".join(
        f"SELECT '{n}' AS metric_name, {v} AS value" for n, v in HEADLINE.items()))
    out["metrics_previous"] = over("revenue_trends", f"WITH {HISTORY}\n{PREVIOUS}")
    out["metrics_drift"] = over("revenue_trends", f"""
        WITH {HISTORY}, earlier AS ({PREVIOUS}),
        moved AS (
          SELECT h.metric_name, previous, h.value AS current,
                 (h.value - previous) * CAST(100 AS DOUBLE) / NULLIF(ABS(previous), 0) AS change
          FROM history h LEFT JOIN earlier USING (metric_name) WHERE run_id = '{CURRENT_RUN}')
        SELECT metric_name, previous, current, ROUND(change, 6) AS change_pct,
               CASE WHEN current IS NULL THEN 'ERROR' WHEN previous IS NULL THEN 'baseline'
                    WHEN ABS(change) >= 10 THEN 'DRIFT' ELSE 'ok' END AS flag
        FROM moved""")
    out["alert_eval"] = over("revenue_trends delivery_performance data_quality", f"""
        WITH measured AS (
          SELECT 'gold_tables_stale' AS alert_name,
                 CAST(date_diff('hour', CAST(MAX(month) AS TIMESTAMP), {NOW}) AS DOUBLE) AS value,
                 CAST(36 AS DOUBLE) AS threshold FROM revenue_trends
          UNION ALL SELECT 'same_day_delay_rate', {HEADLINE['same_day_avg_delay_pct']}, 65
          UNION ALL SELECT 'worst_quality_check', {HEADLINE['dq_worst_check_pct']}, 1)
        SELECT alert_name, value, 'GREATER_THAN' AS op, threshold, value > threshold AS breached FROM measured""")
    out["alert_transitions"] = over("revenue_trends", """
        WITH states AS (
          SELECT month, delivered_pct AS value, delivered_pct < 33 AS low FROM revenue_trends),
        changes AS (SELECT *, COALESCE(LAG(low) OVER (ORDER BY month), FALSE) AS was_low FROM states)
        SELECT 'delivered_share_low' AS alert_name, month AS evaluated_at, value,
               CASE WHEN low THEN 'BREACH' ELSE 'RECOVERY' END AS transition
        FROM changes WHERE low <> was_low""")
    return out
