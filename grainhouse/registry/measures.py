"""Measures as queries."""

from __future__ import annotations

from grainhouse.functions import labels
from grainhouse.plans import measures as m
from grainhouse.registry.oracle import band, case, mean, minutes, per

_MONEY = "DECIMAL(38,2)"
_NET = "order_status NOT IN ('canceled', 'unavailable')"
_NET_TOTAL = f"(SELECT SUM(price) FROM fact_order_items JOIN dim_order USING (order_key) WHERE {_NET})"
_BUCKET = case("actual_days", labels.DELIVERY_STEPS, labels.DELIVERY_REST, missing="N/A")
_BUCKET_SORT = case("actual_days", labels.DELIVERY_STEPS, labels.DELIVERY_REST, missing="N/A", position=True)
_PROMISE = "CASE WHEN delay_days > 0 THEN 'Broken' ELSE 'Kept' END"
_LATE = """COUNT(DISTINCT CASE WHEN order_status = 'delivered' AND delivery_delay_days > 0 THEN f.order_id END)"""
_DELIVERED = """COUNT(DISTINCT CASE WHEN order_status = 'delivered' THEN f.order_id END)"""


def avg_days(column: str) -> str:
    return f"ROUND(CAST(SUM({column}) AS DOUBLE) / NULLIF(CAST(COUNT({column}) * 1440 AS DOUBLE), 0), 6)"


def score(condition: str) -> str:
    return f"CAST(SUM(review_score) FILTER (WHERE {condition}) AS DOUBLE) / NULLIF(COUNT(review_score) FILTER (WHERE {condition}), 0)"


_HANDLING = f"{minutes('purchase_timestamp', 'delivered_carrier_date')}"
_TRANSIT = f"{minutes('delivered_carrier_date', 'delivered_customer_date')}"

_SELLER_STATES = f"""
    SELECT *, ROUND(avg_handling_days / (avg_handling_days + avg_transit_days), 6) AS handling_share,
           rank() OVER (ORDER BY orders DESC) AS orders_rank
    FROM (SELECT seller_state, COUNT(*) AS orders, {avg_days("h")} AS avg_handling_days, {avg_days("t")} AS avg_transit_days
          FROM (SELECT s.state AS seller_state, f.order_id, MAX({_HANDLING}) AS h, MAX({_TRANSIT}) AS t
                FROM fact_order_items f JOIN dim_seller s ON f.seller_key = s.seller_key GROUP BY s.state, f.order_id)
          GROUP BY seller_state)"""

QUERIES = {
    "m_category_group": (
        lambda wh: wh.products.select("product_id", "category_name_english", "category_group"),
        "SELECT product_id, category_name_english, category_group FROM dim_product_grouped",
    ),
    "m_revenue_kinds": (
        m.revenue_kinds,
        f"""SELECT i.y AS year, g AS items_revenue_gross, n AS items_revenue_net, pg AS gross_revenue, pn AS net_revenue_paid
            FROM (SELECT CAST(purchase_date_key // 10000 AS INTEGER) AS y, CAST(SUM(price) AS {_MONEY}) AS g,
                         CAST(SUM(price) FILTER (WHERE {_NET}) AS {_MONEY}) AS n
                  FROM fact_order_items JOIN dim_order USING (order_key) GROUP BY 1) i
            JOIN (SELECT CAST(purchase_date_key // 10000 AS INTEGER) AS y, CAST(SUM(payment_value) AS {_MONEY}) AS pg,
                         CAST(SUM(payment_value) FILTER (WHERE {_NET}) AS {_MONEY}) AS pn
                  FROM fact_payments JOIN dim_order USING (order_key) GROUP BY 1) p ON i.y = p.y""",
    ),
    "m_net_share": (
        m.net_share,
        f"""SELECT category_group, items_revenue_net, {per("items_revenue_net", _NET_TOTAL, 100)} AS pct_net
            FROM (SELECT category_group, CAST(SUM(price) AS {_MONEY}) AS items_revenue_net
                  FROM fact_order_items f JOIN dim_order d ON f.order_key = d.order_key
                  JOIN dim_product_grouped p ON f.product_key = p.product_key WHERE {_NET} GROUP BY category_group)""",
    ),
    "m_category_sales": (
        m.category_sales,
        f"""SELECT category_name_english, CAST(SUM(price) AS {_MONEY}) AS items_revenue_net, COUNT(*) AS items_sold
            FROM fact_order_items f JOIN dim_order d ON f.order_key = d.order_key
            JOIN dim_product p ON f.product_key = p.product_key WHERE {_NET} GROUP BY category_name_english""",
    ),
    "m_order_counts": (
        m.order_counts,
        """SELECT COALESCE(i.y, p.y) AS year, COALESCE(i.m, p.m) AS month, COALESCE(op, 0) AS orders_paid, COALESCE(oi, 0) AS orders_items, COALESCE(n, 0) AS items_sold
           FROM (SELECT CAST(purchase_date_key // 10000 AS INTEGER) AS y, CAST(purchase_date_key // 100 % 100 AS INTEGER) AS m,
                        COUNT(DISTINCT order_id) AS oi, COUNT(*) AS n FROM fact_order_items GROUP BY 1, 2) i
           FULL JOIN (SELECT CAST(purchase_date_key // 10000 AS INTEGER) AS y, CAST(purchase_date_key // 100 % 100 AS INTEGER) AS m,
                        COUNT(DISTINCT order_id) AS op FROM fact_payments GROUP BY 1, 2) p ON i.y = p.y AND i.m = p.m""",
    ),
    "m_category_orders": (
        m.category_orders,
        """SELECT category_group, COUNT(DISTINCT order_id) AS orders_category, COUNT(*) AS items_sold
           FROM fact_order_items f JOIN dim_product_grouped p ON f.product_key = p.product_key GROUP BY category_group""",
    ),
    "m_delivered_late": (
        m.late_orders,
        f"""SELECT d.state AS customer_state, {_LATE} AS late_orders, {_DELIVERED} AS delivered_orders, {per(_LATE, _DELIVERED, 100)} AS pct_late
            FROM dim_order d LEFT JOIN fact_order_items f ON d.order_key = f.order_key GROUP BY d.state""",
    ),
    "m_avg_delivery": (
        m.delivery_averages,
        f"""SELECT customer_state, {mean("a")} AS avg_delivery_days, {mean("a - p")} AS avg_promised_days,
                   {avg_days("h")} AS avg_handling_days, {avg_days("t")} AS avg_transit_days
            FROM (SELECT d.state AS customer_state, d.order_id, MAX(actual_delivery_days) AS a, MAX(delivery_delay_days) AS p,
                         MAX({_HANDLING}) AS h, MAX({_TRANSIT}) AS t
                  FROM dim_order d LEFT JOIN fact_order_items f ON d.order_key = f.order_key GROUP BY d.state, d.order_id)
            GROUP BY customer_state""",
    ),
    "m_handling_transit": (m.handling_by_seller_state, _SELLER_STATES),
    "m_handling_share_top10": (
        m.handling_share_top,
        f"SELECT * FROM ({_SELLER_STATES}) ORDER BY orders DESC, seller_state LIMIT 10",
    ),
    "m_review_avg": (
        m.review_average,
        f"""SELECT ROUND({score("order_status = 'delivered'")}, 6) AS avg_score_delivered, {mean("review_score")} AS avg_score_all, COUNT(*) AS reviews
            FROM fact_reviews r JOIN dim_order d ON r.order_key = d.order_key""",
    ),
    "m_review_avg_by_status": (
        lambda wh: m.review_average(wh, ["order_status"]),
        f"""SELECT order_status, ROUND({score("order_status = 'delivered'")}, 6) AS avg_score_delivered, {mean("review_score")} AS avg_score_all, COUNT(*) AS reviews
            FROM fact_reviews r JOIN dim_order d ON r.order_key = d.order_key GROUP BY order_status""",
    ),
    "m_review_dist": (
        m.review_distribution,
        f"""SELECT review_score, reviews, {per("reviews", "SUM(reviews) OVER ()", 100)} AS pct
            FROM (SELECT review_score, COUNT(*) AS reviews FROM fact_reviews GROUP BY review_score)""",
    ),
    "m_delivery_bucket": (
        lambda wh: m.per_label(wh, "delivery_bucket", "delivery_bucket_sort"),
        f"SELECT {_BUCKET} AS delivery_bucket, {_BUCKET_SORT} AS delivery_bucket_sort, COUNT(*) AS orders FROM order_delivery GROUP BY 1, 2",
    ),
    "m_order_mirrors": (
        m.order_mirrors,
        f"""SELECT order_id, order_status, delay_days, actual_days, actual_days - delay_days AS promised_days, {_BUCKET} AS delivery_bucket,
                   {_BUCKET_SORT} AS delivery_bucket_sort, {band("actual_days")} AS duration_band, {band("actual_days", True)} AS duration_band_sort,
                   {_PROMISE} AS promise_status
            FROM order_delivery""",
    ),
    "m_duration_band": (
        lambda wh: m.per_label(wh, "duration_band", "duration_band_sort"),
        f"SELECT {band('actual_days')} AS duration_band, {band('actual_days', True)} AS duration_band_sort, COUNT(*) AS orders FROM order_delivery GROUP BY 1, 2",
    ),
    "m_week_start": (
        lambda wh: m.on_orders(wh, ["week_start"], m.F.count(m.F.lit(1)).alias("orders")),
        """SELECT CAST(date_trunc('week', order_purchase_timestamp) AS DATE) AS week_start, COUNT(*) AS orders FROM stg_orders GROUP BY 1""",
    ),
    "m_promise_status": (
        lambda wh: m.per_label(wh, "promise_status"),
        f"SELECT {_PROMISE} AS promise_status, COUNT(*) AS orders FROM order_delivery GROUP BY 1",
    ),
    "m_payment_mix": (
        m.payment_mix,
        f"""SELECT payment_type, payments, value, avg_installments, {per("value", "SUM(value) OVER ()", 100)} AS pct_value
            FROM (SELECT payment_type, COUNT(*) AS payments, CAST(SUM(payment_value) AS {_MONEY}) AS value, {mean("payment_installments")} AS avg_installments
                  FROM fact_payments WHERE payment_type <> 'not_defined' GROUP BY payment_type)""",
    ),
    "m_payment_habits": (
        m.payment_habits,
        f"""SELECT (SELECT {mean("payment_installments")} FROM fact_payments) AS avg_installments,
                   {per("COUNT(*) FILTER (WHERE n > 1)", "COUNT(*)", 100)} AS pct_multi_payment
            FROM (SELECT order_id, COUNT(*) AS n FROM fact_payments GROUP BY order_id)""",
    ),
    "m_points_lost": (
        m.points_lost,
        f"""SELECT customer_state, ROUND(k, 6) AS avg_score_on_time, ROUND(b, 6) AS avg_score_late, ROUND(k - b, 6) AS points_lost
            FROM (SELECT customer_state, {score("order_status = 'delivered' AND COALESCE(delay_days, 0) <= 0")} AS k,
                         {score("order_status = 'delivered' AND delay_days > 0")} AS b
                  FROM order_delivery LEFT JOIN fact_reviews USING (order_key) GROUP BY customer_state)""",
    ),
    "m_seller_revenue": (
        m.revenue_by_seller,
        f"""SELECT seller_id, city || ' ' || s.seller_key AS seller_label, CAST(SUM(price) AS {_MONEY}) AS revenue
            FROM fact_order_items f JOIN dim_seller s ON f.seller_key = s.seller_key GROUP BY seller_id, city, s.seller_key""",
    ),
    "m_state_revenue": (
        m.revenue_by_state,
        f"""SELECT state AS customer_state, CAST(SUM(price) AS {_MONEY}) AS revenue, COUNT(DISTINCT customer_key) AS customers
            FROM dim_order d LEFT JOIN fact_order_items f ON d.order_key = f.order_key GROUP BY state""",
    ),
    "m_geo_seller": (
        m.sellers_by_place,
        f"""SELECT s.state AS seller_state, s.city AS seller_city, COUNT(DISTINCT s.seller_key) AS sellers,
                   CAST(COALESCE(SUM(price), 0) AS {_MONEY}) AS revenue
            FROM dim_seller s LEFT JOIN fact_order_items f ON s.seller_key = f.seller_key GROUP BY s.state, s.city""",
    ),
    "m_labels": (
        m.display_labels,
        """SELECT 'customer' AS kind, customer_unique_id AS id, 'Customer #' || customer_key AS label FROM dim_customer
           UNION ALL SELECT 'seller', seller_id, concat_ws(' ', city, seller_key) FROM dim_seller""",
    ),
    "m_delivered_month": (
        m.delivered_month,
        f"""SELECT CAST(delivered_date_key // 10000 AS INTEGER) AS year, CAST(delivered_date_key // 100 % 100 AS INTEGER) AS month,
                   CAST(SUM(price) AS {_MONEY}) AS revenue, COUNT(DISTINCT order_id) AS orders
            FROM fact_order_items WHERE delivered_date_key IS NOT NULL GROUP BY 1, 2""",
    ),
}
