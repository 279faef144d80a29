"""DuckDB forms of the layers, written naively from the star-schema tables.

A query's SQL names the layer tables it needs; :func:`with_layers` puts their
definitions in front of it.
"""

from __future__ import annotations

import re

from grainhouse.functions import labels
from grainhouse.sources.driver_tables import BRAND_STEP, UNTRANSLATED


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rows(values: list[tuple[str, str]]) -> str:
    return ", ".join(f"({text(a)}, {text(b)})" for a, b in values)


def case(column: str, steps, rest: str | None, missing: str | None = None, position: bool = False) -> str:
    """SQL CASE of a bucket: the label, or with ``position`` its place 1, 2, …"""
    parts = ["CASE"]
    none = "NULL" if missing is None else (str(len(steps) + 2) if position else text(missing))
    parts.append(f"WHEN {column} IS NULL THEN {none}")
    for place, (bound, label) in enumerate(steps, start=1):
        parts.append(f"WHEN {column} <= {bound} THEN {place if position else text(label)}")
    last = "NULL" if rest is None else (str(len(steps) + 1) if position else text(rest))
    return " ".join([*parts, f"ELSE {last} END"])


def band(column: str, position: bool = False) -> str:
    return f"CASE WHEN {column} > 4 AND {column} <= 29 THEN {case(column, labels.BAND_STEPS, None, position=position)} END"


def mean(column: str) -> str:
    return f"ROUND(CAST(SUM({column}) AS DOUBLE) / NULLIF(COUNT({column}), 0), 6)"


def per(numerator: str, denominator: str, factor: int = 1) -> str:
    top = f"CAST({numerator} AS DOUBLE)" + (f" * {factor}" if factor != 1 else "")
    return f"ROUND({top} / NULLIF(CAST({denominator} AS DOUBLE), 0), 6)"


def minutes(start: str, end: str) -> str:
    return f"date_diff('minute', {start}, {end})"


def key8(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS INTEGER)"


def _status(key: str) -> str:
    return (
        f"CASE WHEN {key} % 40 = 0 THEN 'canceled' WHEN {key} % 50 = 1 THEN 'unavailable' "
        f"WHEN {key} % 17 = 2 THEN 'shipped' ELSE 'delivered' END"
    )


def _plus(days: str, mins: str, ts: str = "o_orderdate") -> str:
    return f"({ts} + to_days(CAST({days} AS INTEGER)) + to_minutes(CAST({mins} AS INTEGER)))"


_zip = "right('00000' || CAST({0} AS VARCHAR), 5)".format
_brand_no = "CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER)"
_english = [(str(i), name) for i, name in enumerate(labels.CATEGORIES, start=1)]
_groups = [(name, group) for group, names in labels.CATEGORY_GROUPS.items() for name in names]

LAYERS: dict[str, str] = {
    "src_customers": """
        SELECT CAST(o_orderkey AS VARCHAR) AS customer_id,
               CAST(o_custkey * 11 + o_orderkey % 11 AS VARCHAR) AS customer_unique_id,
               CAST(c_custkey % 200 AS INTEGER) AS customer_zip_code_prefix,
               '  ' || lower(n_name) || ' ' AS customer_city, n_name AS customer_state
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "src_geolocation": """
        SELECT CAST(c_custkey % 190 AS INTEGER) AS geolocation_zip_code_prefix,
               CAST(CAST(-5000 - (c_custkey % 28) * 1000 - c_custkey % 97 AS DECIMAL(10,0)) * 0.001 AS DECIMAL(10,8)) AS geolocation_lat,
               CAST(CAST(-35000 - (c_custkey % 37) * 1000 - c_custkey % 89 AS DECIMAL(10,0)) * 0.001 AS DECIMAL(11,8)) AS geolocation_lng
        FROM customer""",
    "src_sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_suppkey % 200 AS INTEGER) AS seller_zip_code_prefix,
               ' ' || lower(n_name) AS seller_city, n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "src_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN p_partkey % 54 <> 0 THEN lower(p_brand) END AS product_category_name,
               p_size * 200 AS product_weight_g, p_size AS product_length_cm,
               p_size + 1 AS product_height_cm, p_size + 2 AS product_width_cm
        FROM part""",
    "src_translation": f"""
        SELECT lower(p_brand) AS product_category_name,
               COALESCE(c.name, 'en_' || lower(p_brand)) AS product_category_name_english
        FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand NOT IN ({", ".join(map(text, UNTRANSLATED))})) b
        LEFT JOIN (VALUES {rows(_english)}) c(place, name) ON CAST(c.place AS INTEGER) = {_brand_no} * {BRAND_STEP}""",
    "src_orders": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderkey AS VARCHAR) AS customer_id,
               ' ' || upper(st) AS order_status,
               {_plus("0", "(o_orderkey * 7) % 1440")} AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 211 <> 0 THEN {_plus("0", "(o_orderkey * 7) % 1440 + o_orderkey % 300")} END AS order_approved_at,
               CASE WHEN st IN ('delivered', 'shipped') THEN {_plus("1 + o_orderkey % 3", "(o_orderkey * 11) % 1440")} END AS order_delivered_carrier_date,
               CASE WHEN (st = 'delivered' AND o_orderkey % 499 <> 3) OR o_orderkey % 1200 = 0
                    THEN {_plus("3 + (o_orderkey * 13) % 32", "(o_orderkey * 37) % 1440")} END AS order_delivered_customer_date,
               {_plus("10 + (o_orderkey * 5) % 23", "0")} AS order_estimated_delivery_date
        FROM (SELECT *, {_status("o_orderkey")} AS st FROM orders)""",
    "src_order_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS INTEGER) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date, CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
               CAST(5 + l_partkey % 30 AS DECIMAL(10,2)) AS freight_value
        FROM lineitem""",
    "src_payments": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, seq AS payment_sequential,
               CASE WHEN o_orderkey % 5000 = 7 THEN 'not_defined' WHEN o_orderkey % 4 = 0 THEN ' BOLETO'
                    WHEN o_orderkey % 9 = 1 THEN 'voucher' ELSE 'credit_card' END AS payment_type,
               CAST((o_orderkey + seq) % 11 AS INTEGER) AS payment_installments,
               CAST(CAST(1000 + (o_orderkey * 31 + seq * 17) % 50000 AS DECIMAL(12,0)) * 0.01 AS DECIMAL(10,2)) AS payment_value
        FROM (SELECT o_orderkey, CAST(unnest(generate_series(1, 1 + o_orderkey % 3)) AS INTEGER) AS seq
              FROM orders WHERE o_orderkey % 997 <> 5)""",
    "src_reviews": f"""
        SELECT CAST(CASE WHEN o_orderkey % 251 = 4 AND k = 1 THEN 1000000 + o_orderkey // 502 ELSE o_orderkey * 10 + k END AS VARCHAR) AS review_id,
               CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE 1 + (o_orderkey * 7 + k) % 5 END AS SMALLINT) AS review_score,
               CASE WHEN o_orderkey % 4 <> 0 THEN 'Pedido "' || o_orderkey || '"' END AS review_comment_title,
               CASE WHEN o_orderkey % 3 <> 0 THEN 'line 1, "quoted"' || chr(10) || 'line 2 — avaliação ' || o_orderkey || ', nota ' || k END AS review_comment_message,
               {_plus("20 + o_orderkey % 20", "0")} AS review_creation_date,
               {_plus("21 + o_orderkey % 20", "o_orderkey % 1440")} AS review_answer_timestamp
        FROM (SELECT o_orderkey, o_orderdate, unnest(generate_series(1, CASE WHEN o_orderkey % 20 = 0 THEN 2 ELSE 1 END)) AS k
              FROM orders WHERE o_orderkey % 101 <> 0)""",
    "stg_customers": f"""
        SELECT customer_id, customer_unique_id, upper(trim(customer_city)) AS customer_city,
               upper(trim(customer_state)) AS customer_state,
               {_zip("customer_zip_code_prefix")} AS customer_zip_code_prefix
        FROM src_customers""",
    "stg_geolocation": f"""
        SELECT {_zip("geolocation_zip_code_prefix")} AS zip_code_prefix, geolocation_lat AS latitude, geolocation_lng AS longitude
        FROM src_geolocation""",
    "stg_sellers": f"""
        SELECT seller_id, upper(trim(seller_city)) AS seller_city, upper(trim(seller_state)) AS seller_state,
               {_zip("seller_zip_code_prefix")} AS seller_zip_code_prefix
        FROM src_sellers""",
    "stg_products": """
        SELECT product_id, p.product_category_name,
               COALESCE(product_category_name_english, p.product_category_name, 'Unknown') AS product_category_name_eng,
               product_weight_g, product_length_cm, product_height_cm, product_width_cm
        FROM src_products p LEFT JOIN src_translation t ON p.product_category_name = t.product_category_name""",
    "stg_orders": "SELECT * REPLACE (lower(trim(order_status)) AS order_status) FROM src_orders",
    "stg_order_items": "SELECT * EXCLUDE (shipping_limit_date) FROM src_order_items",
    "stg_payments": "SELECT * REPLACE (lower(trim(payment_type)) AS payment_type) FROM src_payments",
    "stg_reviews": "SELECT review_id, order_id, CAST(review_score AS INTEGER) AS review_score FROM src_reviews",
    "dim_date": f"""
        SELECT {key8("d")} AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
               CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31), INTERVAL 1 DAY)) AS d
              FROM (SELECT year(MIN(order_purchase_timestamp)) AS lo,
                           year(MAX(GREATEST(order_purchase_timestamp, COALESCE(order_delivered_customer_date, order_purchase_timestamp)))) AS hi
                    FROM stg_orders))""",
    "zip_centres": """
        SELECT zip_code_prefix, CAST(AVG(latitude) AS DECIMAL(10,8)) AS latitude, CAST(AVG(longitude) AS DECIMAL(11,8)) AS longitude
        FROM stg_geolocation GROUP BY zip_code_prefix""",
    "dim_customer": """
        SELECT row_number() OVER (ORDER BY customer_unique_id) AS customer_key, customer_unique_id
        FROM (SELECT DISTINCT customer_unique_id FROM stg_customers)""",
    "dim_seller": """
        SELECT row_number() OVER (ORDER BY seller_id) AS seller_key, seller_id, seller_city AS city, seller_state AS state,
               seller_zip_code_prefix AS zip_code, 'Brazil' AS country, latitude, longitude
        FROM stg_sellers LEFT JOIN zip_centres ON seller_zip_code_prefix = zip_code_prefix""",
    "dim_product": """
        SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id,
               product_category_name_eng AS category_name_english, product_weight_g, product_length_cm, product_height_cm, product_width_cm
        FROM stg_products""",
    "dim_order": """
        SELECT row_number() OVER (ORDER BY order_id) AS order_key, order_id, order_status, customer_city AS city,
               customer_state AS state, customer_zip_code_prefix AS zip_code, 'Brazil' AS country, latitude, longitude
        FROM stg_orders o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id
        LEFT JOIN zip_centres z ON c.customer_zip_code_prefix = z.zip_code_prefix""",
    "buyers": """
        SELECT o.order_id, d.order_key, p.customer_key, o.order_purchase_timestamp, o.order_delivered_carrier_date,
               o.order_delivered_customer_date, o.order_estimated_delivery_date
        FROM stg_orders o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id
        LEFT JOIN dim_customer p ON c.customer_unique_id = p.customer_unique_id
        LEFT JOIN dim_order d ON o.order_id = d.order_id""",
    "fact_order_items": f"""
        SELECT i.order_id, i.order_item_id, b.order_key, b.customer_key, s.seller_key, p.product_key,
               {key8("b.order_purchase_timestamp")} AS purchase_date_key,
               {key8("b.order_delivered_customer_date")} AS delivered_date_key,
               b.order_purchase_timestamp AS purchase_timestamp, b.order_delivered_carrier_date AS delivered_carrier_date,
               b.order_delivered_customer_date AS delivered_customer_date, b.order_estimated_delivery_date AS estimated_delivery_date,
               i.price, i.freight_value,
               CAST(date_diff('day', b.order_estimated_delivery_date, b.order_delivered_customer_date) AS INTEGER) AS delivery_delay_days,
               CAST(date_diff('day', b.order_purchase_timestamp, b.order_delivered_customer_date) AS INTEGER) AS actual_delivery_days
        FROM stg_order_items i JOIN buyers b ON i.order_id = b.order_id
        LEFT JOIN dim_seller s ON i.seller_id = s.seller_id LEFT JOIN dim_product p ON i.product_id = p.product_id""",
    "fact_payments": f"""
        SELECT y.order_id, payment_sequential, order_key, customer_key, {key8("order_purchase_timestamp")} AS purchase_date_key,
               payment_type, payment_installments, payment_value
        FROM stg_payments y JOIN buyers b ON y.order_id = b.order_id""",
    "fact_reviews": f"""
        SELECT review_id, r.order_id, order_key, customer_key, {key8("order_purchase_timestamp")} AS purchase_date_key, review_score
        FROM stg_reviews r JOIN buyers b ON r.order_id = b.order_id""",
    "dim_product_grouped": f"""
        SELECT p.*, COALESCE(g.category_group, 'Unclassified') AS category_group
        FROM dim_product p LEFT JOIN (VALUES {rows(_groups)}) g(name, category_group)
        ON lower(p.category_name_english) = lower(g.name)""",
    "order_delivery": """
        SELECT d.order_key, d.order_id, d.order_status, d.city AS customer_city, d.state AS customer_state,
               COUNT(f.order_id) AS items, MAX(f.delivery_delay_days) AS delay_days, MAX(f.actual_delivery_days) AS actual_days,
               MAX(f.purchase_date_key) AS purchase_date_key, MAX(f.delivered_date_key) AS delivered_date_key
        FROM dim_order d LEFT JOIN fact_order_items f ON d.order_key = f.order_key
        GROUP BY d.order_key, d.order_id, d.order_status, d.city, d.state""",
}


def with_layers(sql: str) -> str:
    """Prepend the definitions of every layer table the SQL needs."""
    needed: set[str] = set()

    def visit(body: str) -> None:
        for name in LAYERS:
            if name not in needed and re.search(rf"\b{name}\b", body):
                needed.add(name)
                visit(LAYERS[name])

    visit(sql)
    if not needed:
        return sql
    head = ",\n".join(f"{name} AS ({LAYERS[name]})" for name in LAYERS if name in needed)
    return f"WITH {head}\n{sql}"
