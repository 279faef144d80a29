"""Reports as queries. Years and days are set for the dates the given tables hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainhouse.functions import labels
from grainhouse.operators.aggregates import union_all
from grainhouse.plans import reports as r
from grainhouse.registry.measures import _DELIVERED, _LATE, _MONEY, _NET, _TRANSIT, avg_days, score
from grainhouse.registry.oracle import band, case, mean, minutes, per

YEARS = (1997, 1998)
MONTH = 5
WINDOW = (1, 14)
HEAD = (1, 16)
EVENTS = {1997: 11, 1998: 10}  # second Sunday of May
CLIP = ("1996-01-01", "2000-08-31")

_YEAR_MONTH = "CAST(purchase_date_key // 10000 AS INTEGER) AS year, CAST(purchase_date_key // 100 % 100 AS INTEGER) AS month"
_DAILY = f"""SELECT full_date, year, month, day_name, CAST(day(full_date) AS INTEGER) AS d,
                    CAST(SUM(payment_value) AS {_MONEY}) AS daily_revenue, COUNT(DISTINCT order_id) AS orders
             FROM fact_payments JOIN dim_date ON purchase_date_key = date_key GROUP BY full_date, year, month, day_name"""
_IN_MAY = f"month = {MONTH} AND year IN {YEARS}"
_EVENT = " OR ".join(f"(year = {y} AND d = {d})" for y, d in EVENTS.items())
_INSIDE = f"d BETWEEN {WINDOW[0]} AND {WINDOW[1]}"

_GAPS = """SELECT customer_key, CAST(date_diff('day', ts, nxt) AS INTEGER) AS days
           FROM (SELECT customer_key, purchase_timestamp AS ts,
                        lead(purchase_timestamp) OVER w AS nxt, row_number() OVER w AS rn
                 FROM (SELECT DISTINCT customer_key, order_id, purchase_timestamp FROM fact_order_items)
                 WINDOW w AS (PARTITION BY customer_key ORDER BY purchase_timestamp, order_id))
           WHERE rn = 1 AND nxt IS NOT NULL"""

_INT_MEAN = "CAST(trunc(CAST(SUM({0}) AS DOUBLE) / COUNT({0})) AS BIGINT)".format
_SEVERITY = case("delivery_delay_days", labels.SEVERITY_STEPS, labels.SEVERITY_REST)

_ROUTED = """SELECT CASE WHEN o.state = s.state THEN 'Same State' ELSE 'Cross State' END AS route_type, f.order_id, actual_delivery_days
             FROM fact_order_items f JOIN dim_order o ON f.order_key = o.order_key JOIN dim_seller s ON f.seller_key = s.seller_key"""


def _by_category(fields: str) -> str:
    return f"""SELECT category_name_english, {fields} FROM fact_order_items f JOIN dim_product p ON f.product_key = p.product_key
               GROUP BY category_name_english"""


def _poor_suppliers(wh):
    """Sellers named by the supplier table: those with a negative balance."""
    return wh.raw.table("supplier").where(F.col("s_acctbal") < 0).select(F.col("s_suppkey").cast("string").alias("seller_id"))


def _poor_customers(wh):
    """Persons behind orders of customers with a negative balance."""
    poor = wh.raw.table("customer").where(F.col("c_acctbal") < 0).select("c_custkey")
    orders = wh.raw.table("orders").join(poor, F.col("o_custkey") == F.col("c_custkey"))
    return orders.select((F.col("o_custkey") * 11 + F.col("o_orderkey") % 11).cast("string").alias("customer_unique_id"))


_LATE_COLUMNS = f"{_LATE} AS late_orders, {_DELIVERED} AS delivered_orders, {per(_LATE, _DELIVERED, 100)} AS pct_late"
_DELIVERY = "order_delivery od LEFT JOIN fact_reviews fr ON od.order_key = fr.order_key"
_DBUCKET = case("actual_days", labels.DELIVERY_STEPS, labels.DELIVERY_REST, missing="N/A")

SELLER_STATES, CUSTOMER_STATES = [f"NATION_{k}" for k in range(12)], ["NATION_3", "NATION_7", "NATION_12"]

SLICERS = {"none": (), "customer": (CUSTOMER_STATES,), "seller": (None, SELLER_STATES), "both": (CUSTOMER_STATES, SELLER_STATES)}
_POINTS = [
    f"ROUND({k}, 6) AS avg_score_on_time, ROUND({b}, 6) AS avg_score_late, ROUND({k} - {b}, 6) AS points_lost"
    for k, b in [
        [
            f"(CAST(SUM(total) FILTER ({c}) AS DOUBLE) / NULLIF(SUM(n) FILTER ({c}), 0))"
            for c in ("order_status = 'delivered' AND COALESCE(delay_days, 0) <= 0", "order_status = 'delivered' AND delay_days > 0")
        ]
    ]
]


def _cards_sql(name: str, values: list[str]) -> str:
    """Cards over the orders that two slicers leave."""
    customers, sellers = [*SLICERS[name], None, None][:2]
    where = [f"customer_state IN {tuple(customers)}"] if customers else []
    if sellers:
        where.append(
            f"""order_key IN (SELECT f.order_key FROM fact_order_items f JOIN dim_seller s ON f.seller_key = s.seller_key WHERE s.state IN {tuple(sellers)})"""
        )
    delivered, late = "COUNT(*) FILTER (order_status = 'delivered' AND items > 0)", "COUNT(*) FILTER (order_status = 'delivered' AND delay_days > 0)"
    return (
        f"SELECT '{name}' AS slicers, {', '.join(values)}, {late} AS late_orders, {delivered} AS delivered_orders, {per(late, delivered, 100)} AS pct_late "
        "FROM order_delivery LEFT JOIN (SELECT order_key, SUM(review_score) AS total, COUNT(review_score) AS n FROM fact_reviews GROUP BY order_key) "
        f"USING (order_key) {'WHERE ' + ' AND '.join(where) if where else ''}"
    )


def _overview_cards_sql(group: str | None) -> str:
    items = "fact_order_items f JOIN dim_order o ON f.order_key = o.order_key"
    chosen = "" if group is None else f"AND category_group = '{group}'"
    label = "CAST(NULL AS VARCHAR)" if group is None else f"'{group}'"
    net = f"(SELECT CAST(SUM(price) AS {_MONEY}) FROM {items} JOIN dim_product_grouped p ON f.product_key = p.product_key WHERE {_NET} {chosen})"
    whole = f"(SELECT SUM(price) FROM {items} WHERE {_NET})"
    orders = f"(SELECT COUNT(DISTINCT f.order_key) FROM fact_order_items f JOIN dim_product_grouped p ON f.product_key = p.product_key WHERE TRUE {chosen})"
    return f"SELECT {label} AS category_group, {net} AS items_revenue_net, {orders} AS orders_category, {per(net, whole, 100)} AS pct_net"


QUERIES = {
    "r_monthly_items": (
        r.monthly_items,
        f"""SELECT {_YEAR_MONTH}, COUNT(DISTINCT order_id) AS orders, CAST(SUM(price) AS {_MONEY}) AS revenue FROM fact_order_items GROUP BY 1, 2""",
    ),
    "r_monthly_items_before": (
        lambda wh: r.monthly_items(wh, before="1997-01-01"),
        f"""SELECT {_YEAR_MONTH}, COUNT(DISTINCT order_id) AS orders, CAST(SUM(price) AS {_MONEY}) AS revenue
            FROM fact_order_items WHERE purchase_timestamp < DATE '1997-01-01' GROUP BY 1, 2""",
    ),
    "r_monthly_net": (
        r.monthly_net,
        f"""SELECT year, month, COUNT(DISTINCT f.order_id) AS orders, CAST(SUM(payment_value) AS {_MONEY}) AS net_revenue
            FROM fact_payments f JOIN dim_date ON purchase_date_key = date_key JOIN dim_order o ON f.order_key = o.order_key
            WHERE {_NET} GROUP BY year, month""",
    ),
    "r_daily_net": (
        r.daily_net,
        f"""SELECT full_date, CAST(SUM(payment_value) AS {_MONEY}) AS daily_revenue, COUNT(DISTINCT f.order_id) AS orders
            FROM fact_payments f JOIN dim_date ON purchase_date_key = date_key JOIN dim_order o ON f.order_key = o.order_key
            WHERE {_NET} GROUP BY full_date""",
    ),
    "r_score_stats": (
        r.score_stats,
        f"""SELECT MIN(review_score) AS min_score, MAX(review_score) AS max_score, {mean("review_score")} AS avg_score,
                   {_INT_MEAN("review_score")} AS avg_score_int FROM fact_reviews""",
    ),
    "r_repeat_customers": (
        r.repeat_customers,
        f"""SELECT COUNT(*) FILTER (WHERE n > 1) AS repeat_customers, COUNT(*) AS total_customers, {per("COUNT(*) FILTER (WHERE n > 1)", "COUNT(*)", 100)} AS pct_repeat
            FROM (SELECT customer_key, COUNT(DISTINCT order_id) AS n FROM fact_payments GROUP BY customer_key)""",
    ),
    "r_second_order_gap": (
        r.second_order_gap,
        f"""SELECT {mean("days")} AS avg_days, {_INT_MEAN("days")} AS avg_days_int, CAST(MEDIAN(days) AS DOUBLE) AS median_days, COUNT(*) AS customers
            FROM ({_GAPS})""",
    ),
    "r_second_order_gaps_list": (r.second_order_gaps, _GAPS),
    "r_pareto": (
        r.seller_pareto,
        f"""SELECT CAST(SUM(CASE WHEN p <= 0.2 THEN revenue ELSE 0 END) AS {_MONEY}) AS top_revenue, CAST(SUM(revenue) AS {_MONEY}) AS total_revenue,
                   {per("SUM(CASE WHEN p <= 0.2 THEN revenue ELSE 0 END)", "SUM(revenue)", 100)} AS pct_from_top
            FROM (SELECT revenue, percent_rank() OVER (ORDER BY revenue DESC) AS p
                  FROM (SELECT seller_key, SUM(price) AS revenue FROM fact_order_items WHERE seller_key IS NOT NULL GROUP BY seller_key))""",
    ),
    "r_category_top10": (
        r.category_top,
        f"""SELECT category_name_english, revenue, {per("revenue", "total", 100)} AS pct_of_total
            FROM (SELECT *, SUM(revenue) OVER () AS total FROM ({_by_category(f"CAST(SUM(price) AS {_MONEY}) AS revenue")}))
            ORDER BY revenue DESC, category_name_english LIMIT 10""",
    ),
    "r_approval_minutes": (
        r.approval_minutes,
        f"""SELECT {mean("n")} AS avg_approval_minutes, {_INT_MEAN("n")} AS avg_approval_minutes_int
            FROM (SELECT {minutes("order_purchase_timestamp", "order_approved_at")} AS n FROM stg_orders WHERE order_approved_at IS NOT NULL)""",
    ),
    "r_distance_bucket": (
        r.distance_buckets,
        f"""SELECT {case("distance", labels.DISTANCE_STEPS, labels.DISTANCE_REST)} AS distance_bucket, {mean("actual_days")} AS avg_delivery_days,
                   {_INT_MEAN("actual_days")} AS avg_delivery_days_int, COUNT(*) AS orders
            FROM (SELECT DISTINCT f.order_key, actual_delivery_days AS actual_days,
                         sqrt((CAST(o.latitude AS DOUBLE) - CAST(s.latitude AS DOUBLE)) * (CAST(o.latitude AS DOUBLE) - CAST(s.latitude AS DOUBLE))
                            + (CAST(o.longitude AS DOUBLE) - CAST(s.longitude AS DOUBLE)) * (CAST(o.longitude AS DOUBLE) - CAST(s.longitude AS DOUBLE))) AS distance
                  FROM fact_order_items f JOIN dim_order o ON f.order_key = o.order_key JOIN dim_seller s ON f.seller_key = s.seller_key
                  WHERE o.latitude IS NOT NULL AND s.latitude IS NOT NULL)
            GROUP BY 1""",
    ),
    "r_route_type": (
        r.route_types,
        f"""SELECT a.route_type, avg_delivery_days, avg_delivery_days_items, orders
            FROM (SELECT route_type, {mean("actual_delivery_days")} AS avg_delivery_days_items, COUNT(DISTINCT order_id) AS orders
                  FROM ({_ROUTED}) GROUP BY 1) a
            JOIN (SELECT route_type, {mean("x")} AS avg_delivery_days
                  FROM (SELECT route_type, order_id, MAX(actual_delivery_days) AS x FROM ({_ROUTED}) GROUP BY 1, 2) GROUP BY 1) b
            ON a.route_type = b.route_type""",
    ),
    "r_freight_pct": (
        r.freight_share,
        _by_category(
            f"""{mean("price")} AS avg_price, {mean("freight_value")} AS avg_freight,
                ROUND(SUM(CAST(freight_value AS DOUBLE) / NULLIF(CAST(price AS DOUBLE), 0)) * 100 / COUNT(NULLIF(price, 0)), 6) AS freight_pct"""
        ),
    ),
    "r_weight_bucket": (
        r.weight_buckets,
        f"""SELECT {case("product_weight_g", labels.WEIGHT_STEPS, labels.WEIGHT_REST)} AS weight_bucket, {mean("freight_value")} AS avg_freight, COUNT(*) AS items
            FROM fact_order_items f JOIN dim_product p ON f.product_key = p.product_key WHERE product_weight_g IS NOT NULL GROUP BY 1""",
    ),
    "r_instalments_bucket": (
        r.instalment_buckets,
        f"""SELECT {case("payment_value", labels.VALUE_STEPS, labels.VALUE_REST)} AS value_bucket, {mean("payment_installments")} AS avg_installments,
                   {_INT_MEAN("payment_installments")} AS avg_installments_int, COUNT(*) AS payments
            FROM fact_payments WHERE payment_type = 'credit_card' GROUP BY 1""",
    ),
    "r_weekday": (
        r.weekday_revenue,
        f"SELECT day_name, {mean('daily_revenue')} AS avg_revenue FROM ({_DAILY}) GROUP BY day_name",
    ),
    "r_month_daily": (
        lambda wh: r.month_daily(wh, MONTH, YEARS),
        f"SELECT full_date, daily_revenue, orders FROM ({_DAILY}) WHERE {_IN_MAY}",
    ),
    "r_holiday_test": (
        lambda wh: r.holiday_test(wh, MONTH, WINDOW, EVENTS),
        f"""SELECT year, {mean(f"CASE WHEN NOT ({_INSIDE}) THEN daily_revenue END")} AS avg_baseline,
                   {mean(f"CASE WHEN {_INSIDE} THEN daily_revenue END")} AS avg_window,
                   MAX(CASE WHEN {_EVENT} THEN daily_revenue END) AS event_revenue
            FROM ({_DAILY}) WHERE {_IN_MAY} GROUP BY year""",
    ),
    "r_month_head": (
        lambda wh: r.month_head(wh, MONTH, YEARS, HEAD),
        f"SELECT year, d AS day, full_date, daily_revenue FROM ({_DAILY}) WHERE {_IN_MAY} AND d BETWEEN {HEAD[0]} AND {HEAD[1]}",
    ),
    "r_category_items": (
        r.category_items,
        _by_category(f"COUNT(*) AS items, COUNT(DISTINCT f.product_key) AS products, CAST(SUM(price) AS {_MONEY}) AS revenue"),
    ),
    "r_bucket_score": (
        r.bucket_scores,
        f"""SELECT {_DBUCKET} AS delivery_bucket, {mean("review_score")} AS avg_score, COUNT(*) AS cnt
            FROM order_delivery od JOIN fact_reviews fr ON od.order_id = fr.order_id GROUP BY 1""",
    ),
    "r_status_counts": (
        r.status_counts,
        "SELECT order_status, COUNT(*) AS cnt FROM stg_orders GROUP BY order_status",
    ),
    "r_status_scores": (
        r.status_scores,
        f"""SELECT order_status, {mean("review_score")} AS avg_score, COUNT(*) AS cnt
            FROM fact_reviews f JOIN dim_order o ON f.order_key = o.order_key GROUP BY order_status""",
    ),
    "r_city_state": (
        r.city_state,
        f"""SELECT city, state, CAST(SUM(price) AS {_MONEY}) AS revenue, COUNT(DISTINCT seller_key) AS sellers
            FROM fact_order_items f JOIN dim_order o ON f.order_key = o.order_key GROUP BY city, state""",
    ),
    "r_city_state_named": (
        lambda wh: r.city_state(wh, cities=["NATION_3", "NATION_7"], states=["NATION_3", "NATION_7"]),
        f"""SELECT city, state, CAST(SUM(price) AS {_MONEY}) AS revenue, COUNT(DISTINCT seller_key) AS sellers
            FROM fact_order_items f JOIN dim_order o ON f.order_key = o.order_key
            WHERE city IN ('NATION_3', 'NATION_7') AND state IN ('NATION_3', 'NATION_7') GROUP BY city, state""",
    ),
    "r_state_sellers": (
        lambda wh: r.city_state(wh, by=["state"]),
        f"""SELECT state, CAST(SUM(price) AS {_MONEY}) AS revenue, COUNT(DISTINCT seller_key) AS sellers
            FROM fact_order_items f JOIN dim_order o ON f.order_key = o.order_key GROUP BY state""",
    ),
    "r_named_sellers": (
        lambda wh: r.named_sellers(wh, _poor_suppliers(wh)),
        f"""SELECT s.seller_id, CAST(SUM(price) AS {_MONEY}) AS revenue, COUNT(DISTINCT f.order_id) AS orders
            FROM fact_order_items f JOIN dim_seller s ON f.seller_key = s.seller_key
            WHERE s.seller_id IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 0) GROUP BY s.seller_id""",
    ),
    "r_delay_severity": (
        r.delay_severity,
        f"""SELECT i.severity, avg_score_items, item_rows, avg_score, reviews
            FROM (SELECT {_SEVERITY} AS severity, {mean("review_score")} AS avg_score_items, COUNT(*) AS item_rows
                  FROM fact_order_items f JOIN fact_reviews r ON f.order_key = r.order_key WHERE delivery_delay_days > 0 GROUP BY 1) i
            JOIN (SELECT {_SEVERITY} AS severity, {mean("review_score")} AS avg_score, COUNT(*) AS reviews
                  FROM (SELECT DISTINCT order_key, delivery_delay_days FROM fact_order_items) f JOIN fact_reviews r ON f.order_key = r.order_key
                  WHERE delivery_delay_days > 0 GROUP BY 1) o ON i.severity = o.severity""",
    ),
    "r_cliff": (
        r.cliff,
        """SELECT delay_days, ROUND(AVG(s), 6) AS mean_score, COUNT(*) AS orders
           FROM (SELECT order_id, MAX(delivery_delay_days) AS delay_days FROM fact_order_items WHERE delivery_delay_days IS NOT NULL GROUP BY order_id)
           JOIN (SELECT order_id, CAST(SUM(review_score) AS DOUBLE) / COUNT(*) AS s FROM fact_reviews GROUP BY order_id) USING (order_id)
           WHERE delay_days BETWEEN -25 AND 25 GROUP BY delay_days HAVING COUNT(*) >= 30""",
    ),
    "r_cliff_delivered": (
        r.cliff_delivered,
        f"""SELECT delay_days, {mean("review_score")} AS avg_score, COUNT(DISTINCT od.order_id) AS delivered_orders FROM {_DELIVERY}
            WHERE order_status = 'delivered' AND items > 0 AND delay_days BETWEEN -25 AND 25 GROUP BY delay_days HAVING COUNT(DISTINCT od.order_id) >= 30""",
    ),
    "r_days_histogram": (
        r.days_histogram,
        f"""SELECT CASE WHEN actual_days < 0 THEN 'negative' ELSE {_DBUCKET} END AS bucket, COUNT(*) AS orders
            FROM (SELECT date_diff('day', order_purchase_timestamp, order_delivered_customer_date) AS actual_days FROM stg_orders) GROUP BY 1""",
    ),
    "r_customer_items": (
        lambda wh: r.customer_items(wh, _poor_customers(wh)),
        """SELECT f.* FROM fact_order_items f JOIN dim_customer c ON f.customer_key = c.customer_key
           WHERE c.customer_unique_id IN (SELECT CAST(o_custkey * 11 + o_orderkey % 11 AS VARCHAR) FROM orders
                                          WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))""",
    ),
    "r_page_overview": (
        r.overview_categories,
        f"""SELECT category_group, category_name_english, CAST(SUM(price) AS {_MONEY}) AS items_revenue_net, COUNT(*) AS items_sold
            FROM fact_order_items f JOIN dim_order o ON f.order_key = o.order_key JOIN dim_product_grouped p ON f.product_key = p.product_key
            WHERE {_NET} GROUP BY category_group, category_name_english""",
    ),
    "r_page_overview_months": (
        lambda wh: r.overview_months(wh, *CLIP),
        f"""SELECT year, month, CAST(COALESCE(SUM(price) FILTER (WHERE {_NET}), 0) AS {_MONEY}) AS items_revenue_net, {_LATE_COLUMNS}
            FROM fact_order_items f JOIN dim_order o ON f.order_key = o.order_key JOIN dim_date ON purchase_date_key = date_key
            WHERE full_date BETWEEN DATE '{CLIP[0]}' AND DATE '{CLIP[1]}' GROUP BY year, month""",
    ),
    "r_page_overview_sliced": (
        lambda wh: r.overview_months(wh, category_group="Home & Furniture"),
        f"""SELECT year, month, CAST(COALESCE(SUM(price) FILTER (WHERE {_NET}), 0) AS {_MONEY}) AS items_revenue_net, {_LATE_COLUMNS}
            FROM fact_order_items f JOIN dim_order o ON f.order_key = o.order_key JOIN dim_date ON purchase_date_key = date_key
            JOIN dim_product_grouped p ON f.product_key = p.product_key WHERE category_group = 'Home & Furniture' GROUP BY year, month""",
    ),
    "r_page_overview_cards": (
        lambda wh: union_all([r.overview_cards(wh, g).withColumn("category_group", F.lit(g)) for g in (None, "Home & Furniture")]),
        "\nUNION ALL\n".join(_overview_cards_sql(g) for g in (None, "Home & Furniture")),
    ),
    "r_page_promise_cards": (
        lambda wh: union_all([r.promise_cards(wh, *s).withColumn("slicers", F.lit(n)) for n, s in SLICERS.items()]),
        "\nUNION ALL\n".join(_cards_sql(n, _POINTS) for n in SLICERS),
    ),
    "r_page_delivery_cards_sliced": (
        lambda wh: union_all([r.delivery_cards(wh, *s).withColumn("slicers", F.lit(n)) for n, s in SLICERS.items()]),
        "\nUNION ALL\n".join(
            _cards_sql(n, [f"{mean('actual_days')} AS avg_delivery_days", "COUNT(*) FILTER (items > 0) AS orders_items"]) for n in SLICERS
        ),
    ),
    "r_page_geography_customer": (
        r.geography_customers,
        f"""SELECT o.state AS customer_state, CAST(SUM(price) AS {_MONEY}) AS revenue, COUNT(DISTINCT f.order_id) AS orders
            FROM fact_order_items f JOIN dim_order o ON f.order_key = o.order_key GROUP BY o.state""",
    ),
    "r_page_geography_seller": (
        r.geography_sellers,
        f"""SELECT s.state AS seller_state, CAST(SUM(price) AS {_MONEY}) AS revenue, COUNT(DISTINCT f.order_id) AS orders, COUNT(DISTINCT f.seller_key) AS sellers
            FROM fact_order_items f JOIN dim_seller s ON f.seller_key = s.seller_key GROUP BY s.state""",
    ),
    "r_page_geography_sliced": (
        lambda wh: r.geography_sellers(wh, SELLER_STATES, CUSTOMER_STATES),
        f"""SELECT s.state AS seller_state, CAST(SUM(price) AS {_MONEY}) AS revenue, COUNT(DISTINCT f.order_id) AS orders, COUNT(DISTINCT f.seller_key) AS sellers
            FROM fact_order_items f JOIN dim_seller s ON f.seller_key = s.seller_key JOIN dim_order o ON f.order_key = o.order_key
            WHERE s.state IN {tuple(SELLER_STATES)} AND o.state IN {tuple(CUSTOMER_STATES)} GROUP BY s.state""",
    ),
    "r_page_delivery": (
        r.late_by_state_top,
        f"""SELECT o.state AS customer_state, {_LATE_COLUMNS} FROM fact_order_items f JOIN dim_order o ON f.order_key = o.order_key
            GROUP BY o.state ORDER BY pct_late DESC, customer_state LIMIT 10""",
    ),
    "r_page_delivery_cards": (
        r.delivery_cards,
        f"""SELECT {_LATE_COLUMNS}, (SELECT {mean("actual_days")} FROM order_delivery) AS avg_delivery_days, COUNT(DISTINCT f.order_id) AS orders_items
            FROM fact_order_items f JOIN dim_order o ON f.order_key = o.order_key""",
    ),
    "r_page_payments": (
        r.payment_cards,
        f"""SELECT (SELECT CAST(SUM(payment_value) AS {_MONEY}) FROM fact_payments JOIN dim_order USING (order_key) WHERE {_NET}) AS net_revenue_paid,
                   (SELECT {mean("payment_installments")} FROM fact_payments) AS avg_installments,
                   {per("COUNT(*) FILTER (WHERE n > 1)", "COUNT(*)", 100)} AS pct_multi_payment
            FROM (SELECT order_id, COUNT(*) AS n FROM fact_payments GROUP BY order_id)""",
    ),
    "r_page_promise": (
        r.promise_bands,
        f"""SELECT {band("actual_days")} AS duration_band, {band("actual_days", True)} AS duration_band_sort,
                   CASE WHEN delay_days > 0 THEN 'Broken' ELSE 'Kept' END AS promise_status,
                   ROUND({score("order_status = 'delivered'")}, 6) AS avg_score,
                   CAST(COUNT(review_score) FILTER (WHERE order_status = 'delivered') AS BIGINT) AS reviews
            FROM {_DELIVERY} WHERE actual_days > 4 AND actual_days <= 29 GROUP BY 1, 2, 3""",
    ),
    "r_page_promise_weeks": (
        r.promise_weeks,
        f"""SELECT a.week_start, avg_promised_days, avg_transit_days, late_orders, delivered_orders, pct_late
            FROM (SELECT week_start, {mean("p")} AS avg_promised_days, {avg_days("t")} AS avg_transit_days
                  FROM (SELECT CAST(date_trunc('week', b.order_purchase_timestamp) AS DATE) AS week_start, b.order_id,
                               MAX(actual_delivery_days - delivery_delay_days) AS p, MAX({_TRANSIT}) AS t
                        FROM buyers b LEFT JOIN fact_order_items f ON b.order_id = f.order_id GROUP BY 1, 2) GROUP BY 1) a
            JOIN (SELECT CAST(date_trunc('week', b.order_purchase_timestamp) AS DATE) AS week_start, {_LATE_COLUMNS}
                  FROM buyers b JOIN dim_order o ON b.order_key = o.order_key LEFT JOIN fact_order_items f ON b.order_id = f.order_id GROUP BY 1) l
            ON a.week_start = l.week_start""",
    ),
    "r_customer_rows": (
        r.customer_reviews,
        """SELECT review_id, order_id, f.customer_key, customer_unique_id, review_score
           FROM fact_reviews f LEFT JOIN dim_customer c ON f.customer_key = c.customer_key""",
    ),
    "r_customer_payments": (
        r.customer_payments,
        """SELECT c.customer_key, customer_unique_id, order_id, payment_sequential, payment_type, payment_value
           FROM dim_customer c JOIN fact_payments f ON f.customer_key = c.customer_key""",
    ),
    "r_item_sample": (
        r.item_sample,
        "SELECT order_id, order_item_id, price, freight_value FROM fact_order_items ORDER BY order_id, order_item_id LIMIT 10",
    ),
    "r_delay_mean": (
        r.delay_mean,
        f"SELECT {mean('delivery_delay_days')} AS avg_delay, {_INT_MEAN('delivery_delay_days')} AS avg_delay_int FROM fact_order_items",
    ),
    "r_delivery_days": (
        r.delivery_days,
        """SELECT order_id, order_item_id, CAST(date_diff('day', purchase_timestamp, delivered_customer_date) AS INTEGER) AS days FROM fact_order_items""",
    ),
    "r_extra_payments": (
        r.extra_payments,
        "SELECT COUNT(*) - COUNT(DISTINCT customer_key) AS extra_rows FROM fact_payments",
    ),
    "r_gap_median": (
        r.gap_median,
        f"SELECT CAST(MEDIAN(days) AS DOUBLE) AS median FROM ({_GAPS})",
    ),
}
