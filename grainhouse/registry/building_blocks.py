"""The relational operators and functions one by one, over whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from grainhouse.functions import labels
from grainhouse.functions import scalar as s
from grainhouse.operators import aggregates as a
from grainhouse.operators import joins as j
from grainhouse.operators.keys import number_within, percent_rank_weights
from grainhouse.operators.selection import exact_quantiles, rank_rows
from grainhouse.plans import layers, slices
from grainhouse.plans import measures as m
from grainhouse.registry.measures import _MONEY, _NET, _NET_TOTAL
from grainhouse.registry.oracle import case, mean, minutes, per

_INT_MEAN = "CAST(trunc(CAST(SUM({0}) AS DOUBLE) / COUNT({0})) AS BIGINT)".format


# --- columns and predicates ---------------------------------------------------


def projection(wh):
    """Rename, constant and casts."""
    return wh.raw.order_items.select(
        F.col("order_id").alias("id"),
        F.lit(layers.COUNTRY).alias("country"),
        F.col("order_item_id").cast("string").alias("item_text"),
        F.col("product_id").cast("int").alias("product_no"),
        F.col("price").cast("double").alias("price_double"),
        F.col("price").cast("decimal(12,1)").alias("price_tenths"),
        F.col("shipping_limit_date").cast("date").alias("limit_day"),
    )


def predicates(wh):
    """NULL tests, lists, ranges and comparisons, counted in one pass."""
    arrived, delay = F.col("delivered_customer_date"), F.col("delivery_delay_days")
    tests = {
        "arrived": arrived.isNotNull(),
        "open": arrived.isNull(),
        "listed": F.col("order_item_id").isin(1, 3),
        "unlisted": ~F.col("order_item_id").isin(1, 3),
        "near": delay.between(-5, 5),
        "far": ~delay.between(-5, 5),
        "cheap_or_late": (F.col("price") < 10000) | (delay > 0),
        "dear_and_late": (F.col("price") >= 50000) & (delay > 0),
    }
    return wh.fact_order_items.agg(*[s.count_where(t).alias(n) for n, t in tests.items()])


def arithmetic(wh):
    """Sum, negation, difference and percentage of columns."""
    return wh.fact_order_items.select(
        "order_id",
        "order_item_id",
        (F.col("price") + F.col("freight_value")).cast("decimal(12,2)").alias("total"),
        (F.col("actual_delivery_days") * -1).alias("negated"),
        (F.col("actual_delivery_days") - F.col("delivery_delay_days")).alias("promised"),
        F.round(s.safe_div(F.col("freight_value").cast("double") * 100, F.col("price").cast("double")), 6).alias("freight_pct"),
    )


def null_handling(wh):
    """Fallback chain, division by zero as NULL, missing category."""
    return wh.raw.products.select(
        "product_id",
        F.coalesce("product_category_name", F.lit("Unknown")).alias("category"),
        F.nullif(F.col("product_photos_qty"), F.lit(1)).alias("photos_or_null"),
        F.round(s.safe_div(F.col("product_weight_g").cast("double"), (F.col("product_photos_qty") - 1).cast("double")), 6).alias("per_extra_photo"),
    )


def text_functions(wh):
    """Trim, case, zero padding and concatenation."""
    return wh.raw.customers.select(
        "customer_id",
        s.clean_upper("customer_city").alias("city"),
        s.clean_lower("customer_state").alias("state"),
        s.zip5("customer_zip_code_prefix").alias("zip"),
        labels.customer_label("customer_unique_id").alias("label"),
    )


def date_functions(wh):
    """Calendar parts, keys and differences of every order."""
    bought, arrived = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    parts = s.calendar_columns(bought.cast("date"))
    return wh.stg_orders.select(
        "order_id",
        *[c.alias(n) for n, c in parts.items()],
        F.dayofmonth(bought).alias("day"),
        F.date_add(bought.cast("date"), 1).alias("next_day"),
        s.week_start(bought).alias("week_start"),
        s.days_between(bought, arrived).alias("days"),
        s.minutes_between(bought, arrived).alias("minutes"),
        s.date_key(arrived).alias("arrived_key"),
    )


def math_functions(wh):
    """Square root and power, over the distance of each seller from the origin."""
    lat, lng = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    return wh.dim_seller.select("seller_id", F.round(F.sqrt(F.pow(lat, 2) + F.pow(lng, 2)), 6).alias("distance"))


# --- joins ---------------------------------------------------------------------


def paired_orders(wh):
    """First and second order of a customer side by side."""
    w = Window.partitionBy("customer_key").orderBy("purchase_timestamp", "order_id")
    ranked = (
        wh.orders.where(F.col("customer_key").isNotNull())
        .select("customer_key", "order_id", "purchase_timestamp", F.row_number().over(w).alias("place"))
        .where(F.col("place") <= 2)
    )

    def at(place: int):
        return F.max(F.when(F.col("place") == place, F.col("order_id")))

    pairs = ranked.groupBy("customer_key").agg(at(1).alias("first_order"), at(2).alias("second_order"))
    return pairs.where(F.col("second_order").isNotNull())


def fan_out(wh):
    """What three totals become when their table is joined to item rows."""
    items = wh.stg_order_items
    pay = j.fan_out_total(items, wh.stg_payments, "order_id", "payment_value")
    rev = j.fan_out_total(items, wh.stg_reviews, "order_id", "review_score")
    return a.union_all(
        [
            df.select(F.lit(n).alias("child"), F.col("total").cast(s.MONEY).alias("total"), "pairs")
            for n, df in (("payments", pay), ("reviews", rev))
        ]
    )


def drill(wh):
    """Latest delivery of each order beside each of its reviews."""
    return j.drill_across(
        wh.fact_order_items,
        "order_key",
        {"actual_days": F.max("actual_delivery_days"), "items": F.count(F.lit(1))},
        wh.fact_reviews.select("order_key", "review_id", "review_score"),
    )


# --- aggregates, windows, order ---------------------------------------------------


def counts(wh):
    return wh.fact_order_items.groupBy("seller_key").agg(
        F.count(F.lit(1)).alias("items"),
        F.countDistinct("order_key").alias("orders"),
        F.countDistinct("product_key").alias("products"),
        (F.count(F.lit(1)) - F.countDistinct("order_key")).alias("extra"),
    )


def sums(wh):
    return wh.fact_payments.groupBy("payment_type").agg(
        s.money_sum("payment_value").alias("total"),
        s.mean("payment_value").alias("avg_value"),
        s.mean("payment_installments").alias("avg_instalments"),
        s.truncated_mean("payment_installments").alias("avg_instalments_int"),
        F.min("payment_value").alias("smallest"),
        F.max("payment_value").alias("largest"),
    )


def conditional(wh):
    """Hand-made pivot: a column per delivery outcome and year."""
    return m.on_orders(
        wh,
        ["year"],
        s.count_where(F.col("delay_days") > 0).alias("late"),
        s.count_where(F.col("delay_days") <= 0).alias("on_time"),
        s.count_where(F.col("delay_days").isNull()).alias("open"),
        s.mean(F.when(F.col("delay_days") > 0, F.col("actual_days"))).alias("avg_days_late"),
    )


def two_level(wh):
    """Mean of order totals per state: orders first, then states."""
    per_order = wh.fact_order_items.groupBy("order_key").agg(F.sum("price").alias("total"))
    states = wh.dim_order.select("order_key", "state")
    return (
        per_order.join(states, "order_key")
        .groupBy("state")
        .agg(s.mean("total").alias("avg_order"), F.max("total").cast(s.MONEY).alias("largest_order"))
    )


def repeated_lines(wh):
    """Line numbers used more than once in an order of the given line items."""
    return a.repeated(wh.raw.table("lineitem"), ["l_orderkey", "l_linenumber"])


def numbered_lines(wh):
    """Items of a seller numbered by price, the hot seller spread over tasks."""

    def run():
        rows = wh.fact_order_items.select("seller_key", "price", "order_id", "order_item_id")
        return number_within(rows, "seller_key", ["price", "order_id", "order_item_id"], "place", wh.store, "seller_lines")

    return wh.once("seller_lines", run)


def customer_percent_rank(wh):
    """Percent rank of every distinct customer total, highest first."""

    def run():
        paid = wh.orders.where(F.col("payments") > 0).groupBy("customer_key").agg(F.sum("paid").cast(s.MONEY).alias("paid"))
        return percent_rank_weights(paid, "paid", wh.store, "customer_paid")

    return wh.once("customer_paid", run).select("paid", "n", F.round("pct_rank", 9).alias("pct_rank"))


def state_ranks(wh):
    """Rank of each state among all states, whatever is shown."""
    revenue = m.revenue_by_state(wh).drop("customers")
    return a.rank_global(revenue, "revenue", "place")


def top_states(wh):
    """Five states with the most revenue, shown by number of customers."""
    return a.top_then_sort(
        m.revenue_by_state(wh),
        5,
        by=[F.col("revenue").desc(), F.col("customer_state")],
        then=[F.col("customers").desc(), F.col("customer_state")],
    )


def sorted_bands(wh):
    """Bands in their own order, which the text would not give."""
    return m.per_label(wh, "duration_band", "duration_band_sort").orderBy(F.col("duration_band_sort").asc_nulls_last())


def filter_context(wh):
    """Two groups shown, measured against all groups."""
    return m.net_share(wh, only=["Home & Furniture", "Electronics & Appliances"])


def sliced_places(wh):
    """Revenue from sellers of one state to customers of each state."""
    rows = m.attach(wh, wh.fact_order_items.select("order_key", "seller_key", "price"), ["seller_state", "customer_state"])
    return rows.groupBy("seller_state", "customer_state").agg(s.money_sum("price").alias("revenue"))


def totals_row(wh):
    """Independent totals as one row."""
    return a.side_by_side(
        wh.stg_orders.agg(F.count(F.lit(1)).alias("orders")),
        wh.stg_order_items.agg(s.money_sum("price").alias("items")),
        wh.stg_payments.agg(s.money_sum("payment_value").alias("paid")),
        wh.stg_reviews.agg(F.max("review_score").alias("best")),
    )


_ITEM_ORDER = "fact_order_items f JOIN dim_order o ON f.order_key = o.order_key"
_STATE_SALES = f"""SELECT state AS customer_state, CAST(SUM(price) AS {_MONEY}) AS revenue, COUNT(DISTINCT customer_key) AS customers
                   FROM dim_order o LEFT JOIN fact_order_items f ON o.order_key = f.order_key GROUP BY state"""
_TS = "order_purchase_timestamp"

QUANTILES = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "q99": 0.99, "highest": 1.0}


def _rounded(df, names):
    return df.select(*[F.round(n, 4).alias(n) for n in names])


_SLICERS = ["purchase_month", "customer_state", "seller_state", "category_group"]
SLICED = [()] + [(a,) for a in _SLICERS] + [(a, b) for k, a in enumerate(_SLICERS) for b in _SLICERS[k + 1 :]]


def sliced_counts(wh):
    """Distinct orders by every slicer and every two of them, from the rollup alone."""

    def cut(by):
        found = slices.sliced_counts(wh.order_slices, by)
        return found.select(
            F.lit(" ".join(by)).alias("slicers"),
            *[(F.col(c) if c in by else F.lit(None)).cast("string").alias(c) for c in _SLICERS],
            *slices.COUNTS,
            "pct_late",
        )

    return a.union_all([cut(by) for by in SLICED])


def _sliced_sql() -> str:
    orders = """SELECT order_key, order_status, customer_state, delay_days, d.purchase_date_key // 100 AS purchase_month
                FROM order_delivery o JOIN (SELECT order_key, {day} AS purchase_date_key FROM buyers) d USING (order_key)"""
    orders = orders.format(day="CAST(strftime(order_purchase_timestamp, '%Y%m%d') AS INTEGER)")
    items = """SELECT o.*, s.state AS seller_state, p.category_group FROM ({orders}) o JOIN fact_order_items f ON o.order_key = f.order_key
               LEFT JOIN dim_seller s ON f.seller_key = s.seller_key LEFT JOIN dim_product_grouped p ON f.product_key = p.product_key"""
    parts = []
    for by in SLICED:
        source = items.format(orders=orders) if {"seller_state", "category_group"} & {*by} else orders
        keys = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in by else f"CAST(NULL AS VARCHAR) AS {c}" for c in _SLICERS)
        late = "COUNT(DISTINCT order_key) FILTER (order_status = 'delivered' AND delay_days > 0)"
        delivered = "COUNT(DISTINCT order_key) FILTER (order_status = 'delivered')"
        parts.append(
            f"SELECT '{' '.join(by)}' AS slicers, {keys}, COUNT(DISTINCT order_key) AS orders, {delivered} AS delivered_orders, "
            f"{late} AS late_orders, {per(late, delivered, 100)} AS pct_late FROM ({source})" + (f" GROUP BY {', '.join(by)}" if by else "")
        )
    return "\nUNION ALL\n".join(parts)


QUERIES = {
    "col_projection": (
        projection,
        """SELECT order_id AS id, 'Brazil' AS country, CAST(order_item_id AS VARCHAR) AS item_text, CAST(product_id AS INTEGER) AS product_no,
                  CAST(price AS DOUBLE) AS price_double, CAST(price AS DECIMAL(12,1)) AS price_tenths, CAST(shipping_limit_date AS DATE) AS limit_day
           FROM src_order_items""",
    ),
    "col_predicates": (
        predicates,
        """SELECT COUNT(*) FILTER (WHERE delivered_customer_date IS NOT NULL) AS arrived, COUNT(*) FILTER (WHERE delivered_customer_date IS NULL) AS open,
                  COUNT(*) FILTER (WHERE order_item_id IN (1, 3)) AS listed, COUNT(*) FILTER (WHERE order_item_id NOT IN (1, 3)) AS unlisted,
                  COUNT(*) FILTER (WHERE delivery_delay_days BETWEEN -5 AND 5) AS near, COUNT(*) FILTER (WHERE delivery_delay_days NOT BETWEEN -5 AND 5) AS far,
                  COUNT(*) FILTER (WHERE price < 10000 OR delivery_delay_days > 0) AS cheap_or_late,
                  COUNT(*) FILTER (WHERE price >= 50000 AND delivery_delay_days > 0) AS dear_and_late
           FROM fact_order_items""",
    ),
    "col_arithmetic": (
        arithmetic,
        """SELECT order_id, order_item_id, CAST(price + freight_value AS DECIMAL(12,2)) AS total, -actual_delivery_days AS negated,
                  actual_delivery_days - delivery_delay_days AS promised,
                  ROUND(CAST(freight_value AS DOUBLE) * 100 / NULLIF(CAST(price AS DOUBLE), 0), 6) AS freight_pct
           FROM fact_order_items""",
    ),
    "col_null_handling": (
        null_handling,
        """SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN p_partkey % 54 = 0 THEN 'Unknown' ELSE lower(p_brand) END AS category,
                  CAST(NULLIF(p_partkey % 5 + 1, 1) AS INTEGER) AS photos_or_null,
                  ROUND(CAST(p_size * 200 AS DOUBLE) / NULLIF(CAST(p_partkey % 5 AS DOUBLE), 0), 6) AS per_extra_photo
           FROM part""",
    ),
    "fn_text": (
        text_functions,
        """SELECT customer_id, upper(trim(customer_city)) AS city, lower(trim(customer_state)) AS state,
                  lpad(CAST(customer_zip_code_prefix AS VARCHAR), 5, '0') AS zip, 'Customer #' || customer_unique_id AS label
           FROM src_customers""",
    ),
    "fn_dates": (
        date_functions,
        f"""SELECT order_id, d.*, CAST(day({_TS}) AS INTEGER) AS day, CAST({_TS} AS DATE) + 1 AS next_day,
                   CAST(date_trunc('week', {_TS}) AS DATE) AS week_start,
                   CAST(date_diff('day', {_TS}, order_delivered_customer_date) AS INTEGER) AS days,
                   {minutes(_TS, "order_delivered_customer_date")} AS minutes,
                   CAST(strftime(order_delivered_customer_date, '%Y%m%d') AS INTEGER) AS arrived_key
            FROM stg_orders JOIN dim_date d ON CAST({_TS} AS DATE) = full_date""",
    ),
    "fn_math": (
        math_functions,
        """SELECT seller_id, ROUND(sqrt(pow(CAST(latitude AS DOUBLE), 2) + pow(CAST(longitude AS DOUBLE), 2)), 6) AS distance FROM dim_seller""",
    ),
    "join_inner": (
        lambda wh: m.attach(wh, wh.fact_order_items.select("order_id", "order_item_id", "product_key", "seller_key"), ["category_group", "seller_state"]).drop("product_key", "seller_key"),
        """SELECT order_id, order_item_id, category_group, s.state AS seller_state FROM fact_order_items f
           JOIN dim_product_grouped p ON f.product_key = p.product_key JOIN dim_seller s ON f.seller_key = s.seller_key""",
    ),
    "join_left_lookup": (
        lambda wh: j.lookup(
            wh.raw.products.select("product_id", "product_category_name"),
            wh.raw.category_translation,
            {"product_category_name": "product_category_name"},
            {"english": "product_category_name_english"},
        ),
        """SELECT product_id, p.product_category_name, product_category_name_english AS english
           FROM src_products p LEFT JOIN src_translation t ON p.product_category_name = t.product_category_name""",
    ),
    "join_lookup_aggregate": (
        lambda wh: j.lookup(
            wh.stg_customers.select("customer_id", "customer_zip_code_prefix"),
            wh.zip_centres,
            {"customer_zip_code_prefix": "zip_code_prefix"},
            {"latitude": "latitude", "longitude": "longitude"},
        ),
        """SELECT customer_id, customer_zip_code_prefix, latitude, longitude
           FROM stg_customers LEFT JOIN zip_centres ON customer_zip_code_prefix = zip_code_prefix""",
    ),
    "join_resolve_keys": (
        lambda wh: j.resolve_keys(
            wh.stg_order_items.select("order_id", "order_item_id", "seller_id", "product_id"),
            [(wh.dim_seller, "seller_id", "seller_key"), (wh.dim_product, "product_id", "product_key")],
        ),
        """SELECT order_id, order_item_id, i.seller_id, i.product_id, seller_key, product_key FROM stg_order_items i
           LEFT JOIN dim_seller s ON i.seller_id = s.seller_id LEFT JOIN dim_product p ON i.product_id = p.product_id""",
    ),
    "join_anti": (
        lambda wh: j.without_match(wh.stg_orders, wh.stg_order_items, "order_id").select("order_id", "order_status"),
        "SELECT o.order_id, order_status FROM stg_orders o LEFT JOIN src_order_items i ON o.order_id = i.order_id WHERE i.order_id IS NULL",
    ),
    "join_semi": (
        lambda wh: j.with_match(wh.stg_orders, wh.stg_order_items, "order_id").select("order_id", "order_status"),
        "SELECT order_id, order_status FROM stg_orders WHERE order_id IN (SELECT order_id FROM src_order_items)",
    ),
    "join_rank_pair": (
        paired_orders,
        """SELECT a.customer_key, a.order_id AS first_order, b.order_id AS second_order
           FROM (SELECT *, row_number() OVER (PARTITION BY customer_key ORDER BY order_purchase_timestamp, order_id) AS rn FROM buyers) a
           JOIN (SELECT *, row_number() OVER (PARTITION BY customer_key ORDER BY order_purchase_timestamp, order_id) AS rn FROM buyers) b
           ON a.customer_key = b.customer_key AND a.rn = 1 AND b.rn = 2""",
    ),
    "join_drill_across": (
        drill,
        """SELECT f.order_key, actual_days, items, review_id, review_score
           FROM (SELECT order_key, MAX(actual_delivery_days) AS actual_days, COUNT(*) AS items FROM fact_order_items GROUP BY order_key) f
           JOIN fact_reviews r ON f.order_key = r.order_key""",
    ),
    "join_fan_out": (
        fan_out,
        f"""SELECT 'payments' AS child, CAST(SUM(payment_value) AS {_MONEY}) AS total, COUNT(payment_value) AS pairs
            FROM src_order_items i JOIN src_payments p ON i.order_id = p.order_id
            UNION ALL SELECT 'reviews', CAST(SUM(review_score) AS {_MONEY}), COUNT(review_score)
            FROM src_order_items i JOIN src_reviews r ON i.order_id = r.order_id""",
    ),
    "agg_counts": (
        counts,
        """SELECT seller_key, COUNT(*) AS items, COUNT(DISTINCT order_key) AS orders, COUNT(DISTINCT product_key) AS products,
                  COUNT(*) - COUNT(DISTINCT order_key) AS extra FROM fact_order_items GROUP BY seller_key""",
    ),
    "agg_sums": (
        sums,
        f"""SELECT payment_type, CAST(SUM(payment_value) AS {_MONEY}) AS total, {mean("payment_value")} AS avg_value,
                   {mean("payment_installments")} AS avg_instalments, {_INT_MEAN("payment_installments")} AS avg_instalments_int,
                   MIN(payment_value) AS smallest, MAX(payment_value) AS largest FROM fact_payments GROUP BY payment_type""",
    ),
    "agg_conditional": (
        conditional,
        f"""SELECT CAST(year(order_purchase_timestamp) AS INTEGER) AS year, COUNT(*) FILTER (WHERE delay_days > 0) AS late,
                   COUNT(*) FILTER (WHERE delay_days <= 0) AS on_time, COUNT(*) FILTER (WHERE delay_days IS NULL) AS open,
                   {mean("CASE WHEN delay_days > 0 THEN actual_days END")} AS avg_days_late
            FROM order_delivery d JOIN buyers b ON d.order_key = b.order_key GROUP BY 1""",
    ),
    "agg_two_level": (
        two_level,
        f"""SELECT state, {mean("total")} AS avg_order, CAST(MAX(total) AS {_MONEY}) AS largest_order
            FROM (SELECT state, f.order_key, SUM(price) AS total FROM {_ITEM_ORDER} GROUP BY state, f.order_key) GROUP BY state""",
    ),
    "agg_having": (
        repeated_lines,
        "SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1",
    ),
    "agg_repeat_count": (
        lambda wh: repeated_lines(wh).agg(F.count(F.lit(1)).alias("repeated"), F.sum("copies").alias("total_rows")),
        """SELECT COUNT(*) AS repeated, CAST(SUM(c) AS BIGINT) AS total_rows
           FROM (SELECT COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)""",
    ),
    "agg_order_collapse": (
        lambda wh: a.collapse(
            m.attach(wh, wh.fact_order_items, ["seller_state"]), ["seller_state"], "order_key", F.max("actual_delivery_days").alias("days")
        ).groupBy("seller_state").agg(s.mean("days").alias("avg_days")),
        f"""SELECT seller_state, {mean("days")} AS avg_days
            FROM (SELECT s.state AS seller_state, order_key, MAX(actual_delivery_days) AS days
                  FROM fact_order_items f JOIN dim_seller s ON f.seller_key = s.seller_key GROUP BY 1, 2) GROUP BY seller_state""",
    ),
    "agg_share_of_total": (
        lambda wh: a.share_of_total(m.revenue_by_state(wh).drop("customers"), "revenue", "pct"),
        f"SELECT customer_state, revenue, {per('revenue', 'SUM(revenue) OVER ()', 100)} AS pct FROM ({_STATE_SALES})",
    ),
    "agg_bucketed": (
        lambda wh: wh.fact_payments.groupBy(s.bucket("payment_value", labels.VALUE_STEPS, labels.VALUE_REST).alias("bucket")).agg(F.count(F.lit(1)).alias("n")),
        f"SELECT {case('payment_value', labels.VALUE_STEPS, labels.VALUE_REST)} AS bucket, COUNT(*) AS n FROM fact_payments GROUP BY 1",
    ),
    "agg_median": (
        lambda wh: exact_quantiles(wh.stg_products, "product_weight_g", {"median": 0.5}, wh.store, "weight_values"),
        "SELECT CAST(MEDIAN(p_size * 200) AS DOUBLE) AS median FROM part",
    ),
    "agg_quantiles": (
        lambda wh: _rounded(exact_quantiles(wh.fact_order_items, "price", QUANTILES, wh.store, "price_values"), QUANTILES),
        "SELECT " + ", ".join(f"ROUND(quantile_cont(CAST(price AS DOUBLE), {q}), 4) AS {n}" for n, q in QUANTILES.items()) + " FROM fact_order_items",
    ),
    "win_rank_rows": (
        lambda wh: rank_rows(wh.fact_payments.select("order_id", "payment_sequential", "payment_value"), "payment_value", "place", wh.store, "payment_values"),
        "SELECT order_id, payment_sequential, payment_value, rank() OVER (ORDER BY payment_value DESC NULLS LAST) AS place FROM fact_payments",
    ),
    "win_row_number": (
        numbered_lines,
        """SELECT seller_key, price, order_id, order_item_id, row_number() OVER (PARTITION BY seller_key ORDER BY price, order_id, order_item_id) AS place
           FROM fact_order_items""",
    ),
    "win_percent_rank": (
        customer_percent_rank,
        f"""SELECT paid, COUNT(*) AS n, ROUND(MIN(p), 9) AS pct_rank
            FROM (SELECT paid, percent_rank() OVER (ORDER BY paid DESC) AS p
                  FROM (SELECT customer_key, CAST(SUM(payment_value) AS {_MONEY}) AS paid FROM fact_payments GROUP BY customer_key)) GROUP BY paid""",
    ),
    "win_rank_global": (
        state_ranks,
        f"SELECT customer_state, revenue, rank() OVER (ORDER BY revenue DESC) AS place FROM ({_STATE_SALES})",
    ),
    "sort_top_then_sort": (
        top_states,
        f"SELECT * FROM ({_STATE_SALES}) ORDER BY revenue DESC, customer_state LIMIT 5",
    ),
    "sort_by_rank_column": (
        sorted_bands,
        """SELECT CASE WHEN place IS NOT NULL THEN (place * 5) || '-' || (place * 5 + 4) || 'd' END AS duration_band, CAST(place AS INTEGER) AS duration_band_sort, COUNT(*) AS orders
           FROM (SELECT CASE WHEN actual_days BETWEEN 5 AND 29 THEN actual_days // 5 END AS place FROM order_delivery) GROUP BY place""",
    ),
    "ctx_ignore_filter": (
        filter_context,
        f"""SELECT * FROM (SELECT category_group, items_revenue_net, {per("items_revenue_net", _NET_TOTAL, 100)} AS pct_net
            FROM (SELECT category_group, CAST(SUM(price) AS {_MONEY}) AS items_revenue_net
                  FROM {_ITEM_ORDER} JOIN dim_product_grouped p ON f.product_key = p.product_key WHERE {_NET} GROUP BY category_group))
            WHERE category_group IN ('Home & Furniture', 'Electronics & Appliances')""",
    ),
    "ctx_sliced_counts": (sliced_counts, _sliced_sql()),
    "ctx_slicers": (
        sliced_places,
        f"""SELECT s.state AS seller_state, o.state AS customer_state, CAST(SUM(price) AS {_MONEY}) AS revenue
            FROM {_ITEM_ORDER} JOIN dim_seller s ON f.seller_key = s.seller_key GROUP BY 1, 2""",
    ),
    "scalar_totals": (
        totals_row,
        f"""SELECT (SELECT COUNT(*) FROM stg_orders) AS orders, (SELECT CAST(SUM(price) AS {_MONEY}) FROM src_order_items) AS items,
                   (SELECT CAST(SUM(payment_value) AS {_MONEY}) FROM src_payments) AS paid, (SELECT MAX(review_score) FROM stg_reviews) AS best""",
    ),
    "set_union_all": (
        lambda wh: a.union_all(
            [wh[f].groupBy("purchase_date_key").agg(F.count(F.lit(1)).alias("n")).select(F.lit(f).alias("fact"), "purchase_date_key", "n") for f in ("fact_order_items", "fact_payments", "fact_reviews")]
        ),
        "\nUNION ALL\n".join(
            f"SELECT '{f}' AS fact, purchase_date_key, COUNT(*) AS n FROM {f} GROUP BY purchase_date_key" for f in ("fact_order_items", "fact_payments", "fact_reviews")
        ),
    ),
    "set_distinct": (
        lambda wh: wh.dim_order.select("city", "state").distinct(),
        "SELECT DISTINCT upper(n_name) AS city, upper(n_name) AS state FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
    ),
}
