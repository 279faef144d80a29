"""Report queries: the research questions and the dashboard pages."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainhouse.functions import labels
from grainhouse.functions.scalar import (
    bucket,
    count_where,
    days_between,
    mean,
    minutes_between,
    money_sum,
    percent,
    ratio,
    safe_div,
    truncated_mean,
)
from grainhouse.operators.aggregates import exact_median, share_of_total, side_by_side
from grainhouse.operators.joins import with_match
from grainhouse.plans import measures as m
from grainhouse.plans import slices
from grainhouse.plans.layers import MONTH, YEAR
from grainhouse.plans.warehouse import Warehouse

RATIO = "decimal(28,16)"  # ratios are summed exactly, whatever the order of partitions

def between_dates(df: DataFrame, first: str | None = None, last: str | None = None, role: str = "purchase") -> DataFrame:
    """Keep a window of days, both included, given as yyyy-mm-dd.

    The bounds go to the date key and to the partition column, so whole
    partitions and row groups outside the window are never read.
    """
    key = f"{role}_date_key"
    partitions = {YEAR: 10000, MONTH: 100}
    for bound, keep in ((first, Column.__ge__), (last, Column.__le__)):
        if bound is not None:
            number = int(bound.replace("-", ""))
            df = df.where(keep(F.col(key), F.lit(number)))
            for column, unit in partitions.items():
                if role == "purchase" and column in df.columns:
                    df = df.where(keep(F.col(column), F.lit(number // unit)))
    return df


def _day_before(text: str) -> str:
    return str(datetime.date.fromisoformat(text) - datetime.timedelta(days=1))


def _months(wh: Warehouse, before: str | None, where: Column) -> DataFrame:
    rows = between_dates(wh.orders.where(where), last=None if before is None else _day_before(before))
    return m.attach(wh, rows, ["year", "month"])


# --- revenue over time ------------------------------------------------------------


def monthly_items(wh: Warehouse, before: str | None = None) -> DataFrame:
    """Orders with items and their revenue per purchase month."""
    return (
        _months(wh, before, F.col("items") > 0)
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("orders"), money_sum("items_revenue").alias("revenue"))
        .orderBy("year", "month")
    )


def monthly_net(wh: Warehouse, before: str | None = None) -> DataFrame:
    """Net paid revenue and paid orders per purchase month.

    Filter, order and date joins, then two sums; a paid order is one mirror row.
    """
    return (
        _months(wh, before, labels.is_net() & (F.col("payments") > 0))
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("orders"), money_sum("paid").alias("net_revenue"))
        .orderBy("year", "month")
    )


def _daily(wh: Warehouse, *more: str, orders: DataFrame | None = None) -> DataFrame:
    """Paid revenue and orders per purchase day.

    Orders are reduced to days before the calendar is joined.
    """
    paid = (wh.orders if orders is None else orders).where(F.col("payments") > 0)
    days = paid.groupBy("purchase_date_key").agg(
        money_sum("paid").alias("daily_revenue"), F.count(F.lit(1)).alias("orders")
    )
    return m.with_dates(wh, days, sorted({"full_date", *more})).drop("purchase_date_key")


def daily_net(wh: Warehouse, first: str | None = None, last: str | None = None) -> DataFrame:
    """Daily net revenue, highest day first."""
    days = _daily(wh, orders=between_dates(wh.orders.where(labels.is_net()), first, last))
    return days.orderBy(F.col("daily_revenue").desc(), "full_date")


def weekday_revenue(wh: Warehouse) -> DataFrame:
    """Mean daily revenue per weekday: days first, then weekdays."""
    return (
        _daily(wh, "day_name")
        .groupBy("day_name")
        .agg(mean("daily_revenue").alias("avg_revenue"))
        .orderBy(F.col("avg_revenue").desc(), "day_name")
    )


def _month_days(wh: Warehouse, month: int, years: Sequence[int]) -> DataFrame:
    """Daily revenue of one month in the given years; other years are not read,
    nor other months where the orders are partitioned by month."""
    months = [year * 100 + month for year in years]
    key = F.col("purchase_date_key")
    orders = wh.orders.where(reduce(Column.__or__, [key.between(ym * 100 + 1, ym * 100 + 31) for ym in months]))
    for column, wanted in ((YEAR, list(years)), (MONTH, months)):
        if column in orders.columns:
            orders = orders.where(F.col(column).isin(*wanted))
    return _daily(wh, "year", "month", orders=orders)


def month_daily(wh: Warehouse, month: int, years: Sequence[int]) -> DataFrame:
    """Daily revenue of one month in the given years, highest first."""
    return (
        _month_days(wh, month, years)
        .select("full_date", "daily_revenue", "orders")
        .orderBy(F.col("daily_revenue").desc(), "full_date")
    )


def month_head(wh: Warehouse, month: int, years: Sequence[int], days: tuple[int, int]) -> DataFrame:
    """Daily revenue of the first days of a month, year by year."""
    day = F.dayofmonth("full_date")
    rows = _month_days(wh, month, years).where(day.between(*days))
    return rows.select("year", day.alias("day"), "full_date", "daily_revenue").orderBy("year", "day")


def holiday_test(wh: Warehouse, month: int, window: tuple[int, int], event_days: Mapping[int, int]) -> DataFrame:
    """Per year: mean daily revenue outside the window, inside it, and on the day.

    ``event_days`` maps a year to the day of the month the event fell on.
    """
    day = F.dayofmonth("full_date")
    inside = day.between(*window)
    on_event = F.lit(False)
    for year, event in event_days.items():
        on_event = on_event | ((F.col("year") == year) & (day == event))
    revenue = F.col("daily_revenue")
    return (
        _month_days(wh, month, list(event_days))
        .groupBy("year")
        .agg(
            mean(F.when(~inside, revenue)).alias("avg_baseline"),
            mean(F.when(inside, revenue)).alias("avg_window"),
            F.max(F.when(on_event, revenue)).alias("event_revenue"),
        )
        .orderBy("year")
    )


# --- customers ----------------------------------------------------------------------


def score_stats(wh: Warehouse) -> DataFrame:
    """Lowest, highest and mean score; the mean also cut to an integer, as integer
    averaging would give it."""
    score = "review_score"
    return wh.fact_reviews.agg(
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        mean(score).alias("avg_score"),
        truncated_mean(score).alias("avg_score_int"),
    )


def repeat_customers(wh: Warehouse) -> DataFrame:
    """Customers with more than one paid order, all paying customers, and the share."""
    per_customer = (
        wh.orders.where((F.col("payments") > 0) & F.col("customer_key").isNotNull())
        .groupBy("customer_key")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    repeat = count_where(F.col("orders") > 1)
    return per_customer.agg(
        repeat.alias("repeat_customers"),
        F.count(F.lit(1)).alias("total_customers"),
        percent(repeat, F.count(F.lit(1))).alias("pct_repeat"),
    )


def second_order_gaps(wh: Warehouse) -> DataFrame:
    """Days from the first to the second order of each customer who has two.

    Ranking stops at two per customer before the shuffle, so a customer with very
    many orders sends two rows, and no self-join is needed.
    """
    bought = wh.orders.where((F.col("items") > 0) & F.col("customer_key").isNotNull())
    in_order = Window.partitionBy("customer_key").orderBy("purchase_timestamp", "order_id")
    first_two = (
        bought.select("customer_key", "order_id", "purchase_timestamp")
        .withColumn("place", F.row_number().over(in_order))
        .where(F.col("place") <= 2)
    )
    pairs = first_two.groupBy("customer_key").agg(
        F.min("purchase_timestamp").alias("first"), F.max("purchase_timestamp").alias("second"), F.max("place").alias("n")
    )
    return pairs.where(F.col("n") == 2).select("customer_key", days_between("first", "second").alias("days"))


def second_order_gap(wh: Warehouse) -> DataFrame:
    """Mean, integer mean and median of the gaps."""
    by_days = second_order_gaps(wh).groupBy("days").agg(F.count(F.lit(1)).alias("n"))
    total, n = F.sum(F.col("days") * F.col("n")), F.sum("n")
    return by_days.agg(
        ratio(total, n).alias("avg_days"),
        F.call_function("div", total, F.nullif(n, F.lit(0))).alias("avg_days_int"),
        F.percentile(F.col("days"), F.lit(0.5), F.col("n")).alias("median_days"),
        n.alias("customers"),
    )


def extra_payments(wh: Warehouse) -> DataFrame:
    """Payment rows beyond one per customer."""
    return wh.fact_payments.agg((F.count(F.lit(1)) - F.countDistinct("customer_key")).alias("extra_rows"))


def customer_reviews(wh: Warehouse) -> DataFrame:
    """Every review with its customer; reviews without one stay."""
    people = wh.dim_customer
    return wh.fact_reviews.join(people, "customer_key", "left").select(
        "review_id", "order_id", "customer_key", "customer_unique_id", "review_score"
    )


def customer_payments(wh: Warehouse) -> DataFrame:
    """Customers with each of their payments."""
    return wh.dim_customer.join(wh.fact_payments, "customer_key").select(
        "customer_key", "customer_unique_id", "order_id", "payment_sequential", "payment_type", "payment_value"
    )


def customer_items(wh: Warehouse, customers: DataFrame) -> DataFrame:
    """Item rows of the customers in a frame (customer_unique_id)."""
    wanted = with_match(wh.dim_customer, customers, "customer_unique_id")
    return with_match(wh.fact_order_items, wanted, "customer_key").drop("fact_key", YEAR, MONTH)


def item_sample(wh: Warehouse, n: int = 10) -> DataFrame:
    """First item rows by key, as an ordered sample."""
    columns = ("order_id", "order_item_id", "price", "freight_value")
    return wh.fact_order_items.select(*columns).orderBy("order_id", "order_item_id").limit(n)


# --- sellers, products, places --------------------------------------------------------


def seller_pareto(wh: Warehouse, top: float = 0.2) -> DataFrame:
    """Revenue of the best sellers, up to and including percent rank ``top``."""
    ranked = wh.seller_revenue_ranks.withColumn("earned", F.col("revenue") * F.col("n"))
    best = F.coalesce(F.sum(F.when(F.col("pct_rank") <= top, F.col("earned"))), F.lit(0))
    total = F.sum("earned")
    return ranked.agg(
        best.cast("decimal(38,2)").alias("top_revenue"),
        total.cast("decimal(38,2)").alias("total_revenue"),
        percent(best, total).alias("pct_from_top"),
    )


def category_top(wh: Warehouse, n: int = 10) -> DataFrame:
    """Best categories by revenue with their share of all categories."""
    sales = m.category_sales(wh, net=False).withColumnRenamed("items_revenue_gross", "revenue").drop("items_sold")
    shared = share_of_total(sales, "revenue", "pct_of_total")
    return shared.orderBy(F.col("revenue").desc(), "category_name_english").limit(n)


def category_items(wh: Warehouse) -> DataFrame:
    """Item rows, distinct products sold and revenue per category."""
    per_product = wh.fact_order_items.groupBy("product_key").agg(
        F.count(F.lit(1)).alias("items"), F.sum("price").alias("price")
    )
    return (
        m.attach(wh, per_product, ["category_name_english"])
        .groupBy("category_name_english")
        .agg(
            F.sum("items").alias("items"),
            F.count(F.lit(1)).alias("products"),
            money_sum("price").alias("revenue"),
        )
        .orderBy(F.col("revenue").desc(), "category_name_english")
    )


def freight_share(wh: Warehouse) -> DataFrame:
    """Mean price, freight and freight share of price per category.

    The share is the mean of item ratios, not the ratio of means; items priced
    zero have none.
    """
    share = safe_div(F.col("freight_value").cast("double"), F.col("price").cast("double")).cast(RATIO)
    per_product = wh.fact_order_items.groupBy("product_key").agg(
        F.sum("price").alias("price"),
        F.count("price").alias("prices"),
        F.sum("freight_value").alias("freight"),
        F.count("freight_value").alias("freights"),
        F.sum(share).alias("share"),
        F.count(share).alias("shares"),
    )
    return (
        m.attach(wh, per_product, ["category_name_english"])
        .groupBy("category_name_english")
        .agg(
            ratio(F.sum("price"), F.sum("prices")).alias("avg_price"),
            ratio(F.sum("freight"), F.sum("freights")).alias("avg_freight"),
            percent(F.sum("share"), F.sum("shares")).alias("freight_pct"),
        )
        .orderBy(F.col("freight_pct").desc(), "category_name_english")
    )


def weight_buckets(wh: Warehouse) -> DataFrame:
    """Mean freight per product weight bucket, lightest first."""
    per_product = wh.fact_order_items.groupBy("product_key").agg(
        F.sum("freight_value").alias("freight"), F.count("freight_value").alias("freights"), F.count(F.lit(1)).alias("items")
    )
    weighed = m.attach(wh, per_product, ["product_weight_g"]).where(F.col("product_weight_g").isNotNull())
    return (
        weighed.withColumn("weight_bucket", bucket("product_weight_g", labels.WEIGHT_STEPS, labels.WEIGHT_REST))
        .groupBy("weight_bucket")
        .agg(
            ratio(F.sum("freight"), F.sum("freights")).alias("avg_freight"),
            F.sum("items").alias("items"),
            F.min("product_weight_g").alias("_sort"),
        )
        .orderBy("_sort")
        .drop("_sort")
    )


def instalment_buckets(wh: Warehouse, payment_type: str = "credit_card") -> DataFrame:
    """Mean instalments per payment size, smallest first."""
    return (
        wh.fact_payments.where(F.col("payment_type") == payment_type)
        .withColumn("value_bucket", bucket("payment_value", labels.VALUE_STEPS, labels.VALUE_REST))
        .groupBy("value_bucket")
        .agg(
            mean("payment_installments").alias("avg_installments"),
            truncated_mean("payment_installments").alias("avg_installments_int"),
            F.count(F.lit(1)).alias("payments"),
            F.min("payment_value").alias("_sort"),
        )
        .orderBy("_sort")
        .drop("_sort")
    )


def city_state(
    wh: Warehouse,
    cities: Sequence[str] | None = None,
    states: Sequence[str] | None = None,
    by: Sequence[str] = ("city", "state"),
) -> DataFrame:
    """Item revenue and distinct sellers by customer place, optionally for named
    cities or states."""
    pairs = wh.order_sellers.withColumnsRenamed({"customer_city": "city", "customer_state": "state"})
    if cities is not None:
        pairs = pairs.where(F.col("city").isin(*cities))
    if states is not None:
        pairs = pairs.where(F.col("state").isin(*states))
    return (
        pairs.groupBy(*by, "seller_key")
        .agg(F.sum("price").alias("price"))
        .groupBy(*by)
        .agg(money_sum("price").alias("revenue"), F.count("seller_key").alias("sellers"))
    )


def named_sellers(wh: Warehouse, sellers: DataFrame) -> DataFrame:
    """Revenue and orders of the sellers in a frame (seller_id)."""
    wanted = with_match(wh.dim_seller, sellers, "seller_id").select("seller_key", "seller_id")
    return (
        wh.fact_order_items.join(wanted, "seller_key")
        .groupBy("seller_id", "order_key")
        .agg(F.sum("price").alias("price"))
        .groupBy("seller_id")
        .agg(money_sum("price").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )


# --- delivery ---------------------------------------------------------------------------


def approval_minutes(wh: Warehouse) -> DataFrame:
    """Mean minutes from purchase to approval; approval exists in staging only."""
    approved = wh.stg_orders.where(F.col("order_approved_at").isNotNull())
    minutes = minutes_between("order_purchase_timestamp", "order_approved_at")
    return approved.agg(
        mean(minutes).alias("avg_approval_minutes"), truncated_mean(minutes).alias("avg_approval_minutes_int")
    )


def distance_buckets(wh: Warehouse) -> DataFrame:
    """Delivery days by distance in degrees between buyer and seller.

    The grain is distinct order and distance, so an order with several sellers
    counts once per distance.
    """
    distances = wh.order_sellers.where(F.col("first_of_distance") & F.col("distance").isNotNull())
    return (
        distances.withColumn("distance_bucket", bucket("distance", labels.DISTANCE_STEPS, labels.DISTANCE_REST))
        .groupBy("distance_bucket")
        .agg(
            mean("actual_days").alias("avg_delivery_days"),
            truncated_mean("actual_days").alias("avg_delivery_days_int"),
            F.count(F.lit(1)).alias("orders"),
            F.min("distance").alias("_sort"),
        )
        .orderBy("_sort")
        .drop("_sort")
    )


def route_types(wh: Warehouse) -> DataFrame:
    """Delivery days within a state and across states, each order counted once,
    beside the mean over item rows."""
    routed = wh.order_sellers.where(F.col("seller_key").isNotNull())
    once = F.when(F.col("first_of_route"), F.col("actual_days"))
    return routed.groupBy("route_type").agg(
        mean(once).alias("avg_delivery_days"),
        ratio(F.sum(F.col("actual_days") * F.col("dated_rows")), F.sum("dated_rows")).alias("avg_delivery_days_items"),
        count_where(F.col("first_of_route")).alias("orders"),
    )


def delay_mean(wh: Warehouse) -> DataFrame:
    """Mean delay over item rows, true and cut to an integer."""
    return wh.fact_order_items.agg(
        mean("delivery_delay_days").alias("avg_delay"), truncated_mean("delivery_delay_days").alias("avg_delay_int")
    )


def delivery_days(wh: Warehouse) -> DataFrame:
    """Days to delivery of every item row."""
    days = days_between("purchase_timestamp", "delivered_customer_date").alias("days")
    return wh.fact_order_items.select("order_id", "order_item_id", days)


def days_histogram(wh: Warehouse) -> DataFrame:
    """Orders per delivery-time bucket, from staging; undelivered orders and
    negative times have buckets of their own."""
    days = days_between("order_purchase_timestamp", "order_delivered_customer_date")
    label = F.when(days < 0, F.lit("negative")).otherwise(labels.delivery_bucket(days))
    return wh.stg_orders.groupBy(label.alias("bucket")).agg(F.count(F.lit(1)).alias("orders"))


# --- reviews ------------------------------------------------------------------------------


def _reviewed(wh: Warehouse) -> DataFrame:
    return wh.orders.where(F.col("reviews") > 0)


def bucket_scores(wh: Warehouse) -> DataFrame:
    """Mean score per delivery bucket, all statuses on purpose: the bucket without
    a delivery is the point of the comparison."""
    return (
        _reviewed(wh)
        .groupBy("delivery_bucket")
        .agg(F.round(m.mean_score(), 6).alias("avg_score"), F.sum("reviews").alias("cnt"))
        .orderBy("avg_score", "delivery_bucket")
    )


def status_counts(wh: Warehouse) -> DataFrame:
    return (
        wh.stg_orders.groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.col("cnt").desc(), "order_status")
    )


def status_scores(wh: Warehouse) -> DataFrame:
    return (
        _reviewed(wh)
        .groupBy("order_status")
        .agg(F.round(m.mean_score(), 6).alias("avg_score"), F.sum("reviews").alias("cnt"))
        .orderBy("avg_score", "order_status")
    )


def delay_severity(wh: Warehouse) -> DataFrame:
    """Score by how late an order was: weighted by items, as joining items to
    reviews would have it, beside the mean over reviews.

    The item weight is the order's item count, so the join is never made.
    """
    late = _reviewed(wh).where(F.col("delay_days") > 0)
    items, reviews, total = F.col("items"), F.col("reviews"), F.col("review_total")
    return (
        late.withColumn("severity", labels.delay_severity("delay_days"))
        .groupBy("severity")
        .agg(
            ratio(F.sum(items * total), F.sum(items * reviews)).alias("avg_score_items"),
            F.sum(items * reviews).alias("item_rows"),
            F.round(m.mean_score(), 6).alias("avg_score"),
            F.sum(reviews).alias("reviews"),
            F.min("delay_days").alias("_sort"),
        )
        .orderBy("_sort")
        .drop("_sort")
    )


def cliff(wh: Warehouse, span: int = 25, min_orders: int = 30) -> DataFrame:
    """Mean of order scores per day of delay, all statuses; days with few orders
    are left out."""
    scored = (
        _reviewed(wh)
        .where(F.col("delay_days").between(-span, span))
        .withColumn("score", (F.col("review_total") / F.col("reviews")).cast(RATIO))
    )
    return (
        scored.groupBy("delay_days")
        .agg(mean("score").alias("mean_score"), F.count(F.lit(1)).alias("orders"))
        .where(F.col("orders") >= min_orders)
        .orderBy("delay_days")
    )


def cliff_delivered(wh: Warehouse, span: int = 25, min_orders: int = 30) -> DataFrame:
    """The dashboard form: mean over reviews of delivered orders per day of delay."""
    delivered = wh.orders.where(labels.is_delivered() & (F.col("items") > 0) & F.col("delay_days").between(-span, span))
    return (
        delivered.groupBy("delay_days")
        .agg(F.round(m.mean_score(), 6).alias("avg_score"), F.count(F.lit(1)).alias("delivered_orders"))
        .where(F.col("delivered_orders") >= min_orders)
        .orderBy("delay_days")
    )


# --- dashboard pages -------------------------------------------------------------------------


def overview_categories(wh: Warehouse, category_group: str | None = None) -> DataFrame:
    """Category table of the overview page, optionally sliced to one group."""
    table = m.category_sales(wh, ["category_group", "category_name_english"])
    return table if category_group is None else table.where(F.col("category_group") == category_group)


def _category_orders(wh: Warehouse, category_group: str) -> DataFrame:
    """The order mirror as a slicer on a category group leaves it: only orders with
    an item of the group, and only the revenue of those items."""
    sliced = wh.products.where(F.col("category_group") == category_group)
    kept = with_match(wh.fact_order_items, sliced, "product_key").groupBy("order_key").agg(
        F.sum("price").alias("items_revenue")
    )
    return wh.orders.drop("items_revenue").join(kept, "order_key")


def overview_months(
    wh: Warehouse, first: str | None = None, last: str | None = None, category_group: str | None = None
) -> DataFrame:
    """Net item revenue against late orders, month by month."""
    orders = wh.orders if category_group is None else _category_orders(wh, category_group)
    rows = m.attach(wh, between_dates(orders, first, last), ["year", "month"])
    revenue = F.coalesce(money_sum(F.when(labels.is_net(), F.col("items_revenue"))), F.lit(0).cast("decimal(38,2)"))
    return rows.groupBy("year", "month").agg(revenue.alias("items_revenue_net"), *m.late_columns())


def geography_customers(wh: Warehouse, customer_state: Sequence[str] | None = None) -> DataFrame:
    """Customer view of the geography page: item revenue and orders with items by state of the buyer."""
    orders = wh.orders.where(F.col("items") > 0)
    if customer_state is not None:
        orders = orders.where(F.col("customer_state").isin(*customer_state))
    return orders.groupBy("customer_state").agg(money_sum("items_revenue").alias("revenue"), F.count(F.lit(1)).alias("orders"))


def geography_sellers(wh: Warehouse, seller_state: Sequence[str] | None = None, customer_state: Sequence[str] | None = None) -> DataFrame:
    """Seller view of the geography page: item revenue, orders and sellers by state of the seller; a slicer for either side."""
    pairs = wh.order_sellers.where(F.col("seller_key").isNotNull())
    if seller_state is not None:
        pairs = pairs.where(F.col("seller_state").isin(*seller_state))
    if customer_state is not None:
        pairs = pairs.where(F.col("customer_state").isin(*customer_state))
    per_seller = pairs.groupBy("seller_state", "seller_key").agg(F.sum("price").alias("price"), count_where(F.col("first_of_state")).alias("orders"))
    return per_seller.groupBy("seller_state").agg(
        money_sum("price").alias("revenue"), F.sum("orders").alias("orders"), F.count(F.lit(1)).alias("sellers")
    )


def late_by_state_top(wh: Warehouse, n: int = 10, customer_state: str | None = None) -> DataFrame:
    """States with the largest share of late orders."""
    where = None if customer_state is None else F.col("customer_state") == customer_state
    return m.late_orders(wh, where=where).orderBy(F.col("pct_late").desc(), "customer_state").limit(n)


def sliced_orders(
    wh: Warehouse, customer_state: Sequence[str] | None = None, seller_state: Sequence[str] | None = None
) -> DataFrame:
    """The order mirror as two slicers leave it: the state of the buyer, and the state of a seller of one of its items. Orders
    never multiply: the mark of one row per order and seller state tells whether an order has one of the states."""
    orders = wh.orders
    if customer_state is not None:
        orders = orders.where(F.col("customer_state").isin(*customer_state))
    if seller_state is not None:
        sold = wh.order_sellers.where(F.col("first_of_state") & F.col("seller_state").isin(*seller_state))
        orders = with_match(orders, sold, "order_key")
    return orders


def overview_cards(wh: Warehouse, category_group: str | None = None) -> DataFrame:
    """Net item revenue, its share of all, and orders with an item of a category, for one group or for all of them.

    Orders come from the rollup of counts, so that no item is read for them.
    """
    chosen = m.category_sales(wh, ["category_group"])
    orders = wh.order_slices
    if category_group is None:
        orders = orders.where(F.exists("pairs", lambda p: p["category_group"].isNotNull()))
        counted = slices.sliced_counts(orders)
    else:
        chosen = chosen.where(F.col("category_group") == category_group)
        counted = slices.sliced_counts(orders, where={"category_group": [category_group]})
    both = side_by_side(
        chosen.agg(money_sum("items_revenue_net").alias("items_revenue_net")),
        m.net_items(wh).agg(money_sum("price").alias("whole")),
        counted.select(F.col("orders").alias("orders_category")),
    )
    return both.withColumn("pct_net", percent(F.col("items_revenue_net"), F.col("whole"))).drop("whole")


def promise_cards(
    wh: Warehouse, customer_state: Sequence[str] | None = None, seller_state: Sequence[str] | None = None
) -> DataFrame:
    """Points lost to lateness, delivered orders and the late share of them."""
    orders = sliced_orders(wh, customer_state, seller_state)
    return m.on_orders(wh, [], *m.points_lost_columns(), *m.late_columns(), orders=orders)


def delivery_cards(
    wh: Warehouse, customer_state: Sequence[str] | None = None, seller_state: Sequence[str] | None = None
) -> DataFrame:
    """Late share, mean delivery days and orders with items, over everything or what two slicers leave."""
    return m.on_orders(
        wh,
        [],
        *m.late_columns(),
        mean("actual_days").alias("avg_delivery_days"),
        count_where(F.col("items") > 0).alias("orders_items"),
        orders=sliced_orders(wh, customer_state, seller_state),
    )


def payment_cards(wh: Warehouse) -> DataFrame:
    """Net paid revenue, mean instalments and share of orders with several payments."""
    paid = m.on_orders(wh, [], money_sum(F.when(labels.is_net(), F.col("paid"))).alias("net_revenue_paid"))
    return side_by_side(paid, m.payment_habits(wh))


def promise_bands(wh: Warehouse) -> DataFrame:
    """Same wait, different promise: delivered score per band and promise."""
    return m.on_orders(
        wh,
        ["duration_band", "duration_band_sort", "promise_status"],
        F.round(m.mean_score(labels.is_delivered()), 6).alias("avg_score"),
        F.sum(F.when(labels.is_delivered(), F.col("reviews"))).alias("reviews"),
        where=F.col("duration_band").isNotNull(),
    )


def promise_weeks(wh: Warehouse) -> DataFrame:
    """Promised and transit days and late share per week of purchase."""
    return m.on_orders(
        wh,
        ["week_start"],
        mean("promised_days").alias("avg_promised_days"),
        m.mean_days("transit_minutes").alias("avg_transit_days"),
        *m.late_columns(),
    )


def gap_median(wh: Warehouse) -> DataFrame:
    """Median of the gaps between first and second order alone; days are counted before one task sees them."""
    return exact_median(second_order_gaps(wh), "days")
