"""Measures of the semantic layer.

A measure takes the warehouse, the columns to group by and an optional filter,
and returns one row per group. Names follow the source of the figure: *paid*
means payments, *items* means order items. Where the group columns belong to the
order, the order mirror answers alone and no fact is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainhouse.functions import labels
from grainhouse.functions.scalar import count_where, mean, minutes_between, money_sum, percent, ratio, safe_div
from grainhouse.operators.aggregates import collapse, rank_global, share_of_total, side_by_side, top_then_sort, union_all
from grainhouse.operators.joins import with_match
from grainhouse.plans.warehouse import Warehouse

PRODUCT_COLUMNS = ("category_name_english", "category_group", "product_weight_g")
SELLER_COLUMNS = ("seller_id", "seller_city", "seller_state", "seller_latitude", "seller_longitude")
DATE_COLUMNS = ("full_date", "year", "quarter", "month", "month_name", "day_of_week", "day_name", "is_weekend", "week_start")
# a state or city always says whose it is
ORDER_COLUMNS = (
    "order_status", "customer_city", "customer_state", "delay_days", "actual_days", "promised_days", "delivery_bucket",
    "delivery_bucket_sort", "duration_band", "duration_band_sort", "promise_status",
)


def sellers(wh: Warehouse) -> DataFrame:
    """Seller dimension with column names that say the place is the seller's."""
    places = {f"seller_{c}": F.col(c) for c in ("city", "state", "latitude", "longitude")}
    return wh.dim_seller.select("seller_key", "seller_id", *[c.alias(n) for n, c in places.items()])


def with_dates(wh: Warehouse, fact: DataFrame, columns: Sequence[str], role: str = "purchase") -> DataFrame:
    """Attach calendar columns by the purchase date or, on request, the delivery
    date, whose key is missing for orders that never arrived."""
    dates = wh.dates.select(F.col("date_key").alias(f"{role}_date_key"), *columns)
    return fact.join(dates, f"{role}_date_key")


def attach(wh: Warehouse, fact: DataFrame, columns: Sequence[str], role: str = "purchase") -> DataFrame:
    """Join only the dimensions that own one of the wanted columns."""
    todo = [c for c in columns if c not in fact.columns]
    product = [c for c in todo if c in PRODUCT_COLUMNS]
    seller = [c for c in todo if c in SELLER_COLUMNS]
    date = [c for c in todo if c in DATE_COLUMNS]
    order = [c for c in todo if c in ORDER_COLUMNS]
    unknown = set(todo) - set(product) - set(seller) - set(date) - set(order)
    if unknown:
        raise ValueError(f"no dimension has {sorted(unknown)}")
    if product:
        fact = fact.join(wh.products.select("product_key", *product), "product_key")
    if seller:
        fact = fact.join(sellers(wh).select("seller_key", *seller), "seller_key")
    if order:
        fact = fact.join(wh.orders.select("order_key", *order), "order_key")
    if date:
        fact = with_dates(wh, fact, date, role)
    return fact


def on_orders(
    wh: Warehouse,
    by: Sequence[str],
    *values: Column,
    where: Column | None = None,
    role: str = "purchase",
    orders: DataFrame | None = None,
) -> DataFrame:
    """Aggregate the order mirror, or the rows of it that a slicer has left, by order and date columns."""
    rows = attach(wh, wh.orders if orders is None else orders, by, role)
    rows = rows if where is None else rows.where(where)
    return rows.groupBy(*by).agg(*values)


def net_items(wh: Warehouse) -> DataFrame:
    """Item rows of orders that count as net."""
    counted = wh.dim_order.where(labels.is_net("order_status"))
    return with_match(wh.fact_order_items, counted, "order_key")


# --- revenue --------------------------------------------------------------------


def revenue_kinds(wh: Warehouse, by: Sequence[str] = ("year",), where: Column | None = None) -> DataFrame:
    """The four revenue figures side by side. Gross and net share a source and
    differ by status; paid figures include freight and come from payments."""
    net = labels.is_net("order_status")
    return on_orders(
        wh,
        by,
        money_sum("items_revenue").alias("items_revenue_gross"),
        money_sum(F.when(net, F.col("items_revenue"))).alias("items_revenue_net"),
        money_sum("paid").alias("gross_revenue"),
        money_sum(F.when(net, F.col("paid"))).alias("net_revenue_paid"),
        where=where,
    )


def category_sales(wh: Warehouse, by: Sequence[str] = ("category_name_english",), net: bool = True) -> DataFrame:
    """Item revenue and items sold per product attribute; reduced to one row per
    product before the attribute is joined."""
    items = net_items(wh) if net else wh.fact_order_items
    per_product = items.groupBy("product_key").agg(
        F.sum("price").alias("price"), F.count(F.lit(1)).alias("items_sold")
    )
    return (
        per_product.join(wh.products.select("product_key", *by), "product_key")
        .groupBy(*by)
        .agg(
            money_sum("price").alias("items_revenue_net" if net else "items_revenue_gross"),
            F.sum("items_sold").alias("items_sold"),
        )
    )


def net_share(wh: Warehouse, by: str = "category_group", only: Sequence[str] | None = None) -> DataFrame:
    """Net item revenue as a percentage of all products. ``only`` restricts the
    groups shown, never the total they are measured against. The total is that of
    the item rows, so items without a product count in it."""
    whole = net_items(wh).agg(money_sum("price").alias("items_revenue_net"))
    shares = share_of_total(category_sales(wh, [by]), "items_revenue_net", "pct_net", whole).drop("items_sold")
    return shares if only is None else shares.where(F.col(by).isin(*only))


def revenue_by_seller(wh: Warehouse, top: int | None = None) -> DataFrame:
    """Item revenue per seller with its display label, best first."""
    per_seller = wh.fact_order_items.groupBy("seller_key").agg(money_sum("price").alias("revenue"))
    named = per_seller.join(sellers(wh).select("seller_key", "seller_id", "seller_city"), "seller_key").select(
        "seller_id", labels.seller_label("seller_city", "seller_key").alias("seller_label"), "revenue"
    )
    ordered = named.orderBy(F.col("revenue").desc(), "seller_id")
    return ordered if top is None else ordered.limit(top)


def revenue_by_state(wh: Warehouse) -> DataFrame:
    """Item revenue and buyers per customer state."""
    buying = F.when(F.col("items") > 0, F.col("customer_key"))
    return on_orders(
        wh, ["customer_state"], money_sum("items_revenue").alias("revenue"), F.countDistinct(buying).alias("customers")
    )


def sellers_by_place(wh: Warehouse) -> DataFrame:
    """Sellers and their item revenue by state and city."""
    per_seller = wh.fact_order_items.groupBy("seller_key").agg(F.sum("price").alias("price"))
    places = sellers(wh).select("seller_key", "seller_state", "seller_city")
    return (
        places.join(per_seller, "seller_key", "left")
        .groupBy("seller_state", "seller_city")
        .agg(F.count(F.lit(1)).alias("sellers"), F.coalesce(money_sum("price"), F.lit(0).cast("decimal(38,2)")).alias("revenue"))
    )


def delivered_month(wh: Warehouse) -> DataFrame:
    """Item revenue and orders by the month of delivery instead of purchase."""
    return on_orders(
        wh,
        ["year", "month"],
        money_sum("items_revenue").alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        where=F.col("items") > 0,
        role="delivered",
    )


# --- orders and delivery ----------------------------------------------------------


def order_counts(wh: Warehouse, by: Sequence[str] = ("year", "month")) -> DataFrame:
    """Orders with a payment, orders with items, and items sold.

    Formulas inferred from the names: distinct orders per fact, and item rows.
    """
    return on_orders(
        wh,
        by,
        count_where(F.col("payments") > 0).alias("orders_paid"),
        count_where(F.col("items") > 0).alias("orders_items"),
        F.sum("items").alias("items_sold"),
    )


def category_orders(wh: Warehouse, by: str = "category_group") -> DataFrame:
    """Distinct orders and items per product attribute."""
    rows = attach(wh, wh.fact_order_items, [by])
    return (
        rows.groupBy(by, "order_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(by)
        .agg(F.count(F.lit(1)).alias("orders_category"), F.sum("n").alias("items_sold"))
    )


def late_columns() -> list[Column]:
    """Late and delivered orders and their ratio, for a grouped order mirror.
    Delivered applies to both sides of the ratio."""
    delivered = labels.is_delivered() & (F.col("items") > 0)
    late = delivered & (F.col("delay_days") > 0)
    return [
        count_where(late).alias("late_orders"),
        count_where(delivered).alias("delivered_orders"),
        percent(count_where(late), count_where(delivered)).alias("pct_late"),
    ]


def late_orders(wh: Warehouse, by: Sequence[str] = ("customer_state",), where: Column | None = None) -> DataFrame:
    return on_orders(wh, by, *late_columns(), where=where)


def mean_days(minutes: str) -> Column:
    """Mean of a minute column in days; the sum stays a whole number."""
    return ratio(F.sum(minutes), F.count(minutes) * 1440)


def delivery_averages(wh: Warehouse, by: Sequence[str] = ("customer_state",)) -> DataFrame:
    """Delivery, promised, handling and transit days, each order counted once.

    Promised, transit and their averages are inferred from the handling formula.
    """
    return on_orders(
        wh,
        by,
        mean("actual_days").alias("avg_delivery_days"),
        mean("promised_days").alias("avg_promised_days"),
        mean_days("handling_minutes").alias("avg_handling_days"),
        mean_days("transit_minutes").alias("avg_transit_days"),
    )


def handling_by_seller_state(wh: Warehouse) -> DataFrame:
    """Handling and transit days per seller state, one value per order in it,
    with the rank of the state by orders among all states."""
    handling, transit = F.col("avg_handling_days"), F.col("avg_transit_days")
    states = wh.order_sellers.where("first_of_state").groupBy("seller_state").agg(
        F.count(F.lit(1)).alias("orders"),
        mean_days("handling_minutes").alias("avg_handling_days"),
        mean_days("transit_minutes").alias("avg_transit_days"),
    )
    shared = states.withColumn("handling_share", F.round(safe_div(handling, handling + transit), 6))
    return rank_global(shared, "orders", "orders_rank")


def handling_share_top(wh: Warehouse, n: int = 10) -> DataFrame:
    """The busiest seller states, shown by share of handling in delivery time."""
    return top_then_sort(
        handling_by_seller_state(wh),
        n,
        by=[F.col("orders").desc(), F.col("seller_state")],
        then=[F.col("handling_share").desc(), F.col("seller_state")],
    )


def order_mirrors(wh: Warehouse) -> DataFrame:
    """Order-level delivery timing and its labels."""
    return wh.orders.select("order_id", *[c for c in ORDER_COLUMNS if not c.startswith("customer_")])


def per_label(wh: Warehouse, label: str, *more: str) -> DataFrame:
    """Orders per label of the order mirror."""
    return on_orders(wh, [label, *more], F.count(F.lit(1)).alias("orders"))


# --- reviews ----------------------------------------------------------------------


def mean_score(where: Column | None = None) -> Column:
    """Mean score over review rows, from per-order totals; unrounded."""
    total, n = F.col("review_total"), F.col("reviews")
    if where is not None:
        total, n = F.when(where, total), F.when(where, n)
    return safe_div(F.sum(total).cast("double"), F.sum(n).cast("double"))


def review_average(wh: Warehouse, by: Sequence[str] = ()) -> DataFrame:
    """Mean score of delivered orders (the default) beside all statuses."""
    return on_orders(
        wh,
        by,
        F.round(mean_score(labels.is_delivered()), 6).alias("avg_score_delivered"),
        F.round(mean_score(), 6).alias("avg_score_all"),
        F.sum("reviews").alias("reviews"),
    )


def review_distribution(wh: Warehouse) -> DataFrame:
    scores = wh.fact_reviews.groupBy("review_score").agg(F.count(F.lit(1)).alias("reviews"))
    return share_of_total(scores, "reviews", "pct")


def points_lost_columns() -> list[Column]:
    """Mean delivered score of orders on time, of late orders, and the difference, for a grouped order mirror.

    A missing delay counts as zero, so delivered orders without a date are on time.
    """
    delay = F.coalesce(F.col("delay_days"), F.lit(0))
    on_time, late = mean_score(labels.is_delivered() & (delay <= 0)), mean_score(labels.is_delivered() & (delay > 0))
    return [
        F.round(on_time, 6).alias("avg_score_on_time"),
        F.round(late, 6).alias("avg_score_late"),
        F.round(on_time - late, 6).alias("points_lost"),
    ]


def points_lost(wh: Warehouse, by: Sequence[str] = ("customer_state",)) -> DataFrame:
    return on_orders(wh, by, *points_lost_columns())


# --- payments ---------------------------------------------------------------------


def payment_mix(wh: Warehouse, leave_out: Sequence[str] = ("not_defined",)) -> DataFrame:
    """Payments, value, mean instalments and share of value per payment type."""
    kinds = (
        wh.fact_payments.where(~F.col("payment_type").isin(*leave_out))
        .groupBy("payment_type")
        .agg(
            F.count(F.lit(1)).alias("payments"),
            money_sum("payment_value").alias("value"),
            mean("payment_installments").alias("avg_installments"),
        )
    )
    return share_of_total(kinds, "value", "pct_value")


def payment_habits(wh: Warehouse) -> DataFrame:
    """Mean instalments, and the share of paid orders with several payments."""
    return side_by_side(
        wh.fact_payments.agg(mean("payment_installments").alias("avg_installments")),
        wh.orders.agg(
            percent(count_where(F.col("payments") > 1), count_where(F.col("payments") > 0)).alias("pct_multi_payment")
        ),
    )


# --- labels -----------------------------------------------------------------------


def display_labels(wh: Warehouse) -> DataFrame:
    """Display text of every customer and seller."""
    customers = wh.dim_customer.select(
        F.lit("customer").alias("kind"),
        F.col("customer_unique_id").alias("id"),
        labels.customer_label("customer_key").alias("label"),
    )
    shops = wh.dim_seller.select(
        F.lit("seller").alias("kind"), F.col("seller_id").alias("id"), labels.seller_label("city", "seller_key").alias("label")
    )
    return union_all([customers, shops])
