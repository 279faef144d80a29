"""Builders of the staging tables, dimensions and facts.

Each takes and returns frames and plans nothing by itself; the
:class:`~grainhouse.plans.warehouse.Warehouse` decides what is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainhouse.functions.scalar import (
    calendar_columns,
    clean_lower,
    clean_upper,
    date_key,
    days_between,
    label_equal,
    minutes_between,
    month_key,
    zip5,
)
from grainhouse.operators.joins import lookup, resolve_keys
from grainhouse.sources.schemas import SCHEMAS
from grainhouse.sources.store import conform

COUNTRY = "Brazil"
YEAR, MONTH = "purchase_year", "purchase_month"  # partition columns of the order-dated tables

# --- staging: clean copies, same grain --------------------------------------


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        clean_upper("customer_city").alias("customer_city"),
        clean_upper("customer_state").alias("customer_state"),
        zip5("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
    )


def stg_geolocation(geolocation: DataFrame) -> DataFrame:
    return geolocation.select(
        zip5("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").alias("latitude"),
        F.col("geolocation_lng").alias("longitude"),
    )


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        clean_upper("seller_city").alias("seller_city"),
        clean_upper("seller_state").alias("seller_state"),
        zip5("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
    )


def stg_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """English category where translated, else the original, else ``Unknown``.

    The translation must be unique per category, or products would multiply.
    """
    named = lookup(
        products,
        translation,
        {"product_category_name": "product_category_name"},
        {"_english": "product_category_name_english"},
    )
    english = F.coalesce("_english", "product_category_name", F.lit("Unknown"))
    return conform(named.withColumn("product_category_name_eng", english), SCHEMAS["stg_products"])


def stg_orders(orders: DataFrame) -> DataFrame:
    cleaned = orders.withColumn("order_status", clean_lower("order_status"))
    return conform(cleaned, SCHEMAS["stg_orders"])


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return conform(order_items, SCHEMAS["stg_order_items"])


def stg_payments(order_payments: DataFrame) -> DataFrame:
    cleaned = order_payments.withColumn("payment_type", clean_lower("payment_type"))
    return conform(cleaned, SCHEMAS["stg_payments"])


def stg_reviews(order_reviews: DataFrame) -> DataFrame:
    return conform(order_reviews, SCHEMAS["stg_reviews"])


# --- dimensions --------------------------------------------------------------


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day for a one-row frame (first_day, last_day)."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("day"))
    return conform(days.select(*[c.alias(n) for n, c in calendar_columns("day").items()]), SCHEMAS["dim_date"])


def calendar_between(spark, first_day: str, last_day: str) -> DataFrame:
    """Calendar of a fixed range, both days included."""
    bounds = spark.range(1).select(
        F.lit(first_day).cast("date").alias("first_day"), F.lit(last_day).cast("date").alias("last_day")
    )
    return calendar(bounds)


def calendar_bounds(orders: DataFrame) -> DataFrame:
    """Whole years that cover every purchase and delivery."""
    first = F.min(F.least("order_purchase_timestamp", "order_delivered_customer_date"))
    last = F.max(F.greatest("order_purchase_timestamp", "order_delivered_customer_date"))
    return orders.agg(first.alias("first"), last.alias("last")).select(
        F.make_date(F.year("first"), F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(F.year("last"), F.lit(12), F.lit(31)).alias("last_day"),
    )


def zip_centres(geolocation: DataFrame) -> DataFrame:
    """One mean position per zip, shared by sellers and orders."""
    return geolocation.groupBy("zip_code_prefix").agg(
        F.avg("latitude").cast("decimal(10,8)").alias("latitude"),
        F.avg("longitude").cast("decimal(11,8)").alias("longitude"),
    )


def people(customers: DataFrame) -> DataFrame:
    """Persons, not order-scoped customer ids; no address."""
    return customers.select("customer_unique_id").distinct()


def located_sellers(sellers: DataFrame, centres: DataFrame) -> DataFrame:
    placed = lookup(
        sellers,
        centres,
        {"seller_zip_code_prefix": "zip_code_prefix"},
        {"latitude": "latitude", "longitude": "longitude"},
    )
    return placed.select(
        "seller_id",
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
        F.col("seller_zip_code_prefix").alias("zip_code"),
        F.lit(COUNTRY).alias("country"),
        "latitude",
        "longitude",
    )


def catalogue(products: DataFrame) -> DataFrame:
    return products.withColumnRenamed("product_category_name_eng", "category_name_english").drop(
        "product_category_name"
    )


def order_spine(orders: DataFrame, customers: DataFrame, dim_customer: DataFrame, centres: DataFrame) -> DataFrame:
    """Every order once with its person key, address and timestamps.

    The order dimension is a projection of it, and each fact needs one join to it
    for all its order-level keys and dates, instead of one per dimension.
    """
    buyers = resolve_keys(customers, [(dim_customer, "customer_unique_id", "customer_key")])
    buyers = lookup(
        buyers,
        centres,
        {"customer_zip_code_prefix": "zip_code_prefix"},
        {"latitude": "latitude", "longitude": "longitude"},
    )
    spine = lookup(
        orders,
        buyers,
        {"customer_id": "customer_id"},
        {
            "customer_key": "customer_key",
            "city": "customer_city",
            "state": "customer_state",
            "zip_code": "customer_zip_code_prefix",
            "latitude": "latitude",
            "longitude": "longitude",
        },
    )
    return spine.withColumn("country", F.lit(COUNTRY)).withColumn(
        "purchase_date_key", date_key("order_purchase_timestamp")
    )


# --- facts ---------------------------------------------------------------------


def laid_out(df: DataFrame, partition: str = YEAR) -> DataFrame:
    """Placed for a write by purchase year or month, each file a narrow run of days.

    ``rebalance`` sizes the files from measured data: a month holding a third of
    all rows is split, small months share a task. Sorting by day gives the row
    groups tight date bounds, so date filters skip them inside a partition, too.
    """
    placed = df.withColumn(MONTH, month_key("purchase_date_key")).hint("rebalance", MONTH)
    if partition == MONTH:
        return placed.sortWithinPartitions(MONTH, "purchase_date_key").drop(YEAR)
    # the year is worked out behind the shuffle, which only needs the month
    dated = placed.withColumn(YEAR, F.floor(F.col("purchase_date_key") / 10000).cast("int"))
    return dated.sortWithinPartitions(YEAR, "purchase_date_key").drop(MONTH)


def _keyed(fact: DataFrame, schema: str, partition: str, derived: dict[str, Column] | None = None) -> DataFrame:
    """Laid out, with a key that is unique per row (not dense, no extra shuffle), and columns derived from a row alone."""
    keyed = laid_out(fact, partition).withColumns({**(derived or {}), "fact_key": F.monotonically_increasing_id() + 1})
    return conform(keyed, T.StructType([*SCHEMAS[schema].fields, T.StructField(partition, T.IntegerType())]))


def _with_order(child: DataFrame, spine: DataFrame, *extra: str) -> DataFrame:
    """Inner join of child rows to their order; orphans are dropped and counted by a check."""
    return child.join(spine.select("order_id", "order_key", "customer_key", "purchase_date_key", *extra), "order_id")


def fact_order_items(
    items: DataFrame, spine: DataFrame, dim_seller: DataFrame, dim_product: DataFrame, partition: str = YEAR
) -> DataFrame:
    """One row per order item. Days are NULL for orders that never arrived; a
    delay above zero is late.

    Keys are looked up while rows are narrow, and what follows from the dates of the order is worked out behind the last
    shuffle, so that neither travels.
    """
    rows = resolve_keys(items, [(dim_seller, "seller_id", "seller_key"), (dim_product, "product_id", "product_key")])
    rows = _with_order(
        rows.drop("seller_id", "product_id"),
        spine,
        "order_purchase_timestamp",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    arrived = F.col("order_delivered_customer_date")
    dated = {
        "delivered_date_key": date_key(arrived),
        "purchase_timestamp": F.col("order_purchase_timestamp"),
        "delivered_carrier_date": F.col("order_delivered_carrier_date"),
        "delivered_customer_date": arrived,
        "estimated_delivery_date": F.col("order_estimated_delivery_date"),
        "delivery_delay_days": days_between("order_estimated_delivery_date", arrived),
        "actual_delivery_days": days_between("order_purchase_timestamp", arrived),
    }
    return _keyed(rows, "fact_order_items", partition, dated)


def fact_payments(payments: DataFrame, spine: DataFrame, partition: str = YEAR) -> DataFrame:
    """One row per payment of an order."""
    return _keyed(_with_order(payments, spine), "fact_payments", partition)


def fact_reviews(reviews: DataFrame, spine: DataFrame, partition: str = YEAR) -> DataFrame:
    """One row per review and order; a review id alone is not unique."""
    return _keyed(_with_order(reviews, spine), "fact_reviews", partition)


def order_totals(spine: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every order once, with what each fact says about it. Each fact is reduced to a row per order before the join."""
    sold = items.groupBy("order_key").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("price").alias("items_revenue"),
        F.sum("freight_value").alias("freight"),
        F.max("delivery_delay_days").alias("delay_days"),
        F.max("actual_delivery_days").alias("actual_days"),
        F.max("delivered_date_key").alias("delivered_date_key"),
        F.max("delivered_carrier_date").alias("_carrier"),
        F.max("delivered_customer_date").alias("_customer"),
    )
    paid = payments.groupBy("order_key").agg(F.count(F.lit(1)).alias("payments"), F.sum("payment_value").alias("paid"))
    rated = reviews.groupBy("order_key").agg(F.count("review_score").alias("reviews"), F.sum("review_score").alias("review_total"))
    joined = spine.select(
        "order_key",
        "order_id",
        "customer_key",
        "order_status",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        F.col("order_purchase_timestamp").alias("purchase_timestamp"),
        "purchase_date_key",
    )
    for side in (sold, paid, rated):
        joined = joined.join(side, "order_key", "left")
    # timing is constant within an order, so minutes are worked out once per order
    timed = joined.withColumns(
        {
            "handling_minutes": minutes_between("purchase_timestamp", "_carrier"),
            "transit_minutes": minutes_between("_carrier", "_customer"),
        }
    ).drop("_carrier", "_customer")
    return timed.fillna(0, ["items", "payments", "reviews"])


def order_sellers(spine: DataFrame, items: DataFrame, dim_seller: DataFrame) -> DataFrame:
    """Every order with every seller of its items once: sums of the items, both places, their distance and the delivery times.

    An order counts once per seller state, distance or kind of route; ``first_of_…`` marks the row that stands for it there, so
    that reports count and average orders without grouping by order again. Items are reduced to pairs before anything is joined,
    so that an order is as many rows as it has sellers, however many items there are. Items without a seller are a pair, too.
    """
    pairs = items.groupBy("order_key", "seller_key").agg(
        F.count(F.lit(1)).alias("item_rows"), F.sum("price").alias("price"), F.sum("freight_value").alias("freight_value")
    )
    sellers = dim_seller.select(
        "seller_key", "seller_id", F.col("city").alias("seller_city"), F.col("state").alias("seller_state"),
        F.col("latitude").alias("_seller_lat"), F.col("longitude").alias("_seller_lng"),
    )
    # an item has the dates of its order, which need not travel with the pairs
    buyers = spine.select(
        "order_key", "purchase_date_key", "order_status", F.col("city").alias("customer_city"), F.col("state").alias("customer_state"),
        F.col("latitude").alias("_lat"), F.col("longitude").alias("_lng"),
        F.col("order_purchase_timestamp").alias("_bought"), F.col("order_delivered_carrier_date").alias("_carrier"),
        F.col("order_delivered_customer_date").alias("_customer"),
    )
    d_lat = F.col("_lat").cast("double") - F.col("_seller_lat").cast("double")
    d_lng = F.col("_lng").cast("double") - F.col("_seller_lng").cast("double")
    dated = pairs.join(buyers, "order_key").withColumn("actual_days", days_between("_bought", "_customer"))
    located = dated.join(sellers, "seller_key", "left").withColumns(
        {
            "dated_rows": F.when(F.col("actual_days").isNotNull(), F.col("item_rows")).otherwise(0),
            "distance": F.sqrt(d_lat * d_lat + d_lng * d_lng),
            "route_type": F.when(F.col("seller_id").isNotNull(), label_equal("customer_state", "seller_state", "Same State", "Cross State")),
            "handling_minutes": minutes_between("_bought", "_carrier"),
            "transit_minutes": minutes_between("_carrier", "_customer"),
        }
    )

    def first(column: str) -> Column:
        least = F.min("seller_key").over(Window.partitionBy("order_key", column))
        return F.col("seller_key").isNotNull() & (F.col("seller_key") == least)

    marked = located.withColumns(
        {"first_of_state": first("seller_state"), "first_of_distance": first("distance"), "first_of_route": first("route_type")}
    )
    return marked.drop("_bought", "_carrier", "_customer", "_lat", "_lng", "_seller_lat", "_seller_lng")


# what a pair has from its seller alone
_OF_SELLER = ("seller_id", "seller_city", "seller_state", "route_type")


def placed_order_sellers(pairs: DataFrame, sellers: DataFrame, partition: str = YEAR) -> DataFrame:
    """The pairs laid out without what they have from their seller, which is looked up again behind the shuffle.

    ``sellers`` must be small enough for a broadcast: another join would undo the layout.
    """
    bare = T.StructType([f for f in SCHEMAS["order_sellers"].fields if f.name not in _OF_SELLER])
    placed = laid_out(conform(pairs, bare), partition)
    found = lookup(
        placed, F.broadcast(sellers), {"seller_key": "seller_key"}, {"seller_id": "seller_id", "seller_city": "city", "seller_state": "state"}
    )
    route = F.when(F.col("seller_id").isNotNull(), label_equal("customer_state", "seller_state", "Same State", "Cross State"))
    whole = T.StructType([*SCHEMAS["order_sellers"].fields, T.StructField(partition, T.IntegerType())])
    return conform(found.withColumn("route_type", route), whole)
