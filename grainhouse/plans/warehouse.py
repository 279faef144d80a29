"""The warehouse: staging views, written dimensions and facts, order mirror.

Tables are built on first use and written once, so every check, measure and
report after that is a scan of narrow Parquet columns.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainhouse.functions import labels
from grainhouse.functions.scalar import week_start
from grainhouse.operators.joins import broadcast_few, is_few
from grainhouse.operators.keys import number_rows, percent_rank_weights, with_surrogate_key
from grainhouse.plans import layers, slices
from grainhouse.session import input_bytes, size_shuffles, tune
from grainhouse.sources.driver_tables import DriverTables
from grainhouse.sources.schemas import DWH_SCHEMAS, SCHEMAS, SRC_SCHEMAS, STG_SCHEMAS
from grainhouse.sources.store import Store, conform


class RawTables:
    """Raw tables handed over as a dict of frames, by attribute."""

    def __init__(self, tables: dict[str, DataFrame]):
        for name in SRC_SCHEMAS:
            setattr(self, name, tables[name])


def at_once(work: Callable[[str], object], names: Iterable[str]) -> None:
    """Do the work of each name in a thread of its own, so that their Spark jobs share the cores."""
    names = list(names)
    with ThreadPoolExecutor(max(len(names), 1)) as pool:
        list(pool.map(work, names))


class built_once(cached_property):  # noqa: N801
    """A cached property that one thread builds while others wait: its value is a table that must not be written twice."""

    def __get__(self, owner, kind=None):
        if owner is None or self.attrname in owner.__dict__:
            return super().__get__(owner, kind)
        with owner.locks[self.attrname]:
            return super().__get__(owner, kind)


class Warehouse:
    """All layers over one set of raw tables.

    ``raw`` has one attribute per source table; ``store`` receives what is
    written; ``partition`` is the partition column of the facts.
    """

    def __init__(self, raw, store: Store, partition: str = layers.YEAR):
        self.raw = raw
        self.store = store
        self.partition = partition
        self.spark = store.spark
        self._kept: dict[str, DataFrame] = {}
        self.locks: dict[str, RLock] = defaultdict(RLock)

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A frame over written tables, built on first use and kept. Writing its
        tables again would pull them from under the frame handed out before."""
        if name not in self._kept:
            self._kept[name] = build()
        return self._kept[name]

    def together(self, *names: str) -> None:
        """Build tables that do not depend on each other as concurrent Spark jobs."""
        at_once(lambda n: getattr(self, n), [n for n in names if n not in self.__dict__])

    def __getitem__(self, name: str) -> DataFrame:
        """A table by its declared name, from any layer."""
        return getattr(self.raw if name in SRC_SCHEMAS else self, name)

    # --- staging ---------------------------------------------------------------

    @built_once
    def stg_customers(self) -> DataFrame:
        return layers.stg_customers(self.raw.customers)

    @built_once
    def stg_geolocation(self) -> DataFrame:
        return layers.stg_geolocation(self.raw.geolocation)

    @built_once
    def stg_sellers(self) -> DataFrame:
        return layers.stg_sellers(self.raw.sellers)

    @built_once
    def stg_products(self) -> DataFrame:
        return layers.stg_products(self.raw.products, self.raw.category_translation)

    @built_once
    def stg_orders(self) -> DataFrame:
        return layers.stg_orders(self.raw.orders)

    @built_once
    def stg_order_items(self) -> DataFrame:
        return layers.stg_order_items(self.raw.order_items)

    @built_once
    def stg_payments(self) -> DataFrame:
        return layers.stg_payments(self.raw.order_payments)

    @built_once
    def stg_reviews(self) -> DataFrame:
        return layers.stg_reviews(self.raw.order_reviews)

    # --- dimensions --------------------------------------------------------------

    @built_once
    def dim_date(self) -> DataFrame:
        return self.store.overwrite(layers.calendar(layers.calendar_bounds(self.stg_orders)), "dim_date")

    @built_once
    def zip_centres(self) -> DataFrame:
        return self.store.overwrite(layers.zip_centres(self.stg_geolocation), "zip_centres")

    @built_once
    def dim_customer(self) -> DataFrame:
        return self._dimension(layers.people(self.stg_customers), "customer_unique_id", "dim_customer")

    @built_once
    def dim_seller(self) -> DataFrame:
        return self._dimension(layers.located_sellers(self.stg_sellers, self.zip_centres), "seller_id", "dim_seller")

    @built_once
    def dim_product(self) -> DataFrame:
        return self._dimension(layers.catalogue(self.stg_products), "product_id", "dim_product")

    @built_once
    def order_spine(self) -> DataFrame:
        """Every order with its key, person, address and timestamps.

        Orders are numbered before the lookups, so that the sampling pass of the
        range shuffle scans staging instead of running the joins twice.
        """
        self.together("dim_customer", "zip_centres")
        orders = number_rows(self.stg_orders, ["order_id"], "order_key", self.store, "orders_placed")
        spine = layers.order_spine(orders, self.stg_customers, self.dim_customer, self.zip_centres)
        written = self.store.overwrite(spine, "order_spine")
        self.store.remove("orders_placed")
        return written

    @built_once
    def dim_order(self) -> DataFrame:
        return conform(self.order_spine, DWH_SCHEMAS["dim_order"])

    def _dimension(self, rows: DataFrame, natural_key: str, table: str) -> DataFrame:
        schema = DWH_SCHEMAS[table]
        return conform(with_surrogate_key(rows, natural_key, schema[0].name, self.store, table), schema)

    # --- facts --------------------------------------------------------------------

    @built_once
    def fact_order_items(self) -> DataFrame:
        self.together("stg_order_items", "dim_customer", "dim_product", "zip_centres")
        self.together("order_spine", "dim_seller")
        sellers = broadcast_few(self.dim_seller, "seller_id", "seller_key")
        products = broadcast_few(self.dim_product, "product_id", "product_key")
        rows = layers.fact_order_items(self.stg_order_items, self.order_spine, sellers, products, self.partition)
        return self.store.overwrite(rows, "fact_order_items", [self.partition])

    @built_once
    def fact_payments(self) -> DataFrame:
        rows = layers.fact_payments(self.stg_payments, self.order_spine, self.partition)
        return self.store.overwrite(rows, "fact_payments", [self.partition])

    @built_once
    def fact_reviews(self) -> DataFrame:
        rows = layers.fact_reviews(self.stg_reviews, self.order_spine, self.partition)
        return self.store.overwrite(rows, "fact_reviews", [self.partition])

    # --- semantic layer -------------------------------------------------------------

    @built_once
    def products(self) -> DataFrame:
        """Product dimension with its rollup group."""
        return self.dim_product.withColumn("category_group", labels.category_group("category_name_english"))

    @built_once
    def dates(self) -> DataFrame:
        """Calendar with the Monday of each week."""
        return self.dim_date.withColumn("week_start", week_start("full_date"))

    @built_once
    def order_totals(self) -> DataFrame:
        """Every order once, with what each fact says about it.

        The only place where a fact is collapsed to order grain. Facts never join
        each other row by row; they meet here, which is what keeps totals and
        averages free of fan-out. Each fact is reduced before the join, so an
        order with very many rows is one row by then.
        """
        self.together("stg_order_items", "dim_customer", "dim_product", "zip_centres", "dim_date")
        self.together("order_spine", "dim_seller")
        self.together("fact_order_items", "fact_payments", "fact_reviews")
        totals = layers.order_totals(self.order_spine, self.fact_order_items, self.fact_payments, self.fact_reviews)
        return self.store.overwrite(layers.laid_out(totals, self.partition), "order_totals", [self.partition])

    @built_once
    def order_sellers(self) -> DataFrame:
        """Every order with every seller of its items once; see :func:`~grainhouse.plans.layers.order_sellers`."""
        self.together("order_spine", "dim_seller")
        pairs = layers.order_sellers(self.order_spine, self.fact_order_items, self.dim_seller)
        if is_few(self.dim_seller):
            placed = layers.placed_order_sellers(pairs, self.dim_seller, self.partition)
        else:
            placed = layers.laid_out(conform(pairs, SCHEMAS["order_sellers"]), self.partition)
        return self.store.overwrite(placed, "order_sellers", [self.partition])

    @built_once
    def order_slices(self) -> DataFrame:
        """Counts of orders that add up under every slicer; see :mod:`~grainhouse.plans.slices`."""
        sellers = self.dim_seller.select("seller_key", F.col("state").alias("seller_state"))
        groups = self.products.select("product_key", "category_group")
        return self.store.overwrite(slices.rollup(self.fact_order_items, sellers, groups, self.orders), "order_slices")

    @built_once
    def orders(self) -> DataFrame:
        """Order mirror: totals plus the labels derived from delivery timing."""
        delay, actual = F.col("delay_days"), F.col("actual_days")
        return self.order_totals.withColumns(
            {
                "promised_days": actual - delay,
                "delivery_bucket": labels.delivery_bucket(actual),
                "delivery_bucket_sort": labels.delivery_bucket_sort(actual),
                "duration_band": labels.duration_band(actual),
                "duration_band_sort": labels.duration_band_sort(actual),
                "promise_status": labels.promise_status(delay),
            }
        )

    @built_once
    def seller_revenue_ranks(self) -> DataFrame:
        """Distinct seller revenues with their percent rank, highest first."""
        revenue = (
            self.fact_order_items.where(F.col("seller_key").isNotNull())
            .groupBy("seller_key")
            .agg(F.sum("price").cast("decimal(38,2)").alias("revenue"))
        )
        return percent_rank_weights(revenue, "revenue", self.store, "seller_revenue")

    # --- bookkeeping -----------------------------------------------------------------

    def build(self) -> Warehouse:
        """Write every dimension and fact and the two mirrors."""
        self.together("order_totals", "order_sellers", *DWH_SCHEMAS)
        return self

    def declared(self, name: str) -> DataFrame:
        """A layer table with exactly its declared columns."""
        schema = STG_SCHEMAS.get(name) or DWH_SCHEMAS.get(name) or SRC_SCHEMAS[name]
        return conform(self[name], schema)


_open: dict[tuple[str, str], Warehouse] = {}


def open_driver_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over the star-schema Parquet tables of a folder.

    Kept per application and folder, so the queries of a session share what was
    written.
    """
    tune(spark)
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _open:
        label = "".join(c if c.isalnum() else "-" for c in key[1]).strip("-")
        store = Store.scratch(spark, label)
        raw = DriverTables(spark, folder, store)
        size_shuffles(spark, input_bytes(raw.table("lineitem"), raw.table("orders")))
        _open[key] = Warehouse(raw, store)
    return _open[key]


def close_driver_warehouses(spark: SparkSession) -> None:
    """Delete what the warehouses of this application have written."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _open if k[0] == app]:
        _open.pop(key).store.clear()
