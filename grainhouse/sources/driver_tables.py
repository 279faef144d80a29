"""Raw order data in the declared source shape, derived from the star-schema
Parquet tables (recipe in FIXTURES.md). Every value comes from whole-number
arithmetic on the given rows, so any engine derives the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainhouse.functions.labels import CATEGORIES
from grainhouse.operators.keys import number_within
from grainhouse.sources.schemas import SRC_SCHEMAS
from grainhouse.sources.store import Store, conform

BRAND_STEP = 3  # brand k stands for category 3k of the list
UNTRANSLATED = ("Brand#5", "Brand#10")


def _plus(ts: Column, days: Column | int, minutes: Column | int) -> Column:
    def count(value: Column | int) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    return ts + F.make_dt_interval(count(days).cast("int"), F.lit(0), count(minutes).cast("int"))


def _milli(base: Column, digits: int) -> Column:
    """Thousandths as an exact decimal of the declared scale."""
    return (base.cast("decimal(10,0)") * F.lit("0.001").cast("decimal(4,3)")).cast(f"decimal({digits},8)")


class DriverTables:
    """The nine raw tables as frames, by attribute."""

    def __init__(self, spark: SparkSession, folder: str, store: Store):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.store = store
        self._given: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its footer is read once."""
        if name not in self._given:
            self._given[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._given[name]

    @staticmethod
    def _shape(df: DataFrame, name: str) -> DataFrame:
        return conform(df, SRC_SCHEMAS[name])

    @cached_property
    def customers(self) -> DataFrame:
        people = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        rows = self.table("orders").join(people, F.col("o_custkey") == F.col("c_custkey"))
        return self._shape(
            rows.select(
                F.col("o_orderkey").alias("customer_id"),
                (F.col("o_custkey") * 11 + F.col("o_orderkey") % 11).alias("customer_unique_id"),
                (F.col("c_custkey") % 200).alias("customer_zip_code_prefix"),
                F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")).alias("customer_city"),
                F.col("n_name").alias("customer_state"),
            ),
            "customers",
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        key = F.col("c_custkey")
        return self._shape(
            self.table("customer").select(
                (key % 190).alias("geolocation_zip_code_prefix"),
                _milli(F.lit(-5000) - (key % 28) * 1000 - key % 97, 10).alias("geolocation_lat"),
                _milli(F.lit(-35000) - (key % 37) * 1000 - key % 89, 11).alias("geolocation_lng"),
                F.lit(None).alias("geolocation_city"),
                F.lit(None).alias("geolocation_state"),
            ),
            "geolocation",
        )

    @cached_property
    def sellers(self) -> DataFrame:
        rows = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return self._shape(
            rows.select(
                F.col("s_suppkey").alias("seller_id"),
                (F.col("s_suppkey") % 200).alias("seller_zip_code_prefix"),
                F.concat(F.lit(" "), F.lower("n_name")).alias("seller_city"),
                F.col("n_name").alias("seller_state"),
            ),
            "sellers",
        )

    @cached_property
    def products(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        return self._shape(
            self.table("part").select(
                key.alias("product_id"),
                F.when(key % 54 != 0, F.lower("p_brand")).alias("product_category_name"),
                F.length("p_name").alias("product_name_lenght"),
                (F.length("p_name") * 10).alias("product_description_lenght"),
                (key % 5 + 1).alias("product_photos_qty"),
                (size * 200).alias("product_weight_g"),
                size.alias("product_length_cm"),
                (size + 1).alias("product_height_cm"),
                (size + 2).alias("product_width_cm"),
            ),
            "products",
        )

    @cached_property
    def category_translation(self) -> DataFrame:
        brands = self.table("part").where(~F.col("p_brand").isin(*UNTRANSLATED)).select("p_brand").distinct()
        number = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
        english = F.try_element_at(F.array(*[F.lit(name) for name in CATEGORIES]), number * BRAND_STEP)
        return self._shape(
            brands.select(
                F.lower("p_brand").alias("product_category_name"),
                F.coalesce(english, F.concat(F.lit("en_"), F.lower("p_brand"))).alias("product_category_name_english"),
            ),
            "category_translation",
        )

    @cached_property
    def orders(self) -> DataFrame:
        key, day = F.col("o_orderkey"), F.col("o_orderdate")
        status = (
            F.when(key % 40 == 0, "canceled")
            .when(key % 50 == 1, "unavailable")
            .when(key % 17 == 2, "shipped")
            .otherwise("delivered")
        )
        bought = (key * 7) % 1440
        arrived = ((status == "delivered") & (key % 499 != 3)) | (key % 1200 == 0)
        return self._shape(
            self.table("orders").select(
                key.alias("order_id"),
                key.alias("customer_id"),
                F.concat(F.lit(" "), F.upper(status)).alias("order_status"),
                _plus(day, 0, bought).alias("order_purchase_timestamp"),
                F.when(key % 211 != 0, _plus(day, 0, bought + key % 300)).alias("order_approved_at"),
                F.when(status.isin("delivered", "shipped"), _plus(day, 1 + key % 3, (key * 11) % 1440)).alias(
                    "order_delivered_carrier_date"
                ),
                F.when(arrived, _plus(day, 3 + (key * 13) % 32, (key * 37) % 1440)).alias(
                    "order_delivered_customer_date"
                ),
                _plus(day, 10 + (key * 5) % 23, 0).alias("order_estimated_delivery_date"),
            ),
            "orders",
        )

    @cached_property
    def order_items(self) -> DataFrame:
        """Line items numbered within their order. The given line number repeats
        within an order, and an order may be very large, hence the written,
        range-partitioned numbering."""
        lines = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"
        )
        numbered = number_within(
            lines,
            "l_orderkey",
            ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"],
            "order_item_id",
            self.store,
            "numbered_lines",
        )
        rows = numbered.select(
            F.col("l_orderkey").alias("order_id"),
            "order_item_id",
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            (F.lit(5) + F.col("l_partkey") % 30).alias("freight_value"),
        )
        return self._shape(rows, "order_items")

    @cached_property
    def order_payments(self) -> DataFrame:
        key, seq = F.col("o_orderkey"), F.col("seq")
        parts = F.sequence(F.lit(1), F.lit(1) + (key % 3).cast("int"))
        cents = F.lit(1000) + (key * 31 + seq * 17) % 50000
        kind = (
            F.when(key % 5000 == 7, "not_defined")
            .when(key % 4 == 0, " BOLETO")
            .when(key % 9 == 1, "voucher")
            .otherwise("credit_card")
        )
        return self._shape(
            self.table("orders")
            .where(key % 997 != 5)
            .select("o_orderkey", F.explode(parts).alias("seq"))
            .select(
                key.alias("order_id"),
                seq.alias("payment_sequential"),
                kind.alias("payment_type"),
                ((key + seq) % 11).alias("payment_installments"),
                (cents.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(3,2)")).alias("payment_value"),
            ),
            "order_payments",
        )

    @cached_property
    def order_reviews(self) -> DataFrame:
        key, k = F.col("o_orderkey"), F.col("k")
        copies = F.sequence(F.lit(1), F.when(key % 20 == 0, 2).otherwise(1))
        shared = (key % 251 == 4) & (k == 1)
        message = F.concat(
            F.lit('line 1, "quoted"\nline 2 — avaliação '), key.cast("string"), F.lit(", nota "), k.cast("string")
        )
        return self._shape(
            self.table("orders")
            .where(key % 101 != 0)
            .select("o_orderkey", "o_orderdate", F.explode(copies).alias("k"))
            .select(
                F.when(shared, F.lit(1000000) + F.call_function("div", key, F.lit(502)))
                .otherwise(key * 10 + k)
                .alias("review_id"),
                key.alias("order_id"),
                F.when(key % 3 == 0, 5).otherwise(F.lit(1) + (key * 7 + k) % 5).alias("review_score"),
                F.when(key % 4 != 0, F.concat(F.lit('Pedido "'), key.cast("string"), F.lit('"'))).alias(
                    "review_comment_title"
                ),
                F.when(key % 3 != 0, message).alias("review_comment_message"),
                _plus(F.col("o_orderdate"), 20 + key % 20, 0).alias("review_creation_date"),
                _plus(F.col("o_orderdate"), 21 + key % 20, key % 1440).alias("review_answer_timestamp"),
            ),
            "order_reviews",
        )
