"""Data-quality jobs. Each returns a small frame of findings; no rows, equal
numbers or zero differences mean the check passes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainhouse.functions import labels
from grainhouse.functions.scalar import MONEY, count_where, mean, money_sum, percent, ratio, safe_div
from grainhouse.operators.aggregates import repeated, side_by_side, union_all
from grainhouse.operators.joins import drill_across, fan_out_total, without_match
from grainhouse.plans.warehouse import Warehouse
from grainhouse.sources.schemas import DWH_SCHEMAS, FOREIGN_KEYS, GRAINS, LENGTHS, SCHEMAS

if TYPE_CHECKING:
    from grainhouse.plans.measured import Measured

FACTS = ("fact_order_items", "fact_payments", "fact_reviews")
# source table behind each written table, for reconciliation
LOADED_FROM = {
    "fact_order_items": "order_items",
    "fact_payments": "order_payments",
    "fact_reviews": "order_reviews",
    "dim_order": "orders",
}


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _tagged(df: DataFrame, **constants: str) -> DataFrame:
    return df.select(*[F.lit(v).alias(k) for k, v in constants.items()], "*")


def payment_fanout(wh: Warehouse) -> DataFrame:
    """True payment total, the total after joining payments to item rows, and the
    warehouse total. The second is inflated, the others agree."""
    payments = wh.stg_payments
    inflated = fan_out_total(wh.stg_order_items, payments, "order_id", "payment_value")
    return side_by_side(
        payments.agg(money_sum("payment_value").alias("correct_total")),
        inflated.select(F.col("total").cast(MONEY).alias("inflated_total")),
        wh.fact_payments.agg(money_sum("payment_value").alias("warehouse_total")),
    )


def multi_child_orders(wh: Warehouse) -> DataFrame:
    """Orders with several payments, and with several reviews."""
    return side_by_side(
        _count(repeated(wh.stg_payments, ["order_id"]), "orders_multi_payment"),
        _count(repeated(wh.stg_reviews, ["order_id"]), "orders_multi_review"),
    )


def review_bias(wh: Warehouse) -> DataFrame:
    """Mean score weighted by items (wrong) beside the mean at review grain."""
    weighted = fan_out_total(wh.stg_order_items, wh.stg_reviews, "order_id", "review_score")
    return side_by_side(
        weighted.select(ratio(F.col("total"), F.col("pairs")).alias("item_weighted_avg")),
        wh.fact_reviews.agg(mean("review_score").alias("review_avg")),
    )


def row_counts(wh: Warehouse) -> DataFrame:
    """Rows in the source and in the warehouse."""
    return union_all(
        [
            _tagged(
                side_by_side(_count(wh[source], "source_rows"), _count(wh[table], "warehouse_rows")),
                table_name=table,
            ).withColumn("diff", F.col("source_rows") - F.col("warehouse_rows"))
            for table, source in LOADED_FROM.items()
        ]
    )


def missing_keys(wh: Warehouse) -> DataFrame:
    """Rows of each fact without a dimension key; NULL where the fact has no such key."""

    def misses(fact: str, key: str):
        if key not in SCHEMAS[fact].names:
            return F.lit(None).cast("long")
        return count_where(F.col(key).isNull())

    return union_all(
        [
            _tagged(
                wh[fact].agg(
                    *[misses(fact, f"{dim}_key").alias(f"missing_{dim}") for dim in ("customer", "order", "seller", "product")],
                    F.count(F.lit(1)).alias("total_rows"),
                ),
                fact=fact,
            )
            for fact in FACTS
        ]
    )


def _items_by_status(wh: Warehouse, *aggregates, where=None) -> DataFrame:
    """Aggregate item rows per order status.

    ``aggregates`` are (name, per-order aggregate). Items are reduced to one row
    per order before the status is joined to them.
    """
    items = wh.fact_order_items if where is None else wh.fact_order_items.where(where)
    per_order = drill_across(
        items, "order_key", dict(aggregates), wh.dim_order.select("order_key", "order_status")
    )
    return per_order


def missing_keys_by_status(wh: Warehouse) -> DataFrame:
    per_order = _items_by_status(
        wh,
        ("missing_product", count_where(F.col("product_key").isNull())),
        ("missing_seller", count_where(F.col("seller_key").isNull())),
        ("total_rows", F.count(F.lit(1))),
    )
    names = ("missing_product", "missing_seller", "total_rows")
    return per_order.groupBy("order_status").agg(*[F.sum(n).alias(n) for n in names])


def totals_preserved(wh: Warehouse) -> DataFrame:
    """Sums and means that must not change from staging to fact."""

    def pair(measure: str, staging: DataFrame, fact: DataFrame, value) -> DataFrame:
        both = side_by_side(staging.agg(value.alias("source_value")), fact.agg(value.alias("warehouse_value")))
        return _tagged(both, measure=measure)

    def total(column: str):
        return F.round(F.sum(column).cast("double"), 2)

    items, payments, reviews = (wh[f] for f in FACTS)
    checked = union_all(
        [
            pair("sum price", wh.stg_order_items, items, total("price")),
            pair("sum freight", wh.stg_order_items, items, total("freight_value")),
            pair("sum payment", wh.stg_payments, payments, total("payment_value")),
            pair("mean score", wh.stg_reviews, reviews, mean("review_score")),
        ]
    )
    return checked.withColumn("diff", F.round(F.col("source_value") - F.col("warehouse_value"), 6))


GRAIN_TABLES = [*FACTS, "dim_customer", "dim_order", "dim_product", "dim_seller", "order_reviews"]
# every parent key with the columns that must be found in it
PARENT_KEYS = {
    (parent, key): [(c, col) for c, col, p, k in FOREIGN_KEYS if (p, k) == (parent, key)]
    for parent, key in dict.fromkeys((p, k) for _, _, p, k in FOREIGN_KEYS)
}


def key_audit(uses: Sequence[tuple[str, int, DataFrame, Sequence[str]]]) -> DataFrame:
    """One row (kind, k1, k2, present, n0, n1, …) per key, from any number of tables in one shuffle.

    ``uses`` names the key's kind, a slot, a frame and one or two columns of it. ``n<slot>`` counts the rows that a slot has of the
    key, ``present`` has a bit for each slot with rows. Rows of a key are counted before the shuffle, so that a hot key is one row
    per task. NULL is a key like others.
    """
    tagged = [
        df.select(
            F.lit(kind).alias("kind"),
            F.col(columns[0]).cast("string").alias("k1"),
            (F.col(columns[1]) if len(columns) > 1 else F.lit(None)).cast("string").alias("k2"),
            F.lit(1 << slot).alias("bit"),
        )
        for kind, slot, df, columns in uses
    ]
    slots = sorted({slot for _, slot, _, _ in uses})
    return (
        union_all(tagged)
        .groupBy("kind", "k1", "k2")
        .agg(
            F.bit_or("bit").alias("present"),
            *[F.count_if(F.col("bit") == 1 << slot).alias(f"n{slot}") for slot in slots],
        )
    )


def _parent_uses(wh: Warehouse):
    for (parent, key), children in PARENT_KEYS.items():
        yield f"key {parent}", 0, wh[parent], [key]
        for slot, (child, column) in enumerate(children, 1):
            yield f"key {parent}", slot, wh[child].where(F.col(column).isNotNull()), [column]


def _grain_uses(wh: Warehouse):
    for table in GRAIN_TABLES:
        yield f"grain {table}", 0, wh[table], GRAINS[table]


def _surrogate_uses(wh: Warehouse):
    for table, schema in DWH_SCHEMAS.items():
        yield f"surrogate {table}", 0, wh[table], [schema[0].name]


def _in_one_row(audit: DataFrame, found: Mapping[tuple[str, ...], Mapping[str, Column]], names: Sequence[str]) -> DataFrame:
    """Totals over the audit, ``found`` by the constants of their result row, without another shuffle of keys."""
    one = audit.agg(
        F.array(
            *[
                F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)], *[v.alias(n) for n, v in values.items()])
                for row, values in found.items()
            ]
        ).alias("x")
    )
    return one.select(F.explode("x").alias("x")).select("x.*")


def _lost(parent: str, slot: int) -> Column:
    """Rows of a slot whose key the parent does not have."""
    lost = (F.col("kind") == f"key {parent}") & (F.col("present").bitwiseAND(F.lit(1)) == 0)
    return F.coalesce(F.sum(F.when(lost, F.col(f"n{slot}"))), F.lit(0))


def orphans(wh: Warehouse) -> DataFrame:
    """Child rows whose parent does not exist, per foreign key."""
    found = {
        (child, column, parent): {"orphans": _lost(parent, slot)}
        for (parent, _), children in PARENT_KEYS.items()
        for slot, (child, column) in enumerate(children, 1)
    }
    return _in_one_row(key_audit([*_parent_uses(wh)]), found, ["child", "fk", "parent"])


def grain_duplicates(wh: Warehouse) -> DataFrame:
    """Natural keys that occur more than once, with the key as text."""
    dups = key_audit([*_grain_uses(wh)]).where(F.col("n0") > 1)
    return dups.select(
        F.substring_index("kind", " ", -1).alias("table_name"), F.concat_ws("|", "k1", "k2").alias("grain"), F.col("n0").alias("copies")
    )


def conflicts(wh: Warehouse) -> DataFrame:
    """Review and order pairs that carry different scores."""
    scores = wh.stg_reviews.groupBy("review_id", "order_id").agg(
        F.countDistinct("review_score").alias("distinct_scores")
    )
    return scores.where(F.col("distinct_scores") > 1)


def _population(table: str) -> dict[str, Column]:
    of = F.col("kind") == f"surrogate {table}"
    return {
        "total_rows": F.coalesce(F.sum(F.when(of, F.col("n0"))), F.lit(0)),
        "distinct_keys": F.count_if(of & F.col("k1").isNotNull()),
    }


def key_population(wh: Warehouse) -> DataFrame:
    """Rows against distinct surrogate keys of the eight warehouse tables."""
    return _in_one_row(key_audit([*_surrogate_uses(wh)]), {(t,): _population(t) for t in DWH_SCHEMAS}, ["table_name"])


def key_gates(wh: Warehouse) -> DataFrame:
    """(gate, failures) of orphans, duplicate grains and key population: all keys of all tables in one audit."""
    uses = [*_parent_uses(wh), *_grain_uses(wh), *_surrogate_uses(wh)]
    lost = [_lost(parent, slot) for (parent, _), children in PARENT_KEYS.items() for slot in range(1, len(children) + 1)]
    populations = [_population(t) for t in DWH_SCHEMAS]
    found = {
        ("orphans",): {"failures": sum(lost[1:], lost[0])},
        ("duplicate grain",): {"failures": F.count_if(F.col("kind").startswith("grain ") & (F.col("n0") > 1))},
        ("key population",): {"failures": sum((p["total_rows"] - p["distinct_keys"] for p in populations), F.lit(0))},
    }
    return _in_one_row(key_audit(uses), found, ["gate"])


def person_vs_order(wh: Warehouse) -> DataFrame:
    """Order-scoped customer ids against persons."""
    counted = side_by_side(
        wh.raw.customers.agg(F.countDistinct("customer_id").alias("order_scoped")),
        wh.raw.customers.agg(F.countDistinct("customer_unique_id").alias("person_scoped")),
        _count(wh.dim_customer, "dim_rows"),
    )
    return counted.withColumn("difference", F.col("order_scoped") - F.col("person_scoped"))


def expected_counts(wh: Warehouse, expected: DataFrame) -> DataFrame:
    """Rows loaded per source table against a frame (table_name, expected), and
    NULLs in critical keys, which must be none."""
    critical = [("customers", "customer_id"), ("orders", "order_id"), ("order_items", "order_id"), ("order_reviews", "review_id")]
    tables = ["customers", "geolocation", "orders", "order_items", "order_payments", "order_reviews", "products", "sellers", "category_translation"]
    loaded = union_all([_tagged(_count(wh[t], "actual"), check_name=t) for t in tables])
    rows = loaded.join(expected.withColumnRenamed("table_name", "check_name"), "check_name")
    nulls = union_all(
        [
            _tagged(wh[t].agg(count_where(F.col(c).isNull()).alias("actual")), check_name=f"{t}.{c} is null").withColumn(
                "expected", F.lit(0).cast("long")
            )
            for t, c in critical
        ]
    )
    return union_all([rows, nulls])


def unsteady_sorts(df: DataFrame, label: str, sort: str) -> DataFrame:
    """Labels that carry more than one sort value, or none in some rows; rows without a label are left out."""
    counted = (
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg((F.countDistinct(sort) + F.max(F.col(sort).isNull().cast("int"))).alias("distinct_sorts"))
    )
    return counted.where(F.col("distinct_sorts") > 1)


def band_sort(wh: Warehouse) -> DataFrame:
    """Duration bands that carry more than one sort value."""
    days = wh.fact_order_items.groupBy("actual_delivery_days").agg(F.count(F.lit(1)))
    pairs = days.select(
        labels.duration_band("actual_delivery_days").alias("duration_band"),
        labels.duration_band_sort("actual_delivery_days").alias("duration_band_sort"),
    )
    return unsteady_sorts(pairs, "duration_band", "duration_band_sort")


def raw_grains(raw) -> DataFrame:
    """(table_name, repeated, lost): natural keys of raw tables that occur more than once, where lookups need them unique, and orders
    whose customer is not there."""
    tables = ["customers", "orders", "products", "sellers", "category_translation"]
    buyers = ("grain customers", 1, raw.orders.where(F.col("customer_id").isNotNull()), ["customer_id"])
    audit = key_audit([*((f"grain {t}", 0, getattr(raw, t), GRAINS[t]) for t in tables), buyers])

    def told(table: str) -> dict[str, Column]:
        given = (F.col("kind") == f"grain {table}") & F.col("k1").isNotNull()
        lost = F.when(given & (F.col("n0") == 0), F.col("n1"))
        return {"repeated": F.count_if(given & (F.col("n0") > 1)), "lost": F.coalesce(F.sum(lost), F.lit(0))}

    return _in_one_row(audit, {(t,): told(t) for t in tables}, ["table_name"])


class ProvenKeys:
    """What :func:`key_gates` finds, for a load whose raw keys lookups need are unique (:func:`raw_grains`).

    Where each raw row has become one fact row with all its keys, no child is without its parent, and nothing is shuffled to see it.
    A grain is counted by its first column, with a bit for each value of the second: only keys with fewer bits than rows can hold a
    repeated pair, and their rows alone are grouped by both. Surrogate keys are counted in blocks of 64 as bits. ``lost`` are orders
    whose customer is not there.
    """

    def __init__(self, wh: Warehouse, measured: Measured, lost: int):
        self.wh, self.measured, self.lost = wh, measured, lost
        reviews = LOADED_FROM["fact_reviews"]
        # rows of a fact that has all rows of its source have the keys of the source
        tables = [t for t in GRAIN_TABLES if t != reviews or not measured.complete("fact_reviews")]
        self.repeated = self._repeated(tables)
        if reviews not in tables:
            self.repeated[reviews] = self.repeated["fact_reviews"]

    def _repeated(self, tables: Sequence[str]) -> dict[str, int]:
        """Natural keys of each table that occur more than once."""
        store, spark = self.wh.store, self.wh.spark
        rows = union_all([self._keyed(place, table) for place, table in enumerate(tables)])
        counted = rows.groupBy("place", "k1").agg(F.count(F.lit(1)).alias("_rows"), F.bit_or("bit").alias("_bits"))
        fewer = F.coalesce(F.bit_count("_bits"), F.lit(0)) < F.col("_rows")
        crowded = store.overwrite(counted.where(fewer).select(F.col("place").alias("_place"), F.col("k1").alias("_k1")), "crowded_keys")
        found = {}
        if not crowded.isEmpty():
            held = rows.join(crowded, (F.col("place") == F.col("_place")) & F.col("k1").eqNullSafe(F.col("_k1")), "left_semi")
            pairs = held.groupBy("place", "k1", "k2").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1)
            found = {r.place: r.n for r in pairs.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per table
        store.remove("crowded_keys")
        return {table: found.get(place, 0) for place, table in enumerate(tables)}

    def _keyed(self, place: int, table: str) -> DataFrame:
        df, (first, *second) = self.wh[table], GRAINS[table]
        bit, other = F.lit(1).cast("long"), F.lit(None)
        if second:
            other = F.col(second[0])
            number = other if isinstance(df.schema[second[0]].dataType, T.IntegralType) else F.xxhash64(other)
            bit = F.call_function("shiftleft", bit, number.bitwiseAND(F.lit(63)).cast("int"))
        return df.select(F.lit(place).alias("place"), F.col(first).cast("string").alias("k1"), other.cast("string").alias("k2"), bit.alias("bit"))

    def _population(self) -> DataFrame:
        """One row (failures): rows less distinct surrogate keys of all tables."""
        blocks = union_all(
            [
                self.wh[table].select(
                    F.lit(place).alias("place"),
                    F.shiftright(F.col(schema[0].name).cast("long"), 6).alias("block"),
                    F.call_function(
                        "shiftleft", F.lit(1).cast("long"), F.col(schema[0].name).cast("long").bitwiseAND(F.lit(63)).cast("int")
                    ).alias("bit"),
                )
                for place, (table, schema) in enumerate(DWH_SCHEMAS.items())
            ]
        )
        counted = blocks.groupBy("place", "block").agg(F.count(F.lit(1)).alias("_rows"), F.bit_or("bit").alias("_bits"))
        return counted.agg((F.sum("_rows") - F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0))).alias("failures"))

    def _orphans(self) -> DataFrame:
        if all(map(self.measured.complete, FACTS)) and self.measured.all_keyed("fact_order_items", ("seller", "product")):
            return self.wh.spark.createDataFrame([(self.lost,)], "failures long")
        return orphans(self.wh).agg(F.sum("orphans").alias("failures"))

    def gates(self) -> DataFrame:
        duplicates = self.wh.spark.createDataFrame([(sum(self.repeated.values()),)], "failures long")
        found = {"orphans": self._orphans(), "duplicate grain": duplicates, "key population": self._population()}
        return union_all([_tagged(df, gate=gate) for gate, df in found.items()])

    def single_reviews(self) -> bool:
        """No pair of review and order has two rows, and so none has two scores."""
        return self.measured.complete("fact_reviews") and not self.repeated["fact_reviews"]


def column_list(frames: Mapping[str, DataFrame], spark) -> DataFrame:
    """Tables, columns, positions, types and nullability."""
    rows = [
        (table, f.name, place, f.dataType.simpleString(), f.nullable)
        for table, df in frames.items()
        for place, f in enumerate(df.schema.fields, start=1)
    ]
    schema = "table_name string, column_name string, position int, data_type string, nullable boolean"
    return spark.createDataFrame(rows, schema)


def schema_issues(df: DataFrame, table: str) -> list[tuple[str, str, str]]:
    """Missing, unexpected and differently typed columns, from the schema alone."""
    want = {f.name: f.dataType.simpleString() for f in SCHEMAS[table].fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    issues = [(table, c, "missing") for c in want if c not in have]
    issues += [(table, c, "unexpected") for c in have if c not in want]
    issues += [(table, c, f"type {have[c]}, declared {want[c]}") for c in want if c in have and have[c] != want[c]]
    return issues


def column_contract(frames: Mapping[str, DataFrame], spark) -> DataFrame:
    """Differences from the declared columns, types and text lengths.

    One pass per table finds the longest text of every limited column.
    """
    schema = "table_name string, column_name string, issue string"
    found = [issue for table, df in frames.items() for issue in schema_issues(df, table)]
    results = [spark.createDataFrame(found, schema)]
    for table, df in frames.items():
        limits = {c: n for c, n in LENGTHS[table].items() if c in df.columns}
        if not limits:
            continue
        longest = df.agg(*[F.max(F.length(c)).alias(c) for c in limits])
        per_column = longest.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("longest"), F.lit(n).alias("declared"))
                        for c, n in limits.items()
                    ]
                )
            ).alias("x")
        ).select("x.*")
        results.append(
            per_column.where(F.col("longest") > F.col("declared")).select(
                F.lit(table).alias("table_name"),
                "column_name",
                F.concat(
                    F.lit("length "), F.col("longest").cast("string"), F.lit(", declared "), F.col("declared").cast("string")
                ).alias("issue"),
            )
        )
    return union_all(results)


def one_to_one(wh: Warehouse) -> DataFrame:
    """Orders and customer ids must pair off."""
    return side_by_side(
        _count(wh.stg_orders, "total_rows"),
        wh.stg_orders.agg(F.countDistinct("order_id").alias("distinct_orders")),
        wh.stg_orders.agg(F.countDistinct("customer_id").alias("distinct_customers")),
    )


def delivered_wrong_status(wh: Warehouse) -> DataFrame:
    """Items with a delivery date on an order that is not delivered."""
    per_order = _items_by_status(
        wh, ("item_rows", F.count(F.lit(1))), where=F.col("delivered_customer_date").isNotNull()
    )
    return (
        per_order.where(F.col("order_status") != labels.DELIVERED)
        .groupBy("order_status")
        .agg(F.sum("item_rows").alias("item_rows"), F.count(F.lit(1)).alias("orders"))
    )


def delivered_no_date(wh: Warehouse) -> DataFrame:
    """Delivered orders without a delivery date."""
    per_order = _items_by_status(wh, ("item_rows", F.count(F.lit(1))), where=F.col("actual_delivery_days").isNull())
    return per_order.where(F.col("order_status") == labels.DELIVERED).agg(
        F.coalesce(F.sum("item_rows"), F.lit(0)).alias("item_rows"), F.count(F.lit(1)).alias("orders")
    )


def negative_days(wh: Warehouse) -> DataFrame:
    """Items that arrived before they were bought."""
    return wh.fact_order_items.where(F.col("actual_delivery_days") < 0).select(
        "order_id", "order_item_id", "purchase_timestamp", "delivered_customer_date", "actual_delivery_days"
    )


def zero_instalments(wh: Warehouse) -> DataFrame:
    """Payments in zero instalments, and all payments of an undefined type."""
    zero = F.col("payment_installments") == 0
    kinds = wh.fact_payments.groupBy("payment_type").agg(
        count_where(zero).alias("zero_rows"), F.count(F.lit(1)).alias("total_rows")
    )
    return kinds.where((F.col("zero_rows") > 0) | (F.col("payment_type") == "not_defined"))


def payment_item_gap(wh: Warehouse) -> DataFrame:
    """Orders paid without items, and with items but unpaid, by status with value."""
    paid = wh.fact_payments.groupBy("order_key").agg(F.sum("payment_value").alias("value"))
    sold = wh.fact_order_items.groupBy("order_key").agg(F.sum(F.col("price") + F.col("freight_value")).alias("value"))
    status = wh.dim_order.select("order_key", "order_status")

    def gap(kind: str, have: DataFrame, lack: DataFrame) -> DataFrame:
        lost = without_match(have, lack, "order_key").join(status, "order_key")
        return _tagged(
            lost.groupBy("order_status").agg(
                F.count(F.lit(1)).alias("orders"), F.sum("value").cast(MONEY).alias("value")
            ),
            kind=kind,
        )

    return union_all([gap("payment without items", paid, sold), gap("items without payment", sold, paid)])


def revenue_bridge(wh: Warehouse) -> DataFrame:
    """Items + freight + payments without items against everything paid."""
    sold = wh.order_totals.agg(
        money_sum("items_revenue").alias("items"),
        money_sum("freight").alias("freight"),
        F.coalesce(money_sum(F.when(F.col("items") == 0, F.col("paid"))), F.lit(0).cast(MONEY)).alias("payments_no_items"),
        money_sum("paid").alias("paid"),
    )
    explained = F.col("items") + F.col("freight") + F.col("payments_no_items")
    return sold.withColumn("residual_pct", percent(F.col("paid") - explained, F.col("paid")))


def plausibility(wh: Warehouse, expected: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct customer states and sellers against one-row frames (expected)."""
    actual = {
        "states": wh.dim_order.agg(F.countDistinct("state").alias("actual")),
        "sellers": wh.dim_seller.agg(F.countDistinct("seller_id").alias("actual")),
    }
    return union_all([_tagged(side_by_side(actual[m], expected[m]), metric=m) for m in expected])


def uncategorised(wh: Warehouse) -> DataFrame:
    """Products without a category and what they earned."""
    unknown = wh.dim_product.where(F.col("category_name_english") == "Unknown").select("product_key")
    sales = wh.fact_order_items.groupBy("product_key").agg(F.sum("price").alias("price"))
    return unknown.join(sales, "product_key", "left").agg(
        F.count(F.lit(1)).alias("products"), F.coalesce(F.sum("price"), F.lit(0)).cast(MONEY).alias("revenue")
    )


def date_key_coverage(wh: Warehouse) -> DataFrame:
    """Latest date key of each fact role and keys the calendar does not have.

    Facts are reduced to one row per day first.
    """
    roles = [(f, "purchase_date_key") for f in FACTS] + [("fact_order_items", "delivered_date_key")]
    known = wh.dim_date.select(F.col("date_key").alias("_key"), F.lit(1).alias("_known"))

    def covered(fact: str, column: str) -> DataFrame:
        keys = wh[fact].where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)))
        return _tagged(
            keys.join(known, "_key", "left").agg(
                F.max("_key").alias("max_date_key"), count_where(F.col("_known").isNull()).alias("unmatched_keys")
            ),
            fact=fact,
            role=column,
        )

    return union_all([covered(*r) for r in roles])


def gates(wh: Warehouse, measured: Measured | None = None, proven: ProvenKeys | None = None) -> DataFrame:
    """All pass/fail checks as (gate, failures); a release needs zero everywhere.

    Given what a load has measured while it wrote, the checks of rows, sums, keys and days read no table again; given what that
    proves of the keys, their audit is not made.
    """

    def gate(name: str, df: DataFrame, failures=None) -> DataFrame:
        amount = F.count(F.lit(1)) if failures is None else F.coalesce(F.sum(failures), F.lit(0))
        return df.agg(amount.cast("long").alias("failures")).select(F.lit(name).alias("gate"), "failures")

    source = measured or _Scanned(wh)
    lost_rows = F.abs(F.col("diff"))
    changed = F.when(safe_div(F.abs("diff"), F.greatest(F.abs("source_value"), F.lit(1.0))) > 1e-9, 1).otherwise(0)
    absent = sum((F.coalesce(F.col(f"missing_{d}"), F.lit(0)) for d in ("customer", "order", "seller", "product")), F.lit(0))
    no_rows = wh.spark.createDataFrame([], "distinct_scores long")
    return union_all(
        [
            gate("row counts", source.row_counts(), lost_rows),
            gate("totals preserved", source.totals_preserved(), changed),
            gate("missing keys", source.missing_keys(), absent),
            (proven.gates() if proven else key_gates(wh)).select("gate", F.col("failures").cast("long").alias("failures")),
            gate("conflicting scores", no_rows if proven and proven.single_reviews() else conflicts(wh)),
            gate("negative days", source.negative_days(), F.col("item_rows")),
            gate("band sort", band_sort(wh)),
            gate("date coverage", date_key_coverage(wh), F.col("unmatched_keys")),
        ]
    )


class _Scanned:
    """The checks that a load can measure, from scans of the written tables."""

    def __init__(self, wh: Warehouse):
        self.wh = wh

    def row_counts(self) -> DataFrame:
        return row_counts(self.wh)

    def totals_preserved(self) -> DataFrame:
        return totals_preserved(self.wh)

    def missing_keys(self) -> DataFrame:
        return missing_keys(self.wh)

    def negative_days(self) -> DataFrame:
        return _count(negative_days(self.wh), "item_rows")
