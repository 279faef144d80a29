"""Distinct order counts under slicers, from a rollup that adds up.

Month, customer state and status belong to an order; seller state and category group belong to its items, and an order may have
several of them. The rollup counts orders by what belongs to the order and by the set of (seller state, category group) pairs of its
items. Every order is in exactly one row, so the distinct orders under any choice of slicers are a plain sum over the rows whose set
meets the choice: exact, without keys, and rollups of different orders (months, batches) just add up. Sets repeat, so the rollup
grows with the combinations that occur and not with the orders; a bitmap of order keys per cell would take a page of 4 KB at least for
each pair, month, state and bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainhouse.functions import labels
from grainhouse.functions.scalar import count_where, month_key, percent

OF_ORDERS = ("purchase_month", "customer_state", "order_status")
OF_ITEMS = ("seller_state", "category_group")
COUNTS = ("orders", "delivered_orders", "late_orders")


def rollup(items: DataFrame, sellers: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """(purchase_month, customer_state, order_status, pairs, orders, delivered_orders, late_orders).

    ``items`` has order, seller and product keys, ``sellers`` (seller_key, seller_state), ``products`` (product_key,
    category_group), ``orders`` one row per order. An order's set has at most states x groups pairs, however many items it has;
    orders without items have an empty one. An item without a seller or product has a NULL in its pair.
    """
    located = items.select("order_key", "seller_key", "product_key").join(sellers, "seller_key", "left").join(products, "product_key", "left")
    sets = located.groupBy("order_key").agg(F.sort_array(F.collect_set(F.struct(*OF_ITEMS))).alias("pairs"))
    known = orders.withColumn("purchase_month", month_key("purchase_date_key")).join(sets, "order_key", "left")
    delivered, late = labels.is_delivered(), F.col("delay_days") > 0
    empty = F.array().cast(sets.schema["pairs"].dataType)
    return known.groupBy(*OF_ORDERS, F.coalesce("pairs", empty).alias("pairs")).agg(
        F.count(F.lit(1)).alias("orders"),
        count_where(delivered).alias("delivered_orders"),
        count_where(delivered & late).alias("late_orders"),
    )


def sliced_counts(found: DataFrame, by: Sequence[str] = (), where: Mapping[str, Sequence[str | int | None]] | None = None) -> DataFrame:
    """Distinct orders by any of the slicers, with any of them set to some values: ``by``, COUNTS and ``pct_late``.

    Slicers on items mean one item that meets all of them. By seller state or category group an order counts once in each that
    it has; without an item slicer all orders count, those without items too.
    """
    where = where or {}
    unknown = {*by, *where} - {*OF_ORDERS, *OF_ITEMS}
    if unknown:
        raise ValueError(f"no slicer {sorted(unknown)}")
    for name in (n for n in OF_ORDERS if n in where):
        found = found.where(_among(F.col(name), where[name]))
    chosen = [n for n in OF_ITEMS if n in where]
    shown = [n for n in OF_ITEMS if n in by]
    if chosen or shown:
        meets = F.col("pairs")
        if chosen:
            meets = F.filter(meets, lambda p: _all([_among(p[n], where[n]) for n in chosen]))
        if shown:
            cells = F.array_distinct(F.transform(meets, lambda p: F.struct(*[p[n].alias(n) for n in shown])))
            found = found.withColumn("_cell", F.explode(cells)).select(*OF_ORDERS, *COUNTS, "_cell.*")
        else:
            found = found.where(F.size(meets) > 0)
    totals = found.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])
    return totals.withColumn("pct_late", percent(F.col("late_orders"), F.col("delivered_orders")))


def _among(column: Column, values: Sequence[str | int | None]) -> Column:
    given = [v for v in values if v is not None]
    met = F.coalesce(column.isin(given), F.lit(False)) if given else F.lit(False)
    return met | column.isNull() if len(given) < len(values) else met


def _all(conditions: Sequence[Column]) -> Column:
    met = conditions[0]
    for condition in conditions[1:]:
        met = met & condition
    return met
