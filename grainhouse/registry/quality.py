"""Data-quality jobs as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainhouse.plans import quality as q
from grainhouse.plans.layers import MONTH, YEAR
from grainhouse.registry.oracle import band, mean, per
from grainhouse.sources.schemas import DWH_SCHEMAS, GRAINS, LENGTHS, SRC_SCHEMAS, STG_SCHEMAS

# DuckDB names of the raw tables
SRC = {name: f"src_{name.removeprefix('order_') if name in ('order_payments', 'order_reviews') else name}" for name in SRC_SCHEMAS}
SRC["category_translation"] = "src_translation"

_MONEY = "DECIMAL(38,2)"


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _expected(wh):
    """Row counts the recipe implies, taken from the given tables."""
    t = wh.raw.table
    key = F.col("o_orderkey")
    one = {
        "customers": t("orders").agg(F.count(F.lit(1)).alias("expected")),
        "geolocation": t("customer").agg(F.count(F.lit(1)).alias("expected")),
        "orders": t("orders").agg(F.count(F.lit(1)).alias("expected")),
        "order_items": t("lineitem").agg(F.count(F.lit(1)).alias("expected")),
        "order_payments": t("orders").agg(F.sum(F.when(key % 997 != 5, 1 + key % 3)).alias("expected")),
        "order_reviews": t("orders").agg(
            F.sum(F.when(key % 101 != 0, F.when(key % 20 == 0, 2).otherwise(1)).cast("long")).alias("expected")
        ),
        "products": t("part").agg(F.count(F.lit(1)).alias("expected")),
        "sellers": t("supplier").agg(F.count(F.lit(1)).alias("expected")),
        "category_translation": t("part").agg((F.countDistinct("p_brand") - 2).alias("expected")),
    }
    return q.union_all([df.select(F.lit(n).alias("table_name"), "expected") for n, df in one.items()])


_EXPECTED_SQL = {
    "customers": "SELECT COUNT(*) FROM orders",
    "geolocation": "SELECT COUNT(*) FROM customer",
    "orders": "SELECT COUNT(*) FROM orders",
    "order_items": "SELECT COUNT(*) FROM lineitem",
    "order_payments": "SELECT CAST(SUM(1 + o_orderkey % 3) AS BIGINT) FROM orders WHERE o_orderkey % 997 <> 5",
    "order_reviews": "SELECT CAST(SUM(CASE WHEN o_orderkey % 20 = 0 THEN 2 ELSE 1 END) AS BIGINT) FROM orders WHERE o_orderkey % 101 <> 0",
    "products": "SELECT COUNT(*) FROM part",
    "sellers": "SELECT COUNT(*) FROM supplier",
    "category_translation": "SELECT COUNT(DISTINCT p_brand) - 2 FROM part",
}


def _plausibility(wh):
    t = wh.raw.table
    return q.plausibility(
        wh,
        {
            "states": t("customer").agg(F.countDistinct("c_nationkey").alias("expected")),
            "sellers": t("supplier").agg(F.count(F.lit(1)).alias("expected")),
        },
    )


def _contract(wh):
    names = [*SRC_SCHEMAS, *STG_SCHEMAS, *DWH_SCHEMAS]
    return q.column_contract({n: wh[n].drop(YEAR, MONTH) for n in names}, wh.spark)


def _length_sql() -> str:
    parts = []
    for table in [*SRC_SCHEMAS, *STG_SCHEMAS, *DWH_SCHEMAS]:
        for column, limit in LENGTHS[table].items():
            if column in ("geolocation_city", "geolocation_state"):
                continue
            parts.append(
                f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
                f"'length ' || MAX(length({column})) || ', declared {limit}' AS issue "
                f"FROM {SRC.get(table, table)} HAVING MAX(length({column})) > {limit}"
            )
    return _union(parts)


def _distinct_keys_sql() -> str:
    parts = []
    for table, schema in DWH_SCHEMAS.items():
        key = "COUNT(*)" if table.startswith("fact_") else f"COUNT(DISTINCT {schema[0].name})"
        parts.append(f"SELECT '{table}' AS table_name, COUNT(*) AS total_rows, {key} AS distinct_keys FROM {table}")
    return _union(parts)


_dups = ["fact_order_items", "fact_payments", "fact_reviews", "dim_customer", "dim_order", "dim_product", "dim_seller", "order_reviews"]

QUERIES = {
    "dq_payment_fanout": (
        q.payment_fanout,
        f"""SELECT (SELECT CAST(SUM(payment_value) AS {_MONEY}) FROM src_payments) AS correct_total,
                   (SELECT CAST(SUM(p.payment_value) AS {_MONEY}) FROM src_order_items i JOIN src_payments p ON i.order_id = p.order_id) AS inflated_total,
                   (SELECT CAST(SUM(payment_value) AS {_MONEY}) FROM fact_payments) AS warehouse_total""",
    ),
    "dq_multi_child": (
        q.multi_child_orders,
        """SELECT (SELECT COUNT(*) FROM (SELECT order_id FROM src_payments GROUP BY order_id HAVING COUNT(*) > 1)) AS orders_multi_payment,
                  (SELECT COUNT(*) FROM (SELECT order_id FROM src_reviews GROUP BY order_id HAVING COUNT(*) > 1)) AS orders_multi_review""",
    ),
    "dq_review_bias": (
        q.review_bias,
        f"""SELECT (SELECT {mean("r.review_score")} FROM src_order_items i JOIN src_reviews r ON i.order_id = r.order_id) AS item_weighted_avg,
                   (SELECT {mean("review_score")} FROM fact_reviews) AS review_avg""",
    ),
    "dq_row_counts": (
        q.row_counts,
        "SELECT *, source_rows - warehouse_rows AS diff FROM ("
        + _union(
            f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {SRC[s]}) AS source_rows, (SELECT COUNT(*) FROM {t}) AS warehouse_rows"
            for t, s in q.LOADED_FROM.items()
        )
        + ")",
    ),
    "dq_missing_keys": (
        q.missing_keys,
        """SELECT 'fact_order_items' AS fact, COUNT(*) - COUNT(customer_key) AS missing_customer, COUNT(*) - COUNT(order_key) AS missing_order,
                  COUNT(*) - COUNT(seller_key) AS missing_seller, COUNT(*) - COUNT(product_key) AS missing_product, COUNT(*) AS total_rows
           FROM fact_order_items
           UNION ALL SELECT 'fact_payments', COUNT(*) - COUNT(customer_key), COUNT(*) - COUNT(order_key), NULL, NULL, COUNT(*) FROM fact_payments
           UNION ALL SELECT 'fact_reviews', COUNT(*) - COUNT(customer_key), COUNT(*) - COUNT(order_key), NULL, NULL, COUNT(*) FROM fact_reviews""",
    ),
    "dq_missing_keys_by_status": (
        q.missing_keys_by_status,
        """SELECT order_status, COUNT(*) - COUNT(product_key) AS missing_product, COUNT(*) - COUNT(seller_key) AS missing_seller, COUNT(*) AS total_rows
           FROM fact_order_items JOIN dim_order USING (order_key) GROUP BY order_status""",
    ),
    "dq_totals_preserved": (
        q.totals_preserved,
        "SELECT *, ROUND(source_value - warehouse_value, 6) AS diff FROM ("
        + _union(
            f"SELECT '{label}' AS measure, (SELECT {value} FROM {stg}) AS source_value, (SELECT {value} FROM {fact}) AS warehouse_value"
            for label, value, stg, fact in [
                ("sum price", "ROUND(CAST(SUM(price) AS DOUBLE), 2)", "stg_order_items", "fact_order_items"),
                ("sum freight", "ROUND(CAST(SUM(freight_value) AS DOUBLE), 2)", "stg_order_items", "fact_order_items"),
                ("sum payment", "ROUND(CAST(SUM(payment_value) AS DOUBLE), 2)", "stg_payments", "fact_payments"),
                ("mean score", mean("review_score"), "stg_reviews", "fact_reviews"),
            ]
        )
        + ")",
    ),
    "dq_orphans": (
        q.orphans,
        _union(
            f"SELECT '{c}' AS child, '{col}' AS fk, '{p}' AS parent, COUNT(*) AS orphans FROM {SRC[c]} c "
            f"WHERE c.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {SRC[p]} p WHERE p.{key} = c.{col})"
            for c, col, p, key in q.FOREIGN_KEYS
        ),
    ),
    "dq_grain_dups": (
        q.grain_duplicates,
        _union(
            f"SELECT '{t}' AS table_name, concat_ws('|', {', '.join(GRAINS[t])}) AS grain, COUNT(*) AS copies "
            f"FROM {SRC.get(t, t)} GROUP BY {', '.join(GRAINS[t])} HAVING COUNT(*) > 1"
            for t in _dups
        ),
    ),
    "dq_conflicts": (
        q.conflicts,
        """SELECT review_id, order_id, COUNT(DISTINCT review_score) AS distinct_scores FROM stg_reviews
           GROUP BY review_id, order_id HAVING COUNT(DISTINCT review_score) > 1""",
    ),
    "dq_key_population": (q.key_population, _distinct_keys_sql()),
    "dq_person_vs_order": (
        q.person_vs_order,
        """SELECT COUNT(DISTINCT customer_id) AS order_scoped, COUNT(DISTINCT customer_unique_id) AS person_scoped,
                  (SELECT COUNT(*) FROM dim_customer) AS dim_rows,
                  COUNT(DISTINCT customer_id) - COUNT(DISTINCT customer_unique_id) AS difference
           FROM src_customers""",
    ),
    "dq_expected_counts": (
        lambda wh: q.expected_counts(wh, _expected(wh)),
        _union(
            [f"SELECT '{t}' AS check_name, (SELECT COUNT(*) FROM {SRC[t]}) AS actual, ({e}) AS expected" for t, e in _EXPECTED_SQL.items()]
            + [
                f"SELECT '{t}.{c} is null' AS check_name, COUNT(*) - COUNT({c}) AS actual, CAST(0 AS BIGINT) AS expected FROM {SRC[t]}"
                for t, c in [("customers", "customer_id"), ("orders", "order_id"), ("order_items", "order_id"), ("order_reviews", "review_id")]
            ]
        ),
    ),
    "dq_band_sort": (
        q.band_sort,
        f"""SELECT duration_band, COUNT(DISTINCT s) AS distinct_sorts
            FROM (SELECT {band("actual_delivery_days")} AS duration_band, {band("actual_delivery_days", True)} AS s FROM fact_order_items)
            WHERE duration_band IS NOT NULL GROUP BY duration_band HAVING COUNT(DISTINCT s) > 1""",
    ),
    "dq_column_contract": (_contract, _length_sql()),
    "dq_one_to_one": (
        q.one_to_one,
        """SELECT COUNT(*) AS total_rows, COUNT(DISTINCT order_id) AS distinct_orders, COUNT(DISTINCT customer_id) AS distinct_customers
           FROM stg_orders""",
    ),
    "dq_delivered_wrong_status": (
        q.delivered_wrong_status,
        """SELECT order_status, COUNT(*) AS item_rows, COUNT(DISTINCT f.order_id) AS orders
           FROM fact_order_items f JOIN dim_order d ON f.order_key = d.order_key
           WHERE delivered_customer_date IS NOT NULL AND order_status <> 'delivered' GROUP BY order_status""",
    ),
    "dq_delivered_no_date": (
        q.delivered_no_date,
        """SELECT COUNT(*) AS item_rows, COUNT(DISTINCT f.order_id) AS orders
           FROM fact_order_items f JOIN dim_order d ON f.order_key = d.order_key
           WHERE actual_delivery_days IS NULL AND order_status = 'delivered'""",
    ),
    "dq_negative_days": (
        q.negative_days,
        """SELECT order_id, order_item_id, purchase_timestamp, delivered_customer_date, actual_delivery_days
           FROM fact_order_items WHERE actual_delivery_days < 0""",
    ),
    "dq_zero_instalments": (
        q.zero_instalments,
        """SELECT payment_type, COUNT(*) FILTER (WHERE payment_installments = 0) AS zero_rows, COUNT(*) AS total_rows
           FROM fact_payments GROUP BY payment_type
           HAVING COUNT(*) FILTER (WHERE payment_installments = 0) > 0 OR payment_type = 'not_defined'""",
    ),
    "dq_payment_item_gap": (
        q.payment_item_gap,
        f"""SELECT 'payment without items' AS kind, order_status, COUNT(DISTINCT p.order_id) AS orders, CAST(SUM(payment_value) AS {_MONEY}) AS value
            FROM fact_payments p JOIN dim_order d ON p.order_key = d.order_key
            WHERE p.order_id NOT IN (SELECT order_id FROM fact_order_items) GROUP BY order_status
            UNION ALL
            SELECT 'items without payment', order_status, COUNT(DISTINCT f.order_id), CAST(SUM(price + freight_value) AS {_MONEY})
            FROM fact_order_items f JOIN dim_order d ON f.order_key = d.order_key
            WHERE f.order_id NOT IN (SELECT order_id FROM fact_payments) GROUP BY order_status""",
    ),
    "dq_revenue_bridge": (
        q.revenue_bridge,
        f"""SELECT *, {per("paid - (items + freight + payments_no_items)", "paid", 100)} AS residual_pct FROM (
            SELECT (SELECT CAST(SUM(price) AS {_MONEY}) FROM fact_order_items) AS items,
                   (SELECT CAST(SUM(freight_value) AS {_MONEY}) FROM fact_order_items) AS freight,
                   (SELECT CAST(COALESCE(SUM(payment_value), 0) AS {_MONEY}) FROM fact_payments
                    WHERE order_id NOT IN (SELECT order_id FROM fact_order_items)) AS payments_no_items,
                   (SELECT CAST(SUM(payment_value) AS {_MONEY}) FROM fact_payments) AS paid)""",
    ),
    "dq_plausibility": (
        _plausibility,
        """SELECT 'states' AS metric, (SELECT COUNT(DISTINCT state) FROM dim_order) AS actual, (SELECT COUNT(DISTINCT c_nationkey) FROM customer) AS expected
           UNION ALL SELECT 'sellers', (SELECT COUNT(DISTINCT seller_id) FROM dim_seller), (SELECT COUNT(*) FROM supplier)""",
    ),
    "dq_uncategorised": (
        q.uncategorised,
        f"""SELECT COUNT(DISTINCT p.product_key) AS products, CAST(COALESCE(SUM(price), 0) AS {_MONEY}) AS revenue
            FROM dim_product p LEFT JOIN fact_order_items f ON p.product_key = f.product_key WHERE category_name_english = 'Unknown'""",
    ),
    "dq_date_key_coverage": (
        q.date_key_coverage,
        _union(
            f"SELECT '{f}' AS fact, '{c}' AS role, MAX({c}) AS max_date_key, "
            f"COUNT(DISTINCT CASE WHEN {c} NOT IN (SELECT date_key FROM dim_date) THEN {c} END) AS unmatched_keys FROM {f}"
            for f, c in [(f, "purchase_date_key") for f in q.FACTS] + [("fact_order_items", "delivered_date_key")]
        ),
    ),
}

_ABSENT = " + ".join(f"COALESCE(missing_{d}, 0)" for d in ("customer", "order", "seller", "product"))
_GATES = [
    ("row counts", "dq_row_counts", "SUM(ABS(diff))"),
    ("totals preserved", "dq_totals_preserved", "COUNT(*) FILTER (WHERE ABS(diff) > 1e-9 * GREATEST(ABS(source_value), 1))"),
    ("missing keys", "dq_missing_keys", f"SUM({_ABSENT})"),
    ("orphans", "dq_orphans", "SUM(orphans)"),
    ("duplicate grain", "dq_grain_dups", "COUNT(*)"),
    ("conflicting scores", "dq_conflicts", "COUNT(*)"),
    ("key population", "dq_key_population", "SUM(total_rows - distinct_keys)"),
    ("negative days", "dq_negative_days", "COUNT(*)"),
    ("band sort", "dq_band_sort", "COUNT(*)"),
    ("date coverage", "dq_date_key_coverage", "SUM(unmatched_keys)"),
]
QUERIES["dq_gates"] = (
    q.gates,
    _union(f"SELECT '{gate}' AS gate, CAST({failures} AS BIGINT) AS failures FROM ({QUERIES[name][1]})" for gate, name, failures in _GATES),
)
