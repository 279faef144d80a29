"""History, incremental loads, schema changes, file sources and publishing as queries."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from grainhouse.functions.digest import digest_of
from grainhouse.operators.aggregates import side_by_side, union_all
from grainhouse.operators.history import HISTORY, high_water_mark, increment, scd2_apply, start_history
from grainhouse.operators.history_table import HistoryTable
from grainhouse.operators.keys import with_surrogate_key
from grainhouse.plans import layers, measures, rebuild, reports
from grainhouse.plans.incremental import DONE, FACTS, TOTALS, IncrementalLoad
from grainhouse.plans.measured import KEYS
from grainhouse.plans.release import MANIFEST, RELEASED
from grainhouse.registry.measures import QUERIES as MEASURES
from grainhouse.registry.oracle import key8
from grainhouse.registry.quality import QUERIES as QUALITY
from grainhouse.registry.quality import SRC
from grainhouse.registry.reports import QUERIES as REPORTS
from grainhouse.sources.files import check_content, load_csv, read_csv, refresh_mirror, write_csv
from grainhouse.sources.schemas import DWH_SCHEMAS, LENGTHS, MIRROR_SCHEMAS, SCHEMAS, SRC_SCHEMAS, STG_SCHEMAS
from grainhouse.sources.store import Store, conform, drop_columns

SINCE, AS_OF = "1995-01-01", "2001-09-01"
CUT = "2000-01-01"
LOOKBACK = datetime.timedelta(days=30)


def _below(wh, name: str) -> Store:
    return Store(wh.spark, wh.store.path(name))


def _seller_snapshot(wh):
    """A later snapshot of all sellers: those with a negative balance have moved,
    and every nation has opened a market stall of its own."""
    moved = wh.raw.table("supplier").select(
        F.col("s_suppkey").cast("string").alias("seller_id"), (F.col("s_acctbal") < 0).alias("moved")
    )
    known = wh.dim_seller.join(moved, "seller_id").select(
        "seller_id", F.when(F.col("moved"), "RIO DE JANEIRO").otherwise(F.col("city")).alias("city"), "state"
    )
    stalls = wh.raw.table("nation").select(
        F.concat(F.lit("stall-"), F.col("n_nationkey").cast("string")).alias("seller_id"),
        F.upper("n_name").alias("city"),
        F.upper("n_name").alias("state"),
    )
    return known.unionByName(stalls)


def scd2(wh):
    return wh.once(
        "scd2",
        lambda: scd2_apply(
            start_history(wh.dim_seller, SINCE), _seller_snapshot(wh), "seller_id", "seller_key", ["city"], AS_OF, wh.store, "scd2"
        ),
    )


LATER, LATER_CITY, BUCKETS = "2002-03-01", "SALVADOR", 16


def _twice(wh) -> HistoryTable:
    """The snapshot as one run, a few moves as a second, and moves that are undone as a third."""
    table = HistoryTable(_below(wh, "seller_history"), "dim_seller", "seller_id", "seller_key", ["city"], BUCKETS)

    def run():
        table.create(wh.dim_seller, SINCE)
        table.apply(_seller_snapshot(wh), AS_OF)
        number = F.col("s_suppkey")
        moves = wh.raw.table("supplier").select(number.cast("string").alias("seller_id"), F.lit(LATER_CITY).alias("city"), number.alias("_n"))
        table.apply(moves.where("_n % 5 = 0").drop("_n"), LATER)
        table.apply(moves.where("_n % 7 = 0").withColumn("city", F.lit("NOWHERE")).drop("_n"), "2002-04-01")
        table.undo()
        return table.read()

    wh.once("seller_history", run)
    return table


def scd2_twice(wh):
    return _twice(wh).read()


def undo_scd2(wh):
    """Drop the history columns and reload the dimension from staging."""

    def reload():
        schema = DWH_SCHEMAS["dim_seller"]
        left = drop_columns(scd2(wh), HISTORY).columns
        if left != schema.names:
            raise ValueError(f"history left {left}")
        rows = layers.located_sellers(wh.stg_sellers, wh.zip_centres)
        return conform(with_surrogate_key(rows, "seller_id", "seller_key", _below(wh, "undo"), "dim_seller"), schema)

    return wh.once("undo", reload)


def incremental(wh):
    """Items bought before the cut are loaded, but shipped orders come late. The
    next run takes everything after its mark, less the look-back."""
    shipped = wh.dim_order.where(F.col("order_status") == "shipped")
    source = wh.fact_order_items.drop("fact_key", layers.YEAR, layers.MONTH)
    early = source.where(F.col("purchase_timestamp") < F.lit(CUT).cast("timestamp_ntz"))
    loaded = early.join(shipped.select("order_key"), "order_key", "left_anti")
    mark = high_water_mark(loaded, "purchase_timestamp")
    return increment(loaded, source, ["order_id", "order_item_id"], "purchase_timestamp", mark, LOOKBACK)


_INCREMENT = f"""
    SELECT f.* FROM fact_order_items f JOIN dim_order o ON f.order_key = o.order_key
    WHERE (f.purchase_timestamp >= DATE '{CUT}' OR order_status = 'shipped')
      AND f.purchase_timestamp > (SELECT MAX(purchase_timestamp) FROM fact_order_items i JOIN dim_order d ON i.order_key = d.order_key
                                  WHERE purchase_timestamp < DATE '{CUT}' AND order_status <> 'shipped') - INTERVAL {LOOKBACK.days} DAY"""


LATE = 20  # days before the cut from which shipped orders were not known yet


def batches_at_cut(wh):
    """The sources of two loads: what was known at the cut, without late rows, and all there is."""
    wh.together("order_spine", *FACTS)
    spine = wh.order_spine
    cut = int(CUT.replace("-", ""))
    day = F.to_date(F.col("purchase_date_key").cast("string"), "yyyyMMdd")
    late = (F.col("order_status") == "shipped") & (day >= F.date_sub(F.lit(CUT).cast("date"), LATE))
    known = spine.where((F.col("purchase_date_key") < cut) & ~late)
    now = {f: wh[f] for f in FACTS}
    then = {f: rows.join(known.select("order_key"), "order_key", "left_semi") for f, rows in now.items()}
    return (then, known), (now, spine)


def _loaded(wh) -> IncrementalLoad:
    """Two loads, with the second replayed under its name and under another."""
    load = IncrementalLoad(_below(wh, "increments"))

    def run():
        first, second = batches_at_cut(wh)
        for batch, (sources, spine) in {"first": first, "second": second, "again": second}.items():
            load.load(batch, sources, spine, LOOKBACK)
            load.load(batch, sources, spine, LOOKBACK)
        return load.ledger()

    wh.once("increments", run)
    return load


def incremental_load(wh):
    return _loaded(wh).table("fact_order_items").drop("fact_key", layers.MONTH)


def incremental_totals(wh):
    """The order mirror after the loads."""
    columns = ["order_key", "items", "items_revenue", "freight", "payments", "paid", "reviews", "review_total", "delay_days", "delivered_date_key"]
    return _loaded(wh).table(TOTALS).select(*columns)


def incremental_ledger(wh):
    """What each batch has added, in which order, and up to which day."""
    done = _loaded(wh).ledger().where(F.col("state") == DONE)
    return done.select("batch", "table_name", "mark", "rows", F.size("months").cast("long").alias("months"))


def _released(wh):
    """The release that a rebuild has made, opened by its pointer."""
    full_rebuild(wh)
    return rebuild.open_current(_below(wh, "release"))


def release_manifest(wh):
    """Rows of each released table by the manifest, and by a reading of what is there (no row where both agree)."""
    opened = _released(wh)
    issues = opened.verify().withColumnRenamed("table_name", "_name")
    listed = opened.store.read(MANIFEST).select("table_name", "rows")
    return listed.join(issues, F.col("table_name") == F.col("_name"), "left").select("table_name", "rows", "issue")


def load_measures(wh):
    """What the rebuild's own writes have measured."""
    full_rebuild(wh)
    return _below(wh, "release").read("runs/first/measures")


def _old_model(wh):
    """The model before the migration: timing on the order dimension as well, and
    no delivery date key on the items."""
    timing = wh.orders.select(
        "order_key", F.col("delay_days").alias("delivery_delay_days"), F.col("actual_days").alias("actual_delivery_days")
    )
    dim_order = wh.dim_order.join(timing, "order_key", "left")
    return dim_order, wh.fact_order_items.drop("delivered_date_key", layers.YEAR, layers.MONTH)


def schema_change(wh):
    return rebuild.migrate_delivery_timing(*_old_model(wh))[0]


def backfilled(wh):
    items = rebuild.migrate_delivery_timing(*_old_model(wh))[1]
    return items.select("order_id", "order_item_id", "delivered_date_key")


def csv_roundtrip(wh):
    def run():
        path = wh.store.path("csv_reviews")
        write_csv(wh.raw.order_reviews, path)
        return read_csv(wh.spark, path, SCHEMAS["order_reviews"])

    return wh.once("csv_reviews", run)


DROPS = 3


def csv_rejects(wh):
    """Payments delivered in three files. Some rows name an amount that is none, some lack a field, some have one too many."""

    def run():
        store, schema = _below(wh, "drops"), SRC_SCHEMAS["order_payments"]
        key = F.col("order_id").cast("long")
        fields = [F.col(n).cast("string") for n in schema.names]
        amount = F.when(key % 13 == 0, F.lit("n/a")).otherwise(fields[-1])
        line = F.concat_ws(",", *fields[:-1], amount, F.when(key % 17 == 0, F.lit("more")))
        line = F.when(key % 19 == 0, F.concat_ws(",", *fields[:2])).otherwise(line)
        counts = []
        for drop in range(DROPS):
            path = store.path(f"csv/drop-{drop}")
            lines = wh.raw.order_payments.where(key % DROPS == drop).select(line.alias(",".join(schema.names)))
            lines.write.mode("overwrite").option("header", True).option("sep", "\u0001").csv(path)  # lines as they are
            accepted, rejects = load_csv(store, path, schema, f"payments_{drop}", most=wh.raw.order_payments.count())
            both = accepted.select(F.lit(0).alias("bad")).unionByName(rejects.select(F.lit(1).alias("bad")))
            counts.append(both.agg(F.count_if(F.col("bad") == 0).alias("accepted"), F.count_if(F.col("bad") == 1).alias("rejected")).select(F.lit(f"drop-{drop}").alias("file"), "accepted", "rejected"))
        return union_all(counts)

    return wh.once("csv_rejects", run)


# columns that facts carry over from staging unchanged
_CARRIED = {
    ("stg_order_items", "fact_order_items"): ["order_id", "order_item_id", "price", "freight_value"],
    ("stg_payments", "fact_payments"): ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    ("stg_reviews", "fact_reviews"): ["review_id", "order_id", "review_score"],
    ("stg_orders", "dim_order"): ["order_id", "order_status"],
}


def carried_content(wh):
    """Rows of each table, and whether what it carries over from staging is the same multiset of rows there and here."""

    def told(staged, table, columns):
        both = side_by_side(
            digest_of(wh[staged], columns).select(*[F.col(c).alias(f"staged_{c}") for c in ("rows", "digest_a", "digest_b")]),
            digest_of(wh[table], columns),
        )
        same = (F.col("rows") == F.col("staged_rows")) & (F.col("digest_a") == F.col("staged_digest_a")) & (F.col("digest_b") == F.col("staged_digest_b"))
        return both.select(F.lit(table).alias("table_name"), "rows", same.alias("same"))

    return union_all([told(staged, table, columns) for (staged, table), columns in _CARRIED.items()])


def _carried_sql() -> str:
    def part(staged, table, columns):
        a, b = f"SELECT {', '.join(columns)} FROM {staged}", f"SELECT {', '.join(columns)} FROM {table}"
        return (
            f"SELECT '{table}' AS table_name, (SELECT COUNT(*) FROM {table}) AS rows, "
            f"NOT EXISTS (({a}) EXCEPT ALL ({b})) AND NOT EXISTS (({b}) EXCEPT ALL ({a})) AS same"
        )

    return "\nUNION ALL\n".join(part(s, t, c) for (s, t), c in _CARRIED.items())


def _mirror(wh):
    """The nine raw tables as CSV, loaded into a mirror of their own."""

    def run():
        for name in SRC_SCHEMAS:
            write_csv(wh[name], wh.store.path(f"csv/{name}.csv"))
        tables = refresh_mirror(_below(wh, "mirror"), wh.store.path("csv"))
        check_content({name: (conform(wh[name], schema), tables[name]) for name, schema in SRC_SCHEMAS.items()})
        return union_all([t.agg(F.count(F.lit(1)).alias("total_rows")).select(F.lit(n).alias("table_name"), "total_rows") for n, t in tables.items()])

    return wh.once("mirror", run)


def published(wh):
    """Rows and money of every published table, as read back."""

    def run():
        tables = rebuild.publish(wh, _below(wh, "published"))
        check_content({name: (conform(wh[name], schema), tables[name]) for name, schema in DWH_SCHEMAS.items()})
        money = {"fact_order_items": "price", "fact_payments": "payment_value"}

        def summary(name, table):
            value = F.sum(money[name]) if name in money else F.lit(None)
            return table.agg(F.count(F.lit(1)).alias("total_rows"), value.cast("decimal(38,2)").alias("value")).select(
                F.lit(name).alias("table_name"), "total_rows", "value"
            )

        return union_all([summary(n, t) for n, t in tables.items()])

    return wh.once("published", run)


def create_append(wh):
    """Create a table if absent, then append two halves by column name, the
    second with its columns in another order."""

    def run():
        store, schema = _below(wh, "appended"), SCHEMAS["stg_payments"]
        store.remove("stg_payments")
        if not store.ensure("stg_payments", schema).isEmpty():
            raise ValueError("a new table is empty")
        first = F.col("payment_sequential") == 1
        store.append(wh.stg_payments.where(first), "stg_payments", schema)
        rest = wh.stg_payments.where(~first)
        store.append(rest.select(*reversed(rest.columns)), "stg_payments", schema)
        return store.ensure("stg_payments", schema)

    return wh.once("appended", run)


def full_rebuild(wh):
    """Every layer from the raw tables into a run of its own, gated."""

    def run():
        return rebuild.rebuild(wh.raw, _below(wh, "release"), "first")

    return wh.once("release", run)


_RELEASED_ROWS = {
    "order_totals": "(SELECT COUNT(*) FROM dim_order)",
    "zip_centres": "(SELECT COUNT(*) FROM zip_centres)",
    "order_spine": "(SELECT COUNT(*) FROM dim_order)",
    "order_sellers": "(SELECT COUNT(*) FROM (SELECT DISTINCT order_key, seller_key FROM fact_order_items))",
    "seller_revenue_ranks": """(SELECT COUNT(DISTINCT revenue) FROM (SELECT SUM(price) AS revenue FROM fact_order_items
        WHERE seller_key IS NOT NULL GROUP BY seller_key))""",
}


def _measures_sql() -> str:
    """The measures of a load by scans of each table."""
    parts = []
    for table in (*STG_SCHEMAS, *DWH_SCHEMAS):
        names = SCHEMAS[table].names
        found = {"rows": "COUNT(*)"}
        found |= {n: f"ROUND(CAST(SUM({c}) AS DOUBLE), 2)" for c, n in {"price": "sum price", "freight_value": "sum freight", "payment_value": "sum payment"}.items() if c in names}
        if "review_score" in names:
            found["mean score"] = "ROUND(CAST(SUM(review_score) AS DOUBLE) / NULLIF(COUNT(review_score), 0), 6)"
        if table in FACTS:
            found |= {f"missing {k}": f"COUNT(*) - COUNT({k}_key)" for k in KEYS if f"{k}_key" in names}
        if "actual_delivery_days" in names:
            found["negative days"] = "COUNT(*) FILTER (actual_delivery_days < 0)"
        found |= {f"longest {c}": f"MAX(length({c}))" for c in LENGTHS[table] if c in names}
        parts += [f"SELECT '{table}' AS table_name, '{n}' AS measure, CAST({sql} AS DOUBLE) AS value FROM {table}" for n, sql in found.items()]
    parts += [f"SELECT '{t}' AS table_name, 'rows' AS measure, CAST({_RELEASED_ROWS[t]} AS DOUBLE) AS value" for t in MIRROR_SCHEMAS]
    return "\nUNION ALL\n".join(parts)


# the first load has the orders known at the cut; the second brings the others; a third finds nothing
_KNOWN = f"""purchase_date_key < {CUT.replace("-", "")} AND NOT (order_status = 'shipped' AND purchase_date_key >= {{late}})"""
_LATE = (datetime.date.fromisoformat(CUT) - datetime.timedelta(LATE)).strftime("%Y%m%d")
_DATED_ORDERS = f"""SELECT order_key, {key8("order_purchase_timestamp")} AS purchase_date_key FROM buyers"""


def _ledger_sql() -> str:
    known = f"SELECT b.order_key FROM ({_DATED_ORDERS}) b JOIN dim_order d ON b.order_key = d.order_key WHERE " + _KNOWN.format(late=_LATE)
    tables = {**{f: f"SELECT order_key, purchase_date_key FROM {f}" for f in FACTS}, TOTALS: _DATED_ORDERS}
    months = " UNION ".join(
        f"SELECT DISTINCT purchase_date_key // 100 AS m, order_key IN ({known}) AS early FROM ({sql})" for sql in tables.values()
    )
    parts = []
    for batch, kept in (("first", "early"), ("second", "NOT early"), ("again", "FALSE")):
        for table, sql in tables.items():
            mark = f"SELECT MAX(purchase_date_key) FROM ({sql})" + (f" WHERE order_key IN ({known})" if batch == "first" else "")
            parts.append(
                f"SELECT '{batch}' AS batch, '{table}' AS table_name, ({mark}) AS mark, COUNT(*) FILTER ({kept}) AS rows, "
                f"(SELECT COUNT(DISTINCT m) FROM ({months}) WHERE {kept}) AS months FROM (SELECT order_key IN ({known}) AS early FROM ({sql}))"
            )
    return "\nUNION ALL\n".join(parts)


_MONEY, _MONEY20 = "DECIMAL(38,2)", "DECIMAL(20,2)"
_VALUES = {"fact_order_items": f"CAST(SUM(price) AS {_MONEY})", "fact_payments": f"CAST(SUM(payment_value) AS {_MONEY})"}

_SCD2 = f"""
        SELECT s.* EXCLUDE (moved), DATE '{SINCE}' AS valid_from, CASE WHEN moved THEN DATE '{AS_OF}' END AS valid_to, NOT moved AS is_current
        FROM (SELECT d.*, s_acctbal < 0 AS moved FROM dim_seller d JOIN supplier ON seller_id = CAST(s_suppkey AS VARCHAR)) s
        UNION ALL
        SELECT (SELECT MAX(seller_key) FROM dim_seller) + row_number() OVER (ORDER BY seller_id), seller_id, city, state, zip_code, country,
               latitude, longitude, DATE '{AS_OF}', NULL, TRUE
        FROM (SELECT seller_id, 'RIO DE JANEIRO' AS city, state, zip_code, country, latitude, longitude
              FROM dim_seller JOIN supplier ON seller_id = CAST(s_suppkey AS VARCHAR) WHERE s_acctbal < 0
              UNION ALL SELECT 'stall-' || n_nationkey, upper(n_name), upper(n_name), NULL, NULL, NULL, NULL FROM nation)"""

QUERIES = {
    "h_scd2": (scd2, _SCD2),
    "h_scd2_twice": (
        scd2_twice,
        f"""
        SELECT * FROM (WITH h AS ({_SCD2}), moved AS (
            SELECT h.* FROM h JOIN supplier ON seller_id = CAST(s_suppkey AS VARCHAR) WHERE is_current AND s_suppkey % 5 = 0 AND city <> '{LATER_CITY}')
        SELECT * EXCLUDE (expires) REPLACE (CASE WHEN expires THEN DATE '{LATER}' ELSE valid_to END AS valid_to, is_current AND NOT expires AS is_current)
        FROM (SELECT h.*, seller_key IN (SELECT seller_key FROM moved) AS expires FROM h)
        UNION ALL
        SELECT * REPLACE ((SELECT MAX(seller_key) FROM h) + row_number() OVER (ORDER BY seller_id) AS seller_key, '{LATER_CITY}' AS city,
                          DATE '{LATER}' AS valid_from)
        FROM moved)""",
    ),
    "h_undo_scd2": (undo_scd2, "SELECT * FROM dim_seller"),
    "h_incremental": (incremental, _INCREMENT),
    "h_incremental_load": (incremental_load, "SELECT * FROM fact_order_items"),
    "h_incremental_totals": (
        incremental_totals,
        f"""SELECT d.order_key, COALESCE(items, 0) AS items, items_revenue, freight, COALESCE(payments, 0) AS payments, paid,
                   COALESCE(reviews, 0) AS reviews, review_total, delay_days, delivered_date_key
            FROM dim_order d
            LEFT JOIN (SELECT order_key, COUNT(*) AS items, CAST(SUM(price) AS {_MONEY20}) AS items_revenue, CAST(SUM(freight_value) AS {_MONEY20}) AS freight,
                              MAX(delivery_delay_days) AS delay_days, MAX(delivered_date_key) AS delivered_date_key
                       FROM fact_order_items GROUP BY order_key) i ON d.order_key = i.order_key
            LEFT JOIN (SELECT order_key, COUNT(*) AS payments, CAST(SUM(payment_value) AS {_MONEY20}) AS paid FROM fact_payments GROUP BY order_key) p
              ON d.order_key = p.order_key
            LEFT JOIN (SELECT order_key, COUNT(review_score) AS reviews, CAST(SUM(review_score) AS BIGINT) AS review_total
                       FROM fact_reviews GROUP BY order_key) r ON d.order_key = r.order_key""",
    ),
    "h_incremental_ledger": (incremental_ledger, _ledger_sql()),
    "h_schema_change": (schema_change, "SELECT * FROM dim_order"),
    "h_backfill": (
        backfilled,
        f"SELECT order_id, order_item_id, {key8('delivered_customer_date')} AS delivered_date_key FROM fact_order_items",
    ),
    "io_csv_roundtrip": (csv_roundtrip, "SELECT * FROM src_reviews"),
    "io_csv_rejects": (
        csv_rejects,
        f"""SELECT 'drop-' || CAST(k % {DROPS} AS VARCHAR) AS file, COUNT(*) FILTER (NOT bad) AS accepted, COUNT(*) FILTER (bad) AS rejected
            FROM (SELECT k, k % 13 = 0 OR k % 17 = 0 OR k % 19 = 0 AS bad FROM (SELECT CAST(order_id AS BIGINT) AS k FROM src_payments)) GROUP BY 1""",
    ),
    "dq_content": (carried_content, _carried_sql()),
    "io_mirror_refresh": (
        _mirror,
        "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, COUNT(*) AS total_rows FROM {SRC[t]}" for t in SRC_SCHEMAS),
    ),
    "io_publish": (
        published,
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, COUNT(*) AS total_rows, {_VALUES.get(t, f'CAST(NULL AS {_MONEY})')} AS value FROM {t}" for t in DWH_SCHEMAS
        ),
    ),
    "io_create_append": (create_append, "SELECT * FROM stg_payments"),
    # a rebuild returns only when its gates have passed
    "rebuild_gates": (full_rebuild, QUALITY["dq_gates"][1]),
    "rebuild_measures": (load_measures, _measures_sql()),
    # reports on the released run, opened by the pointer; they write nothing
    "io_open_current": (lambda wh: reports.monthly_net(_released(wh)), REPORTS["r_monthly_net"][1]),
    "io_open_current_handling": (lambda wh: measures.handling_share_top(_released(wh)), MEASURES["m_handling_share_top10"][1]),
    "io_release_manifest": (
        release_manifest,
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, {_RELEASED_ROWS.get(t, f'(SELECT COUNT(*) FROM {t})')} AS rows, CAST(NULL AS VARCHAR) AS issue" for t in RELEASED
        ),
    ),
}
