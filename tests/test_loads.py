"""Digests, incremental loads, released runs, gates measured while writing, and the key audit."""

import datetime
import os

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from grainhouse.functions import digest
from grainhouse.functions.digest import content_differences, digest_of
from grainhouse.plans import layers, measures, reports
from grainhouse.plans import quality as q
from grainhouse.plans.incremental import FACTS, TOTALS, IncrementalLoad
from grainhouse.plans.layers import MONTH
from grainhouse.plans.measured import Measured, Watched, all_measures
from grainhouse.plans.rebuild import rebuild
from grainhouse.plans.release import RELEASED, current_run, move_pointer, open_current
from grainhouse.registry.maintenance import LOOKBACK, batches_at_cut
from grainhouse.sources.schemas import SCHEMAS
from grainhouse.sources.store import MeasuringStore, Store

ROW = "k int, a string, b string"


def files_of(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def rows_by_name(df):
    """Rows with their columns in the order of their names, less what says only where a row was written."""
    return rows_of(df.select(*sorted(set(df.columns) - {"fact_key", "purchase_month", "purchase_year"})))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- digests


def test_digest_knows_rows_not_their_order(frame):
    rows = [(1, "x", "y"), (2, None, "y"), (2, None, "y"), (3, "", None)]
    same = digest_of(frame(rows, ROW)).first()
    assert digest_of(frame(rows[::-1], ROW).repartition(3)).first() == same and same["rows"] == 4
    changed = [
        rows[:3],
        [*rows, rows[0]],
        [(1, "x", "y"), (2, "y", None), (2, None, "y"), (3, "", None)],
        [(1, "x", "y"), (2, None, "y"), (2, None, "y"), (3, None, "")],
        [(2, "x", "y"), (1, None, "y"), (2, None, "y"), (3, "", None)],
    ]
    for other in changed:
        assert digest_of(frame(other, ROW)).first() != same
    empty = digest_of(frame([], ROW)).first()
    assert empty["rows"] == 0 and empty["digest_a"] == 0


def test_differences_name_the_column(frame):
    rows = [(1, "x", "y"), (2, "z", "y"), (3, None, "w")]
    mine = frame(rows, ROW)
    assert content_differences(mine, frame(rows, ROW).select("b", "k", "a")).collect() == []
    other = content_differences(mine, frame([(1, "x", "y"), (2, "Z", "y"), (3, None, "w")], ROW))
    assert {r.column_name for r in other.collect()} == {"a", "(row)"}
    swapped = content_differences(mine, frame([(1, "z", "y"), (2, "x", "y"), (3, None, "w")], ROW))
    assert [r.column_name for r in swapped.collect()] == ["(row)"]
    assert {r.column_name for r in content_differences(mine, frame(rows[:2], ROW)).collect()} >= {"(rows)", "(row)"}
    with pytest.raises(ValueError, match="differ"):
        content_differences(mine, mine.drop("a"))


# --- incremental loads


@pytest.fixture(scope="module")
def batches(warehouse):
    warehouse.build()
    return batches_at_cut(warehouse)


def is_full_build(load, warehouse):
    for name in FACTS:
        assert rows_by_name(load.table(name)) == rows_by_name(warehouse[name])
        keys = load.table(name).agg(F.count("fact_key"), F.countDistinct("fact_key")).first()
        assert keys[0] == keys[1] > 0
    assert rows_by_name(load.table(TOTALS)) == rows_by_name(warehouse.order_totals)


def test_loads_replays_and_a_load_cut_off(warehouse, batches, store, monkeypatch):
    (early, known), (all_rows, spine) = batches
    load = IncrementalLoad(store)
    assert load.load("first", early, known, LOOKBACK)
    assert rows_by_name(load.table("fact_payments")) == rows_by_name(early["fact_payments"])
    before = files_of(f"{store.root}/fact_order_items")

    # cut off while staging: nothing has changed, and the batch is not known
    def stop(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(IncrementalLoad, "_note", stop)
        with pytest.raises(RuntimeError):
            load.load("second", all_rows, spine, LOOKBACK)
    assert files_of(f"{store.root}/fact_order_items") == before
    assert {r.batch for r in load.ledger().collect()} == {"first"}

    # cut off between two tables, the first with some of its months gone
    replace, tables = IncrementalLoad._replace, []

    def fail_on_second(self, rows, name):
        tables.append(name)
        if len(tables) == 2:
            raise RuntimeError("driver lost")
        replace(self, rows.where(F.col(MONTH) % 2 == 0), name)

    with monkeypatch.context() as patch:
        patch.setattr(IncrementalLoad, "_replace", fail_on_second)
        with pytest.raises(RuntimeError):
            load.load("second", all_rows, spine, LOOKBACK)
    again = IncrementalLoad(store)
    assert not again.load("second", all_rows, spine, LOOKBACK)  # finished from what was staged
    is_full_build(again, warehouse)

    kept = files_of(f"{store.root}/fact_order_items")
    untouched = {f for f in before if f in kept}
    assert untouched and all(before[f] == kept[f] for f in untouched)  # months before the look-back
    assert all("purchase_month=200" in f or "purchase_month=1999" in f for f in kept if f not in before)

    assert not again.load("first", all_rows, spine, LOOKBACK)
    assert again.load("third", all_rows, spine, LOOKBACK)  # finds nothing new
    assert files_of(f"{store.root}/fact_order_items") == kept
    third = again.ledger().where("batch = 'third' AND state = 'done'").collect()
    assert {r.table_name for r in third} == {*FACTS, TOTALS} and all(r.rows == 0 and r.months == [] for r in third)
    is_full_build(again, warehouse)


def test_rows_before_the_lookback_are_not_looked_at(warehouse, batches, store):
    (early, known), (all_rows, spine) = batches
    load = IncrementalLoad(store)
    load.load("first", early, known, LOOKBACK)
    load.load("second", all_rows, spine, datetime.timedelta(0))
    mark = load.ledger().where("batch = 'first' AND state = 'done' AND table_name = 'fact_reviews'").first().mark
    expected = early["fact_reviews"].unionByName(all_rows["fact_reviews"].where(F.col("purchase_date_key") >= mark)).dropDuplicates(["review_id", "order_id"])
    assert rows_by_name(load.table("fact_reviews")) == rows_by_name(expected)


def test_rows_without_a_day_are_refused(batches, store):
    (early, known), _ = batches
    undated = {**early, "fact_reviews": early["fact_reviews"].withColumn("purchase_date_key", F.lit(None).cast("int"))}
    load = IncrementalLoad(store)
    with pytest.raises(ValueError, match="fact_reviews"):
        load.load("first", undated, known, LOOKBACK)
    assert load.ledger().count() == 0 and load.table("fact_payments").count() == 0


# --- released runs


@pytest.fixture(scope="module")
def released(spark, warehouse, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("release")))
    rebuild(warehouse.raw, store, "one")
    return store


def test_reports_on_a_release_write_nothing(warehouse, released):
    before = files_of(released.root)
    opened = open_current(released)
    assert rows_of(reports.monthly_net(opened)) == rows_of(reports.monthly_net(warehouse))
    assert rows_of(measures.handling_share_top(opened)) == rows_of(measures.handling_share_top(warehouse))
    assert rows_of(reports.seller_pareto(opened)) == rows_of(reports.seller_pareto(warehouse))
    assert "zip_centres" not in vars(opened) and "order_totals" in vars(opened)  # opened when first used
    assert files_of(released.root) == before
    with pytest.raises(KeyError):
        opened["orders_placed"]


def test_manifest_tells_what_is_there(spark, released):
    opened = open_current(released)
    assert set(opened.manifest) == set(RELEASED)
    assert all(opened.released(t).count() == e.rows for t, e in opened.manifest.items())
    assert opened.verify().collect() == []
    table = opened.dim_seller.withColumn("city", F.when(F.col("seller_key") == 1, F.lit("ELSEWHERE")).otherwise(F.col("city")))
    held = spark.createDataFrame(table.collect(), table.schema)
    opened.store.overwrite(held, "dim_seller")
    issues = rows_of(open_current(released).verify())
    opened.store.overwrite(spark.createDataFrame(held.collect()[1:], held.schema), "dim_seller")
    short = rows_of(open_current(released).verify())
    assert issues == [("dim_seller", "other content")]
    assert short == [("dim_seller", f"{held.count() - 1} rows, {held.count()} released")]


def test_pointer_numbers_are_claimed_once(spark, store):
    move_pointer(store, "a")
    assert store.claim("releases/2") and not store.claim("releases/2")  # another release is on its way
    move_pointer(store, "b")
    assert {(r["run"], r["number"]) for r in store.read("current").collect()} == {("a", 1), ("b", 3)}
    assert current_run(store) == "b"


# --- gates measured while writing


@pytest.fixture(scope="module")
def loaded(spark, warehouse, tmp_path_factory):
    """Facts and staging written by a measuring store, a fact with impossible days and missing keys among them."""
    store = MeasuringStore(spark, str(tmp_path_factory.mktemp("measured")), all_measures(RELEASED))
    watched = Watched(warehouse.raw)
    for name in ("order_items", "orders"):
        store.overwrite(getattr(layers, f"stg_{name}")(getattr(watched, name)), f"stg_{name}")
    for name in ("payments", "reviews"):
        store.overwrite(getattr(layers, f"stg_{name}")(getattr(watched, f"order_{name}")), f"stg_{name}")
    early = F.col("order_item_id") == 2
    items = warehouse.fact_order_items.withColumns(
        {
            "actual_delivery_days": F.when(early, F.lit(-3)).otherwise(F.col("actual_delivery_days")),
            "seller_key": F.when(early, F.lit(None)).otherwise(F.col("seller_key")),
        }
    )
    store.overwrite(items, "fact_order_items", ["purchase_year"])
    for name in ("fact_payments", "fact_reviews"):
        store.overwrite(warehouse[name], name)
    store.overwrite(warehouse.dim_order.withColumn("state", F.rpad("state", 13, "-")), "dim_order")
    return store, Measured(spark, store.measured, watched.rows())


class Written:
    """The tables of a store under the names of a warehouse."""

    def __init__(self, warehouse, store):
        self.warehouse, self.store = warehouse, store

    def __getitem__(self, name):
        return self.store.read(name) if name in self.store.measured else self.warehouse[name]

    def __getattr__(self, name):
        return self[name]


def test_measured_checks_equal_scans_and_scan_nothing(warehouse, loaded):
    store, measured = loaded
    written = Written(warehouse, store)
    for mine, scanned in [
        (measured.row_counts(), q.row_counts(written)),
        (measured.totals_preserved(), q.totals_preserved(written)),
        (measured.missing_keys(), q.missing_keys(written)),
    ]:
        assert mine.columns == scanned.columns and rows_of(mine) == rows_of(scanned)
        assert "FileScan" not in plan(mine) and "FileScan" in plan(scanned)
    days = q.negative_days(written).count()
    assert days > 0 and rows_of(measured.negative_days()) == [(days,)]
    assert measured.missing_keys().where("fact = 'fact_order_items'").first().missing_seller == days


def test_longest_texts_are_measured(loaded):
    _, measured = loaded
    assert rows_of(measured.too_long()) == [("dim_order", "state", 13, 10)]


def test_gates_with_measures_read_less(warehouse, loaded):
    _, measured = loaded
    scans = plan(q.gates(warehouse)).count("FileScan")
    assert plan(q.gates(warehouse, measured)).count("FileScan") <= scans - 13
    failures = {r.gate: r.failures for r in q.gates(warehouse, measured).collect()}
    assert failures["negative days"] > 0 and failures["missing keys"] > 0 and failures["row counts"] == 0
    assert [r.gate for r in q.gates(warehouse).collect()] == [r.gate for r in q.gates(warehouse, measured).collect()]


# --- key audit


def shuffles_of_keys(df):
    return plan(df).count("Exchange hashpartitioning")


def test_one_shuffle_for_all_keys(warehouse):
    for check in (q.orphans, q.grain_duplicates, q.key_population, q.key_gates):
        assert shuffles_of_keys(check(warehouse)) == 1, check.__name__


class Tables(dict):
    def __getattr__(self, name):
        return self[name]


def test_audit_finds_orphans_duplicates_and_repeated_keys(frame):
    def table(name, rows, *columns):
        schema = SCHEMAS[name]
        values = [dict(zip(columns, r, strict=True)) for r in rows]
        return frame([tuple(v.get(f.name) for f in schema) for v in values], schema)

    hot = [("o1", i, "p1", "s1") for i in range(50)]
    wh = Tables(
        customers=table("customers", [("c1",), ("c2",)], "customer_id"),
        orders=table("orders", [("o1", "c1"), ("o2", "c9"), ("o3", None), ("o4", "c2")], "order_id", "customer_id"),
        order_items=table("order_items", [*hot, ("o9", 1, "p1", "s1"), ("o9", 2, "p8", None)], "order_id", "order_item_id", "product_id", "seller_id"),
        order_payments=table("order_payments", [("o2", 1), (None, 1)], "order_id", "payment_sequential"),
        order_reviews=table("order_reviews", [("r1", "o1"), ("r1", "o1"), ("r1", "o2"), ("r2", "o7")], "review_id", "order_id"),
        products=table("products", [("p1",)], "product_id"),
        sellers=table("sellers", [("s1",)], "seller_id"),
        dim_customer=table("dim_customer", [(1, "u"), (2, "u"), (2, None), (None, None)], "customer_key", "customer_unique_id"),
        dim_date=table("dim_date", [(20000101,)], "date_key"),
        dim_order=table("dim_order", [(1, "o1"), (2, "o2")], "order_key", "order_id"),
        dim_product=table("dim_product", [(1, "p1")], "product_key", "product_id"),
        dim_seller=table("dim_seller", [], "seller_key", "seller_id"),
        fact_order_items=table("fact_order_items", [(1, "o1", 1), (2, "o1", 1), (3, "o1", 2), (3, "o1|1", None)], "fact_key", "order_id", "order_item_id"),
        fact_payments=table("fact_payments", [(1, "o1", 1)], "fact_key", "order_id", "payment_sequential"),
        fact_reviews=table("fact_reviews", [(1, "r1", "o1")], "fact_key", "review_id", "order_id"),
    )
    lost = {(r.child, r.fk): r.orphans for r in q.orphans(wh).collect()}
    assert lost == {
        ("orders", "customer_id"): 1, ("order_items", "order_id"): 2, ("order_items", "product_id"): 1, ("order_items", "seller_id"): 0,
        ("order_payments", "order_id"): 0, ("order_reviews", "order_id"): 1,
    }
    dups = {(r.table_name, r.grain): r.copies for r in q.grain_duplicates(wh).collect()}
    assert dups == {("fact_order_items", "o1|1"): 2, ("dim_customer", "u"): 2, ("dim_customer", ""): 2, ("order_reviews", "r1|o1"): 2}
    keys = {r.table_name: (r.total_rows, r.distinct_keys) for r in q.key_population(wh).collect()}
    assert keys["dim_customer"] == (4, 2) and keys["fact_order_items"] == (4, 3) and keys["dim_seller"] == (0, 0)
    assert rows_of(q.key_gates(wh)) == [("duplicate grain", 4), ("key population", 3), ("orphans", 5)]


def test_digest_sums_are_exact_and_of_whole_numbers(frame):
    numbers = [-(1 << 63), (1 << 63) - 1, -1, 0, 1, (1 << 42) - 1, -(1 << 42) - 1, 1 << 21, *[-(1 << 63)] * 50, *[(1 << 63) - 1] * 7]
    rows = frame([(n,) for n in numbers] + [(None,)], "n long").repartition(3)
    assert int(rows.agg(digest._total(F.col("n"))).first()[0]) == sum(numbers)
    assert int(rows.where("n is null").agg(digest._total(F.col("n"))).first()[0]) == 0
    assert "sum(cast(" not in plan(digest_of(rows))  # decimals are made of the sums, not of each row
