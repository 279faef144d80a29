"""Rejected rows, content checks, history tables, slicers, exact selection and the order-seller mirror."""

import datetime
import os
import random
import statistics

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from grainhouse.functions.digest import digest_of
from grainhouse.operators.history import start_history
from grainhouse.operators.history_table import BUCKET, HistoryTable
from grainhouse.operators.selection import exact_quantiles, rank_rows
from grainhouse.plans import layers, measures, quality, rebuild, reports, slices
from grainhouse.plans.incremental import FACTS, IncrementalLoad
from grainhouse.registry.maintenance import LOOKBACK, batches_at_cut
from grainhouse.session import input_bytes, sized_shuffles
from grainhouse.sources.files import ContentError, RejectedRows, check_content, load_csv, refresh_mirror, write_csv
from grainhouse.sources.schemas import SCHEMAS, SRC_SCHEMAS
from grainhouse.sources.store import MeasuringStore, Store, conform


def files_of(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- rejected rows


PAYMENTS = '''order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,2,10.50
o2,one,boleto,1,3.00
o3,1,"a, quoted ""type""",1,4.00
o4,1,boleto
o5,1,boleto,1,5.00,more
o6,1,,,
'''


def test_rejects_are_kept_with_file_and_text(store, tmp_path):
    path = tmp_path / "payments.csv"
    path.write_text(PAYMENTS)
    schema = SRC_SCHEMAS["order_payments"]
    accepted, rejects = load_csv(store, str(path), schema, "payments", most=3)
    assert accepted.schema.names == schema.names
    assert {r.order_id for r in accepted.collect()} == {"o1", "o3", "o6"}
    found = {r._record: r for r in rejects.collect()}
    assert set(found) == {"o2,one,boleto,1,3.00", "o4,1,boleto", "o5,1,boleto,1,5.00,more"}
    assert found["o2,one,boleto,1,3.00"].order_id == "o2" and all(r.file.endswith("payments.csv") for r in found.values())


def test_too_many_rejects_stop_the_load(store, tmp_path):
    path, schema = tmp_path / "payments.csv", SRC_SCHEMAS["order_payments"]
    path.write_text(PAYMENTS.splitlines()[0] + "\no0,1,boleto,1,1.00\n")
    assert load_csv(store, str(path), schema, "payments")[0].count() == 1
    path.write_text(PAYMENTS)
    with pytest.raises(RejectedRows, match="3 rows"):
        load_csv(store, str(path), schema, "payments", most=2)
    assert [r.order_id for r in store.read("payments").collect()] == ["o0"]  # as it was
    assert store.read("payments_rejects").count() == 3


def test_empty_file_has_no_rejects(store, tmp_path):
    path = tmp_path / "payments.csv"
    path.write_text(PAYMENTS.splitlines()[0] + "\n")
    accepted, rejects = load_csv(store, str(path), SRC_SCHEMAS["order_payments"], "payments")
    assert accepted.count() == rejects.count() == 0


# --- content


def test_swapped_values_are_found_in_a_mirror_and_in_a_publication(spark, warehouse, store, tmp_path):
    files = {}
    for name in ("sellers", "order_payments"):
        write_csv(warehouse[name], f"{tmp_path}/{name}.csv")
        files[name] = f"{name}.csv"
    mirror = refresh_mirror(store, str(tmp_path), files)
    originals = {n: conform(warehouse[n], SRC_SCHEMAS[n]) for n in files}
    check_content({n: (originals[n], mirror[n]) for n in files})

    first, second = mirror["sellers"].orderBy("seller_id").limit(2).collect()
    swap = F.when(F.col("seller_id") == first.seller_id, F.lit(second.seller_city)).when(F.col("seller_id") == second.seller_id, F.lit(first.seller_city))
    swapped = mirror["sellers"].withColumn("seller_city", F.coalesce(swap, F.col("seller_city")))
    with pytest.raises(ContentError, match=r"'sellers': \['\(row\)'\]"):
        check_content({"sellers": (originals["sellers"], swapped)})

    published = rebuild.publish(warehouse, Store(spark, store.path("published")))
    facts = conform(warehouse["fact_payments"], SCHEMAS["fact_payments"])
    check_content({"fact_payments": (facts, published["fact_payments"])})
    low, high = facts.agg(F.min("fact_key"), F.max("fact_key")).first()
    value = {r.fact_key: r.payment_value for r in facts.where(F.col("fact_key").isin(low, high)).collect()}
    assert value[low] != value[high]
    changed = F.when(F.col("fact_key") == low, F.lit(value[high])).when(F.col("fact_key") == high, F.lit(value[low])).otherwise(F.col("payment_value"))
    with pytest.raises(ContentError, match="fact_payments"):
        check_content({"fact_payments": (facts, published["fact_payments"].withColumn("payment_value", changed))})


# --- history tables


DIM = "seller_key long, seller_id string, city string, state string"


@pytest.fixture
def sellers(frame):
    return frame([(k, f"s{k}", "A" if k % 2 else None, "X") for k in range(1, 41)], DIM)


@pytest.fixture
def history(store, sellers):
    table = HistoryTable(store, "sellers", "seller_id", "seller_key", ["city"], 16)
    table.create(sellers, "2000-01-01")
    return table


def test_only_touched_partitions_are_rewritten_and_undone(store, history, frame, sellers):
    before, rows = files_of(f"{store.root}/sellers"), rows_of(history.read())
    assert rows == rows_of(start_history(sellers, "2000-01-01").select(*history.read().columns))
    changes = frame([("s1", "B", "Y"), ("s2", None, "Z"), ("new", "C", "X")], "seller_id string, city string, state string")
    now = {(r.seller_id, r.is_current): r for r in history.apply(changes, "2001-01-01").collect()}
    assert now["s1", False].city == "A" and str(now["s1", False].valid_to) == "2001-01-01"
    assert now["s1", True].city == "B" and now["s1", True].state == "Y"
    assert ("s2", False) not in now and now["s2", True].state == "X"  # nothing tracked has changed
    assert sorted((now["s1", True].seller_key, now["new", True].seller_key)) == [41, 42] and len(now) == 42
    touched = {f"{BUCKET}={b}" for b in history.log().orderBy(F.desc("number")).first().buckets}
    after = files_of(f"{store.root}/sellers")
    assert 1 <= len(touched) <= 2 and {f for f in before if f.split("/")[-2] not in touched} <= after
    assert all(f.split("/")[-2] in touched for f in before ^ after)

    history.apply(frame([("s1", "D")], "seller_id string, city string"), "2002-01-01")
    assert [r.valid_from.year for r in history.read().where("seller_id = 's1'").orderBy("valid_from").collect()] == [2000, 2001, 2002]
    assert history.undo() and history.read().where("seller_id = 's1'").count() == 2
    assert history.undo() and rows_of(history.read()) == rows
    assert not history.undo()
    # keys are not used again
    assert history.apply(changes, "2003-01-01").agg(F.max("seller_key")).first()[0] == 45


def test_a_run_cut_off_is_finished(store, history, frame, monkeypatch):
    changes = frame([(f"s{k}", "B") for k in range(1, 30)], "seller_id string, city string")

    def stop(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(HistoryTable, "_replace", stop)
        with pytest.raises(RuntimeError):
            history.apply(changes, "2001-01-01")
    assert history.read().count() == 40
    history.apply(changes, "2001-06-01")  # finishes the first, then finds nothing to change
    found = history.read()
    assert found.count() == 69 and found.where("is_current").count() == 40
    assert {str(r.valid_from) for r in found.where("city = 'B'").collect()} == {"2001-01-01"}


def test_no_changes_and_repeated_keys(history, frame):
    kind = "seller_id string, city string, at int"
    before = rows_of(history.read())
    assert rows_of(history.apply(frame([], kind).drop("at"), "2001-01-01")) == before
    twice = frame([("s1", "B", 1), ("s1", "C", 2)], kind)
    with pytest.raises(ValueError, match="several"):
        history.apply(twice.drop("at"), "2001-01-01")
    history.apply(twice, "2001-01-01", sequence="at")
    assert history.read().where("seller_id = 's1' AND is_current").first().city == "C"


# --- slicers


def sliced_by_hand(orders, where):
    """Distinct orders from (order, month, state, status, delay, [(seller state, group)])."""

    def met(name, value):
        return name not in where or value in where[name]

    found = []
    for order in orders:
        _, month, state, status, _, pairs = order
        if not (met("purchase_month", month) and met("customer_state", state) and met("order_status", status)):
            continue
        on_items = {"seller_state", "category_group"} & set(where)
        if not on_items or any(met("seller_state", s) and met("category_group", g) for s, g in pairs):
            found.append(order)
    delivered = [o for o in found if o[3] == "delivered"]
    return len(found), len(delivered), sum((o[4] or 0) > 0 for o in delivered)


def test_counts_under_every_slicer(frame):
    rng = random.Random(8)
    states, groups = ["P", "Q", None], ["toys", "home", None]
    orders = []
    for k in range(300):
        pairs = [(rng.choice(states), rng.choice(groups)) for _ in range(rng.choice([0, 1, 1, 2, 3]))]
        orders.append((k, 200001 + k % 3, rng.choice(["X", "Y"]), rng.choice(["delivered", "canceled"]), rng.choice([-3, 4, None]), pairs))
    orders.append((999, 200001, "X", "delivered", 1, [("P", "toys")] * 500 + [("Q", "home")]))  # one order with most of the items
    sellers = frame([(1, "P"), (2, "Q")], "seller_key long, seller_state string")
    products = frame([(1, "toys"), (2, "home")], "product_key long, category_group string")
    key = {"P": 1, "Q": 2, "toys": 1, "home": 2}
    items = frame([(o[0], key.get(s), key.get(g)) for o in orders for s, g in o[5]], "order_key long, seller_key long, product_key long")
    kind = "order_key long, purchase_date_key int, customer_state string, order_status string, delay_days int"
    rollup = slices.rollup(items, sellers, products, frame([(o[0], o[1] * 100 + 5, *o[2:5]) for o in orders], kind))
    assert rollup.agg(F.sum("orders")).first()[0] == 301 and rollup.count() < 200
    for where in [
        {}, {"seller_state": ["P"]}, {"seller_state": ["P", None]}, {"category_group": ["toys"], "seller_state": ["Q"]},
        {"customer_state": ["X"], "category_group": [None]}, {"purchase_month": [200002], "seller_state": ["Q"], "order_status": ["delivered"]},
    ]:
        found = slices.sliced_counts(rollup, where=where).first()
        assert (found.orders, found.delivered_orders, found.late_orders) == sliced_by_hand(orders, where), where
    by = {(r.seller_state, r.customer_state): r.orders for r in slices.sliced_counts(rollup, ["seller_state", "customer_state"], {"category_group": ["toys"]}).collect()}
    assert by == {(s, c): n for s in states for c in "XY" if (n := sliced_by_hand(orders, {"seller_state": [s], "customer_state": [c], "category_group": ["toys"]})[0])}
    with pytest.raises(ValueError, match="no slicer"):
        slices.sliced_counts(rollup, ["city"])


def test_sliced_counts_read_the_rollup_alone(warehouse):
    text = plan(slices.sliced_counts(warehouse.order_slices, ["seller_state"], {"customer_state": ["NATION_3"]}))
    assert text.count("FileScan") == 1 and "order_key" not in text


# --- selection


def test_quantiles_and_ranks_without_one_task(frame, store):
    rng = random.Random(2)
    values = [round(rng.uniform(-1e6, 1e6), 2) for _ in range(999)] + [7.25] * 500 + [None] * 20
    df = frame([(k, v) for k, v in enumerate(values)], "k int, v double").repartition(5)
    points = {"low": 0.0, "q": 0.25, "mid": 0.5, "p": 0.987, "high": 1.0}
    found = exact_quantiles(df, "v", points, store, "values").first().asDict()
    known = sorted(v for v in values if v is not None)
    cuts = {n: known[int(p * (len(known) - 1))] + (known[min(int(p * (len(known) - 1)) + 1, len(known) - 1)] - known[int(p * (len(known) - 1))]) * (p * (len(known) - 1) % 1) for n, p in points.items()}
    assert found == pytest.approx(cuts) and found["mid"] == pytest.approx(statistics.median(known))
    ranked = rank_rows(df, "v", "place", store, "ranks")
    above = sorted(known, reverse=True)
    expected = {k: len(known) + 1 if v is None else above.index(v) + 1 for k, v in enumerate(values)}
    assert {r.k: r.place for r in ranked.collect()} == expected
    for text in (plan(exact_quantiles(df, "v", points, store, "values")), plan(ranked)):
        assert "percentile" not in text
    assert exact_quantiles(df.where("v IS NULL"), "v", {"mid": 0.5}, store, "none").first().mid is None
    assert exact_quantiles(df.where("v = 7.25").limit(2), "v", {"mid": 0.5}, store, "two").first().mid == 7.25
    assert rank_rows(df.where("false"), "v", "place", store, "nothing").count() == 0


# --- order x seller


def test_pair_reports_are_one_scan(warehouse):
    for report in (reports.distance_buckets, reports.route_types, reports.city_state, reports.geography_sellers, measures.handling_by_seller_state):
        text = plan(report(warehouse))
        assert text.count("FileScan") == 1 and "Join" not in text, report.__name__


def test_pairs_mark_one_row_per_state_distance_and_route(warehouse):
    pairs = warehouse.order_sellers
    items = warehouse.fact_order_items
    assert pairs.count() == items.select("order_key", "seller_key").distinct().count()
    assert pairs.agg(F.sum("price"), F.sum("item_rows")).first() == items.agg(F.sum("price"), F.count("*")).first()
    for column, flag in [("seller_state", "first_of_state"), ("distance", "first_of_distance"), ("route_type", "first_of_route")]:
        groups = pairs.where("seller_key IS NOT NULL").groupBy("order_key", column).agg(F.count_if(flag).alias("n"))
        assert groups.where("n <> 1").count() == 0


# --- checks before and around a load


def test_repeated_keys_of_lookups_stop_a_rebuild(spark, warehouse, store):
    class Raw:
        def __getattr__(self, name):
            table = getattr(warehouse.raw, name)
            return table.unionByName(table.limit(3)) if name == "category_translation" else table

    assert {r.table_name: r.repeated for r in quality.raw_grains(warehouse.raw).collect()}["category_translation"] == 0
    with pytest.raises(rebuild.GateError, match="category_translation"):
        rebuild.rebuild(Raw(), store, "bad")
    assert not store.exists("current")
    with pytest.raises(FileExistsError):
        rebuild.rebuild(warehouse.raw, store, "bad")


def test_a_label_with_two_places_is_found(frame):
    rows = [("a", 1), ("a", 1), ("b", 2), ("b", 3), ("c", None), ("c", 4), (None, 9)]
    assert rows_of(quality.unsteady_sorts(frame(rows, "label string, place int"), "label", "place")) == [("b", 2), ("c", 2)]


def test_shuffle_width_is_put_back(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with sized_shuffles(spark, 1 << 40):
        assert spark.conf.get(key) == "4096"
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "9")
    try:
        with sized_shuffles(spark, 1 << 40):
            assert spark.conf.get(key) == "4096"
        assert spark.conf.get(key) == "9"
    finally:
        spark.conf.unset(key)


def test_inputs_of_unknown_size_are_told(frame):
    with pytest.warns(UserWarning, match="1 inputs"):
        assert input_bytes(frame([(1,)], "n int").rdd.toDF()) >= 0


def test_slicers_never_multiply_orders(warehouse):
    every = [f"NATION_{k}" for k in range(25)]
    sliced = reports.sliced_orders(warehouse, every, every)
    assert sliced.count() == sliced.select("order_key").distinct().count() == warehouse.orders.where("items > 0").count()
    assert reports.sliced_orders(warehouse, ["nowhere"]).isEmpty() and reports.sliced_orders(warehouse, None, ["nowhere"]).isEmpty()
    card = reports.promise_cards(warehouse, seller_state=["nowhere"]).first()
    assert card.delivered_orders == 0 and card.points_lost is None and card.pct_late is None


def test_order_sellers_take_the_dates_of_the_order(frame):
    """Items come without dates: only keys and amounts travel with the pairs."""
    items = frame(
        [(1, 7, "10.00", "1.00"), (1, 7, "5.00", "1.00"), (1, 8, "2.00", "0.50"), (2, None, "3.00", "0.25")],
        "order_key long, seller_key long, price string, freight_value string",
    ).selectExpr("order_key", "seller_key", "cast(price as decimal(10,2)) price", "cast(freight_value as decimal(10,2)) freight_value")
    bought, sent, came = (datetime.datetime(2018, 5, d, 12) for d in (1, 2, 6))
    spine = frame(
        [(1, 20180501, "delivered", "X", "RJ", 0.0, 0.0, bought, sent, came), (2, 20180501, "shipped", "Y", None, None, None, bought, sent, None)],
        "order_key long, purchase_date_key int, order_status string, city string, state string, latitude double, longitude double, "
        "order_purchase_timestamp timestamp_ntz, order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz",
    )
    sellers = frame(
        [(7, "s7", "A", "SP", 3.0, 4.0), (8, "s8", "B", "SP", 0.0, 1.0)],
        "seller_key long, seller_id string, city string, state string, latitude double, longitude double",
    )
    pairs = layers.order_sellers(spine, items, sellers)
    columns = ["order_key", "seller_key", "item_rows", "dated_rows", "price", "actual_days", "handling_minutes", "transit_minutes", "distance", "first_of_state"]
    found = [tuple(float(v) if c == "price" else v for c, v in zip(columns, r)) for r in pairs.select(columns).collect()]
    assert sorted(found, key=repr) == sorted(
        [
            (1, 7, 2, 2, 15.0, 5, 1440, 5760, 5.0, True),
            (1, 8, 1, 1, 2.0, 5, 1440, 5760, 1.0, False),
            (2, None, 1, 0, 3.0, None, 1440, None, None, False),
        ],
        key=repr,
    )


def test_a_first_load_writes_its_rows_once_beside_the_table(spark, warehouse, store, monkeypatch):
    (early, known), (now, spine) = batches_at_cut(warehouse)
    written, overwrite = [], MeasuringStore.overwrite
    monkeypatch.setattr(MeasuringStore, "overwrite", lambda self, df, name, by=(): written.append(name) or overwrite(self, df, name, by))
    load = IncrementalLoad(store)
    load.load("first", early, known, LOOKBACK)
    assert sorted(written) == sorted([*FACTS, "order_totals", "new_order_totals"])
    del written[:]
    load.load("second", now, spine, LOOKBACK)
    assert sorted(written) == sorted([*FACTS, "order_totals", *(f"new_{f}" for f in (*FACTS, "order_totals"))])
    ledger = {(r.batch, r.table_name): r for r in load.ledger().where("state = 'done'").collect()}
    for f in FACTS:
        table = load.table(f)
        seen = table.selectExpr("count(*)", "count(DISTINCT fact_key)", "max(fact_key)", "max(purchase_date_key)").first()
        first, second = ledger["first", f], ledger["second", f]
        assert tuple(seen) == (first.rows + second.rows, first.rows + second.rows, second.top_key, second.mark)
        columns = sorted(set(table.columns) - {"fact_key"})
        whole = digest_of(table, columns).first()  # sums of both batches, which have the same columns
        assert (whole.digest_a, whole.digest_b) == (first.digest_a + second.digest_a, first.digest_b + second.digest_b)
