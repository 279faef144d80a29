"""Files, tables, the mirror, contracts and the rebuild."""

import datetime as dt
import decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from grainhouse.plans.layers import calendar_between, stg_products
from grainhouse.plans.measures import net_share
from grainhouse.plans.quality import column_contract, column_list, gates, schema_issues
from grainhouse.plans.rebuild import GateError, migrate_delivery_timing, open_current, rebuild
from grainhouse.plans.warehouse import RawTables, Warehouse
from grainhouse.session import input_bytes, shared_folder, size_shuffles, tune
from grainhouse.sources.files import read_csv, refresh_mirror
from grainhouse.sources.schemas import SCHEMAS, SRC_SCHEMAS
from grainhouse.sources.store import Store, add_columns, backfill, conform, drop_columns

D = decimal.Decimal
T0 = dt.datetime(2017, 5, 10, 10, 0)


def days(n, minutes=0):
    return T0 + dt.timedelta(days=n, minutes=minutes)


# order 1: late, two items, two payments, two reviews; 2: on time; 3: canceled,
# paid, no items; 4: delivered status without a date
TABLES = {
    "customers": [("c1", "p1", 1001, " são paulo ", "sp"), ("c2", "p1", 1001, "Rio", "rj"), ("c3", "p2", None, None, None), ("c4", "p3", 99999, "x", "sp")],
    "geolocation": [(1001, D("-23.5"), D("-46.6"), None, None), (1001, D("-23.7"), D("-46.8"), None, None)],
    "orders": [
        ("o1", "c1", " DELIVERED", days(0), days(0, 30), days(2), days(12), days(10)),
        ("o2", "c2", "delivered", days(20), days(20, 10), days(21), days(24), days(30)),
        ("o3", "c3", "canceled", days(21), None, None, None, days(31)),
        ("o4", "c4", "delivered", days(22), None, days(23), None, days(32)),
    ],
    "order_items": [
        ("o1", 1, "a", "s1", days(3), D("10.00"), D("2.00")),
        ("o1", 2, "b", "s1", days(3), D("0.00"), D("1.00")),
        ("o2", 1, "a", "s2", days(23), D("30.00"), D("3.00")),
        ("o4", 1, "c", "s2", days(25), D("5.00"), D("1.00")),
    ],
    "order_payments": [
        ("o1", 1, "credit_card", 3, D("8.00")),
        ("o1", 2, " VOUCHER ", 1, D("5.00")),
        ("o2", 1, "boleto", 1, D("33.00")),
        ("o3", 1, "not_defined", 0, D("7.00")),
    ],
    "order_reviews": [
        ("r1", "o1", 2, "t", 'said "no",\ntwice', days(13), days(14)),
        ("r2", "o1", 1, None, None, days(13), days(14)),
        ("r3", "o2", 5, None, "ação", days(25), days(26)),
        ("r3", "o4", 3, None, None, days(25), days(26)),
    ],
    "products": [("a", "brinquedos", 1, 1, 1, 400, 1, 1, 1), ("b", None, 1, 1, 1, 700, 1, 1, 1), ("c", "raro", 1, 1, 1, None, 1, 1, 1)],
    "sellers": [("s1", 1001, "Sao Paulo", "SP"), ("s2", 5, "Rio", "RJ")],
    "category_translation": [("brinquedos", "toys")],
}


@pytest.fixture
def raw(spark):
    return RawTables({n: spark.createDataFrame(rows, SRC_SCHEMAS[n]) for n, rows in TABLES.items()})


CSV = {
    "order_reviews": 'review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n'
    'r1,o1,5,"um ""bom"" dia","linha 1, com vírgula\nlinha 2",2017-05-01 00:00:00,2017-05-02 10:11:12\n'
    "r2,o2,1,,,2017-05-03 00:00:00,2017-05-04 00:00:00\n"
    'r3,o3,3,"á ã ç","""",2017-05-03 00:00:00,2017-05-04 00:00:00\n',
}


def test_csv_keeps_quotes_commas_line_ends_and_accents(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(CSV["order_reviews"], encoding="utf-8")
    df = read_csv(spark, str(path), SCHEMAS["order_reviews"])
    assert df.schema == SCHEMAS["order_reviews"]
    got = {r.review_id: (r.review_comment_title, r.review_comment_message) for r in df.collect()}
    assert got == {
        "r1": ('um "bom" dia', "linha 1, com vírgula\nlinha 2"),
        "r2": (None, None),
        "r3": ("á ã ç", '"'),
    }


def test_csv_stops_at_a_malformed_row(spark, tmp_path):
    path = tmp_path / "translation.csv"
    path.write_text("zip,lat,lng,city,state\nnot a number,1,1,a,b\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|not a number"):
        read_csv(spark, str(path), SCHEMAS["geolocation"]).collect()


def test_mirror_refresh_replaces_stale_rows(raw, store, tmp_path):
    def write(tables):
        folder = tmp_path / "csv"
        folder.mkdir(exist_ok=True)
        for name, schema in SRC_SCHEMAS.items():
            lines = [",".join(schema.names)]
            for row in tables[name]:
                lines.append(",".join("" if v is None else '"' + str(v).replace('"', '""') + '"' for v in row))
            (folder / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(folder)

    refresh_mirror(store, write({n: rows[:1] for n, rows in TABLES.items()}))
    for _ in range(2):
        mirror = refresh_mirror(store, write(TABLES))
    for name in SRC_SCHEMAS:
        assert rows_of(mirror[name]) == rows_of(getattr(raw, name)), name


def test_warehouse_of_the_fixture(raw, store):
    wh = Warehouse(raw, store)
    items = {(r.order_id, r.order_item_id): r for r in wh.fact_order_items.collect()}
    assert items["o1", 1].delivery_delay_days == 2 and items["o1", 1].actual_delivery_days == 12
    assert items["o4", 1].delivered_date_key is None and items["o4", 1].actual_delivery_days is None
    orders = {r.order_id: r for r in wh.orders.collect()}
    assert (orders["o1"].items, orders["o1"].payments, orders["o1"].reviews) == (2, 2, 2)
    assert orders["o1"].promise_status == "Broken" and orders["o4"].promise_status == "Kept"
    assert orders["o3"].items == 0 and orders["o3"].delivery_bucket == "N/A"
    assert orders["o1"].customer_key == orders["o2"].customer_key
    dim = {r.order_id: r for r in wh.dim_order.collect()}
    assert dim["o1"].city == "SÃO PAULO" and dim["o1"].latitude == D("-23.60000000")
    assert dim["o3"].zip_code is None and dim["o4"].latitude is None
    assert {r.payment_type for r in wh.fact_payments.collect()} == {"credit_card", "voucher", "boleto", "not_defined"}
    assert {r.product_id: r.category_name_english for r in wh.dim_product.collect()} == {"a": "toys", "b": "Unknown", "c": "raro"}


def test_share_counts_items_without_a_product(spark, raw, store):
    raw.products = spark.createDataFrame(TABLES["products"][1:], SRC_SCHEMAS["products"])  # 40.00 of 45.00 have none
    shares = net_share(Warehouse(raw, store), by="category_name_english")
    assert rows_of(shares.select("category_name_english", F.col("pct_net").cast("double"))) == [("Unknown", 0.0), ("raro", 11.111111)]


def test_gates_pass_and_name_what_fails(spark, raw, store):
    assert all(r.failures == 0 for r in gates(Warehouse(raw, Store(spark, store.path("good")))).collect())
    lost = TABLES["order_payments"] + [("nowhere", 1, "boleto", 1, D("1.00"))]
    twice = TABLES["order_reviews"] + [("r1", "o1", 4, None, None, days(13), days(14))]
    stray = TABLES["order_items"] + [("o2", 2, "unknown", "s9", days(3), D("1.00"), D("1.00"))]
    raw.order_payments = spark.createDataFrame(lost, SRC_SCHEMAS["order_payments"])
    raw.order_reviews = spark.createDataFrame(twice, SRC_SCHEMAS["order_reviews"])
    raw.order_items = spark.createDataFrame(stray, SRC_SCHEMAS["order_items"])
    failures = {r.gate: r.failures for r in gates(Warehouse(raw, Store(spark, store.path("bad")))).collect()}
    assert failures["orphans"] == 3 and failures["missing keys"] == 2
    assert failures["row counts"] == 1 and failures["totals preserved"] == 1
    # a repeated pair is found in the raw table and in the fact
    assert failures["duplicate grain"] == 2 and failures["conflicting scores"] == 1
    assert failures["negative days"] == 0 and failures["band sort"] == 0


def test_rebuild_switches_only_after_its_gates(spark, raw, store):
    rebuild(raw, store, "one")
    first = open_current(store)
    assert first["fact_order_items"].count() == 4 and "purchase_month" in first["fact_order_items"].columns
    raw.order_payments = spark.createDataFrame(
        TABLES["order_payments"] + [("nowhere", 1, "boleto", 1, D("1.00"))], SRC_SCHEMAS["order_payments"]
    )
    with pytest.raises(GateError, match="orphans"):
        rebuild(raw, store, "two")
    assert open_current(store)["fact_payments"].count() == 4
    assert [r["run"] for r in store.read("current").collect()] == ["one"]
    with pytest.raises(FileExistsError):  # a live run is never built over
        rebuild(raw, store, "one")
    assert open_current(store)["fact_payments"].count() == 4


def test_contract_reports_types_columns_and_lengths(spark, raw):
    bad = raw.sellers.withColumn("seller_state", raw.sellers.seller_city).withColumn(
        "seller_zip_code_prefix", raw.sellers.seller_zip_code_prefix.cast("string")
    )
    bad = bad.drop("seller_id").withColumn("extra", bad.seller_city)
    assert rows_of(column_contract({"sellers": bad}, spark)) == sorted(
        [
            ("sellers", "extra", "unexpected"),
            ("sellers", "seller_id", "missing"),
            ("sellers", "seller_state", "length 9, declared 2"),
            ("sellers", "seller_zip_code_prefix", "type string, declared int"),
        ],
        key=repr,
    )
    assert schema_issues(raw.orders, "orders") == []
    listed = column_list({"sellers": raw.sellers}, spark).where("column_name = 'seller_zip_code_prefix'")
    assert rows_of(listed) == [("sellers", "seller_zip_code_prefix", 2, "int", True)]


def test_table_create_append_by_name_and_schema_change(frame, store):
    schema = SCHEMAS["stg_reviews"]
    assert store.ensure("t", schema).count() == 0
    store.append(frame([("r1", "o1", 5)], "review_id string, order_id string, review_score int"), "t", schema)
    table = store.append(frame([(4, "o2", "r2")], "review_score short, order_id string, review_id string"), "t", schema)
    assert rows_of(table) == [("r1", "o1", 5), ("r2", "o2", 4)]
    assert store.ensure("t", schema).count() == 2

    wide = add_columns(table, {"load_day": ("date", "2018-01-01"), "note": ("string", None)})
    assert {(str(r.load_day), r.note) for r in wide.collect()} == {("2018-01-01", None)}
    filled = backfill(wide, "note", wide.order_id, wide.review_score > 4)
    assert rows_of(filled.select("review_id", "note")) == [("r1", "o1"), ("r2", None)]
    assert drop_columns(filled, ["load_day", "note"]).schema == table.schema


def test_migration_checks_its_result(raw, store):
    wh = Warehouse(raw, store)
    old_order = add_columns(wh.dim_order, {"delivery_delay_days": ("int", 1), "actual_delivery_days": ("int", 1)})
    dim_order, items = migrate_delivery_timing(old_order, wh.fact_order_items.drop("delivered_date_key"))
    assert dim_order.columns == wh.dim_order.columns
    columns = ("order_id", "order_item_id", "delivered_date_key")
    assert rows_of(items.select(*columns)) == rows_of(wh.fact_order_items.select(*columns))
    with pytest.raises(ValueError, match="city"):
        migrate_delivery_timing(old_order.drop("city"), items)


def test_translation_fallback_keeps_the_grain(raw):
    staged = stg_products(raw.products, raw.category_translation)
    assert {r.product_id: r.product_category_name_eng for r in staged.collect()} == {"a": "toys", "b": "Unknown", "c": "raro"}


def test_calendar_range(spark):
    df = calendar_between(spark, "2016-01-01", "2020-12-31")
    assert df.count() == 1827
    assert df.schema == SCHEMAS["dim_date"] or df.dtypes == [(f.name, f.dataType.simpleString()) for f in SCHEMAS["dim_date"]]
    assert df.where("is_weekend").count() == 522


def test_conform_is_by_name(frame):
    df = frame([(3, "o", "r")], "review_score short, order_id string, review_id string")
    assert conform(df, SCHEMAS["stg_reviews"]).dtypes == [("review_id", "string"), ("order_id", "string"), ("review_score", "int")]


def test_shuffles_grow_with_the_input(spark, frame, store):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    written = store.overwrite(spark.range(1000).toDF("n"), "n")
    assert 1000 < input_bytes(written) < 100_000 and input_bytes(frame([(1,)], "n int")) < 1 << 60
    try:
        usual = size_shuffles(spark, input_bytes(written))
        assert usual == int(spark.conf.get("spark.sql.shuffle.partitions")) and spark.conf.get(key, None) is None
        assert size_shuffles(spark, 1 << 40) == 4096
        assert size_shuffles(spark, 100 << 40) == 30_000
    finally:
        spark.conf.unset(key)


def test_shuffles_of_small_inputs_are_fine_enough_to_sort_in_memory(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    advisory, codec = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.parquet.compression.codec"
    before = spark.conf.get(advisory, None)
    try:
        assert size_shuffles(spark, 1 << 30) == 64
        spark.conf.unset(advisory)
        assert tune(spark).conf.get(advisory) == "32m" and spark.conf.get(codec) == "zstd"
        spark.conf.set(advisory, "7m")
        assert tune(spark).conf.get(advisory) == "7m"  # the caller's own size stays
    finally:
        spark.conf.unset(key)
        spark.conf.unset(advisory) if before is None else spark.conf.set(advisory, before)


def test_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"
            getConf = staticmethod(lambda: Session.conf)
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named.rstrip("/")


def test_ensure_keeps_a_table_without_marker(spark, store, frame):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        rows = frame([(1, "a")], "k int, v string")
        store.overwrite(rows, "plain")
        assert store.ensure("plain", rows.schema).count() == 1
        assert store.ensure("fresh", rows.schema).count() == 0
        store.append(rows, "fresh", rows.schema)
        assert store.ensure("fresh", rows.schema).count() == 1
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
