"""What travels to the layout of a fact and of the pair mirror, and that the rows are those of the long way."""

from datetime import datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from grainhouse.operators import joins
from grainhouse.plans import layers
from grainhouse.sources.schemas import SCHEMAS
from grainhouse.sources.store import conform


def rebalanced(df):
    """Names of the columns that a layout shuffles."""
    nodes = [df._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("Rebalance"):
            return {node.output().apply(i).name() for i in range(node.output().size())}
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    raise AssertionError("no layout")


def joined_keys(df):
    """Conditions of the joins, the last one first."""
    nodes, found = [df._jdf.queryExecution().optimizedPlan()], []
    while nodes:
        node = nodes.pop(0)
        if node.nodeName() == "Join":
            found.append(node.condition().toString())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.fixture
def spine(frame):
    rows = []
    for n in range(1, 5):
        bought, arrived = datetime(2018, n, 3, 10), datetime(2018, n, 9, 8) if n != 3 else None
        rows.append((f"o{n}", n, n * 10, 20180003 + n * 100, "delivered", bought, datetime(2018, n, 5), arrived, datetime(2018, n, 7), "town", "SP" if n % 2 else None, float(n), -float(n)))
    return frame(
        rows,
        "order_id string, order_key long, customer_key long, purchase_date_key int, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz, "
        "city string, state string, latitude double, longitude double",
    )


@pytest.fixture
def sellers(frame):
    rows = [(1, "a", "rio", "RJ", 1.0, 2.0), (2, "b", "santos", "SP", 2.0, 4.0), (3, "c", None, None, None, None)]
    return frame(rows, "seller_key long, seller_id string, city string, state string, latitude double, longitude double")


def test_items_are_looked_up_narrow_and_dated_last(frame, spine, sellers):
    products = frame([(5, "p"), (6, "q")], "product_key long, product_id string")
    items = frame(
        [("o1", 1, "p", "a", 3.0, 1.0), ("o1", 2, "x", None, 4.0, 1.0), ("o3", 1, None, "b", 5.0, 1.0), ("none", 1, "p", "a", 5.0, 1.0)],
        "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double",
    )
    fact = layers.fact_order_items(items, spine, sellers, products)
    travels = rebalanced(fact)
    assert not travels & {"delivered_date_key", "delivery_delay_days", "actual_delivery_days", "delivered_customer_date", "product_id", "seller_id"}
    assert "order_id" in joined_keys(fact)[0], "the order is joined last"
    got = fact.select("order_id", "order_item_id", "seller_key", "product_key", "delivered_date_key", "delivery_delay_days", "actual_delivery_days")
    assert rows_of(got) == sorted(
        [("o1", 1, 1, 5, 20180109, 2, 6), ("o1", 2, None, None, 20180109, 2, 6), ("o3", 1, 2, None, None, None, None)], key=repr
    )


def test_few_rows_are_broadcast_and_many_are_not(sellers, monkeypatch):
    def hinted():
        return "broadcast" in joins.broadcast_few(sellers, "seller_id", "seller_key")._jdf.queryExecution().analyzed().toString()

    assert hinted()
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 2)
    assert not hinted()


def test_pairs_travel_without_what_their_seller_says(frame, spine, sellers):
    items = frame(
        [(1, 1, 3.0, 1.0), (1, 1, 4.0, 1.0), (1, 2, 5.0, 2.0), (2, 3, 6.0, 1.0), (3, None, 7.0, 1.0), (4, 1, 8.0, 1.0)],
        "order_key long, seller_key long, price double, freight_value double",
    )
    pairs = layers.order_sellers(spine, items, sellers)
    placed = layers.placed_order_sellers(pairs, sellers)
    assert not rebalanced(placed) & {"seller_id", "seller_city", "seller_state", "route_type"}
    long_way = layers.laid_out(conform(pairs, SCHEMAS["order_sellers"]))
    assert placed.columns == long_way.columns
    assert rows_of(placed) == rows_of(long_way) and placed.where(F.col("route_type") == "Same State").count() == 1


def test_a_layout_shuffles_one_partition_column(frame):
    rows = frame([(1, 20180105, 1), (2, 20171231, 2), (3, None, 3)], "order_key long, purchase_date_key int, purchase_year int")
    by_year, by_month = layers.laid_out(rows), layers.laid_out(rows, layers.MONTH)
    assert rebalanced(by_year.drop("order_key")) == {"purchase_date_key", layers.MONTH}
    assert layers.YEAR not in rebalanced(by_month)
    assert rows_of(by_year.select("order_key", layers.YEAR)) == [(1, 2018), (2, 2017), (3, None)]
    assert by_month.columns == ["order_key", "purchase_date_key", layers.MONTH]
    assert rows_of(by_month) == [(1, 20180105, 201801), (2, 20171231, 201712), (3, None, None)]
