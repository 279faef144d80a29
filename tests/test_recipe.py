"""The derived raw tables have the values FIXTURES.md states (SQL side, sf0.01)."""

import os

import duckdb
import pytest

from grainhouse.registry.oracle import with_layers

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(FOLDER):
        pytest.skip("no sf0.01 tables")
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


@pytest.mark.parametrize(
    "sql, expected",
    [
        ("SELECT COUNT(*), COUNT(DISTINCT customer_unique_id) FROM src_customers", [(15000, 9884)]),
        (
            "SELECT order_status, COUNT(*), COUNT(order_delivered_customer_date) FROM stg_orders GROUP BY 1 ORDER BY 1",
            [("canceled", 375, 13), ("delivered", 13481, 13453), ("shipped", 844, 0), ("unavailable", 300, 0)],
        ),
        ("SELECT COUNT(*), CAST(SUM(price) AS VARCHAR), CAST(SUM(freight_value) AS VARCHAR) FROM src_order_items", [(60000, "3183256271.63", "1163963.00")]),
        ("SELECT COUNT(*), CAST(SUM(payment_value) AS VARCHAR) FROM src_payments", [(29967, "7622791.83")]),
        (
            "SELECT payment_type, COUNT(*), COUNT(*) FILTER (WHERE payment_installments = 0) FROM stg_payments GROUP BY 1 ORDER BY 1",
            [("boleto", 7491, 682), ("credit_card", 19970, 1815), ("not_defined", 6, 1), ("voucher", 2500, 227)],
        ),
        ("SELECT COUNT(*), COUNT(DISTINCT review_id) FROM src_reviews", [(15593, 15563)]),
        ("SELECT review_score, COUNT(*) FROM stg_reviews GROUP BY 1 ORDER BY 1", [(1, 1980), (2, 1980), (3, 2475), (4, 1980), (5, 7178)]),
        ("SELECT COUNT(*) FROM src_products WHERE product_category_name IS NULL", [(38,)]),
        ("SELECT COUNT(*) FROM src_translation", [(23,)]),
        ("SELECT COUNT(*), COUNT(DISTINCT geolocation_zip_code_prefix) FROM src_geolocation", [(1500, 190)]),
    ],
)
def test_stated_values(duck, sql, expected):
    assert duck.execute(with_layers(sql)).fetchall() == expected
