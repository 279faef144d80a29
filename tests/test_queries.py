"""Every registered query against its DuckDB twin, and the plans that matter."""

import os

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from grainhouse.plans import measures, reports
from grainhouse.registry import entries
from tools.compare import canonical

@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SMALL}/{file}'")
    return con


@pytest.mark.parametrize("name", list(entries()))
def test_matches_sql(spark, duck, name):
    frame = entry.queries()[name](spark, SMALL)
    mine = canonical([c.lower() for c in frame.columns], [tuple(r) for r in frame.collect()])
    cursor = duck.execute(entry.oracle_sql()[name])
    theirs = canonical([c[0].lower() for c in cursor.description], cursor.fetchall())
    assert mine == theirs


def test_every_query_has_sql():
    # the text operators are a part of their own, tested beside their code
    assert set(entries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_push_date_bounds_and_prune_partitions(spark, warehouse):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(reports.monthly_items(warehouse, before="1997-01-01"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    partitions = [part.split("]")[0] for part in text.split("PartitionFilters: [")[1:]]
    assert any("purchase_year" in p and "<= 1996" in p for p in partitions)
    assert "LessThanOrEqual(purchase_date_key,19961231)" in text


def test_month_reports_read_their_months_only(spark, warehouse):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(reports.month_daily(warehouse, 5, [1995, 1998]))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    partitions = [part.split("]")[0] for part in text.split("PartitionFilters: [")[1:]]
    assert any("purchase_year" in p and "IN (1995,1998)" in p for p in partitions)
    assert "LessThanOrEqual(purchase_date_key,19950531)" in text and "GreaterThanOrEqual(purchase_date_key,19980501)" in text


def test_order_level_reports_read_one_narrow_table(warehouse):
    text = plan(measures.late_orders(warehouse))
    assert text.count("FileScan") == 1 and "items_revenue" not in text


def test_first_two_orders_are_limited_before_the_shuffle(warehouse):
    assert plan(reports.second_order_gaps(warehouse)).count("WindowGroupLimit") == 2


def test_no_python_and_no_cartesian_product_in_plans(spark):
    for name, run in entry.queries().items():
        if name.startswith(("r_", "m_", "dq_")):
            text = plan(run(spark, SMALL))
            assert "Python" not in text and "CartesianProduct" not in text, name
