"""Column semantics that differ between engines or are easy to get wrong."""

import datetime as dt

from pyspark.sql import functions as F

from grainhouse.functions import labels
from grainhouse.functions import scalar as s

NTZ = "a timestamp_ntz, b timestamp_ntz"


def one(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_days_count_midnights_not_hours(frame):
    df = frame([(dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2, 0, 0, 1))], NTZ)
    assert one(df, s.days_between("a", "b")) == [(1,)]
    assert one(df, s.days_between("b", "a")) == [(-1,)]


def test_minutes_count_boundaries_not_elapsed_time(frame):
    df = frame(
        [
            (dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 0)),
            (dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 0, 59)),
            (dt.datetime(2023, 12, 31, 23, 59, 0), dt.datetime(2024, 1, 1, 0, 0, 0)),
            (dt.datetime(2024, 1, 1, 0, 0, 0), None),
        ],
        NTZ,
    )
    assert one(df, s.minutes_between("a", "b")) == [(1,), (0,), (1,), (None,)]


def test_minutes_do_not_depend_on_the_session_zone(spark, frame):
    df = frame([(dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 3, 30))], NTZ)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:00 to 03:00 does not exist there
    try:
        assert one(df, s.minutes_between("a", "b")) == [(120,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_zip_is_padded_and_null_stays_null(frame):
    df = frame([(7,), (12345,), (None,), (1234567,)], "z int")
    assert one(df, s.zip5("z")) == [("00007",), ("12345",), (None,), ("34567",)]


def test_week_starts_on_monday(frame):
    df = frame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)], "d date")
    assert one(df, s.week_start("d")) == [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 8),)]


def test_calendar_columns(frame):
    df = frame([(dt.date(2017, 11, 24),), (dt.date(2017, 11, 26),)], "d date")
    columns = s.calendar_columns("d")
    got = one(df, *[columns[c] for c in ("date_key", "quarter", "month_name", "day_of_week", "day_name", "is_weekend")])
    assert got == [(20171124, 4, "November", 6, "Friday", False), (20171126, 4, "November", 1, "Sunday", True)]


def test_means_true_and_truncated(frame):
    df = frame([(1,), (2,), (2,), (None,)], "x int")
    negative = frame([(-1,), (-2,), (-2,)], "x int")
    empty = frame([], "x int")
    pair = [s.mean("x"), s.truncated_mean("x")]
    assert tuple(df.agg(*pair).first()) == (1.666667, 1)
    assert tuple(negative.agg(*pair).first()) == (-1.666667, -1)
    assert tuple(empty.agg(*pair).first()) == (None, None)


def test_division_by_zero_is_null(frame):
    assert one(frame([(1.0, 0.0), (1.0, None), (1.0, 2.0)], "a double, b double"), s.safe_div("a", "b")) == [
        (None,),
        (None,),
        (0.5,),
    ]


def test_buckets_are_inclusive_and_null_does_not_fall_through(frame):
    df = frame([(None,), (-3,), (3,), (4,), (14,), (15,)], "d int")
    got = one(df, labels.delivery_bucket("d"), labels.delivery_bucket_sort("d"))
    assert got == [("N/A", 5), ("0-3", 1), ("0-3", 1), ("4-7", 2), ("8-14", 3), ("15+", 4)]


def test_duration_bands_have_two_open_ends(frame):
    df = frame([(None,), (4,), (5,), (9,), (10,), (29,), (30,)], "d int")
    got = one(df, labels.duration_band("d"), labels.duration_band_sort("d"))
    assert got == [(None, None), (None, None), ("5-9d", 1), ("5-9d", 1), ("10-14d", 2), ("25-29d", 5), (None, None)]


def test_missing_delay_keeps_the_promise(frame):
    assert one(frame([(None,), (0,), (1,)], "d int"), labels.promise_status("d")) == [("Kept",), ("Kept",), ("Broken",)]


def test_category_groups(frame):
    df = frame([("home_confort",), ("TOYS",), ("Unknown",), ("no such",), (None,)], "c string")
    assert [r[0] for r in one(df, labels.category_group("c"))] == [
        "Home & Furniture",
        "Sports, Leisure & Pets",
        "Unclassified",
        "Unclassified",
        "Unclassified",
    ]
    assert len(labels.CATEGORIES) == len(set(labels.CATEGORIES)) == 73
    assert len(labels.CATEGORY_GROUPS) == 9


def test_missing_status_is_not_net(frame):
    df = frame([("delivered",), ("canceled",), (None,)], "order_status string")
    assert df.where(labels.is_net("order_status")).count() == 1


def test_equal_label_and_concat(frame):
    df = frame([("A", "A", 1), ("A", None, 2)], "a string, b string, k int")
    got = one(df, s.label_equal("a", "b", "same", "cross"), labels.customer_label("k"), labels.seller_label("b", "k"))
    assert got == [("same", "Customer #1", "A 1"), ("cross", "Customer #2", "2")]


def test_text_cleaning_trims_blanks_only(frame):
    df = frame([("  são paulo ",), ("\tx",)], "c string")
    assert one(df, s.clean_upper("c"), s.clean_lower("c")) == [("SÃO PAULO", "são paulo"), ("\tX", "\tx")]
    assert df.agg(F.count("c")).first()[0] == 2
