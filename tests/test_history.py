"""Type 2 history and incremental loads, with the cases the driver tables lack."""

import datetime as dt

import pytest
from conftest import rows_of

from grainhouse.operators.history import high_water_mark, increment, latest_change, scd2_apply, start_history

DAY = dt.date


def versions(df):
    return rows_of(df.select("seller_id", "seller_key", "city", "state", "valid_from", "valid_to", "is_current"))


def test_scd2_changed_unchanged_new_and_null(frame, store):
    dim = frame(
        [(1, "a", "RIO", "RJ"), (2, "b", "SP", "SP"), (3, "c", None, "MG"), (4, "d", "BH", "MG")],
        "seller_key long, seller_id string, city string, state string",
    )
    changes = frame([("a", "SANTOS"), ("b", "SP"), ("c", None), ("d", None), ("z", "NATAL")], "seller_id string, city string")
    dim = start_history(dim, "2016-01-01")
    once = scd2_apply(dim, changes, "seller_id", "seller_key", ["city"], "2018-01-01", store, "one")
    start, day = DAY(2016, 1, 1), DAY(2018, 1, 1)
    expected = [
        ("a", 1, "RIO", "RJ", start, day, False),
        ("a", 5, "SANTOS", "RJ", day, None, True),
        ("b", 2, "SP", "SP", start, None, True),
        ("c", 3, None, "MG", start, None, True),
        ("d", 4, "BH", "MG", start, day, False),
        ("d", 6, None, "MG", day, None, True),
        ("z", 7, "NATAL", None, day, None, True),
    ]
    assert versions(once) == sorted(expected, key=repr)

    # a second change expires only the current version and copies from it
    again = scd2_apply(
        once, frame([("a", "RECIFE")], "seller_id string, city string"), "seller_id", "seller_key", ["city"], "2019-01-01", store, "one"
    )
    of_a = [v for v in versions(again) if v[0] == "a"]
    assert [(v[1], v[2], v[6]) for v in sorted(of_a, key=lambda v: v[1])] == [(1, "RIO", False), (5, "SANTOS", False), (8, "RECIFE", True)]
    assert again.where("is_current").groupBy("seller_id").count().where("count > 1").isEmpty()

    # replaying the same change set changes nothing
    replay = scd2_apply(
        again, frame([("a", "RECIFE")], "seller_id string, city string"), "seller_id", "seller_key", ["city"], "2019-02-01", store, "one"
    )
    assert versions(replay) == versions(again)


def test_repeated_keys_are_ordered_or_refused(frame, store):
    dim = start_history(frame([(1, "a", "RIO")], "seller_key long, seller_id string, city string"), "2016-01-01")
    changes = frame([("a", "X", 1), ("a", "Y", 2)], "seller_id string, city string, seq int")

    def apply(**how):
        return scd2_apply(dim, changes, "seller_id", "seller_key", ["city"], "2018-01-01", store, "repeated", **how)

    with pytest.raises(ValueError):
        apply()
    rows = rows_of(apply(sequence="seq").select("seller_key", "city", "is_current"))
    assert rows == [(1, "RIO", False), (2, "Y", True)]


def test_latest_of_several_changes_wins(frame):
    changes = frame([("a", "X", 1), ("a", None, 2), ("b", "Y", 1)], "seller_id string, city string, seq int")
    assert rows_of(latest_change(changes, "seller_id", "seq")) == [("a", None), ("b", "Y")]


def test_increment_takes_new_and_late_rows_once(frame):
    schema = "order_id string, item int, ts timestamp_ntz"

    def at(day):
        return dt.datetime(2018, 1, day)

    target = frame([("old", 1, at(1)), ("known", 1, at(9)), ("mark", 1, at(10))], schema)
    source = frame(
        [
            ("old", 1, at(1)),
            ("too late", 1, at(2)),
            ("known", 1, at(9)),
            ("known", 2, at(9)),
            ("mark", 1, at(10)),
            ("new", 1, at(11)),
        ],
        schema,
    )
    mark = high_water_mark(target, "ts")
    assert mark == at(10)
    keys = ["order_id", "item"]
    plain = increment(target, source, keys, "ts", mark)
    assert rows_of(plain.select(*keys)) == [("new", 1)]
    late = increment(target, source, keys, "ts", mark, dt.timedelta(days=3))
    assert rows_of(late.select(*keys)) == [("known", 2), ("new", 1)]
    loaded = target.unionByName(late)
    assert increment(loaded, source, keys, "ts", high_water_mark(loaded, "ts"), dt.timedelta(days=5)).isEmpty()
    assert increment(target.limit(0), source, keys, "ts", None).count() == 6
