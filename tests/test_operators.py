"""Operators against brute force, on data with a group that holds most rows."""

import random
from collections import Counter, defaultdict

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from grainhouse.operators import aggregates as a
from grainhouse.operators import joins as j
from grainhouse.operators import keys
from grainhouse.operators.keys import number_rows, number_within, percent_rank_weights, with_surrogate_key


@pytest.fixture
def skewed():
    """One key holds two thirds of 3,000 rows."""
    rng = random.Random(7)
    return [("hot" if i % 3 else f"k{rng.randrange(400)}", i, rng.randrange(50)) for i in range(3000)]


@pytest.fixture
def many_partitions(spark):
    """Keep small shuffles in many partitions, as they are at scale."""
    keys = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "false")
    spark.conf.set(keys[1], "7")
    yield
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def test_surrogate_keys_are_dense_and_ordered(frame, store, many_partitions):
    ids = [f"{i * 7919 % 5000:05d}" for i in range(1000)]
    keyed = with_surrogate_key(frame([(i,) for i in ids], "id string"), "id", "key", store, "t")
    assert rows_of(keyed.select("key", "id")) == sorted(((n, i) for n, i in enumerate(sorted(ids), 1)), key=repr)
    assert not store.exists("t_placed")


def test_numbering_spreads_a_hot_group(frame, store, skewed, many_partitions):
    df = frame(skewed, "g string, i int, v int")
    placed = number_rows(df, ["g", "i"], "n", store, "placed")
    tasks = store.read("placed").where("g = 'hot'").select(F.shiftright("_slot", 33).alias("p")).distinct().count()
    assert tasks > 2
    assert rows_of(placed.select("n")) == rows_of(frame([(n,) for n in range(1, 3001)], "n long"))


def test_numbering_within_groups(frame, store, skewed, many_partitions):
    got = number_within(frame(skewed, "g string, i int, v int"), "g", ["v", "i"], "n", store, "numbered")
    groups = defaultdict(list)
    for g, i, v in skewed:
        groups[g].append((v, i))
    want = [(g, i, n) for g, members in groups.items() for n, (_, i) in enumerate(sorted(members), 1)]
    assert rows_of(got.select("g", "i", "n")) == sorted(want, key=repr)


def test_numbering_takes_one_shuffle_of_ordinary_groups(frame, store, skewed, monkeypatch, many_partitions):
    written, overwrite = [], store.overwrite
    monkeypatch.setattr(store, "overwrite", lambda df, name, *more: written.append(name) or overwrite(df, name, *more))
    df = frame(skewed, "g string, i int, v int")
    plain = rows_of(number_within(df, "g", ["v", "i"], "n", store, "plain"))
    assert written == ["plain_large", "plain"] and not store.exists("plain_large")
    # a group above the limit is spread over tasks, the others stay on the short way, and the numbers are the same
    monkeypatch.setattr(keys, "LARGE_GROUP", 100)
    assert rows_of(number_within(df, "g", ["v", "i"], "n", store, "mixed")) == plain
    assert written[2:] == ["mixed_large", "mixed_placed", "mixed"]
    assert rows_of(number_within(df.withColumn("g", F.lit(None).cast("string")), "g", ["i"], "n", store, "null").select("i", "n")) == rows_of(
        df.select("i", (F.col("i") + 1).cast("long"))
    )


def test_only_groups_of_crowded_slots_are_counted_one_by_one(frame, monkeypatch):
    df = frame([(g, k) for g, n in (("a", 5), ("b", 3), (None, 4), ("c", 3), ("d", 1)) for k in range(n)], "g string, i int").repartition(3)
    monkeypatch.setattr(keys, "LARGE_GROUP", 3)
    for slots in (1 << 16, 2, 1):  # groups in slots of their own, and several in one
        monkeypatch.setattr(keys, "SLOTS", slots)
        assert rows_of(keys._large_groups(df, "g")) == [("a",), (None,)]
    monkeypatch.setattr(keys, "LARGE_GROUP", 13)
    large = keys._large_groups(df, "g")
    assert rows_of(large) == [], "a crowded slot without a large group"
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.count("Aggregate") == 2


def test_numbering_keeps_the_group_without_a_key(frame, store):
    got = number_within(frame([(None, 2), ("a", 9), (None, 1)], "g string, i int"), "g", ["i"], "n", store, "nulls")
    assert rows_of(got.select("g", "i", "n")) == [("a", 9, 1), (None, 1, 1), (None, 2, 2)]


def test_hot_key_is_split_over_tasks(spark, frame):
    """AQE reads the partition of a hot join key in pieces, and then adds the
    shuffle the grouping after it needs."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        items = spark.range(0, n, 1, 8).selectExpr("if(id % 3 = 0, 7, id) AS order_key", "id AS price", "uuid() AS pad")
        orders = spark.range(0, n, 1, 4).selectExpr("id AS order_key")
        kept = j.with_match(items, orders, "order_key").groupBy("order_key").agg(F.sum("price"), F.max("pad"))
        kept.write.format("noop").mode("overwrite").save()
        kept.collect()
        text = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in text or "isSkewJoin=true" in text or "skewed" in text


def test_percent_rank_with_ties(frame, store, skewed, many_partitions):
    got = percent_rank_weights(frame(skewed, "g string, i int, v int"), "v", store, "ranks")
    counts = Counter(v for _, _, v in skewed)
    ahead, want = 0, []
    for v in sorted(counts, reverse=True):
        want.append((v, counts[v], round(ahead / (len(skewed) - 1), 9)))
        ahead += counts[v]
    assert rows_of(got.select("v", "n", F.round("pct_rank", 9))) == sorted(want, key=repr)


def test_percent_rank_of_one_entity_is_zero(frame, store):
    assert rows_of(percent_rank_weights(frame([(5,)], "v int"), "v", store, "one")) == [(5, 1, 0.0)]


def test_fan_out_total_equals_the_join(frame, skewed):
    left = frame([(g,) for g, _, _ in skewed], "k string")
    right = frame([(g, v) for g, _, v in skewed if v % 5 == 0] + [("orphan", 1), ("hot", None)], "k string, v int")
    joined = left.join(right, "k").agg(F.sum("v").cast("decimal(38,2)"), F.count("v"))
    assert tuple(j.fan_out_total(left, right, "k", "v").first()) == tuple(joined.first())


def test_lookup_keeps_rows_and_leaves_misses_null(frame):
    df = frame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    table = frame([("a", "x")], "key string, value string")
    got = j.lookup(df, table, {"k": "key"}, {"found": "value"})
    assert got.columns == ["k", "n", "found"]
    assert {r.n: r.found for r in got.collect()} == {1: "x", 2: None, 3: None}


def test_resolve_keys_leaves_unknown_ids_without_key(frame):
    items = frame([("o1", "s1", "p1"), ("o2", "s9", "p9")], "order_id string, seller_id string, product_id string")
    sellers = frame([("s1", 1)], "seller_id string, seller_key long")
    products = frame([("p1", 5)], "product_id string, product_key long")
    got = j.resolve_keys(items, [(sellers, "seller_id", "seller_key"), (products, "product_id", "product_key")])
    assert rows_of(got.select("order_id", "seller_key", "product_key")) == [("o1", 1, 5), ("o2", None, None)]


def test_semi_and_anti_do_not_multiply(frame):
    left = frame([(1,), (2,), (3,)], "k int")
    right = frame([(1,), (1,), (3,)], "k int")
    assert rows_of(j.with_match(left, right, "k")) == [(1,), (3,)]
    assert rows_of(j.without_match(left, right, "k")) == [(2,)]


def test_merge_new_uses_the_whole_key(frame):
    target = frame([("a", 1), ("b", 1)], "o string, i int")
    source = frame([("a", 1), ("a", 2), ("c", 1)], "o string, i int")
    assert rows_of(j.merge_new(target, source, ["o", "i"])) == [("a", 2), ("c", 1)]


def test_median_share_rank_and_top(frame):
    assert a.exact_median(frame([(1,), (2,), (4,), (9,), (None,)], "v int"), "v").first()[0] == 3.0
    df = frame([("a", 50), ("b", 30), ("c", 30), ("d", 10)], "k string, v int")
    shares = {r.k: r.pct for r in a.share_of_total(df, "v", "pct").collect()}
    assert shares == {"a": 41.666667, "b": 25.0, "c": 25.0, "d": 8.333333}
    assert {r.k: r.place for r in a.rank_global(df, "v", "place").collect()} == {"a": 1, "b": 2, "c": 2, "d": 4}
    top = a.top_then_sort(df, 3, by=[F.col("v").desc(), F.col("k")], then=[F.col("v"), F.col("k")])
    assert [r.k for r in top.collect()] == ["b", "c", "a"]


def test_repeated_and_collapse(frame):
    df = frame([("x", 1, 5), ("x", 1, 7), ("y", 2, 1)], "g string, o int, v int")
    assert rows_of(a.repeated(df, ["g", "o"])) == [("x", 1, 2)]
    assert rows_of(a.collapse(df, ["g"], "o", F.max("v").alias("v"))) == [("x", 1, 7), ("y", 2, 1)]
