"""Gates of keys that follow from what a load has measured."""

import pytest
from conftest import rows_of

from grainhouse.plans import quality as q
from grainhouse.plans import rebuild as r
from grainhouse.plans.measured import Measured
from grainhouse.sources.schemas import SCHEMAS
from grainhouse.sources.store import Store

RAW = {"fact_order_items": "order_items", "fact_payments": "order_payments", "fact_reviews": "order_reviews"}


class Tables(dict):
    def __getattr__(self, name):
        return self[name]


@pytest.fixture
def loaded(spark, store, frame):
    """A warehouse of a few keys and its measures; items, payments and reviews as (first key, second key) of facts and of sources."""

    def build(items, payments, reviews, raw=None, orders=(("o1", "c1"), ("o2", "c2")), missing=0):
        def table(name, rows, *columns):
            given = [dict(zip(columns, row, strict=True)) for row in rows]
            return frame([tuple(v.get(f.name) for f in SCHEMAS[name]) for v in given], SCHEMAS[name])

        facts = {"fact_order_items": items, "fact_payments": payments, "fact_reviews": reviews}
        seconds = {"fact_order_items": ("order_id", "order_item_id"), "fact_payments": ("order_id", "payment_sequential"), "fact_reviews": ("review_id", "order_id")}
        sources = facts | (raw or {})
        wh = Tables(spark=spark, store=store)
        for fact, rows in facts.items():
            wh[fact] = table(fact, [(n // 2 if n < 4 else n, *row) for n, row in enumerate(rows)], "fact_key", *seconds[fact])
            wh[RAW[fact]] = table(RAW[fact], sources[fact], *seconds[fact])
        if "product_id" in wh["order_items"].columns:
            wh["order_items"] = wh["order_items"].fillna({"product_id": "p1", "seller_id": "s1"})
        wh |= {
            "customers": table("customers", [("c1",), ("c2",)], "customer_id"),
            "orders": table("orders", orders, "order_id", "customer_id"),
            "products": table("products", [("p1",)] if not missing else [], "product_id"),
            "sellers": table("sellers", [("s1",)], "seller_id"),
            "dim_customer": table("dim_customer", [(1, "u"), (1, "u"), (2, None), (None, None)], "customer_key", "customer_unique_id"),
            "dim_date": table("dim_date", [(20000101,), (20000102,)], "date_key"),
            "dim_order": table("dim_order", [(n, o) for n, (o, _) in enumerate(orders, 1)], "order_key", "order_id"),
            "dim_product": table("dim_product", [(1, "p1")], "product_key", "product_id"),
            "dim_seller": table("dim_seller", [], "seller_key", "seller_id"),
        }
        seen = {f: {"rows": len(rows), "missing seller": 0, "missing product": missing} for f, rows in facts.items()}
        return wh, Measured(spark, seen, {RAW[f]: len(rows) for f, rows in sources.items()})

    return build


def failures(df):
    return {row.gate: row.failures for row in df.collect()}


MANY = [("o1", n) for n in range(1, 200)]


@pytest.mark.parametrize(
    ("case", "lost"),
    [
        ({"items": [("o1", 1), ("o1", 65), ("o2", 1)], "payments": [("o1", 1), ("o2", 1)], "reviews": [("r1", "o1"), ("r1", "o2")]}, 0),
        ({"items": [*MANY, ("o1", 7), ("o1", 7), ("o2", 3), ("o2", 3)], "payments": [("o1", None), ("o1", None), ("o2", 1)], "reviews": [("r1", "o1")] * 3}, 0),
        ({"items": MANY, "payments": [("o1", -1), ("o1", 63)], "reviews": [("r", f"o{n % 2 + 1}") for n in range(2)], "orders": [("o1", "c9"), ("o2", None), ("o1", "c9")]}, 2),
        ({"items": [("o1", 1)], "payments": [("o1", 1)], "reviews": [("r1", "o1")], "raw": {"fact_reviews": [("r1", "o1"), ("r2", "o9"), ("r2", "o9")]}}, 0),
        ({"items": [("o1", 1), ("o2", 1)], "payments": [], "reviews": [], "missing": 2}, 0),
    ],
    ids=["unlike pairs with the same bits", "repeated pairs", "lost customers", "orphans", "missing keys"],
)
def test_proven_keys_are_those_of_the_audit(loaded, case, lost):
    wh, measured = loaded(**case)
    proven = q.ProvenKeys(wh, measured, lost)
    assert failures(proven.gates()) == failures(q.key_gates(wh))
    assert not proven.single_reviews() or q.repeated(wh["order_reviews"], ["review_id", "order_id"]).isEmpty()


def test_raw_grains_find_orders_without_their_customer(loaded):
    wh, _ = loaded([], [], [], orders=[("o1", "c9"), ("o2", None), ("o3", "c1"), ("o4", "c9")])
    wh["category_translation"] = wh.products.selectExpr("product_id AS product_category_name")
    assert {row.table_name: (row.repeated, row.lost) for row in q.raw_grains(wh).collect()} == {
        "customers": (0, 2), "orders": (0, 0), "products": (0, 0), "sellers": (0, 0), "category_translation": (0, 0)
    }


def test_a_clean_rebuild_audits_raw_keys_alone(warehouse, spark, store, monkeypatch):
    audit, calls = q.key_audit, []
    monkeypatch.setattr(q, "key_audit", lambda uses: calls.append([u[0] for u in uses]) or audit(uses))
    target = Store(spark, store.path("release"))
    results = r.rebuild(warehouse.raw, target, "one")
    assert all(row.failures == 0 for row in results.collect()) and len(results.collect()) == 10
    assert len(calls) == 1 and all(kind.startswith("grain ") for kind in calls[0])
    assert rows_of(results.select("gate")) == rows_of(q.gates(warehouse).select("gate"))
    assert not target.exists("runs/one/crowded_keys")
