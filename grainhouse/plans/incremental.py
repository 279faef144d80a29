"""Incremental loads of the facts and the order mirror.

Facts and mirror are partitioned by purchase month, and all rows of an order have its purchase day, so a batch concerns the same
months in every table. A load

1. takes the source rows from the ledger's mark on, less a look-back for late rows, that the target does not have,
2. writes the full new content of each month they fall in to a folder of its own (staging),
3. notes in the ledger that the batch is staged,
4. replaces those months in every table by dynamic partition overwrite,
5. notes in the ledger that the batch is done, with its mark, rows and digest.

The ledger is append-only. A load that is cut off before 3 has changed nothing, and the next one starts anew; one that is cut off
after 3 is finished by the next from its staged rows, which are never read from the tables they replace. So a batch that is done
once is never done again, and months without new rows keep their very files.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainhouse.functions.digest import table_digest
from grainhouse.operators.joins import merge_new
from grainhouse.plans import layers
from grainhouse.plans.warehouse import at_once
from grainhouse.sources.schemas import GRAINS, SCHEMAS
from grainhouse.sources.store import MeasuringStore, Store, conform

LEDGER, TOTALS = "ledger", "order_totals"
FACTS = ("fact_order_items", "fact_payments", "fact_reviews")
STAGED, DONE = "staged", "done"
_ENTRY = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("mark", T.IntegerType()),  # latest purchase day that has been loaded
        T.StructField("rows", T.LongType()),  # added by the batch
        T.StructField("digest_a", T.DecimalType(38, 0)),
        T.StructField("digest_b", T.DecimalType(38, 0)),
        T.StructField("top_key", T.LongType()),  # highest fact key in use
        T.StructField("months", T.ArrayType(T.IntegerType())),
        T.StructField("folder", T.StringType()),
    ]
)


class IncrementalLoad:
    """The facts and the order mirror of a folder, loaded batch by batch. One load runs at a time."""

    def __init__(self, store: Store):
        self.store = store
        self.spark = store.spark

    def ledger(self) -> DataFrame:
        """One row for each batch, state and table."""
        return self.store.ensure(LEDGER, _ENTRY)

    def _note(self, entries: list[Row], state: str) -> None:
        rows = [tuple({**e.asDict(), "state": state}[f.name] for f in _ENTRY) for e in entries]
        self.store.append(self.spark.createDataFrame(rows, _ENTRY).coalesce(1), LEDGER, _ENTRY)

    def table(self, name: str) -> DataFrame:
        """A loaded table; empty before the first batch."""
        schema = _schema(name)
        return self.store.read(name, schema) if self.store.exists(name) else self.spark.createDataFrame([], schema)

    def load(self, batch: str, sources: Mapping[str, DataFrame], spine: DataFrame, lookback: datetime.timedelta) -> bool:
        """Load a batch; False where it has been loaded before.

        ``sources`` has the keyed rows of each fact as the source knows them now, ``spine`` the orders. Rows before the mark less
        ``lookback`` are not looked at. A row whose natural key is there already stays as it is: facts do not change. Rows without
        a purchase day belong to no month and are refused before anything is changed.
        """
        self.recover()
        ledger = self.ledger()
        if not ledger.where((F.col("batch") == batch) & (F.col("state") == DONE)).isEmpty():
            return False
        staged = self._stage(batch, sources, spine, lookback)
        self._note(staged, STAGED)
        self._finish(staged)
        return True

    def recover(self) -> None:
        """Finish the batch that was staged and not done, if there is one."""
        ledger = self.ledger()
        left = ledger.where(F.col("state") == STAGED).join(ledger.where(F.col("state") == DONE), ["batch", "table_name"], "left_anti")
        entries = left.select(*_ENTRY.names).collect()  # a row for each table: one load runs at a time
        for name in sorted({e.batch for e in entries}):
            self._finish([e for e in entries if e.batch == name])

    def _stage(self, batch: str, sources, spine: DataFrame, lookback: datetime.timedelta) -> list[Row]:
        folder = f"staging/{batch}-{uuid.uuid4().hex[:12]}"
        last = self.ledger().where(F.col("state") == DONE).groupBy("table_name")
        reached = {r.table_name: r for r in last.agg(F.max("mark").alias("mark"), F.max("top_key").alias("top_key")).collect()}
        marks = {n: reached[n].mark if n in reached else None for n in (*FACTS, TOTALS)}
        tops = {n: reached[n].top_key if n in reached else 0 for n in FACTS}
        measured = {f"new_{name}": _measures_of(name) for name in (*FACTS, TOTALS)} | {name: _top_key for name in FACTS}
        empty = [name for name in FACTS if not self.store.exists(name)]
        work = MeasuringStore(self.spark, self.store.path(folder), measured | {name: _both(name) for name in empty})
        keys = {**{f: GRAINS[f] for f in FACTS}, TOTALS: ["order_key"]}
        fresh = {**sources, TOTALS: spine.select("order_key", "purchase_date_key")}

        new = {}

        def keyed(name: str, rows: DataFrame) -> DataFrame:
            return conform(rows.withColumn("fact_key", F.monotonically_increasing_id() + 1 + tops[name]), _schema(name))

        # what is new, each table on its own: only the months from the mark on are read on either side
        def find(name: str) -> None:
            since = None if marks[name] is None else _day_before(marks[name], lookback)
            rows = _since(fresh[name], since)
            if name in empty:  # what is new is all there will be
                new[name] = work.overwrite(keyed(name, layers.laid_out(rows, layers.MONTH)), name, [layers.MONTH])
            else:
                new[name] = work.overwrite(_dated(merge_new(_since(self.table(name), since), rows, keys[name])), f"new_{name}")

        at_once(find, fresh)
        found = {name: work.measured[name if name in empty else f"new_{name}"] for name in fresh}
        if undated := [name for name, seen in found.items() if seen["undated"]]:
            raise ValueError(f"rows without a purchase day in {undated}")
        months = sorted({m for seen in found.values() for m in seen["months"] or []})
        touched = F.col(layers.MONTH).isin(months) if months else F.lit(False)

        def fill(name: str) -> None:
            content = self.table(name).where(touched).unionByName(keyed(name, new[name]))
            new[name] = work.overwrite(layers.laid_out(content, layers.MONTH), name, [layers.MONTH])

        at_once(fill, [name for name in FACTS if name not in empty])
        # every order of a touched month, from facts of the same months
        orders = self.table(TOTALS).where(touched).select("order_key").unionByName(new[TOTALS].select("order_key"))
        low, high = (months[0] * 100, months[-1] * 100 + 99) if months else (0, 0)
        known = spine.where(F.col("purchase_date_key").between(low, high)).join(orders, "order_key", "left_semi")
        totals = layers.order_totals(known, *[new[f] for f in FACTS])
        work.overwrite(layers.laid_out(totals, layers.MONTH), TOTALS, [layers.MONTH])
        entries = []
        for name in (*FACTS, TOTALS):
            seen = found[name]
            mark = max(filter(None, [marks[name], seen["mark"]]), default=None)
            top = max(tops[name], work.measured[name]["top_key"] or 0) if name in FACTS else 0
            digest = {k: seen[k] for k in ("rows", "digest_a", "digest_b")}
            entries.append(Row(batch=batch, table_name=name, mark=mark, top_key=top, months=months, folder=folder, **digest))
        return entries

    def _finish(self, entries: list[Row]) -> None:
        """Put the staged months of a batch in place, however far an earlier try has come, and note that it is done."""
        staged = Store(self.spark, self.store.path(entries[0].folder))

        def place(name: str) -> None:
            rows = staged.read(name, _schema(name))
            # staged files are by month and day already
            self._replace(rows.sortWithinPartitions(layers.MONTH, "purchase_date_key"), name)

        at_once(place, [e.table_name for e in entries] if entries[0].months else [])
        self._note(entries, DONE)
        staged.clear()

    def _replace(self, rows: DataFrame, name: str) -> None:
        self.store.overwrite_partitions(rows, name, [layers.MONTH])


def _schema(name: str) -> T.StructType:
    return T.StructType([*SCHEMAS[name].fields, T.StructField(layers.MONTH, T.IntegerType())])


def _measures_of(name: str) -> Callable[[DataFrame], dict[str, Any]]:
    declared = {*_schema(name).names} - {"fact_key"}

    def measures(df: DataFrame) -> dict[str, Any]:
        columns = sorted(c for c in df.columns if c in declared)
        # as many months as the batch has, a few hundred at most
        undated = F.count_if(F.col("purchase_date_key").isNull())
        return {**table_digest(columns), "mark": F.max("purchase_date_key"), "months": F.collect_set(layers.MONTH), "undated": undated}

    return measures


def _both(name: str) -> Callable[[DataFrame], dict[str, Any]]:
    return lambda df: {**_measures_of(name)(df), **_top_key(df)}


def _top_key(df: DataFrame) -> dict[str, Any]:
    return {"top_key": F.max("fact_key")}


def _day_before(mark: int, lookback: datetime.timedelta) -> datetime.date:
    return datetime.datetime.strptime(str(mark), "%Y%m%d").date() - lookback


def _since(rows: DataFrame, day: datetime.date | None) -> DataFrame:
    """Rows of a day or later; the bound goes to the partitions, too, where the rows have them."""
    if day is None:
        return rows
    key = int(day.strftime("%Y%m%d"))
    kept = rows.where(F.col("purchase_date_key") >= key)
    if layers.MONTH in rows.columns:
        kept = kept.where(F.col(layers.MONTH) >= key // 100)
    return kept.where(F.col(layers.YEAR) >= key // 10000) if layers.YEAR in rows.columns else kept


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn(layers.MONTH, layers.month_key("purchase_date_key"))
