"""What a load measures while it writes: rows, sums, missing keys, impossible days, longest texts, and a digest of each table.

The measures are aggregates observed in the writing jobs themselves. The checks made from them have the columns of those in
:mod:`~grainhouse.plans.quality` that scan the tables, and read nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from grainhouse.functions.digest import table_digest
from grainhouse.functions.scalar import mean
from grainhouse.plans.quality import FACTS, LOADED_FROM
from grainhouse.sources.schemas import LENGTHS, SCHEMAS

KEYS = ("customer", "order", "seller", "product")
# column -> the name of its total in both layers
_SUMS = {"price": "sum price", "freight_value": "sum freight", "payment_value": "sum payment"}
_TOTALS = {
    "sum price": ("stg_order_items", "fact_order_items"),
    "sum freight": ("stg_order_items", "fact_order_items"),
    "sum payment": ("stg_payments", "fact_payments"),
    "mean score": ("stg_reviews", "fact_reviews"),
}


def digest_columns(table: str) -> list[Column]:
    """What a table's digest covers: its declared columns. A fact's key is not among them, it says where a row was written."""
    return [F.col(f.name).cast(f.dataType) for f in sorted(SCHEMAS[table].fields, key=lambda f: f.name) if f.name != "fact_key"]


def measures_of(table: str) -> Callable[[DataFrame], dict[str, Column]]:
    """The aggregates for one table, by name."""

    def build(df: DataFrame) -> dict[str, Column]:
        found: dict[str, Column] = table_digest(digest_columns(table))
        for column, name in _SUMS.items():
            if table in _TOTALS[name]:
                found[name] = F.round(F.sum(column).cast("double"), 2)
        if table in _TOTALS["mean score"]:
            found["mean score"] = mean("review_score")
        if table in FACTS:
            for dim in KEYS:
                if f"{dim}_key" in df.columns:
                    found[f"missing {dim}"] = F.count_if(F.col(f"{dim}_key").isNull())
        if "actual_delivery_days" in df.columns:
            found["negative days"] = F.count_if(F.col("actual_delivery_days") < 0)
        for column in LENGTHS.get(table, {}):
            if column in df.columns:
                found[f"longest {column}"] = F.max(F.length(column)).cast("long")
        return found

    return build


class Watched:
    """Raw tables whose rows are counted by the first job that reads them to the end."""

    def __init__(self, raw):
        self._raw = raw
        self._seen: dict[str, Observation] = {}
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in LOADED_FROM.values():
            return getattr(self._raw, name)
        if name not in self._frames:
            self._seen[name] = Observation()
            self._frames[name] = getattr(self._raw, name).observe(self._seen[name], F.count(F.lit(1)).alias("rows"))
        return self._frames[name]

    def rows(self) -> dict[str, int]:
        return {name: seen.get["rows"] for name, seen in self._seen.items()}


class Measured:
    """The checks of a load from its measures: ``tables`` by table and name, ``sources`` the rows of each raw table."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, Mapping[str, Any]], sources: Mapping[str, int]):
        self.spark = spark
        self.tables = tables
        self.sources = sources

    def complete(self, fact: str) -> bool:
        """Whether a fact has as many rows as its source."""
        return self.tables[fact]["rows"] == self.sources[LOADED_FROM[fact]]

    def all_keyed(self, fact: str, dims: Sequence[str]) -> bool:
        return not any(self.tables[fact][f"missing {d}"] for d in dims)

    def row_counts(self) -> DataFrame:
        rows = [(t, self.sources[s], self.tables[t]["rows"], self.sources[s] - self.tables[t]["rows"]) for t, s in LOADED_FROM.items()]
        return self.spark.createDataFrame(rows, "table_name string, source_rows long, warehouse_rows long, diff long")

    def totals_preserved(self) -> DataFrame:
        rows = [(name, self.tables[stg].get(name), self.tables[fact].get(name)) for name, (stg, fact) in _TOTALS.items()]
        frame = self.spark.createDataFrame(rows, "measure string, source_value double, warehouse_value double")
        return frame.withColumn("diff", F.round(F.col("source_value") - F.col("warehouse_value"), 6))

    def missing_keys(self) -> DataFrame:
        rows = [(f, *(self.tables[f].get(f"missing {d}") for d in KEYS), self.tables[f]["rows"]) for f in FACTS]
        fields = ", ".join(f"missing_{d} long" for d in KEYS)
        return self.spark.createDataFrame(rows, f"fact string, {fields}, total_rows long")

    def negative_days(self) -> DataFrame:
        return self.spark.createDataFrame([(self.tables["fact_order_items"]["negative days"],)], "item_rows long")

    def too_long(self) -> DataFrame:
        """Columns whose longest text is above the declared limit."""
        rows = [
            (table, column, seen[f"longest {column}"], limit)
            for table, seen in self.tables.items()
            for column, limit in LENGTHS.get(table, {}).items()
            if (seen.get(f"longest {column}") or 0) > limit
        ]
        return self.spark.createDataFrame(rows, "table_name string, column_name string, longest long, declared int")

    def listed(self) -> DataFrame:
        """(table_name, measure, value): everything but the digests."""
        rows = [
            (table, name, None if value is None else float(value))
            for table, seen in self.tables.items()
            for name, value in seen.items()
            if not name.startswith("digest_")
        ]
        return self.spark.createDataFrame(rows, "table_name string, measure string, value double")


def all_measures(tables) -> dict[str, Callable[[DataFrame], dict[str, Column]]]:
    return {table: measures_of(table) for table in tables if table in SCHEMAS}
