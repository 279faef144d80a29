"""Exact quantiles and ranks of a column of any range, without one task that sees all of it.

Equal values are counted first, so that a value held by many rows is one row. The distinct values are placed by range and written;
how many rows lie before each range is then a table of one row per partition. A quantile reads the one or two ranges that hold it,
a rank adds the rows before its range to those before it inside.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainhouse.operators.keys import rows_before
from grainhouse.sources.store import Store


def _placed(counts: DataFrame, order, store: Store, table: str) -> tuple[DataFrame, DataFrame]:
    """The counted values with their range partition, written, and (``_part``, ``_n``, ``_before``) of each partition."""
    placed = store.overwrite(counts.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), table)
    return placed, rows_before(placed.groupBy("_part").agg(F.sum("n").alias("_n")), "_part", "_n", "_before")


def exact_quantiles(df: DataFrame, value: str, points: dict[str, float], store: Store, table: str) -> DataFrame:
    """One row with each of ``points`` (name -> quantile from 0 to 1), interpolated between neighbours; NULLs are left out.

    A column without values gives NULLs.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    placed, parts = _placed(counts, F.col("value"), store, table)
    total = parts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    at = {name: point * (total - 1) for name, point in points.items()}
    wanted = sorted({k for place in at.values() for k in (math.floor(place), math.ceil(place))}) if total else []
    holds = F.lit(False)
    for k in wanted:
        holds = holds | ((F.col("_before") <= k) & (F.col("_before") + F.col("_n") > k))
    # a row per quantile at most: each wanted place lies in one partition
    held = placed.join(F.broadcast(parts.where(holds)), "_part")
    earlier = Window.partitionBy("_part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ahead = held.withColumn("_ahead", F.col("_before") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))

    def nth(k: int):
        here = (F.col("_ahead") <= k) & (F.col("_ahead") + F.col("n") > k)
        return F.max(F.when(here, F.col("value"))).cast("double")

    def between(place: float):
        low, high = nth(math.floor(place)), nth(math.ceil(place))
        return low + (high - low) * (place - math.floor(place))

    return ahead.agg(*[(between(place) if total else F.lit(None).cast("double")).alias(name) for name, place in at.items()])


def rank_rows(df: DataFrame, value: str, name: str, store: Store, table: str) -> DataFrame:
    """Add the rank of every row, highest value first, ties sharing the better rank and NULLs last."""
    counts = df.groupBy(F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("n"))
    down = F.col("_value").desc_nulls_last()
    placed, parts = _placed(counts, down, store, table)
    above = Window.partitionBy("_part").orderBy(down).rowsBetween(Window.unboundedPreceding, -1)
    # parts: one row per range partition
    ranks = placed.join(F.broadcast(parts.drop("_n")), "_part").select(
        "_value", (F.col("_before") + F.coalesce(F.sum("n").over(above), F.lit(0)) + 1).cast("long").alias(name)
    )
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")
