"""Aggregation shapes: order collapse, shares, exact medians, global ranks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainhouse.functions.scalar import percent


def collapse(df: DataFrame, by: Sequence[str], key: str, *values: Column) -> DataFrame:
    """One row per (group, key), the step before any average across orders."""
    return df.groupBy(*by, key).agg(*values)


def share_of_total(df: DataFrame, value: str, name: str, whole: DataFrame | None = None) -> DataFrame:
    """Percentage of the grand total beside every row; ``whole`` has the rows of the total where ``df`` lacks some of them.

    The total is a scalar subquery rather than a window over everything, which
    would run in one task; AQE lets it share the shuffles of ``df``.
    """
    total = (df if whole is None else whole).agg(F.sum(value)).scalar()
    return df.withColumn(name, percent(F.col(value), total))


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """One-row median of a whole-number column of bounded range, such as days.

    Equal values are counted first, so the final step sees one row per distinct
    value instead of one per input row.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.percentile(F.col(value), F.lit(0.5), F.col("_n")).alias("median"))


def rank_global(df: DataFrame, value: str, name: str) -> DataFrame:
    """Rank over all rows, highest first, ties sharing the better rank, for a
    frame already reduced to one row per state or group. Longer lists go through
    :func:`grainhouse.operators.keys.percent_rank_weights`."""
    return df.withColumn(name, F.rank().over(Window.orderBy(F.col(value).desc())).cast("long"))


def top_then_sort(df: DataFrame, n: int, by: Sequence[Column], then: Sequence[Column]) -> DataFrame:
    """The top ``n`` rows by one measure, shown in the order of another."""
    return df.orderBy(*by).limit(n).orderBy(*then)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack check results by column name."""
    return reduce(DataFrame.unionByName, frames)


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """One-row aggregates as one row: stacked by name, then folded, so that no
    cross join is planned."""
    stacked = reduce(lambda above, below: above.unionByName(below, allowMissingColumns=True), one_row)
    return stacked.agg(*[F.max(c).alias(c) for df in one_row for c in df.columns])


def repeated(df: DataFrame, keys: Sequence[str], name: str = "copies") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)
