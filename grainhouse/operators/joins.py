"""Join shapes used by the warehouse.

Dimension sizes grow with the data. A side is broadcast by hand only where its
counted rows are few; otherwise the choice is left to AQE, which sees the
measured size and splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


BROADCAST_ROWS = 500_000  # some 50 MB of two text or number columns


def is_few(table: DataFrame) -> bool:
    return table.count() <= BROADCAST_ROWS


def broadcast_few(table: DataFrame, *columns: str) -> DataFrame:
    """A few narrow columns of a written table, hinted for a broadcast where the table has at most :data:`BROADCAST_ROWS` rows.

    The fact that looks them up is then not shuffled for it. Beyond that the join is left to AQE.
    """
    side = table.select(*columns)
    return F.broadcast(side) if is_few(table) else side


def lookup(df: DataFrame, table: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Left lookup: every row of ``df`` stays, a miss gives NULL.

    ``on`` maps columns of ``df`` to columns of ``table``; ``take`` maps new names
    to columns of ``table``. Rows multiply when ``table`` is not unique on the key.
    """
    side = table.select(
        *[F.col(theirs).alias(f"_k_{i}") for i, theirs in enumerate(on.values())],
        *[F.col(theirs).alias(name) for name, theirs in take.items()],
    )
    condition = [df[ours] == side[f"_k_{i}"] for i, ours in enumerate(on)]
    return df.join(side, condition, "left").drop(*[f"_k_{i}" for i in range(len(on))])


def resolve_keys(df: DataFrame, lookups: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Chain of left lookups ``(dimension, natural id, surrogate key)``."""
    for table, natural, key in lookups:
        df = lookup(df, table, {natural: natural}, {key: key})
    return df


def without_match(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` that have no partner (anti join)."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(other.select(*keys), keys, "left_anti")


def with_match(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` that have a partner (semi join); rows never multiply."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(other.select(*keys), keys, "left_semi")


def merge_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose composite key the target does not have yet."""
    return without_match(source, target, keys)


def drill_across(fact: DataFrame, key: str, collapsed: Mapping[str, Column], other: DataFrame) -> DataFrame:
    """Collapse one fact to one row per key, then join the other fact to it."""
    per_key = fact.groupBy(key).agg(*[value.alias(name) for name, value in collapsed.items()])
    return per_key.join(other, key)


def fan_out_total(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """What ``sum(value)`` becomes when ``right`` is joined to the rows of ``left``.

    Both sides are reduced to one row per key first: each value of ``right``
    would appear once per row of ``left``, so the pairs themselves are never made.
    Returns one row: total, pairs.
    """
    copies = left.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    sums = right.groupBy(key).agg(F.sum(value).alias("_sum"), F.count(value).alias("_rows"))
    copies_dec = F.col("_copies").cast("decimal(20,0)")
    return copies.join(sums, key).agg(
        F.sum((copies_dec * F.col("_sum")).cast("decimal(38,2)")).alias("total"),
        F.sum(F.col("_copies") * F.col("_rows")).alias("pairs"),
    )
