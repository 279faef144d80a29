"""Dense numbering over range partitions.

A plain ``row_number`` over a global order runs in one task. Here the rows are
range partitioned and sorted, each row notes its partition and its place in it,
and the result is written. The rows before each partition are then a table with
one row per partition, so the final number is an addition on the scan side.

The placed rows are written rather than cached: a recomputed range partition
could be cut elsewhere, a written one cannot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainhouse.sources.store import Store

SLOT = "_slot"
LARGE_GROUP = 1 << 20  # rows of a group that one task may sort
SLOTS = 1 << 16  # in which groups are counted together first
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def _partition(slot: Column) -> Column:
    return F.shiftright(slot, _ROW_BITS)


def _row(slot: Column) -> Column:
    return slot.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))


def rows_before(sizes: DataFrame, part: str, size: str, name: str) -> DataFrame:
    """Running total of the partitions before each one.

    ``sizes`` has one row per partition, which bounds the single-task window.
    """
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn(name, F.coalesce(F.sum(size).over(earlier), F.lit(0)))


def number_rows(df: DataFrame, by: Sequence[str | Column], name: str, store: Store, table: str) -> DataFrame:
    """Add ``name`` = 1, 2, 3, … in the order of ``by``.

    One range shuffle. Give enough columns in ``by`` to make rows distinct: a hot
    value of the first column is then spread over several partitions. The result
    reads the placed rows kept as ``table``.
    """
    placed = store.overwrite(
        df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(SLOT, F.monotonically_increasing_id()), table
    )
    sizes = placed.groupBy(_partition(F.col(SLOT)).alias("_part")).agg((F.max(_row(F.col(SLOT))) + 1).alias("_rows"))
    offsets = rows_before(sizes, "_part", "_rows", "_before").drop("_rows")
    # offsets: one row per range partition, so its size is bounded by the shuffle width
    return (
        placed.withColumn("_part", _partition(F.col(SLOT)))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + _row(F.col(SLOT)) + 1)
        .drop("_part", "_before", SLOT)
    )


def with_surrogate_key(df: DataFrame, natural_key: str, name: str, store: Store, table: str) -> DataFrame:
    """Write ``table`` with a dense integer key from 1 in the order of the natural key.

    The keyed rows are a plain table: its size is known to the planner, which can
    then broadcast it where it is small instead of shuffling the fact it joins.
    """
    placed = f"{table}_placed"
    keyed = store.overwrite(number_rows(df, [natural_key], name, store, placed), table)
    store.remove(placed)
    return keyed


def number_within(
    df: DataFrame, group: str, order: Sequence[str], name: str, store: Store, table: str
) -> DataFrame:
    """Write ``table`` with the rows of every group numbered 1, 2, 3, …

    Groups of up to :data:`LARGE_GROUP` rows are sorted and numbered behind one
    hash shuffle. Larger ones are found by counts first and are never put in one
    task.
    """
    large = store.overwrite(_large_groups(df, group), f"{table}_large")
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long")
    if large.isEmpty():
        written = store.overwrite(df.withColumn(name, place), table)
    else:
        in_large = F.col(group).eqNullSafe(F.col("_group"))
        spread = _number_large(df.join(large, in_large, "left_semi"), group, order, name, store, f"{table}_placed")
        others = df.join(large, in_large, "left_anti").withColumn(name, place)
        written = store.overwrite(others.unionByName(spread), table)
        store.remove(f"{table}_placed")
    store.remove(f"{table}_large")
    return written


def _large_groups(df: DataFrame, group: str) -> DataFrame:
    """(``_group``) of the groups above :data:`LARGE_GROUP` rows, one row per LARGE_GROUP rows of input at most.

    Groups are counted by a slot of their hash first: none is larger than its slot, so only the groups of crowded slots are counted
    one by one, and a table without large groups shuffles a count per slot and task.
    """
    slot = F.pmod(F.xxhash64(group), F.lit(SLOTS))
    crowded = df.groupBy(slot.alias("_slot_of")).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > LARGE_GROUP)
    # crowded: SLOTS rows at most
    held = df.select(F.col(group).alias("_group"), slot.alias("_slot_of")).join(F.broadcast(crowded.select("_slot_of")), "_slot_of", "left_semi")
    return held.groupBy("_group").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > LARGE_GROUP).select("_group")


def _number_large(
    df: DataFrame, group: str, order: Sequence[str], name: str, store: Store, placed: str
) -> DataFrame:
    """Rows numbered within groups that no task holds whole.

    The global position is taken over (group, order), which splits a hot group
    over partitions; the first position of a group is a partial aggregate, and
    the join back is split by AQE.
    """
    positions = number_rows(df, [group, *order], "_pos", store, placed)
    first = positions.groupBy(F.col(group).alias("_group")).agg(F.min("_pos").alias("_first"))
    joined = positions.join(first, F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn(name, F.col("_pos") - F.col("_first") + 1).drop("_pos", "_first", "_group")


def percent_rank_weights(df: DataFrame, value: str, store: Store, table: str) -> DataFrame:
    """``percent_rank`` of each distinct value, highest first, as
    (value, n, pct_rank) for a frame with one row per entity.

    Equal values are merged first, so a tie shared by many entities is one row;
    the distinct values are then range partitioned and summed up.
    """
    distinct = df.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    placed = store.overwrite(
        distinct.repartitionByRange(F.col(value).desc()).withColumn("_part", F.spark_partition_id()), f"{table}_values"
    )
    sizes = placed.groupBy("_part").agg(F.sum("n").alias("_n"))
    offsets = rows_before(sizes, "_part", "_n", "_before")
    total = offsets.agg(F.sum("_n")).scalar()
    above = (
        Window.partitionBy("_part").orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = F.col("_before") + F.coalesce(F.sum("n").over(above), F.lit(0))
    # offsets: one row per range partition
    ranked = placed.join(F.broadcast(offsets.select("_part", "_before")), "_part")
    return ranked.select(value, "n", F.coalesce(F.try_divide(ahead, total - 1), F.lit(0.0)).alias("pct_rank"))
