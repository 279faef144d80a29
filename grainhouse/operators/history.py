"""History and incremental loads as batch jobs on Parquet.

There is no MERGE on plain Parquet, so a change is a new table and an increment
is an append.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainhouse.operators.joins import merge_new
from grainhouse.operators.keys import number_rows
from grainhouse.sources.store import Store, add_columns

HISTORY = ("valid_from", "valid_to", "is_current")


def start_history(dim: DataFrame, since: str) -> DataFrame:
    """Add history columns; every existing row is current since ``since``."""
    return add_columns(dim, {"valid_from": ("date", since), "valid_to": ("date", None), "is_current": ("boolean", True)})


def latest_change(changes: DataFrame, key: str, sequence: str) -> DataFrame:
    """The last change per key, for change sets that name a key more than once."""
    others = [c for c in changes.columns if c not in (key, sequence)]
    last = changes.groupBy(key).agg(F.max_by(F.struct(*others), sequence).alias("_last"))
    return last.select(key, "_last.*")


def scd2_apply(
    dim: DataFrame,
    changes: DataFrame,
    key: str,
    surrogate: str,
    tracked: Sequence[str],
    as_of: str,
    store: Store,
    table: str,
    sequence: str | None = None,
) -> DataFrame:
    """Type 2 history: expire the current row of a changed key and add a version.

    ``changes`` has any of the attributes of ``dim``. Of several rows for a key the
    last by ``sequence`` counts; without a sequence column they are refused. A key
    whose tracked attributes are equal (NULLs included) stays as it is; a new key
    gets a first version. New versions copy untouched attributes and take
    surrogate keys after the highest one in use, in the order of the key.

    The result is a written table of its own run, so that ``dim`` may be the
    result of an earlier run with the same ``table``.
    """
    if sequence is not None:
        changes = latest_change(changes, key, sequence)
    elif not changes.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"several changes for one {key}, and no column to order them by")
    run = f"{table}-{as_of}-{uuid.uuid4().hex[:12]}"
    work = Store(store.spark, store.path(f"{run}-work"))
    moved = work.overwrite(versions_of(dim.where("is_current"), changes, key, surrogate, tracked, as_of), "versions")

    numbered = number_rows(moved.where(F.col(surrogate).isNull()).drop(surrogate), [key], "_n", work, "new")
    highest = dim.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
    added = numbered.withColumn(surrogate, highest + F.col("_n"))
    kept = moved.where(F.col(surrogate).isNotNull())
    older = dim.where("NOT is_current")
    stored = store.overwrite(older.unionByName(kept.select(*dim.columns)).unionByName(added.select(*dim.columns)), run)
    work.clear()
    return stored


def versions_of(current: DataFrame, changes: DataFrame, key: str, surrogate: str, tracked: Sequence[str], as_of: str) -> DataFrame:
    """The rows that current ones and a change per key become: kept, expired, and new versions without a surrogate key."""
    attributes = [c for c in current.columns if c not in (key, surrogate, *HISTORY)]
    given = [c for c in attributes if c in changes.columns]
    day = F.lit(as_of).cast("date")
    none = F.lit(None)

    incoming = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in given], F.lit(True).alias("_change"))
    both = current.withColumn("_known", F.lit(True)).join(incoming, key, "full_outer")

    differs = F.lit(False)
    for column in tracked:
        differs = differs | ~F.col(column).eqNullSafe(F.col(f"_new_{column}"))
    known, touched = F.col("_known").isNotNull(), F.col("_change").isNotNull()
    kinds = dict(current.dtypes)

    def version(new_values: bool, start: Column, end: Column, is_current: bool, number: Column) -> Column:
        values = {
            surrogate: number,
            **{c: F.col(f"_new_{c}") if new_values and c in given else F.col(c) for c in attributes},
            "valid_from": start,
            "valid_to": end,
            "is_current": F.lit(is_current),
        }
        return F.struct(*[v.cast(kinds[n]).alias(n) for n, v in values.items()])

    as_is = version(False, F.col("valid_from"), F.col("valid_to"), True, F.col(surrogate))
    expired = version(False, F.col("valid_from"), day, False, F.col(surrogate))
    fresh = version(True, day, none, True, none)
    versions = (
        F.when(~known, F.array(fresh)).when(touched & differs, F.array(expired, fresh)).otherwise(F.array(as_is))
    )
    return both.select(key, F.explode(versions).alias("_v")).select(key, "_v.*")


def high_water_mark(df: DataFrame, column: str) -> datetime.datetime | None:
    """Latest value loaded, a single value, so that it can be pushed to the scan."""
    return df.agg(F.max(column)).first()[0]


def increment(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    ts: str,
    mark: datetime.datetime | None,
    lookback: datetime.timedelta = datetime.timedelta(0),
) -> DataFrame:
    """Source rows after the mark that the target does not have.

    The mark is compared with the column it was taken from. ``lookback`` reads a
    stretch before it again for late rows; the anti join makes that safe, and the
    target is restricted to the same stretch.
    """
    if mark is None:
        return merge_new(target, source, keys)
    since = F.lit(mark - lookback)
    return merge_new(target.where(F.col(ts) > since), source.where(F.col(ts) > since), keys)
