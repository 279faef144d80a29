"""A type 2 dimension that rewrites only the parts of itself that change.

The table lies in hash partitions of its natural key. A set of changes reads the partitions of its keys, finds the versions that are new
or expire, and replaces the partitions that have some; all others keep their files. The log is append-only: a run is noted as staged
once its new and its former rows are written beside the table, and as done once its partitions are in place, so that a run cut off in between
is finished by the next call. Undoing the last run puts the former rows back.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainhouse.operators.history import latest_change, start_history, versions_of
from grainhouse.operators.keys import number_rows
from grainhouse.sources.store import Store

BUCKET = "bucket"
STAGED, DONE, UNDONE = "staged", "done", "undone"
_LOG = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("state", T.StringType()),
        T.StructField("as_of", T.StringType()),
        T.StructField("top_key", T.LongType()),  # highest surrogate key in use after the run
        T.StructField("buckets", T.ArrayType(T.IntegerType())),
        T.StructField("folder", T.StringType()),
    ]
)


class HistoryTable:
    """A dimension ``name`` with columns ``key``, ``surrogate``, its attributes, and the history columns. One run at a time.

    ``buckets`` is chosen once: enough that a bucket is a file or two, and that a usual set of changes leaves most of them alone.
    """

    def __init__(self, store: Store, name: str, key: str, surrogate: str, tracked: Sequence[str], buckets: int):
        self.store, self.name, self.key, self.surrogate, self.tracked, self.buckets = store, name, key, surrogate, list(tracked), buckets
        self.spark = store.spark

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def create(self, dim: DataFrame, since: str) -> DataFrame:
        """Write the dimension with every row current since a day."""
        rows = start_history(dim, since).withColumn(BUCKET, self._bucket())
        written = self.store.overwrite(self._placed(rows), self.name, [BUCKET])
        top = written.agg(F.coalesce(F.max(self.surrogate), F.lit(0))).first()[0]
        self._note(Row(number=0, state=DONE, as_of=since, top_key=top, buckets=[], folder=""))
        return self.read()

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def log(self) -> DataFrame:
        return self.store.read(f"{self.name}_log", _LOG)

    def apply(self, changes: DataFrame, as_of: str, sequence: str | None = None) -> DataFrame:
        """Expire the current version of each changed key and add one; changes as in :func:`~grainhouse.operators.history.scd2_apply`."""
        self._recover()
        if sequence is not None:
            changes = latest_change(changes, self.key, sequence)
        elif not changes.groupBy(self.key).count().where("count > 1").isEmpty():
            raise ValueError(f"several changes for one {self.key}, and no column to order them by")
        last = self.log().agg(F.max("number").alias("number"), F.max("top_key").alias("top_key")).first()
        folder = f"{self.name}_runs/{as_of}-{uuid.uuid4().hex[:12]}"
        work = Store(self.spark, self.store.path(folder))
        placed = work.overwrite(changes.withColumn(BUCKET, self._bucket()), "changes")
        looked_at = [r[0] for r in placed.select(BUCKET).distinct().collect()]  # as many as there are buckets
        stored = self._stored().where(F.col(BUCKET).isin(looked_at))
        current = stored.where("is_current").drop(BUCKET)
        versions = versions_of(current, placed.drop(BUCKET), self.key, self.surrogate, self.tracked, as_of)
        moved = work.overwrite(versions.withColumn(BUCKET, self._bucket()), "versions")
        fresh = moved.where(F.col(self.surrogate).isNull())
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
        among = F.col(BUCKET).isin(touched) if touched else F.lit(False)
        numbered = number_rows(fresh.drop(self.surrogate), [self.key], "_n", work, "numbered")
        added = numbered.withColumn(self.surrogate, (F.col("_n") + last.top_key).cast(moved.schema[self.surrogate].dataType))
        kept = moved.where(among & F.col(self.surrogate).isNotNull())
        older = stored.where(among & ~F.col("is_current"))
        columns = stored.columns
        after = older.unionByName(kept.select(*columns)).unionByName(added.select(*columns))
        work.overwrite(self._placed(after), "after", [BUCKET])
        work.overwrite(self._placed(stored.where(among)), "before", [BUCKET])
        top = last.top_key + fresh.count()
        run = Row(number=last.number + 1, state=STAGED, as_of=as_of, top_key=top, buckets=touched, folder=folder)
        self._note(run)
        self._finish(run)
        return self.read()

    def undo(self) -> bool:
        """Put back the rows before the last run that still stands; False where there is none. The log keeps both."""
        self._recover()
        log = self.log()
        undone = log.where(F.col("state") == UNDONE).select("number")
        standing = log.where((F.col("state") == DONE) & (F.col("number") > 0)).join(undone, "number", "left_anti")
        run = standing.orderBy(F.desc("number")).first()
        if run is None:
            return False
        self._put(run, "before")
        self._note(Row(**{**run.asDict(), "state": UNDONE}))
        return True

    def _recover(self) -> None:
        log = self.log()
        finished = log.where(F.col("state") == DONE).select("number")
        for run in log.where(F.col("state") == STAGED).join(finished, "number", "left_anti").collect():  # one run at a time
            self._finish(run)

    def _finish(self, run: Row) -> None:
        self._put(run, "after")
        self._note(Row(**{**run.asDict(), "state": DONE}))

    def _put(self, run: Row, which: str) -> None:
        """Replace the run's partitions by rows written beside the table."""
        staged = Store(self.spark, self.store.path(run.folder))
        rows = staged.read(which, self._stored().schema)
        left = [r[0] for r in rows.select(BUCKET).distinct().collect()]
        for bucket in set(run.buckets).difference(left):  # had no rows before the run
            self.store.remove(f"{self.name}/{BUCKET}={bucket}")
        if left:
            self._replace(rows.sortWithinPartitions(BUCKET, self.key))

    def _replace(self, rows: DataFrame) -> None:
        self.store.overwrite_partitions(rows, self.name, [BUCKET])

    def _stored(self) -> DataFrame:
        return self.store.read(self.name)

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, self.key)

    def _note(self, run: Row) -> None:
        row = tuple(run[f.name] for f in _LOG)
        self.store.append(self.spark.createDataFrame([row], _LOG).coalesce(1), f"{self.name}_log", _LOG)
