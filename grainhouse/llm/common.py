"""What several text operators need: scratch tables, text batches, size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainhouse.sources.store import Store

#: Words of the contracts: runs of anything but space, tab, LF, VT, FF and CR. ``bytes.split()`` cuts at these six.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows up to which a side of a join is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 2_000_000


def scratch(spark: SparkSession, label: str) -> Store:
    """A new folder of written tables below the shared folder, one per call."""
    return Store.scratch(spark, f"{label}-{uuid.uuid4().hex[:12]}")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, for the Python functions that run there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="grainhouse-")  # on the driver, which serves the file to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = os.path.basename(package)
    kept = shutil.copytree(package, f"{folder}/package/{name}", ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/{name}", "zip", os.path.dirname(kept)))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_checked(side: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast where the counted rows stay below ``limit``; give narrow rows only."""
    return F.broadcast(side) if side.limit(limit + 1).count() <= limit else side


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Jobs run inside hand Python workers batches of at most ``size``, whatever the length of rows; the setting is put back after."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def values(batch: pa.RecordBatch, name: str) -> list[Any]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, null read as empty."""
    return [text or "" for text in values(batch, name)]


def each_text(batch: pa.RecordBatch, rows: int = 256) -> Iterator[str]:
    """The texts of a batch, null read as empty; only ``rows`` of them are Python strings at a time."""
    for start in range(0, batch.num_rows, rows):
        yield from texts(batch.slice(start, rows))


def runs(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Cut consecutive items into runs (from, to) of at most ``most`` in total; a larger item is a run of its own."""
    start = end = total = 0
    for size in sizes:
        if end > start and total + size > most:
            yield start, end
            start, total = end, 0
        end, total = end + 1, total + size
    if end > start:
        yield start, end


def batch_of(schema: pa.Schema, *columns: Any) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
