"""Session settings and the shared folder that written tables live in."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. AQE picks join strategies from measured
# sizes, splits skewed join partitions (also where that costs one more shuffle)
# and merges small ones; UTC keeps timestamp rendering stable.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}

# What AQE merges shuffle partitions to, unless the session names a size itself.
# Rows take several times these bytes while they are sorted, so tasks get half
# the default of 64 MB.
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
ADVISORY_BYTES = "32m"

# Bytes of input one shuffle partition should stand for, and the most partitions
# a shuffle starts with. Up to FINE_PARTITIONS they stand for less, so that
# sorts take less memory.
SHUFFLE_BYTES = 256 << 20
FINE_BYTES, FINE_PARTITIONS = 16 << 20, 2048
MAX_SHUFFLE_PARTITIONS = 30_000

_own_folders: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if spark.conf.get(ADVISORY, None) is None:
        spark.conf.set(ADVISORY, ADVISORY_BYTES)
    return spark


def input_bytes(*frames: DataFrame) -> int:
    """Size of the files a set of frames reads, from the planner's statistics; warns of inputs whose size is not known."""
    total = unknown = 0
    for df in frames:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        for i in range(leaves.size()):
            size = int(str(leaves.apply(i).stats().sizeInBytes()))
            total += size if size < 1 << 60 else 0  # frames without files have no usable size
            unknown += size >= 1 << 60
    if unknown:
        warnings.warn(f"{unknown} inputs of unknown size are not counted", stacklevel=2)
    return total


def size_shuffles(spark: SparkSession, size: int) -> int:
    """Start shuffles with enough partitions for ``size`` bytes of input.

    The default of 200 would give partitions of hundreds of gigabytes on a large
    warehouse. Only ever raises the session's own setting; AQE merges partitions
    that turn out small, so a shuffle of little data does not pay for it.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    current = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    fine = min(-(-size // FINE_BYTES), FINE_PARTITIONS)
    wanted = max(fine, min(-(-size // SHUFFLE_BYTES), MAX_SHUFFLE_PARTITIONS))
    if wanted > current:
        spark.conf.set(key, str(wanted))
    return max(wanted, current)


@contextmanager
def sized_shuffles(spark: SparkSession, size: int) -> Iterator[None]:
    """Shuffles inside start with enough partitions for ``size`` bytes; the caller's setting is put back after."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    size_shuffles(spark, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def local_session(cores: str = "*", app: str = "grainhouse", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    ``spark.checkpoint.dir`` wins. Where it is unset, a local session gets a
    temporary folder of its own; a cluster session is refused, because a folder
    on one machine would be invisible to the others.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    set_by_caller = context.getCheckpointDir()
    if set_by_caller:
        return set_by_caller.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _own_folders:
        folder = tempfile.mkdtemp(prefix="grainhouse-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_folders[app] = folder
    return _own_folders[app]
