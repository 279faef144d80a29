"""Tables as Parquet directories in the shared folder.

A written table cuts lineage, can be read by every executor, and survives the
loss of the executor that wrote it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainhouse.session import shared_folder


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project by name to a declared schema, casting where the type differs."""
    have = {f.name.lower(): f.dataType for f in df.schema.fields}
    return df.select(
        *[
            F.col(f.name) if have[f.name.lower()] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


class Store:
    """A folder of tables, one directory each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @classmethod
    def scratch(cls, spark: SparkSession, label: str) -> Store:
        """A folder of this application below the shared folder."""
        return cls(spark, f"{shared_folder(spark)}/grainhouse/{spark.sparkContext.applicationId}/{label}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(schema) if schema is not None else reader).parquet(self.path(name))

    def exists(self, name: str) -> bool:
        """True when the table's folder holds data. Marker files do not count: object stores often go without them."""
        files, path = self._on_filesystem(name)
        return files.exists(path) and any(f.getPath().getName()[0] not in "_." for f in files.listStatus(path))

    def remove(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        folder, path = self._on_filesystem(name)
        folder.delete(path, True)

    def clear(self) -> None:
        """Delete the whole folder with every table in it."""
        self.remove("")

    def _on_filesystem(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name).rstrip("/"))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def overwrite(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace a table (truncate and load) and return it as read back.

        Must not be given a frame that reads the table it replaces.
        """
        return self._write(df, name, "overwrite", partition_by)

    def overwrite_partitions(self, df: DataFrame, name: str, partition_by: Sequence[str]) -> DataFrame:
        """Replace the partitions that ``df`` has rows for and leave the others as they are, down to their files.

        Must not be given a frame that reads the table. A write that is cut off can leave some partitions without rows: give
        rows from a written table, and write them again.
        """
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
        writer.parquet(self.path(name))
        return self.read(name, _partitions_last(df, partition_by))

    def claim(self, name: str) -> bool:
        """Create an empty marker file; False where it is there already. Of several writers one gets it, on file systems whose
        create is exclusive."""
        files, path = self._on_filesystem(name)
        try:
            files.create(path, False).close()
        except Exception:
            if files.exists(path):
                return False
            raise
        return True

    def append(self, df: DataFrame, name: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> DataFrame:
        """Add rows to a table; columns are matched by name, not by position."""
        return self._write(conform(df, schema), name, "append", partition_by)

    def ensure(self, name: str, schema: T.StructType) -> DataFrame:
        """Create an empty table unless it is there already."""
        if not self.exists(name):
            # never replaces what is there: at worst an empty file joins it
            self._write(self.spark.createDataFrame([], schema), name, "append", ())
        return self.read(name, schema)

    def _write(self, df: DataFrame, name: str, mode: str, partition_by: Sequence[str]) -> DataFrame:
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name))
        return self.read(name, _partitions_last(df, partition_by))


class MeasuringStore(Store):
    """A store that measures chosen tables in the very job that writes them, so that nobody has to read them again for it.

    ``measures`` names the aggregates for each table as a function of its frame; ``measured`` has their values once the table is
    written. The measuring node is the last one before the files, in the stage whose tasks write them, where each task counts
    once however often it is tried.
    """

    def __init__(self, spark: SparkSession, root: str, measures: Mapping[str, Any]):
        super().__init__(spark, root)
        self.measures = measures
        self.measured: dict[str, dict[str, Any]] = {}

    def overwrite(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        wanted = self.measures[name](df) if name in self.measures else {}
        if not wanted:
            return super().overwrite(df, name, partition_by)
        seen = Observation()
        written = super().overwrite(df.observe(seen, *[v.alias(n) for n, v in wanted.items()]), name, partition_by)
        self.measured[name] = seen.get
        return written


def _partitions_last(df: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    fields = [f for f in df.schema.fields if f.name not in partition_by]
    return T.StructType(fields + [f for f in df.schema.fields if f.name in partition_by])


def add_columns(df: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """Add columns as ``name -> (type, value)``; every existing row gets the value."""
    return df.withColumns({name: F.lit(value).cast(kind) for name, (kind, value) in columns.items()})


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def backfill(df: DataFrame, name: str, value: Column, condition: Column) -> DataFrame:
    """Set a column where the condition holds; all other rows keep their value."""
    return df.withColumn(name, F.when(condition, value).otherwise(F.col(name)))
