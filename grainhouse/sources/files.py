"""CSV sources with declared schemas, and the mirror of all of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainhouse.functions.digest import content_differences

from grainhouse.sources.schemas import SRC_SCHEMAS
from grainhouse.sources.store import MeasuringStore, Store

# table -> file below the CSV folder; callers pass their own map for other names.
FILES = {name: f"{name}.csv" for name in SRC_SCHEMAS}


RECORD = "_record"  # the text of a line that does not fit the schema


class RejectedRows(ValueError):
    """More rows of a file were rejected than the load allows."""


def _reader(spark: SparkSession) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """UTF-8 CSV with a header; quoted fields may hold commas, quotes and line ends.

    A malformed row stops the load. Files with line ends inside fields cannot be
    split, so they are converted to Parquet once and read from there after.
    """
    return _reader(spark).schema(schema).option("mode", "FAILFAST").csv(path)


def load_csv(store: Store, path: str, schema: T.StructType, name: str, most: int = 0) -> tuple[DataFrame, DataFrame]:
    """Load a file as table ``name`` and its malformed rows as ``name_rejects``; returns both.

    A row is malformed where it has too few or too many fields or a value that is not of its column's type. The rejects have the
    file, the text of the row as read, and the columns that could be read. The file is parsed once, into a staging table whose rows are counted
    by the job that writes them; with more than ``most`` rejects the load stops there, with the old table as it was and the rejects
    in place to look at.
    """
    staged = f"{name}_staged"
    measures = {staged: lambda df: {"rejects": F.count_if(F.col(RECORD).isNotNull())}}
    work = MeasuringStore(store.spark, store.root, measures)
    wide = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    read = _reader(store.spark).schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).csv(path)
    parsed = work.overwrite(read.withColumn("file", F.col("_metadata.file_path")), staged)
    rejects = store.overwrite(parsed.where(F.col(RECORD).isNotNull()).select("file", RECORD, *schema.names), f"{name}_rejects")
    found = work.measured[staged].get("rejects") or 0
    if found > most:
        raise RejectedRows(f"{name}: {found} rows of {path} rejected, {most} allowed; see {store.path(name)}_rejects")
    accepted = store.overwrite(parsed.where(F.col(RECORD).isNull()).select(*schema.names), name)
    store.remove(staged)
    return accepted, rejects


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def refresh_mirror(store: Store, csv_folder: str, files: Mapping[str, str] = FILES) -> dict[str, DataFrame]:
    """Reload every raw table from its file. Running it twice gives the same tables. A malformed row stops it."""
    return {
        name: store.overwrite(read_csv(store.spark, f"{csv_folder.rstrip('/')}/{file}", SRC_SCHEMAS[name]), name)
        for name, file in files.items()
    }


class ContentError(ValueError):
    """A copy that does not hold what it was made from."""


def check_content(copies: Mapping[str, tuple[DataFrame, DataFrame]]) -> None:
    """Compare each (original, copy) by order-independent digests, a pass over either; raise naming tables and columns that differ.

    The columns are those of the original; what a copy has besides, such as a partition column, is not looked at.
    """
    found = {}
    for name, (original, copy) in copies.items():
        differing = content_differences(original, copy.select(*original.columns)).select("column_name").collect()  # columns at most
        if differing:
            found[name] = sorted(r.column_name for r in differing)
    if found:
        raise ContentError(f"content differs: {found}")
