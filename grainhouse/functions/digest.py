"""Digests of tables that do not depend on the order of rows.

A row is hashed twice with different seeds, and the hashes are summed: equal multisets of rows have equal counts and sums, and a
value that changes, moves to another row or column, or is repeated changes the sums (but for a chance of about 2**-128). Sums are partial
aggregates, so a digest is one pass without a shuffle of rows, and can be observed while a table is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEEDS = {"digest_a": 7, "digest_b": 1_000_003}


_PART_BITS = 21  # sums of parts of 21 or 22 bits stay within 64 bits up to 2**41 rows


def _total(hashed: Column) -> Column:
    """Exact sum of 64-bit numbers as a decimal, from sums of whole-number parts, which cost far less a row than decimals."""
    low = F.lit((1 << _PART_BITS) - 1)
    parts = [F.shiftright(hashed, 2 * _PART_BITS), F.shiftright(hashed, _PART_BITS).bitwiseAND(low), hashed.bitwiseAND(low)]
    sums = [F.coalesce(F.sum(part), F.lit(0)).cast("decimal(19,0)") for part in parts]
    step = F.lit(1 << _PART_BITS).cast("decimal(8,0)")
    high = (sums[0] * step + sums[1]).cast("decimal(30,0)")
    return (high * step + sums[2]).cast("decimal(38,0)")


def row_hash(columns: Sequence[str | Column], seed: int) -> Column:
    """64 bits of a row. A hash passes over NULLs, so their places are hashed as well."""
    given = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(F.lit(seed), *[part for c in given for part in (c, c.isNull())])


def table_digest(columns: Sequence[str | Column]) -> dict[str, Column]:
    """Aggregates ``rows``, ``digest_a`` and ``digest_b`` over whole rows; give the columns in a fixed order, and in fixed types."""
    sums = {name: _total(row_hash(columns, seed)) for name, seed in SEEDS.items()}
    return {"rows": F.count(F.lit(1)), **sums}


def column_digests(columns: Sequence[str]) -> dict[str, Column]:
    """One aggregate per column, ``column -> text of both sums``: tells which column differs where table digests do."""
    return {
        c: F.concat_ws(":", *[_total(row_hash([c], seed)).cast("string") for seed in SEEDS.values()]).alias(c) for c in columns
    }


def digest_of(df: DataFrame, columns: Sequence[str | Column] | None = None) -> DataFrame:
    """One row (rows, digest_a, digest_b) for a frame."""
    return df.agg(*[v.alias(n) for n, v in table_digest(columns or df.columns).items()])


def content_differences(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """(column_name, mine, theirs) of the columns that differ between two frames, each read once.

    ``(rows)`` stands for the number of rows, ``(row)`` for whole rows: values that trade places between rows leave every column
    as it is and change that one alone. No rows mean equal content. Columns are compared by name.
    """
    columns = sorted(mine.columns)
    if columns != sorted(theirs.columns):
        raise ValueError(f"columns differ: {columns} and {sorted(theirs.columns)}")

    def told(df: DataFrame, side: str) -> DataFrame:
        whole = table_digest(columns)
        parts = {
            "(rows)": whole["rows"].cast("string"),
            "(row)": F.concat_ws(":", whole["digest_a"].cast("string"), whole["digest_b"].cast("string")),
            **column_digests(columns),
        }
        one = df.agg(F.array(*[F.struct(F.lit(n).alias("column_name"), v.alias(side)) for n, v in parts.items()]).alias("x"))
        return one.select(F.explode("x").alias("x")).select("x.*")

    return told(mine, "mine").join(told(theirs, "theirs"), "column_name").where("mine <> theirs")
