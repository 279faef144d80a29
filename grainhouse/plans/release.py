"""Released runs: the manifest of a run, the pointer to the current one, and a warehouse that reads them.

A run's folder holds its tables and a manifest with the path, schema, rows and digest of each. The pointer is a table of its own to
which a release adds a row, so that the old one stays readable until the new one is there. Reports run on an opened release as they
do on a warehouse that builds its tables, and write nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainhouse.functions.digest import digest_of
from grainhouse.plans.layers import MONTH
from grainhouse.plans.measured import Measured, digest_columns
from grainhouse.plans.warehouse import Warehouse, built_once
from grainhouse.sources.schemas import DWH_SCHEMAS, MIRROR_SCHEMAS, STG_SCHEMAS
from grainhouse.sources.store import Store

POINTER, MANIFEST = "current", "manifest"
RELEASED = [*STG_SCHEMAS, *DWH_SCHEMAS, *MIRROR_SCHEMAS]
_MANIFEST = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("path", T.StringType()),  # below the run's folder
        T.StructField("schema", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("digest_a", T.DecimalType(38, 0)),
        T.StructField("digest_b", T.DecimalType(38, 0)),
    ]
)


def write_manifest(folder: Store, wh: Warehouse, measured: Measured) -> DataFrame:
    """Note what each released table holds, from what its writing job has measured."""
    rows = []
    for name in RELEASED:
        seen = measured.tables[name]
        rows.append((name, name, wh[name].schema.json(), seen["rows"], seen["digest_a"], seen["digest_b"]))
    return folder.overwrite(folder.spark.createDataFrame(rows, _MANIFEST).coalesce(1), MANIFEST)


def move_pointer(store: Store, run: str) -> None:
    """Make a run current. Releases are numbered; of two at a time each claims a number of its own, and the later one wins."""
    number = store.read(POINTER).agg(F.max("number")).first()[0] + 1 if store.exists(POINTER) else 1
    while not store.claim(f"releases/{number}"):
        number += 1
    release = store.spark.range(1).select(F.lit(run).alias("run"), F.lit(number).alias("number"))
    store.append(release, POINTER, release.schema)


def current_run(store: Store) -> str:
    return store.read(POINTER).orderBy(F.desc("number")).first()["run"]


class ReleasedWarehouse(Warehouse):
    """The tables of a released run, each opened when it is first used. There are no raw tables behind it."""

    def __init__(self, store: Store, run: str):
        super().__init__(None, Store(store.spark, store.path(f"runs/{run}")), MONTH)
        self.run = run

    @built_once
    def manifest(self) -> dict[str, T.Row]:
        """The entry of each table."""
        return {r.table_name: r for r in self.store.read(MANIFEST, _MANIFEST).collect()}  # one row per table

    def released(self, name: str) -> DataFrame:
        entry = self.manifest[name]
        return self.store.read(entry.path, T.StructType.fromJson(json.loads(entry.schema)))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RELEASED:
            raise KeyError(f"{name} is not among the released tables")
        return getattr(self, name)

    def verify(self) -> DataFrame:
        """(table_name, issue) of the tables whose rows are not those of the manifest; reads every table once."""
        found = None
        for name, entry in self.manifest.items():
            table = self.released(name)
            now = digest_of(table, digest_columns(name))
            same = F.lit(True)
            for column in ("rows", "digest_a", "digest_b"):
                same = same & (F.col(column) == F.lit(entry[column]))
            issue = F.when(F.col("rows") != entry.rows, F.concat(F.col("rows").cast("string"), F.lit(f" rows, {entry.rows} released")))
            checked = now.where(~same).select(F.lit(name).alias("table_name"), F.coalesce(issue, F.lit("other content")).alias("issue"))
            found = checked if found is None else found.unionByName(checked)
        return found


for _name in RELEASED:
    _table = built_once(lambda self, name=_name: self.released(name))
    _table.__set_name__(ReleasedWarehouse, _name)
    setattr(ReleasedWarehouse, _name, _table)


def open_current(store: Store) -> ReleasedWarehouse:
    """The warehouse of the current run."""
    return ReleasedWarehouse(store, current_run(store))
