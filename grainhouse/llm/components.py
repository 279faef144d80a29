"""Connected components of a graph that never leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainhouse.sources.store import Store


def _state(edges: DataFrame) -> tuple:
    """Count and sum of hashes, which tell whether a round has changed the edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, store: Store, name: str) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node.

    Alternating large-star and small-star steps: every node passes its smallest neighbour on to its larger neighbours, then to its
    smaller ones, until the edges are stars around the smallest nodes. A step is an aggregate and a join back, so a node with very
    many neighbours never has to fit one task. Each round is written, which cuts lineage. Null ends are left out.
    """
    links = edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    now = store.overwrite(links.where(F.col("low").isNotNull()).distinct(), f"{name}_0")
    done, last = 0, _state(now)
    while True:
        both = now.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            now.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        least = both.groupBy("node").agg(F.min("other").alias("_least"))
        near = least.select("node", F.least("node", "_least").alias("low"))
        # large star: larger neighbours move to the smallest node around
        moved = both.where(F.col("other") > F.col("node")).join(near, "node").select("low", F.col("other").alias("high"))
        moved = moved.where(F.col("low") != F.col("high"))  # at most one row an edge; the end of the step leaves each once
        # small star: smaller neighbours, and the node itself, move to the smallest of them
        least = moved.groupBy("high").agg(F.min("low").alias("_least"))
        pairs = moved.join(least, "high")
        small = pairs.select(F.col("_least").alias("low"), F.col("low").alias("high")).unionByName(
            least.select(F.col("_least").alias("low"), "high")
        )
        done += 1
        now = store.overwrite(small.where(F.col("low") != F.col("high")).distinct(), f"{name}_{done}")
        state = _state(now)
        if state == last:
            break
        last = state
    return now.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )
