"""Filter interaction audit: what each of five filters removes, in every order in which they can be applied.

Every document fails some of the filters; its failures are the bits of a mask, so a part (a source) is told by at most 32 mask
cells, whatever its size. Per part, a walk through the 32 subsets of filters in Gray-code order toggles one filter at a time: each
cell keeps the counter of its active failures, and the running survivors lose a cell whose counter leaves 0 and regain it when the
counter returns there. The survivors of the 32 subsets are stored; every step of every order is the difference of two of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainhouse.llm.common import batch_of, texts, values
from grainhouse.sources.store import Store

FILTERS = "ABCDE"
COPIES = FILTERS.index("E")  # the only filter that looks at other documents
SUBSETS = 1 << len(FILTERS)
ALL = SUBSETS - 1
ORDERS = ["".join(order) for order in permutations(FILTERS)]
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SIGNS = b"#$%&*|"
_MEASURES = ["docs", "good", "toxic"]


def own_failures(text: str) -> int:
    """The mask of the filters that a text fails by itself: short, repetitive, capitals, signs."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    short = len(words) < 50
    repetitive = 100 * len(set(words)) < 65 * len(words)
    capitals = 100 * (len(data) - len(data.translate(None, _CAPITALS))) > 5 * len(text)
    signs = len(data.translate(None, _SIGNS)) < len(data)
    return short | repetitive << 1 | capitals << 2 | signs << 3


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask) of every row; the digest is that of the whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("mask", pa.int32())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = texts(batch)
                digests = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in found]
                yield batch_of(schema, values(batch, "doc_id"), values(batch, "part"), digests, list(map(own_failures, found)))

    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    return docs.select("doc_id", part, "text").mapInArrow(look, "doc_id long, part string, digest binary, mask int")


def mask_cells(docs: DataFrame, labels: DataFrame, store: Store) -> DataFrame:
    """(part, mask, docs, good, toxic): the documents of each part and mask, and how many of them are labelled so.

    A text that many documents share is reduced to a row per part and label before its documents meet. Of those documents the
    ones with the smallest doc_id are first and pass filter E (also as repeated rows); a row without a doc_id has no smaller one
    and passes, too, and makes no other fail. A doc_id with several labels has each of them.
    """
    rows = store.overwrite(measure(docs), "rows")
    marks = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    named = rows.where("doc_id IS NOT NULL").join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    unnamed = rows.where("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    kinds = ["digest", "part", "mask", "good", "toxic"]
    known = named.groupBy("doc_id", *kinds).agg(F.count(F.lit(1)).alias("copies"))
    known = known.groupBy(*kinds).agg(
        F.sum("copies").alias("docs"), F.min(F.struct("doc_id", "copies")).alias("first"), F.lit(0).cast("long").alias("unnamed")
    )
    nameless = unnamed.groupBy(*kinds).agg(F.count(F.lit(1)).alias("docs"))
    nameless = nameless.withColumns({"first": F.lit(None).cast(known.schema["first"].dataType), "unnamed": F.col("docs")})
    found = store.overwrite(known.unionByName(nameless), "texts")
    least = found.where("first IS NOT NULL").groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    passing = F.col("unnamed") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.copies")).otherwise(0)
    split = found.join(least, "digest", "left").withColumn("passing", passing)
    cells = F.array(
        F.struct(F.col("mask"), F.col("passing").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(1 << COPIES)).alias("mask"), (F.col("docs") - F.col("passing")).alias("n")),
    )
    counted = split.select("part", "good", "toxic", F.explode(cells).alias("cell")).select("part", "good", "toxic", "cell.*")
    return (
        counted.where("n > 0")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("docs"),
            F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def walk(cells: np.ndarray) -> np.ndarray:
    """The survivors of every subset of filters, from the cells of every mask; axis 1 is the mask, and the subset in the result."""
    masks = np.arange(SUBSETS)
    states = np.empty_like(cells)
    failing = np.zeros(SUBSETS, np.int64)  # active failures of each cell
    running = cells.sum(axis=1)
    states[:, 0] = running
    subset = 0
    for step in range(1, SUBSETS):
        toggled = step & -step  # the filter in which this word of the Gray code differs from the last
        subset ^= toggled
        holds = (masks & toggled) > 0
        if subset & toggled:
            failing[holds] += 1
            running = running - cells[:, holds & (failing == 1)].sum(axis=1)
        else:
            failing[holds] -= 1
            running = running + cells[:, holds & (failing == 0)].sum(axis=1)
        states[:, subset] = running
    return states


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step from 1, filter, subset before it) of every step of every order."""
    found = []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            at = FILTERS.index(letter)
            found.append((order, step, at, before))
            before |= 1 << at
    return found


def audit(cells: DataFrame) -> DataFrame:
    """The result rows of mask cells (part, mask, docs, good, toxic): 600 for each part, zeros included."""
    steps = _steps()
    orders, numbers, at, before = map(list, zip(*steps, strict=True))
    at, before = np.array(at), np.array(before)
    after = before | 1 << at
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    schema = pa.schema(
        [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((n, pa.int64()) for n in names)]
    )
    one = 1 << np.arange(len(FILTERS))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(values(batch, "part"), values(batch, "cells"), strict=True):
                yield batch_of(schema, *rows(part, found))

    def rows(part: str, found: list[dict[str, int]]) -> list[Any]:
        table = np.zeros((1, SUBSETS, len(_MEASURES)), np.int64)
        for cell in found:
            table[0, cell["mask"]] = [cell[m] for m in _MEASURES]
        states = walk(table)[0]
        lost = states[before] - states[after]
        fails = states[0, 0] - states[one, 0]
        alone = states[ALL ^ one, 0] - states[ALL, 0]
        shapley = np.zeros(len(FILTERS), np.int64)
        for subset in range(SUBSETS):
            size = subset.bit_count()
            for f in range(len(FILTERS)):
                if not subset >> f & 1:
                    orders_through = factorial(size) * factorial(len(FILTERS) - 1 - size)
                    shapley[f] += orders_through * (states[subset, 0] - states[subset | 1 << f, 0])
        numbers_of = [states[after, 0], lost[:, 0], fails[at] - lost[:, 0], alone[at], lost[:, 1], lost[:, 2], shapley[at]]
        return [[part] * len(steps), orders, numbers, *numbers_of]

    cell = F.struct("mask", *_MEASURES)
    parts = cells.groupBy("part").agg(F.collect_list(cell).alias("cells"))  # 32 at most
    fields = "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in names)
    return parts.mapInArrow(look, fields)


def filter_audit(docs: DataFrame, labels: DataFrame, store: Store) -> DataFrame:
    """Rows (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    ``docs`` has doc_id, text and source, ``labels`` doc_id, quality and toxic; other columns are ignored, whatever their names.
    Null texts are empty, a null source is the part "". Rows count as often as they are repeated. An empty table has no part and
    no rows; without labels, ``good_lost`` and ``toxic_lost`` are 0.
    """
    return audit(mask_cells(docs, labels, store))
