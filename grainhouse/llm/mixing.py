"""Mixing sources to target weights by fitting a budget of words exactly.

Every source gets a share of the words by its weight, at most ``MOST`` times its own size. Whole epochs come first; what is left of
a target is filled with documents taken once more. Documents are counted by exact length: every length gives the same share of
its documents, fractions are rounded up from the largest while the budget lasts, and a bounded knapsack (subset sums over the
counts by length) finds the sum nearest to the rest. Which documents of a length are taken is decided by a seeded hash, so
reruns agree. Only the counts by length meet in one place; texts and ids never do.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainhouse.llm.common import WORD, broadcast_checked
from grainhouse.sources.store import Store

WEIGHTS = (3, 1, 2)  # of the sources by code point, repeating; null last
SHARE = 1.5  # words of the mix, as a multiple of all words
MOST = 2  # times that a document may be taken
KNAPSACK_WORDS = 50_000  # of a budget are left to the knapsack, at most (or one length more)
SEED = 20240607
_BUCKET_SHIFT = 54  # a length of very many documents is ranked in 2^(64 - 54) parts of the hash range


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Target words of each source: shares by weight, cut at ``most`` times the source's size, the excess shared anew."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    found: dict[str | None, float] = {}
    budget, open_ = share * sum(sizes.values()), order
    while open_:
        total = sum(weight[s] for s in open_)
        own = {s: budget * weight[s] / total for s in open_}
        full = [s for s in open_ if own[s] > most * sizes[s]]
        if not full:
            return found | own
        for s in full:
            found[s] = float(most * sizes[s])
            budget -= found[s]
        open_ = [s for s in open_ if s not in found]
    return found


def fill(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take so that their lengths sum up to ``budget``, or as near below as can be."""
    counts = {length: n for length, n in counts.items() if length > 0 and n > 0}
    total = sum(length * n for length, n in counts.items())
    if budget >= total:
        return counts
    taken = {length: n * budget // total for length, n in counts.items()}
    left = budget - sum(length * n for length, n in taken.items())
    order = sorted(counts, key=lambda x: (-(counts[x] * budget % total), -x))
    for length in order:
        if left > KNAPSACK_WORDS and taken[length] < counts[length] and length <= left:
            taken[length] += 1
            left -= length
    # bounded knapsack over bits: bit s of ``reach`` says that s words can be made; counts are split into powers of two
    reach, steps, mask = 1, [], (1 << (left + 1)) - 1
    for length in order:
        rest, part = counts[length] - taken[length], 1
        while rest > 0 and part * length <= left and not reach >> left & 1:
            part = min(part, rest)
            steps.append((reach, length, part))
            reach |= reach << (part * length) & mask
            rest, part = rest - part, 2 * part
    at = reach.bit_length() - 1
    for before, length, part in reversed(steps):
        if not before >> at & 1:
            taken[length] += part
            at -= part * length
    return taken


def _thresholds(sized: DataFrame, chosen: DataFrame) -> DataFrame:
    """(source, size, _cut): documents of the length are taken whose hash is at most ``_cut``, as many as ``chosen`` says.

    Ranks run within (source, length, part of the hash range), so documents of one length never have to fit one task.
    """
    keys = ["_source", "size"]
    rows = sized.select(*keys, "_hash", F.shiftright("_hash", _BUCKET_SHIFT).alias("_bucket"))  # keeps the order of hashes
    counted = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most 1024 rows
    parts = counted.join(chosen, keys).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    cut = parts.where("_before < take and take <= _before + _n").select(*keys, "_bucket", (F.col("take") - F.col("_before")).alias("_rank"))
    place = Window.partitionBy(*keys, "_bucket").orderBy("_hash")
    at = rows.join(cut, [*keys, "_bucket"]).withColumn("_place", F.row_number().over(place))
    return at.where("_place = _rank").select(*keys, F.col("_hash").alias("_cut"))


def mix(docs: DataFrame, store: Store, seed: int = SEED) -> DataFrame:
    """(_row, size, source_size, target, copies): each row of ``docs`` as a struct, and how often the mix takes it (0 to ``MOST``).

    The driver sees one row per source; counts by length meet per source. Null and empty texts have size 0 and are taken once. A null source is a source, the
    last. Rows that are equal in doc_id and text hash alike: where a cut falls among them all or none of them are taken once more,
    which can move a source's sum by their words. Columns of ``docs`` that have the names of added ones are replaced.
    """
    # the row travels as one column, so its names cannot clash with those used here
    keyed = docs.select(
        F.struct("*").alias("_row"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_source"),  # null sources must join, too
        word_count().alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("_hash"),
    )
    sized = store.overwrite(keyed.select("_source", "size", "_hash"), "sizes")
    by_length = sized.groupBy("_source", "size").agg(F.count(F.lit(1)).alias("n"))
    by_length = store.overwrite(by_length, "lengths")
    totals = by_length.groupBy("_source").agg(F.sum(F.col("size") * F.col("n")).alias("s")).collect()
    sizes = {r["_source"]: r["s"] for r in totals}
    aims = targets({s[1:] if s else None: n for s, n in sizes.items()})
    aims = {s: aims[s[1:] if s else None] for s in sizes}
    epochs = {s: min(MOST, int(aims[s] // sizes[s])) if sizes[s] else 1 for s in sizes}

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        source = group["_source"].iloc[0]
        budget = round(aims[source]) - epochs[source] * sizes[source] if sizes[source] and epochs[source] < MOST else 0
        found = fill(dict(zip(group["size"].tolist(), group["n"].tolist(), strict=True)), max(0, budget))
        rows = [(source, length, n) for length, n in found.items() if n and budget > 0]
        return pd.DataFrame(rows, columns=["_source", "size", "take"]).astype({"size": "int64", "take": "int64"})

    # one row per length of a source, at most about the square root of twice its words
    chosen = by_length.groupBy("_source").applyInPandas(choose, "_source string, size long, take long")
    chosen = store.overwrite(chosen, "chosen")
    cuts = store.overwrite(_thresholds(sized, chosen), "cuts")
    rows = docs.sparkSession.createDataFrame(
        [(s, sizes[s], float(aims[s]), epochs[s]) for s in sizes], "_source string, source_size long, target double, _epochs int"
    )
    out = keyed.join(F.broadcast(rows), "_source", "left")  # one row per source
    out = out.join(broadcast_checked(cuts), ["_source", "size"], "left")
    extra = (F.col("_hash") <= F.col("_cut")).cast("int")
    copies = F.when(F.col("size") == 0, 1).otherwise(F.col("_epochs") + F.coalesce(extra, F.lit(0)))
    return out.select("_row", "size", "source_size", "target", copies.alias("copies"))


def mixture(docs: DataFrame, store: Store) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    found = mix(docs.select("doc_id", "text", "source"), store)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return found.select("_row.doc_id", "size", "source_size", "target", taken)


def repeat_rows(docs: DataFrame, store: Store) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``docs``."""
    found = mix(docs, store).where("copies > 0")
    return found.select("_row", F.explode(F.sequence(F.lit(1), "copies"))).select("_row.*")
