"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A text is a set of five-word shingles. A sketch has ``COORDINATES`` bins. In round i every element falls into one bin by a hash of
its own round, and an empty bin keeps the smallest value it gets; after as many rounds as there are bins come rounds in which all
elements meet one bin after the other, so every bin fills, also for a set of one element. Two sets agree in a bin with a
probability of their Jaccard similarity, concentrated like independent samples.

``ROWS`` coordinates make a band. Equal sets are one node of the graph. Nodes that share a band meet in a bucket; a bucket never
lists all its pairs. Each round picks centres, nodes of a bucket's smallest components and among them those with the most company,
doubling their number, and compares them with the members of other components; a centre then leaves its bucket. From the second
round on, a node that is a centre anywhere is one in all its buckets, and a pair is compared in the first bucket that it ever shared.
Shingles of at most ``RARE`` nodes are set apart there: pairs that need one of them are listed by these shingles, and nodes that
cannot reach the threshold by their other shingles leave the buckets. The loop ends when no bucket holds two components, so every
pair that shares a band has been compared, is out of reach or is connected already.
Pairs whose sketches agree too little are out of reach of the threshold (six standard deviations); all others are confirmed on
their full sets of 64-bit shingle hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainhouse.llm.common import batch_of, broadcast_checked, runs, small_batches, texts, values
from grainhouse.llm.components import connected_components
from grainhouse.sources.store import Store

SHINGLE = 5
PERCENT = 85  # linked from this similarity, unless the caller gives another one
ROWS = 5
BANDS = 25
COORDINATES = ROWS * BANDS
RARE = 8  # nodes of a shingle whose pairs are listed: at most 3.5 for each place of a shingle
BATCH_CHARS = 500_000
MEMO_WORDS = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


class _Hashes(dict):
    """64-bit hash of each word seen."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SALTS = _mix(np.arange(1, 4 * COORDINATES, dtype=np.uint64) * _ODD)


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text; A-Z are lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    flat = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    found = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        found = _mix(found * _ODD + flat[k : len(flat) - n + 1 + k])
    return np.unique(found)


def least_agreeing(percent: int) -> int:
    """Percent of the sketch: the similarity less six standard deviations of its coordinates, rounded down (65 at 85, 58 at 80)."""
    p = percent / 100
    return max(0, math.floor(100 * (p - 6 * math.sqrt(p * (1 - p) / COORDINATES))))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``COORDINATES`` values per set; rows of empty sets are all ones."""
    sizes = np.array([*map(len, sets)])
    out = np.full((len(sets), COORDINATES), _TOP)
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    bins = np.uint64(COORDINATES)
    for r in range(2 * COORDINATES):
        if not len(flat):
            break
        value = _mix(flat + _SALTS[r])
        bin_ = (value % bins if r < COORDINATES else np.full(len(flat), r - COORDINATES)).astype(np.int64)
        # the round in the upper bits: a bin that is full keeps what it has
        np.minimum.at(out.reshape(-1), owner * COORDINATES + bin_, (np.uint64(r) << np.uint64(55)) | (_mix(value) >> np.uint64(9)))
        open_ = (out == _TOP).any(1)
        left = open_[owner]
        flat, owner = flat[left], owner[left]
    return out


_SKETCH = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())]
    + [("_text", pa.string())]
)


def sketch_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, bands, sketch, _text) of every row; node is a 128-bit hash of the set, null for texts without
    words, and ``_text`` tells rows without a doc_id apart."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, own, named = texts(batch), values(batch, "doc_id"), batch.column("_text")
            for start, end in runs(map(len, found), BATCH_CHARS):
                sets = [shingles(t) for t in found[start:end]]
                rows = sketches(sets)
                bands = np.zeros((len(sets), BANDS), np.uint64)
                for k in range(ROWS):
                    bands = _mix(bands * _ODD + rows[:, k::ROWS] + np.uint64(1))
                flat = pa.array(bands.view(np.int64).reshape(-1))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), flat)
                short = _mix(rows).astype(np.uint8)  # eight bits a coordinate: enough to count those that agree
                node = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                kept = named.slice(start, end - start)
                yield batch_of(_SKETCH, own[start:end], [*map(len, sets)], node, lists, [r.tobytes() for r in short], kept)

    fields = "doc_id long, n_shingles long, node binary, bands array<long>, sketch binary, _text string"
    return docs.select("doc_id", "text", _text_of_nameless()).mapInArrow(sketch, fields)


def _text_of_nameless() -> Column:
    return F.when(F.col("doc_id").isNull(), F.sha2(F.coalesce("text", F.lit("")), 256)).alias("_text")


def _several(held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, component sizes) of buckets that hold several components."""
    sizes = held.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("_size"))
    open_ = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("bucket")
    return held.join(open_, "bucket"), sizes


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _within_reach(held: DataFrame, sets: DataFrame, places: DataFrame, percent: int, store: Store, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows of ``held`` that may have a link in their bucket by common shingles, pairs (a, b) that need a rare one).

    A pair of sets of n and m shingles is linked if they share at least percent / (100 + percent) of n + m. Two sets that share no
    rare shingle, one of at most ``RARE`` sets here, share no more than the common ones of either, and no partner is smaller than
    the smallest set of the bucket. The rows get ``_size_of`` and ``_common`` of their sets and ``_buckets``; a pair that common
    shingles do not bring to the threshold is among the pairs here if it shares a rare one and a bucket.
    """
    schema = pa.schema([("node", pa.binary()), ("shingle", pa.int64())])

    def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(s, np.int64) for s in values(batch, "shingles")]
            for start, end in runs(map(len, found), BATCH_CHARS):
                owner = np.repeat(np.arange(start, end), [*map(len, found[start:end])])
                yield batch_of(schema, batch.column("node").take(pa.array(owner)), pa.array(np.concatenate(found[start:end])))

    of_node = held.groupBy("node").agg(F.first("component").alias("component"))
    live = sets.join(of_node, "node")
    owners = live.select("node", "shingles").mapInArrow(one_by_one, "node binary, shingle long")
    few = owners.groupBy("shingle").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") <= RARE)
    rare = store.overwrite(owners.join(few, "shingle"), name)
    apart = rare.groupBy("node").agg(F.count_if(F.col("_n") == 1).alias("_alone"), F.count(F.lit(1)).alias("_rare"))
    size = (F.length("shingles") / 8).cast("long")
    known = live.select("node", "component", size.alias("_size_of")).join(apart, "node", "left")
    without = {c: F.col("_size_of") - F.coalesce(of, F.lit(0)) for c, of in (("_known", "_alone"), ("_common", "_rare"))}
    known = known.withColumns(without).join(places.select("node", "_buckets"), "node").drop("_alone", "_rare")

    shared = rare.where("_n > 1")
    pairs = shared.select("shingle", F.col("node").alias("a")).join(shared.select("shingle", F.col("node").alias("b")), "shingle")
    pairs = pairs.where(F.col("a") < F.col("b")).select("a", "b").distinct()
    left, right = (known.select([F.col(c).alias(end if c == "node" else end + c) for c in known.columns]) for end in ("a", "b"))
    pairs = pairs.join(left, "a").join(right, "b").where(F.col("acomponent") != F.col("bcomponent"))
    need = percent * (F.col("a_size_of") + F.col("b_size_of"))
    pairs = pairs.where(((100 + percent) * F.least("a_known", "b_known") >= need) & ((100 + percent) * F.least("a_common", "b_common") < need))
    pairs = pairs.where(F.arrays_overlap("a_buckets", "b_buckets")).select("a", "b")

    held = held.join(known.drop("component", "_known"), "node")
    least = held.groupBy("bucket").agg(F.min("_size_of").alias("_least"))
    reach = (100 + percent) * F.col("_common") >= percent * (F.col("_size_of") + F.col("_least"))
    return held.join(least, "bucket").where(reach).drop("_least"), pairs


def _centres(held: DataFrame, many: int, percent: int, store: Store, name: str) -> tuple[DataFrame, DataFrame]:
    """(pairs to compare, members that stay) of buckets that hold several components.

    The centres of a bucket are its first ``many`` nodes, those of its smallest components first. They are compared with every member
    of another component and then leave the bucket.
    """
    if "_buckets" in held.columns:
        several, sizes = _several(held)
        first = several.join(sizes, ["bucket", "component"])
    else:  # the first round, where every node is a component
        first = held.withColumn("_size", F.lit(1))
    place = Window.partitionBy("bucket").orderBy("_size", F.desc("_weight"), "node")  # cut to ``many`` rows before the shuffle
    first = first.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= many)
    first = store.overwrite(first.select("bucket", F.col("node").alias("_centre"), F.col("component").alias("_own")), name)
    a, b = F.least("_centre", "node").alias("a"), F.greatest("_centre", "node").alias("b")
    if "_buckets" not in held.columns:
        pairs = held.join(first, "bucket").where(F.col("component") != F.col("_own")).select(a, b).distinct()
        rest = held.join(first.select("bucket", F.col("_centre").alias("node")), ["bucket", "node"], "left_anti")
        return pairs, rest.select("bucket", "node", "_weight")
    marks = first.select(F.col("_centre").alias("node"), F.lit(True).alias("_is_centre")).distinct()
    held = held.join(marks, "node", "left").withColumn("_is_centre", F.col("_is_centre").isNotNull())
    own = {"node": "_centre", "component": "_own", "_size_of": "_own_size", "_common": "_own_common", "_buckets": "_own_buckets"}
    centres = held.where("_is_centre").select("bucket", *own).withColumnsRenamed(own)
    reach = (100 + percent) * F.least("_common", "_own_common") >= percent * (F.col("_size_of") + F.col("_own_size"))
    # a pair belongs to the first bucket that it ever shared: where one of them is no longer there, the pair is settled
    once = F.col("bucket") == F.array_min(F.array_intersect("_buckets", "_own_buckets"))
    twice = F.col("_is_centre") & (F.col("node") < F.col("_centre"))
    pairs = held.join(centres, "bucket").where((F.col("component") != F.col("_own")) & reach & ~twice & once)
    return pairs.select(a, b), held.where("not _is_centre").select("bucket", "node", "_weight")


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches agree in as much as ``percent`` of similarity leaves likely."""
    least = least_agreeing(percent)
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(values(batch, c)), np.uint8).reshape(-1, COORDINATES) for c in ("sa", "sb"))
            keep = 100 * (left == right).sum(1) >= least * COORDINATES
            yield batch.select(["a", "b"]).filter(pa.array(keep)).cast(schema)

    sketch = nodes.select("node", "sketch")
    found = pairs.join(sketch.withColumnsRenamed({"node": "a", "sketch": "sa"}), "a")
    found = found.join(sketch.withColumnsRenamed({"node": "b", "sketch": "sb"}), "b")
    return found.select("a", "b", "sa", "sb").mapInArrow(agree, "a binary, b binary")


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of wanted nodes (node, doc_id), from the text of the row that stands for each."""
    schema = pa.schema([("node", pa.binary()), ("shingles", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, found = values(batch, "node"), texts(batch)
            for start, end in runs(map(len, found), BATCH_CHARS):
                # another text may have the same doc_id
                own = [(n, s.tobytes()) for n, t in zip(nodes[start:end], found[start:end], strict=True) if xxhash.xxh3_128_digest((s := shingles(t)).tobytes()) == n]
                yield batch_of(schema, [n for n, _ in own], [s for _, s in own])

    rows = docs.select("doc_id", "text").join(broadcast_checked(wanted.select("node", "_doc_id")), F.col("doc_id").eqNullSafe(F.col("_doc_id"))).select("node", "text")
    return rows.mapInArrow(sets, "node binary, shingles binary").dropDuplicates(["node"])


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that reach ``percent`` on their full sets."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                left, right = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                least, most = sorted((len(left), len(right)))
                shared = len(np.intersect1d(left, right, assume_unique=True)) if 100 * least >= percent * most else 0
                keep.append(100 * shared >= percent * (least + most - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_())).cast(schema)

    found = pairs.join(sets.withColumnsRenamed({"node": "a", "shingles": "sa"}), "a")
    found = found.join(sets.withColumnsRenamed({"node": "b", "shingles": "sb"}), "b")
    return found.select("a", "b", "sa", "sb").mapInArrow(compare, "a binary, b binary")


def near_duplicates(docs: DataFrame, store: Store, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable over links of similarity ``percent`` or more, ``kept`` is doc_id = component_id.
    Texts without words have an empty set, are linked with nothing, and are kept. Rows that share a doc_id and have different
    texts are told apart by their sets; repeated rows all get their doc_id's result. A row without doc_id links others, takes
    part in their component, is never its name, and is kept only where no row of its component has a doc_id.
    Other columns are ignored.
    """
    judged = _judged(docs, store, percent)
    return judged.select("doc_id", "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("doc_id")).alias("kept"))


def _judged(docs: DataFrame, store: Store, percent: int) -> DataFrame:
    """(doc_id, n_shingles, node, component, component_id, _text) of every row."""
    with small_batches(docs.sparkSession):
        return _components(docs, store, percent)


def _components(docs: DataFrame, store: Store, percent: int) -> DataFrame:
    found = store.overwrite(sketch_documents(docs), "sketches")
    nodes = found.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("_doc_id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    nodes = store.overwrite(nodes, "nodes")
    rows = nodes.select("node", F.posexplode("bands").alias("_band", "_key"))
    rows = rows.select("node", F.xxhash64("_band", "_key").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    places = rows.join(shared, "bucket").groupBy("node").agg(F.sum("_n").alias("_weight"), F.collect_set("bucket").alias("_buckets"))
    places = store.overwrite(places, "places")
    members = store.overwrite(places.select(F.explode("_buckets").alias("bucket"), "node", "_weight"), "members_0")

    def sets_of(ends: DataFrame, name: str) -> DataFrame:
        return store.overwrite(_full_sets(docs, nodes.select("node", "_doc_id").join(ends, "node")), name)

    spark = docs.sparkSession
    labels = spark.createDataFrame([], "node binary, component binary")
    k, sets = 0, None
    while True:
        held = members.withColumn("component", F.col("node"))
        if k:
            held = store.overwrite(_several(_labelled(members, labels))[0], f"open_{k}")
            if held.isEmpty():
                break
            if sets is None:  # of all nodes that are left, for this round and the later ones
                sets = sets_of(held.select("node").distinct(), "sets")
            held, listed = _within_reach(held, sets, places, percent, store, f"rare_{k}")
            held = store.overwrite(held, f"held_{k}")
        pairs, rest = _centres(held, 1 << k, percent, store, f"centres_{k}")
        pairs = store.overwrite(pairs.unionByName(listed) if k else pairs, f"pairs_{k}")
        members = store.overwrite(rest, f"members_{k + 1}")
        plausible = store.overwrite(_plausible(pairs, nodes, percent), f"plausible_{k}")
        full = sets if sets is not None else sets_of(plausible.select(F.col("a").alias("node")).union(plausible.select("b")).distinct(), f"sets_{k}")
        new = store.overwrite(_confirm(plausible, full, percent), f"links_{k}")
        for name in (f"members_{k}", f"sets_{k}", f"open_{k}", f"rare_{k}", f"held_{k}", f"centres_{k}", f"pairs_{k}", f"plausible_{k}"):
            store.remove(name)
        if not new.isEmpty():
            # the components so far are stars, which stand for the links that made them
            stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
            labels = connected_components(stars.union(new), store, f"components_{k}")
        k += 1

    named = nodes.select("node", "_doc_id").join(labels, "node", "left")
    named = named.select("node", "_doc_id", F.coalesce("component", "node").alias("component"))
    ids = named.groupBy("component").agg(F.min("_doc_id").alias("component_id"))
    named = store.overwrite(named.join(ids, "component").select("node", "component", "component_id"), "named")
    out = found.select("doc_id", "n_shingles", "node", "_text").join(named, "node", "left")
    return out.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, store: Store, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, with all their columns; of rows with one doc_id and one text, one.

    A doc_id of several texts stays if one of them is kept. Of the rows without a doc_id of a component one stays, if no row of
    the component has a doc_id: the one whose text has the smallest hash.
    """
    judged = store.overwrite(_judged(docs, store, percent).drop("n_shingles"), "judged")
    judged = judged.withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))
    fate = judged.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows"))
    stay = docs.where("doc_id IS NOT NULL").join(fate.where("not _kept").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    repeated = fate.where("_kept and _rows > 1").select("doc_id")
    once = stay.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    one = stay.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    # a text without words is a component of its own
    nameless = judged.where("doc_id IS NULL AND component_id IS NULL").withColumn("_own", F.coalesce(F.hex("component"), F.hex("node"), "_text"))
    texts_kept = nameless.groupBy("_own").agg(F.min("_text").alias("_kept_text")).select("_kept_text")
    rows = docs.where("doc_id IS NULL")
    first = rows.join(texts_kept, _text_of_nameless() == F.col("_kept_text"), "left_semi").dropDuplicates(["text"])
    return once.unionByName(one).unionByName(first)
