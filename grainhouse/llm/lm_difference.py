"""Cross-entropy difference scoring: how much better a target model predicts a text than a background model.

Both models are bigram models over one vocabulary: every word that the corpus holds ``LEAST_COUNT`` times or more, and classes by
shape for words seen once, which no other text can share. They are matched: same vocabulary, same smoothing (absolute discounting
to a unigram model that has seen every symbol once), and the background's counts are scaled to the mass of the target's. The
background is every document, the target the documents that the caller marks. Every bigram of every document is counted.

The models grow with the corpus and are never in one place. Documents are cut into chunks; a chunk sends its distinct pairs and
symbols, summed, to buckets by a hash of the pair or symbol, and the buckets send back the totals of those that the chunk holds.
Symbols are 64-bit hashes of words, pairs 64-bit hashes of symbols.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainhouse.llm.common import batch_of, broadcast_checked, runs, scratch, small_batches, texts, values
from grainhouse.sources.store import Store

SYMBOLS = 2048  # the unigram model has room for so many symbols at least
LEAST_COUNT = 2  # a word seen less often is one of its class; 2, so that it is in one place alone
EDGE = 0  # begins and ends a text
CLASSES = 33  # the edge and the classes of other words come first
DISCOUNT = 0.75
CHUNK_TOKENS = 1_000_000  # a longer text is a chunk of its own
SUM_KEYS = 1_000_000  # sums of buckets that a task adds up before it deals them
BATCH_BYTES = 4 << 20  # rows that a Python worker hands back at once
_CODEC = "spark.sql.parquet.compression.codec"
# A writer holds a row group in memory, and a reader decodes up to 4,096 rows of it at once. Rows here take kilobytes to megabytes.
_GROUP_BYTES, _GROUP_ROWS = "parquet.block.size", "parquet.block.row.count.limit"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # a table's shuffles go when it is written
_ODD = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"\w+|[^\w\s]+")
_HAS_DIGIT = re.compile(r"\d")


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_class(word: str) -> int:
    """The class of a word outside the vocabulary: by length, digits and script (1 to 32)."""
    size = min(len(word).bit_length(), 7)  # 1 to 7
    kind = 0 if not word[0].isalnum() else 1 if _HAS_DIGIT.search(word) else 2 if word.isascii() else 3
    return 1 + kind * 8 + size


class Vocabulary:
    def __init__(self, words: list[str]):
        self.ids = {w: CLASSES + n for n, w in enumerate(words)}

    def encode(self, text: str) -> np.ndarray:
        """Symbols of a text between two edges."""
        get = self.ids.get
        found = [get(w) or word_class(w) for w in tokens(text)]
        return np.array([EDGE, *found, EDGE], np.int64)


def _blob(values: np.ndarray, dtype: str = "<i8") -> bytes:
    return values.astype(dtype).tobytes()


def _array(blob: bytes, dtype: str = "<i8") -> np.ndarray:
    return np.frombuffer(blob, dtype)


def _packed(numbers: np.ndarray, dtype: str = "<i4") -> bytes:
    """Numbers byte by byte: first all low bytes, last all high ones, which compress away."""
    width = np.dtype(dtype).itemsize
    return numbers.astype(dtype).view("u1").reshape(-1, width).T.tobytes()


def _unpacked(blob: bytes, dtype: str = "<i4") -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, "u1").reshape(width, -1).T).view(dtype).ravel()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(_mix(a + _ODD) + b)


class _Places(dict):
    """The place of each word among those seen so far; place 0 is the edge."""

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self) + 1
        return place


_CHUNK = pa.schema(
    [("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("mass", pa.int64()), ("mass_target", pa.int64())]
    + [(c, pa.binary()) for c in ("words", "counts", "counts_target", "classes", "sizes", "target", "stream")]
)
_CODED = pa.schema([_CHUNK.field(0), _CHUNK.field(1), *((c, pa.binary()) for c in ("symbols", "may", "sizes", "target", "stream"))])


def _chunks(marked: DataFrame) -> DataFrame:
    """Rows (doc_id, text, _target) in chunks of about ``CHUNK_TOKENS``: hashes, counts and classes of the words, and their places.

    The texts of a chunk lie on end with one edge before, between and after them; a chunk's number names its task and place.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0
        ids: list = []
        sizes: list[int] = []
        marks: list[bool] = []
        places, streams, held = _Places(), [np.zeros(1, np.int32)], 0

        def row() -> pa.RecordBatch:
            stream = np.concatenate(streams)
            counts = np.bincount(stream, minlength=len(places) + 1)[1:]
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in places), np.uint64, len(places))
            classes = np.fromiter(map(word_class, places), np.uint8, len(places))
            hashes = np.where(hashes < CLASSES, hashes + np.uint64(CLASSES), hashes)
            marked = np.repeat(marks, sizes)
            counts_target = np.bincount(stream[1:][marked], minlength=len(places) + 1)[1:]
            blobs = [_blob(hashes, "<u8"), _blob(counts), _blob(counts_target), _blob(classes, "u1")]
            blobs += [_blob(np.array(sizes)), _blob(np.array(marks), "u1"), _packed(stream)]
            return batch_of(_CHUNK, [task + made], [ids], [len(marked)], [int(marked.sum())], *([b] for b in blobs))

        for batch in batches:
            for doc_id, text, mark in zip(values(batch, "doc_id"), texts(batch), values(batch, "_target"), strict=True):
                found = tokens(text)
                if ids and held + len(found) >= CHUNK_TOKENS:
                    yield row()
                    made, ids, sizes, marks = made + 1, [], [], []
                    places, streams, held = _Places(), [np.zeros(1, np.int32)], 0
                streams.append(np.fromiter(chain(map(places.__getitem__, found), (EDGE,)), np.int32, len(found) + 1))
                ids.append(doc_id)
                sizes.append(len(found) + 1)
                marks.append(mark)
                held += len(found) + 1
        if ids:
            yield row()

    fields = "chunk long, doc_ids array<long>, mass long, mass_target long, " + ", ".join(f"{f.name} binary" for f in _CHUNK if f.type == pa.binary())
    return marked.select("doc_id", "text", "_target").mapInArrow(cut, fields)


def _coded(chunks: DataFrame, words: DataFrame, many: int, scale: float) -> DataFrame:
    """Chunks whose stream holds places among ``symbols``: words, and classes in place of words with too small a total in ``words``.

    ``may`` has bit 1 where a symbol is in the target, and bit 2 where it is frequent enough to keep a count after the discount.
    """

    def code(left: pa.Table, right: pa.Table) -> pa.Table:
        found = right.to_pylist()
        out = []
        for r in left.to_pylist():
            own = _array(r["words"], "<u8")
            n_target, n = _answers(found, _SYMBOL, own, many, "<i8 <i8")
            may = (n_target > 0) + 2 * (n * scale > DISCOUNT)
            rare = n < LEAST_COUNT
            own = np.append(np.uint64(EDGE), np.where(rare, _array(r["classes"], "u1").astype(np.uint64), own))
            may = np.append(3, np.where(rare, 3, may))
            symbols, first, place_of = np.unique(own, return_index=True, return_inverse=True)
            blobs = [_blob(symbols, "<u8"), _blob(may[first], "u1"), r["sizes"], r["target"], _packed(place_of[_unpacked(r["stream"])])]
            out.append(batch_of(_CODED, [r["chunk"]], [r["doc_ids"]], *([b] for b in blobs)))
        return pa.Table.from_batches(out, _CODED)

    fields = "chunk long, doc_ids array<long>, " + ", ".join(f"{f.name} binary" for f in _CODED if f.type == pa.binary())
    return chunks.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(code, fields)


def _pairs_of(row: dict) -> tuple[np.ndarray, ...]:
    """(places of a, places of b, count in target texts, count, pair of each step, pairs to send) of the distinct pairs of a coded chunk."""
    stream = _unpacked(row["stream"]).astype(np.int64)
    base = len(row["symbols"]) // 8
    keys, at = np.unique(stream[:-1] * base + stream[1:], return_inverse=True)
    marks = np.repeat(_array(row["target"], "u1"), _array(row["sizes"]))
    n_target = np.bincount(at[marks > 0], minlength=len(keys))
    may = _array(row["may"], "u1")
    a, b = keys // base, keys % base
    return a, b, n_target, np.bincount(at, minlength=len(keys)), at, np.flatnonzero(may[a] & may[b])


def _order(keys: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order in which keys are dealt, the buckets that get some, where each begins). Hashed keys spread evenly, however often each occurs."""
    bucket = (_mix(keys) % np.uint64(many)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, *np.unique(bucket[order], return_index=True)


def _in_batches(schema: pa.Schema, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``BATCH_BYTES``; a larger row is a batch of its own."""
    sizes = (sum(len(v) for v in row if isinstance(v, bytes)) for row in rows)
    for start, end in runs(sizes, BATCH_BYTES):
        yield batch_of(schema, *map(list, zip(*rows[start:end], strict=True)))


def _dealt(chunk: int | None, keys: np.ndarray, many: int, numbers: str, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A chunk's symbols a (and b, for pairs) with two numbers each, one row per bucket of their keys."""
    order, found, start = _order(keys, many)
    cuts = [np.split(c[order], start[1:]) for c in columns]
    symbols = [[p.tobytes() for p in cut] for cut in cuts[:-2]]
    if len(symbols) == 1:
        symbols.append([None] * len(found))
    rows = zip(found.tolist(), [chunk] * len(found), *symbols, *([_packed(p, numbers) for p in cut] for cut in cuts[-2:]), strict=True)
    yield from _in_batches(_DEALT, list(rows))


def _answers(found: list[dict], kind: int, keys: np.ndarray, many: int, dtypes: str) -> list[np.ndarray]:
    """Columns x, y, … of the rows of a kind that came back to a chunk, in the order of its ``keys``."""
    rows = sorted((r for r in found if r["kind"] == kind), key=lambda r: r["bucket"])
    order = _order(keys, many)[0]
    out = []
    for name, dtype in zip("xyuv", dtypes.split(), strict=False):
        column = np.empty(len(keys), dtype)
        column[order] = np.concatenate([np.empty(0, dtype), *(_unpacked(r[name], dtype) for r in rows)])
        out.append(column)
    return out


_DEALT = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64())] + [(c, pa.binary()) for c in ("a", "b", "x", "y")])
_DEALT_FIELDS = "bucket long, chunk long, a binary, b binary, x binary, y binary"
_FOUND = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int32())] + [(c, pa.binary()) for c in ("keys", "x", "y", "u", "v")])
_FOUND_FIELDS = "chunk long, bucket long, kind int, keys binary, x binary, y binary, u binary, v binary"
_PAIR, _SUM, _SYMBOL = range(3)


def _pair_totals(coded: DataFrame, many: int, scale: float) -> DataFrame:
    """Totals of the pairs that keep a count after the discount in either model: for each chunk that holds them, and summed by their first symbol.

    All other pairs have the same loss as a pair never seen, so nothing of them is needed again. A pair is no more frequent than
    either of its symbols, so most of the others are known before they are sent.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                symbols = _array(r["symbols"], "<u8")
                a, b, n_target, n, _, sent = _pairs_of(r)
                a, b = symbols[a[sent]], symbols[b[sent]]
                yield from _dealt(r["chunk"], _pair_keys(a, b), many, "<i8", a, b, n_target[sent], n[sent])

    def total(group: pa.Table) -> pa.Table:
        a, b = (np.concatenate([_array(x.as_buffer(), "<u8") for x in group.column(c)]) for c in ("a", "b"))
        x, y = (np.concatenate([_unpacked(v.as_buffer(), "<i8") for v in group.column(c)]) for c in ("x", "y"))
        sizes = [len(v.as_buffer()) // 8 for v in group.column("x")]
        keys, first, at = np.unique(_pair_keys(a, b), return_index=True, return_inverse=True)
        n_target, n = (np.bincount(at, v, len(keys)).astype(np.int64) for v in (x, y))
        kept = np.maximum(n_target - DISCOUNT, 0), np.maximum(n * scale - DISCOUNT, 0)
        counts = (kept[0] > 0) | (kept[1] > 0)
        n_target, n = n_target * counts, n * counts
        bucket = group.column("bucket")[0].as_py()
        rows = [
            (chunk, bucket, _PAIR, None, _packed(n_target[own], "<i8"), _packed(n[own], "<i8"), None, None)
            for chunk, own in zip(group.column("chunk").to_pylist(), np.split(at, np.cumsum(sizes)[:-1]), strict=True)
        ]
        begins, by = np.unique(a[first][counts], return_inverse=True)
        sums = [np.bincount(by, k[counts], len(begins)).tobytes() for k in kept]
        rows.append((None, bucket, _SUM, begins.tobytes(), None, None, *sums))
        return pa.Table.from_batches(_in_batches(_FOUND, rows), _FOUND)

    return coded.mapInArrow(deal, _DEALT_FIELDS).groupBy("bucket").applyInArrow(total, _FOUND_FIELDS)


def _key_totals(group: pa.Table) -> pa.Table:
    """For each chunk of a bucket the totals of its keys: counts of the chunks, then what rows without a chunk add.

    One more row without a chunk has the number of keys that occur ``LEAST_COUNT`` times or more.
    """
    parts = [_array(s.as_buffer(), "<u8") for s in group.column("a")]
    chunks = group.column("chunk").to_pylist()
    dtypes = ["<f8" if c is None else "<i8" for c in chunks]
    x, y = (np.concatenate([_unpacked(v.as_buffer(), t) for v, t in zip(group.column(c), dtypes, strict=True)]) for c in ("x", "y"))
    keys, at = np.unique(np.concatenate(parts), return_inverse=True)
    is_sum = np.repeat([c is None for c in chunks], [*map(len, parts)])
    found = [np.bincount(at[w], v[w], len(keys)) for w in (~is_sum, is_sum) for v in (x, y)]
    bucket = group.column("bucket")[0].as_py()
    rows = [
        (c, bucket, _SYMBOL, None, *(_packed(f[own], t) for f, t in zip(found, ("<i8", "<i8", "<f8", "<f8"), strict=True)))
        for c, own in zip(chunks, np.split(at, np.cumsum([*map(len, parts)])[:-1]), strict=True)
        if c is not None
    ]
    rows.append((None, bucket, _SYMBOL, None, _blob(np.array([(found[1] >= LEAST_COUNT).sum()])), None, None, None))
    return pa.Table.from_batches(_in_batches(_FOUND, rows), _FOUND)


def _word_totals(chunks: DataFrame, many: int) -> DataFrame:
    """For each chunk its words' counts in the target and in all texts."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words = _array(r["words"], "<u8")
                if len(words):
                    yield from _dealt(r["chunk"], words, many, "<i8", words, _array(r["counts_target"]), _array(r["counts"]))

    rows = chunks.select("chunk", "words", "counts", "counts_target").mapInArrow(deal, _DEALT_FIELDS)
    return rows.groupBy("bucket").applyInArrow(_key_totals, _FOUND_FIELDS)


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, sums u, sums v) of the rows of a task, the same key of several rows once, in parts of about ``SUM_KEYS``.

    Each row is the sums of one bucket and deals to nearly all buckets; dealt one by one they would make the square of the buckets.
    """

    def added() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate(held["keys"]), return_inverse=True)
        return keys, *(np.bincount(at, np.concatenate(held[c]), len(keys)) for c in "uv")

    held: dict[str, list[np.ndarray]] = {"keys": [], "u": [], "v": []}
    size = 0
    for batch in batches:
        for r in batch.to_pylist():
            if r["keys"]:
                for name, dtype in zip(held, ("<u8", "<f8", "<f8"), strict=True):
                    held[name].append(_array(r[name], dtype))
                size += len(held["keys"][-1])
                if size >= SUM_KEYS:
                    yield added()
                    held, size = {name: [] for name in held}, 0
    if size:
        yield added()


def _symbol_totals(coded: DataFrame, sums: DataFrame, many: int) -> DataFrame:
    """For each chunk its symbols' counts in the target and in all texts, and what their pairs keep in both models."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                # an edge is counted once a text, as the end of its own
                symbols, stream = _array(r["symbols"], "<u8"), _unpacked(r["stream"])[1:]
                marks = np.repeat(_array(r["target"], "u1"), _array(r["sizes"]))
                counts = (np.bincount(s, minlength=len(symbols)) for s in (stream[marks > 0], stream))
                yield from _dealt(r["chunk"], symbols, many, "<i8", symbols, *counts)

    def deal_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, u, v in _added_up(batches):
            yield from _dealt(None, keys, many, "<f8", keys, u, v)

    dealt = coded.mapInArrow(deal, _DEALT_FIELDS).union(sums.mapInArrow(deal_sums, _DEALT_FIELDS))
    return dealt.groupBy("bucket").applyInArrow(_key_totals, _FOUND_FIELDS).where("chunk is not null")


def _rate(row: dict, found: list[dict], many: int, scale: float, mass_target: int, mass: int, size: int) -> list[np.ndarray]:
    """[target loss, background loss] of each text of a coded chunk, summed over its steps."""
    symbols = _array(row["symbols"], "<u8")
    n_target, n, kept_target, kept = _answers(found, _SYMBOL, symbols, many, "<i8 <i8 <f8 <f8")
    a, b, _, _, at, sent = _pairs_of(row)
    counts = _answers(found, _PAIR, _pair_keys(symbols[a[sent]], symbols[b[sent]]), many, "<i8 <i8")
    starts = np.append(0, np.cumsum(_array(row["sizes"]))[:-1])
    out = []
    for total, spared, pair_counts, whole, by in (
        (n_target, kept_target, counts[0], mass_target, 1.0), (n * scale, kept, counts[1], mass * scale, scale)
    ):
        unigram = (total + 1) / (whole + size)
        seen = np.maximum(total, 1e-12)
        spare = np.where(total > 0, (total - spared) / seen, 1.0)
        held = np.zeros(len(a))
        held[sent] = np.maximum(pair_counts * by - DISCOUNT, 0)
        loss = -np.log(held / seen[a] + spare[a] * unigram[b])
        out.append(np.add.reduceat(loss[at], starts))
    return out


def score_documents(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every row of ``docs``.

    Losses are means per token, the end of the text counted; ``score`` = target_loss - background_loss, so lower is more like the
    target. Null and empty texts are their end alone. Without target rows the target model knows nothing and is flat. Repeated
    rows count and score as often as they occur; a null doc_id is background; other columns are ignored.
    """
    spark = docs.sparkSession
    # streams and counts lie byte by byte, which zstd packs best
    with _settings(spark, **{_CLEANUP: "true", _CODEC: "zstd", _GROUP_BYTES: str(8 << 20)}), small_batches(spark):
        return _scored(docs, target_ids, scratch(spark, "difference"))


@contextmanager
def _settings(spark: SparkSession, **wanted: str) -> Iterator[None]:
    """Jobs run inside have these settings; the caller's are put back after."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _written_chunks(store: Store, chunks: DataFrame, name: str) -> DataFrame:
    """Write a table with a row per chunk, each a row group of its own, so that a task holds one chunk however many it has."""
    with _settings(store.spark, **{_GROUP_ROWS: "1"}):
        return store.overwrite(chunks, name)


def _scored(docs: DataFrame, target_ids: DataFrame, store: Store) -> DataFrame:
    ids = target_ids.select("doc_id").where("doc_id is not null").distinct().withColumn("_in", F.lit(True))
    marked = docs.select("doc_id", "text").join(broadcast_checked(ids), "doc_id", "left")
    chunks = _written_chunks(store, _chunks(marked.select("doc_id", "text", F.coalesce("_in", F.lit(False)).alias("_target"))), "chunks")
    mass = chunks.agg(F.sum("mass").alias("n"), F.sum("mass_target").alias("target")).first()
    n, n_target = mass.n or 0, mass.target or 0
    scale = n_target / n if n_target else 1.0
    many = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // CHUNK_TOKENS)
    words = store.overwrite(_word_totals(chunks, many), "words")
    kept = words.where("chunk is null").select("x").toArrow().column("x")  # one number a bucket
    size = max(SYMBOLS, CLASSES + sum(int(_array(x.as_buffer())[0]) for x in kept))
    coded = _written_chunks(store, _coded(chunks, words.where("chunk is not null"), many, scale), "coded")
    store.remove("chunks")
    store.remove("words")
    pairs = store.overwrite(_pair_totals(coded, many, scale), "pairs")
    symbols = store.overwrite(_symbol_totals(coded, pairs.where(F.col("kind") == _SUM), many), "symbols")
    found = pairs.where(F.col("kind") == _PAIR).union(symbols)
    names = ("target_loss", "background_loss", "score")
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), *((c, pa.float64()) for c in names)])

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        known = right.to_pylist()
        out = []
        for r in left.to_pylist():
            sizes = _array(r["sizes"])
            a, b = (x / sizes for x in _rate(r, known, many, scale, n_target, n, size))
            out.append(batch_of(schema, r["doc_ids"], sizes, a, b, a - b))
        return pa.Table.from_batches(out, schema)

    rated = coded.groupBy("chunk").cogroup(found.groupBy("chunk"))
    return rated.applyInArrow(rate, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")


def target_documents(labels: DataFrame) -> DataFrame:
    """Documents labelled as good, the target of the registered query."""
    return labels.where("quality = 1").select("doc_id")
