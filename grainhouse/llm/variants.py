"""Spelling variant grouping: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols, so that words become short strings over a small alphabet. Two words one edit apart have
reduced words that are equal or one edit apart, too. Every word generates the full one-edit neighbourhood of its reduced word:
deletions, replacements and insertions, about 2 x symbols x length strings, whatever the letters. A link of two reduced words is in
both of their neighbourhoods; it is handed on from one: from the longer word, or where the lengths are equal, from the one with the
smaller symbol. The neighbourhoods are joined with the reduced vocabulary, and a pair counts if the words themselves are one edit
apart. A word's form is its most frequent near word, if that is far more frequent; the root is where the forms end.

Reduced words travel as 64-bit polynomial hashes, from which those of all neighbours follow by sums, so that a word of n letters
takes O(n) time and no string of n letters is made for each neighbour. Equal hashes of different strings only add pairs to verify.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainhouse.llm.common import batch_of, texts, values
from grainhouse.sources.store import Store

LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES = 10  # how much more frequent a form is than its variant
DAMAGE = 31  # one run in so many loses a letter
SYMBOLS = 4
KEYS_HELD = 500_000  # neighbours made at once
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)  # from lower-cased text; shorter runs give no word
HELD_WORDS = 400_000  # distinct words a task counts before it hands them on


def words_of(text: str, doc_id: int | None) -> dict[str, int]:
    """How often each word is in a text: lower-cased runs of letters, some of which lose the letter that a checksum names."""
    found: dict[str, int] = {}
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes lower only A to Z
    for run, count in Counter(_RUN.findall(lowered)).items():
        h = zlib.crc32(run.encode(), start)
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        found[run] = found.get(run, 0) + count
    return found


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of every word of at least ``LEAST_LENGTH`` letters that occurs at least ``LEAST_COUNT`` times."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for text, doc_id in zip(texts(batch), values(batch, "doc_id"), strict=True):
                for word, n in words_of(text, doc_id).items():
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield batch_of(schema, list(held), list(held.values()))
                    held = {}
        if held:
            yield batch_of(schema, list(held), list(held.values()))

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


_GENERATOR = np.random.default_rng(13)
_VALUES = _GENERATOR.integers(0, 1 << 64, SYMBOLS, np.uint64) | np.uint64(1)  # of each symbol in a hash
_BASE = int(_GENERATOR.integers(0, 1 << 64, dtype=np.uint64)) | 5
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(count: int) -> np.ndarray:
    """The first powers of the base, modulo 2**64."""
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(count, _BASE, np.uint64))])


def reduced(codes: np.ndarray) -> np.ndarray:
    """The symbols of letters, given as code points."""
    return codes % SYMBOLS


def reduced_hash(symbols: np.ndarray) -> np.ndarray:
    """The hash of each row of symbols."""
    return (_VALUES[symbols] * _powers(symbols.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def letter_mask(codes: np.ndarray) -> np.ndarray:
    """64 parities of letter counts per row; one edit changes two of them at most."""
    return np.bitwise_xor.reduce(np.uint64(1) << (codes % 64).astype(np.uint64), axis=1)


def neighbourhood(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the one-edit neighbourhood of each row of symbols, and which of them are handed on, both (rows, neighbours).

    In order: deletions, replacements by each symbol, insertions of each symbol. A string that several edits give is handed on once.
    """
    rows, length = symbols.shape
    powers = _powers(length + 1)
    values = _VALUES[symbols]
    terms = values * powers[:length]
    none = np.zeros((rows, 1), np.uint64)
    heads = np.concatenate([none, np.cumsum(terms, axis=1, dtype=np.uint64)], axis=1)  # of the letters before each place
    tails = heads[:, -1:] - heads  # of the letters from each place on
    deleted = heads[:, :-1] + tails[:, 1:] * np.uint64(_BACK)
    run_starts = np.concatenate([np.ones((rows, 1), bool), symbols[:, 1:] != symbols[:, :-1]], axis=1)
    found, handed = [deleted], [run_starts]  # within a run of one symbol, all deletions give the same
    for symbol, value in enumerate(_VALUES):
        found.append(heads[:, -1:] + (value - values) * powers[:length])
        handed.append(symbols < symbol)
    for value in _VALUES:
        found.append(heads + value * powers[: length + 1] + tails * np.uint64(_BASE))
        handed.append(np.zeros((rows, length + 1), bool))  # the longer word hands these on
    return np.concatenate(found, axis=1), np.concatenate(handed, axis=1)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the list, code points as a matrix) of words of one length, in parts of bounded neighbourhoods."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        most = max(1, KEYS_HELD // (2 * SYMBOLS * int(size) + SYMBOLS))
        for start in range(0, len(places), most):
            part = places[start : start + most]
            codes = np.frombuffer("".join([words[k] for k in part]).encode("utf-32-le"), "<u4")
            yield part, codes.reshape(len(part), size).astype(np.int64)


_KEYS = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("mask", pa.int64())])


def _own_keys(vocabulary: DataFrame) -> DataFrame:
    """(key, near_id, near_mask): the reduced word of each word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ids = values(batch, "word"), np.array(values(batch, "id"), np.int64)
            for places, codes in _by_length(words):
                keys = reduced_hash(reduced(codes))
                yield batch_of(_KEYS, keys.view(np.int64), ids[places], letter_mask(codes).view(np.int64))

    return vocabulary.select("word", "id").mapInArrow(work, "key long, near_id long, near_mask long")


def _near_keys(vocabulary: DataFrame) -> DataFrame:
    """(key, id, mask): the neighbourhood of each word as handed on, and its own reduced word with the id negated, less one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ids = values(batch, "word"), np.array(values(batch, "id"), np.int64)
            for places, codes in _by_length(words):
                symbols, masks = reduced(codes), letter_mask(codes).view(np.int64)
                keys, handed = neighbourhood(symbols)
                row, _ = np.nonzero(handed)
                yield batch_of(_KEYS, keys[handed].view(np.int64), ids[places][row], masks[row])
                yield batch_of(_KEYS, reduced_hash(symbols).view(np.int64), -ids[places] - 1, masks)

    return vocabulary.select("word", "id").mapInArrow(work, "key long, id long, mask long")


def near_pairs(words: DataFrame) -> DataFrame:
    """(id, word, n, near_id, near_word, near_n): every pair of words one edit apart, once. ``words`` is (id, word, n), written."""
    others = F.when(F.col("id") >= 0, F.col("id") != F.col("near_id")).otherwise(-F.col("id") - 1 < F.col("near_id"))
    alike = F.bit_count(F.col("mask").bitwiseXOR(F.col("near_mask"))) <= 2
    met = _near_keys(words).join(_own_keys(words), "key").where(others & alike)
    pairs = met.select(F.when(F.col("id") < 0, -F.col("id") - 1).otherwise(F.col("id")).alias("id"), "near_id")
    near = words.select(*[F.col(c).alias(f"near_{c}") for c in ("id", "word", "n")])
    return pairs.join(words, "id").join(near, "near_id").where(F.levenshtein("word", "near_word", 1) == 1)


def with_roots(forms: DataFrame, store: Store) -> DataFrame:
    """Add ``root`` to (id, word, form, form_id): the end of the forms. Each round doubles the steps taken; a form is ``TIMES`` as
    frequent as its variant, so that rounds are few."""
    name = "steps-0"
    found = forms.where("form IS NOT NULL").select("id", F.col("form_id").alias("to"), F.col("form").alias("root"))
    steps, rounds = store.overwrite(found, name), 0
    while True:
        onward = steps.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("root").alias("_root"))
        joined = steps.join(onward, "to", "left")
        moved = F.col("_to").isNotNull()
        rounds += 1
        next_steps = store.overwrite(
            joined.select("id", F.coalesce("_to", "to").alias("to"), F.coalesce("_root", "root").alias("root"), moved.alias("moved")),
            f"steps-{rounds}",
        )
        steps = next_steps.drop("moved")
        if next_steps.where("moved").isEmpty():
            return forms.join(steps.drop("to"), "id", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, store: Store) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` (doc_id, text), whole texts.

    Null and empty texts have no words; other columns are ignored, whatever their names; repeated rows count again; a null doc_id
    counts as an empty one in the checksum. Of near words with equal counts the smallest in code-point order is the form. An empty
    table gives an empty result.
    """
    counted = store.overwrite(vocabulary(docs), "counted")
    words = store.overwrite(counted.withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = store.overwrite(near_pairs(words), "pairs")
    both = pairs.select("id", F.struct((-F.col("near_n")).alias("n"), F.col("near_word").alias("word"), F.col("near_id").alias("id")).alias("near"))
    both = both.unionByName(
        pairs.select(F.col("near_id").alias("id"), F.struct((-F.col("n")).alias("n"), "word", "id").alias("near"))
    )
    best = both.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("best"))
    is_form = -F.col("best.n") >= TIMES * F.col("n")
    forms = words.join(best, "id", "left").select(
        "id",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"),
        F.when(is_form, F.col("best.id")).alias("form_id"),
        F.when(is_form, -F.col("best.n")).alias("form_n"),
    )
    rooted = with_roots(store.overwrite(forms, "forms"), store)
    return rooted.select("word", "form", "root", "n", "n_near", "form_n")
