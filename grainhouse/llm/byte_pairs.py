"""Byte-level BPE encoding and decoding, the merges of a word found by a segment tree.

A text is cut by a pattern, and each match is encoded by itself: its bytes are the first symbols, and the neighbours whose joined
bytes have the lowest rank are merged, the leftmost among equals, until no neighbours have a rank. The leaves of the tree are the
byte positions; the leaf of a live symbol's first byte holds the rank of the symbol joined with the next one and the position, so
that the root holds the leftmost minimum. A merge changes three leaves (its own, the one before, and the one that is gone), each
with a walk to the root: a word of n bytes takes O(n log n), however long it is. The words of a batch that have trees of one height
are merged side by side in numpy arrays, one merge of each per round; a word above ``SIDE_BY_SIDE`` bytes, which would need as many
rounds, has its own tree. Matches repeat, so a task remembers their ids.

A pattern's classes depend on the Unicode version of the library that reads it. Characters that are letters or numbers to ``regex``
and not yet to ``tiktoken`` are found on the driver, and are unassigned characters to the pattern here as they are there.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from grainhouse.llm.common import batch_of, runs, texts, values

SIDE_BY_SIDE = 64  # bytes of a word up to which trees are held in one array
ARRAY_LEAVES = 1 << 20  # leaves of such an array
MEMO_MATCHES, MEMO_CHARS = 500_000, 8_000_000  # what a task remembers before it starts anew
BATCH_CHARS = 4_000_000  # characters whose ids are held at once
_NONE = (1 << 63) - 1
_ID = np.dtype("<u4")
_SPARK = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.int64()): "array<long>", pa.binary(): "binary"}


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a line each, the bytes in base64 and the rank."""
    return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, data.splitlines()) if word}


UNASSIGNED = "\ufdd0"  # is, and stays, no character


@lru_cache(maxsize=8)
def later_characters(pattern: str) -> str:
    """The characters that a pattern here takes for letters or numbers and the library, older, does not."""
    unknown = "".join(chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn")
    # a character of the class before it joins its match, which shows as a merge across the two
    joins = [bytes([first, second]) for first in b"a1" for second in range(256)]
    ranks = {word: rank for rank, word in enumerate([*(bytes([b]) for b in range(256)), *joins])}
    library = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    cut = regex.compile(pattern).findall

    def differs(character: str, before: str) -> bool:
        text = before + character
        return (library.encode_ordinary(text)[0] > 255) != (len(cut(text)[0]) > 1)

    return "".join(c for c in regex.findall(r"[\p{L}\p{N}]", unknown) if differs(c, "a") or differs(c, "1"))


def _character_class(characters: str) -> re.Pattern[str] | None:
    """Any of sorted characters, told by ranges."""
    if not characters:
        return None
    points = np.array([ord(c) for c in characters])
    cuts = np.flatnonzero(np.diff(points) > 1)
    starts, ends = points[np.r_[0, cuts + 1]], points[np.r_[cuts, len(points) - 1]]
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends, strict=True)) + "]")


def merge_word(word: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """The ids of one word: merges by rank, the leftmost first, with a segment tree over the positions."""
    n = len(word)
    if n < 2:
        return [ranks[word]] if n else []
    bits = (n - 1).bit_length()
    half, mask = 1 << bits, (1 << bits) - 1
    tree = array("q", [_NONE]) * (2 * half)
    after = array("q", range(1, n + 1))  # where the symbol of a position ends
    before = array("q", range(-1, n))  # where the symbol before a position starts

    def leaf(start: int, end: int) -> int:
        rank = ranks.get(word[start:end]) if end - start <= longest else None
        return _NONE if rank is None else rank << bits | start

    for i in range(n - 1):
        tree[half + i] = leaf(i, i + 2)
    for i in range(half - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def put(i: int, value: int) -> None:
        i += half
        tree[i] = value
        while i > 1:
            beside = tree[i ^ 1]
            if beside < value:
                value = beside
            i >>= 1
            if tree[i] == value:
                return
            tree[i] = value

    while (least := tree[1]) != _NONE:
        at = least & mask
        gone = after[at]
        end = after[at] = after[gone]
        before[end] = at
        put(gone, _NONE)
        put(at, leaf(at, after[end]) if end < n else _NONE)
        if at:
            put(before[at], leaf(before[at], end))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at : after[at]]])
        at = after[at]
    return ids


class BytePairCodec:
    """Encodes and decodes by a table of ranks and a pattern that cuts texts. Ids are little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, later: str = ""):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        if not 0 <= min(ranks.values()) <= max(ranks.values()) < 1 << 31 or len(set(ranks.values())) < len(ranks):
            raise ValueError("ranks must be different and between 0 and 2**31 - 1")
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.bytes_of = {rank: word for word, rank in ranks.items()}
        self._pattern = regex.compile(pattern)
        self._later = _character_class(later)
        self._byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = sorted(
            (left << 32 | right, rank)
            for word, rank in ranks.items()
            for k in range(1, len(word))
            if (left := ranks.get(word[:k])) is not None and (right := ranks.get(word[k:])) is not None
        )
        self._pair_keys, self._pair_ranks = np.array([*pairs, (_NONE, _NONE)], np.int64).T.copy()
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, bytes] = {}
        self.memo_chars = 0

    def _leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
        """The leaves at positions ``at`` for pairs of symbols; -1 is no symbol."""
        keys = left << 32 | right
        found = np.searchsorted(self._pair_keys, keys)
        known = (right >= 0) & (left >= 0) & (self._pair_keys[found] == keys)
        return np.where(known, self._pair_ranks[found] << bits | at, _NONE)

    def merge_side_by_side(self, words: list[bytes], bits: int) -> list[bytes]:
        """The ids of words of 2 to 2**bits bytes, one tree of that height each."""
        half, count = 1 << bits, len(words)
        sizes = np.fromiter(map(len, words), np.int64, count)
        padded = np.frombuffer(b"".join(w.ljust(half + 1, b"\0") for w in words), np.uint8).reshape(count, half + 1)
        places = np.arange(half + 1)
        symbols = np.where(places < sizes[:, None], self._byte_ids[padded], -1)  # by first byte; the last column is none
        after, before = np.tile(places + 1, (count, 1)), np.tile(places - 1, (count, 1))
        tree = np.empty((count, 2 * half), np.int64)
        tree[:, half:] = self._leaves(symbols[:, :-1], symbols[:, 1:], places[:-1], bits)
        for level in range(bits - 1, -1, -1):
            below = tree[:, 2 << level : 4 << level]
            tree[:, 1 << level : 2 << level] = np.minimum(below[:, ::2], below[:, 1::2])
        flat, flat_symbols, flat_after, flat_before = tree.ravel(), symbols.ravel(), after.ravel(), before.ravel()
        active = np.arange(count)
        while len(active := active[flat[active * 2 * half + 1] != _NONE]):
            row, root = active * (half + 1), active * 2 * half
            least = flat[root + 1]
            at = least & (half - 1)
            gone = flat_after[row + at]
            end = flat_after[row + gone]
            merged = flat_symbols[row + at] = least >> bits
            flat_symbols[row + gone] = -1
            flat_after[row + at], flat_before[row + end] = end, at
            flat[root + half + gone] = _NONE
            flat[root + half + at] = self._leaves(merged, flat_symbols[row + end], at, bits)
            prior = flat_before[row + at]
            has = np.flatnonzero(prior >= 0)
            prior = prior[has]
            flat[root[has] + half + prior] = self._leaves(flat_symbols[row[has] + prior], merged[has], prior, bits)
            walks = [(root, half + gone), (root, half + at), (root[has], half + prior)]
            for up in range(bits):
                for base, leaf in walks:
                    node = leaf >> up
                    flat[base + (node >> 1)] = np.minimum(flat[base + node], flat[base + (node ^ 1)])
        live = symbols >= 0
        ids = symbols[live].astype(_ID).tobytes()
        ends = np.cumsum(live.sum(axis=1)) * 4
        return [ids[start:end] for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def cut(self, text: str) -> list[str]:
        """The matches of the pattern."""
        if self._later is None or text.isascii() or not self._later.search(text):
            return self._pattern.findall(text)
        older = self._later.sub(UNASSIGNED, text)
        return [text[m.start() : m.end()] for m in self._pattern.finditer(older)]

    def _learn(self, matches: list[str]) -> None:
        by_height: dict[int, list[tuple[str, bytes]]] = {}
        for match in matches:
            word = match.encode()
            rank = self.ranks.get(word)  # a whole word of the vocabulary is one id, whichever way its merges would go
            if rank is not None:
                self.memo[match] = np.array([rank], _ID).tobytes()
            elif len(word) > SIDE_BY_SIDE:
                self.memo[match] = np.array(merge_word(word, self.ranks, self.longest), _ID).tobytes()
            else:
                by_height.setdefault((len(word) - 1).bit_length(), []).append((match, word))
        for bits, found in by_height.items():
            most = ARRAY_LEAVES >> bits
            for start in range(0, len(found), most):
                part = found[start : start + most]
                ids = self.merge_side_by_side([word for _, word in part], bits)
                self.memo.update(zip([match for match, _ in part], ids, strict=True))
        self.memo_chars += sum(map(len, matches))

    def encode(self, batch: list[str]) -> list[bytes]:
        """The ids of each text."""
        cut = [self.cut(text) for text in batch]
        if len(self.memo) > MEMO_MATCHES or self.memo_chars > MEMO_CHARS:
            self._forget()
        if new := set().union(*cut).difference(self.memo):
            self._learn(list(new))
        return [b"".join(map(self.memo.__getitem__, matches)) for matches in cut]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids; an id that is not in the vocabulary is an error."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, _ID).tolist()))


@lru_cache(maxsize=1)
def codec_of(data: bytes, pattern: str, later: str) -> BytePairCodec:
    """The codec of a Python worker, kept for its next tasks with the matches it knows."""
    return BytePairCodec(read_ranks(data), pattern, later)


def _per_batch(
    rows: DataFrame, vocabulary: str, pattern: str, schema: pa.Schema, given: str, row: Callable[[BytePairCodec, list], list[Any]]
) -> DataFrame:
    """Map (doc_id, ``given``) batch by batch. The vocabulary, a file of a few MB at most, goes out from the driver."""
    with open(vocabulary, "rb") as file:
        shipped = rows.sparkSession.sparkContext.broadcast((file.read(), pattern, later_characters(pattern)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(*shipped.value)
        for batch in batches:
            found = texts(batch) if given == "text" else [v or [] for v in values(batch, given)]
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for start, end in runs(map(len, found), BATCH_CHARS):
                yield batch_of(schema, ids.slice(start, end - start), *row(codec, found[start:end]))

    fields = ", ".join(f"{f.name} {_SPARK[f.type]}" for f in schema)
    return rows.select("doc_id", given).mapInArrow(work, fields)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row of ``docs`` (doc_id, text), whole texts.

    Null and empty texts have no ids; repeated rows give repeated results; a null doc_id stays null; other columns are ignored,
    whatever their names; an empty table gives an empty one.
    """

    def row(codec: BytePairCodec, found: list[str]) -> list[Any]:
        packed = codec.encode(found)
        offsets = np.cumsum([0, *(len(p) // 4 for p in packed)])
        ids = pa.array(np.frombuffer(b"".join(packed), _ID).astype(np.int64))
        return [[len(p) // 4 for p in packed], pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids)]

    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int64()))])
    return _per_batch(docs, vocabulary, pattern, schema, "text", row)


def decode_documents(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, data) of encoded rows (doc_id, ids): the decoded bytes, since ids cut from a text may end inside a character.
    Null and empty ids give empty bytes; an unknown id is an error."""

    def row(codec: BytePairCodec, found: list[list[int]]) -> list[Any]:
        return [[codec.decode(np.array(ids, _ID).tobytes()) for ids in found]]

    schema = pa.schema([("doc_id", pa.int64()), ("data", pa.binary())])
    return _per_batch(encoded, vocabulary, pattern, schema, "ids", row)


def round_trip_digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Encode and decode every text; (doc_id, n_tokens, ids_sha256, decoded_sha256), rows as in :func:`encode_documents`.

    ``ids_sha256`` is the hex digest of the ids as little-endian unsigned 32-bit integers, ``decoded_sha256`` that of the bytes
    decoded from them.
    """

    def row(codec: BytePairCodec, found: list[str]) -> list[Any]:
        packed = codec.encode(found)
        decoded = [hashlib.sha256(codec.decode(p)).hexdigest() for p in packed]
        return [[len(p) // 4 for p in packed], [hashlib.sha256(p).hexdigest() for p in packed], decoded]

    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )
    return _per_batch(docs, vocabulary, pattern, schema, "text", row)
