"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A word is cut from a text where no piece of the vocabulary can cross: before a space mark that follows another character, and
around characters that are in no longer piece. Words repeat, so each distinct word of a batch is encoded once. All words of a
batch lie in one flat numpy array of symbols. In each round every word merges its best pair, the leftmost among equals, which is
the order of the library's own agenda; the array is compacted, and words without a pair leave it. A word of thousands of symbols
would need as many rounds, so words above ``LONG_WORD`` symbols go through an agenda (a heap) one by one, with the same result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from grainhouse.llm.common import batch_of, runs, texts, values

MARK = "▁"  # stands for a space inside pieces
LONG_WORD = 256
MEMO_WORDS = 800_000  # distinct words a task remembers before it starts anew
BATCH_ROWS = 512  # rows whose texts are strings at once
BATCH_CHARS = 1_000_000  # characters whose ids are held at once
_SPARK = {pa.int64(): "long", pa.string(): "string", pa.list_(pa.int32()): "array<int>"}
NO_PAIR = 1 << 40
_BYTE, _NORMAL, _USER = 6, 1, 4  # kinds of pieces in the model file


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
            yield key >> 3, value
        else:
            size, at = {1: (8, at), 5: (4, at)}.get(key & 7) or varint(at)
            yield key >> 3, data[at : at + size]
            at += size


class PieceCodec:
    """Encodes and decodes as the sentencepiece library does, for BPE models without a normaliser of their own."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        message = list(_fields(model))
        trainer = dict(_fields(next(v for k, v in message if k == 2)))
        normalizer = dict(_fields(next((v for k, v in message if k == 3), b"")))
        if trainer.get(3, 1) != 2 or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1):
            raise ValueError("needs a BPE model that only marks spaces: identity normaliser, dummy prefix, all white space kept")
        if trainer.get(24):
            raise ValueError("models that treat white space as a suffix are not supported")
        size = self.library.get_piece_size()
        self.pieces = [self.library.id_to_piece(i) for i in range(size)]
        kinds = [dict(_fields(v)).get(3, _NORMAL) for k, v in message if k == 1]
        if _USER in kinds:
            raise ValueError("models with user-defined symbols are not supported")
        normal = [i for i in range(size) if kinds[i] == _NORMAL]
        self.id_of = {self.pieces[i]: i for i in normal}
        self.unknown = self.library.unk_id()
        self.byte_ids = [-1] * 256
        for i in range(size):
            if kinds[i] == _BYTE:
                self.byte_ids[int(self.pieces[i][3:5], 16)] = i
        longer = [self.pieces[i] for i in normal if len(self.pieces[i]) > 1]
        if any(MARK in p.lstrip(MARK) for p in longer):
            raise ValueError("pieces that cross words are not supported")
        self.joined = frozenset("".join(longer))  # characters that can merge
        self._rank_pairs(longer)
        self.symbol_ids = np.array([self.id_of[p] for p in self.symbols], np.int32)
        self._part = re.compile("[{0}]+|[^{0}]".format(re.escape("".join(sorted(self.joined)))), re.DOTALL)
        self._forget()
        cut = "" if "\n" in self.joined else "\n"  # a line end that never merges ends a word, too
        self._runs = re.compile(f"{MARK}+[^{MARK}{cut}]*|[^{MARK}{cut}]+" + (f"|{cut}+" if cut else ""))
        self._bytes = [b"" if k in (2, 3, 5) else p.replace(MARK, " ").encode() for p, k in zip(self.pieces, kinds, strict=True)]
        for value, i in enumerate(self.byte_ids):
            if i >= 0:
                self._bytes[i] = bytes([value])
        self._special = np.array([k not in (_NORMAL, _BYTE) for k in kinds])

    def _rank_pairs(self, longer: list[str]) -> None:
        """A table of every pair of symbols whose joined text is a piece; the better score has the lower rank."""
        symbols: dict[str, int] = {c: n for n, c in enumerate(sorted(self.joined))}
        for p in longer:
            symbols.setdefault(p, len(symbols))
        order = sorted(longer, key=lambda p: -self.library.get_score(self.id_of[p]))
        rank_of: dict[str, int] = {}
        score = None
        for p in order:
            if self.library.get_score(self.id_of[p]) != score:
                score = self.library.get_score(self.id_of[p])
                rank = len(rank_of)
            rank_of[p] = rank
        self.symbols, self.n = symbols, len(symbols)
        rows = [
            (symbols[p[:k]] * self.n + symbols[p[k:]], rank_of[p], symbols[p])
            for p in longer
            for k in range(1, len(p))
            if p[:k] in symbols and p[k:] in symbols
        ]
        rows.sort()
        self.pair_key, self.pair_rank, self.pair_to = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        self.pairs = {key: (rank, to) for key, rank, to in rows}

    def _emit(self, piece: str) -> list[int]:
        """Ids of a character that is no piece: its bytes, or the unknown id."""
        if (i := self.id_of.get(piece)) is not None:
            return [i]
        found = [self.byte_ids[b] for b in piece.encode()]
        return found if found and min(found) >= 0 else [self.unknown]

    def _agenda(self, word: str) -> list[int]:
        """One long word: best pair first from a heap over a linked list of symbols."""
        symbol = [self.symbols[c] for c in word]
        size = len(symbol)
        before, after = list(range(-1, size - 1)), [*range(1, size), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (hit := self.pairs.get(symbol[left] * self.n + symbol[right])):
                heapq.heappush(heap, (hit[0], left, right, symbol[left], symbol[right]))

        for k in range(size - 1):
            offer(k, k + 1)
        while heap:
            _, left, right, a, b = heapq.heappop(heap)
            if symbol[left] != a or symbol[right] != b or after[left] != right:
                continue
            symbol[left], symbol[right] = self.pairs[a * self.n + b][1], -1
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [s for s in symbol if s >= 0]

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, joined symbol) of pairs; pairs that are no piece rank last."""
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NO_PAIR), self.pair_to[at]

    def _rounds(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(final symbols of all words on end, symbols of each word), for words of symbols alone."""
        flat = np.fromiter(map(self.symbols.__getitem__, "".join(words)), np.int64)
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64))
        last = np.append(owner[1:] != owner[:-1], True)
        rank, to = self._look_up(flat, np.append(flat[1:], 0))
        rank[last] = NO_PAIR
        ready: list[tuple[np.ndarray, np.ndarray]] = []
        while flat.size:
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            counts = np.diff(np.append(starts, flat.size))
            best = np.minimum.reduceat(rank, starts)
            live = best < NO_PAIR
            place = np.where(rank == np.repeat(best, counts), np.arange(flat.size), flat.size)
            left = np.minimum.reduceat(place, starts)[live]  # the leftmost best pair of each word
            flat[left] = to[left]
            stays = np.repeat(live, counts)
            ready.append((owner[~stays], flat[~stays]))
            stays[left + 1] = False
            rank[left] = rank[left + 1]  # the merged symbol ends its word if its right part did
            at = (np.cumsum(stays) - 1)[left]
            flat, owner, rank, to = flat[stays], owner[stays], rank[stays], to[stays]
            if not flat.size:
                break
            for k in (at, at - 1):  # only pairs beside a merge have changed
                k = k[(k >= 0) & (k + 1 < flat.size)]
                k = k[owner[k] == owner[k + 1]]
                rank[k], to[k] = self._look_up(flat[k], flat[k + 1])
            end = at[np.append(owner[1:] != owner[:-1], True)[at]]
            rank[end] = NO_PAIR
        owners, symbols = (np.concatenate(x) for x in zip(*ready, strict=True))
        return symbols[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))

    def _learn(self, words: list[str]) -> None:
        """Encode words into the memo."""
        whole = [w for w in words if len(w) <= LONG_WORD and self.joined.issuperset(w)]
        if whole:
            symbols, counts = self._rounds(whole)
            self._keep(whole, self.symbol_ids[symbols], counts)
        if rest := set(words).difference(whole):
            # the others fall into parts at characters that never merge
            parts = {w: re.findall(self._part, w) for w in rest}
            todo = [p for p in {p for cut in parts.values() for p in cut} if p[0] in self.joined]
            short = [p for p in todo if len(p) <= LONG_WORD]
            ids = {p: self.symbol_ids[self._agenda(p)].tolist() for p in todo if len(p) > LONG_WORD}
            if short:
                symbols, counts = self._rounds(short)
                ids |= {p: a.tolist() for p, a in zip(short, np.split(self.symbol_ids[symbols], np.cumsum(counts)[:-1]), strict=True)}
            found = [[i for p in cut for i in ids.get(p) or self._emit(p)] for cut in parts.values()]
            self._keep(list(parts), np.array([i for x in found for i in x], np.int32), np.array([*map(len, found)]))

    def _keep(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        at = len(self.memo)
        self.memo.update(zip(words, range(at, at + len(words)), strict=True))
        self.memo_from = np.concatenate([self.memo_from, len(self.memo_ids) + np.cumsum(counts) - counts])
        self.memo_size = np.concatenate([self.memo_size, counts])
        self.memo_ids = np.concatenate([self.memo_ids, ids.astype(np.int32)])

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}  # word -> its place in the two arrays that follow
        self.memo_from = self.memo_size = np.empty(0, np.int64)
        self.memo_ids = np.empty(0, np.int32)

    def words(self, text: str) -> list[str]:
        """The text cut where no piece crosses, spaces marked, with the mark the library puts in front."""
        return self._runs.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [self.words(t) for t in batch]
        if len(self.memo) > MEMO_WORDS:
            self._forget()
        if new := set().union(*cut).difference(self.memo):
            self._learn(list(new))
        get, out = self.memo.__getitem__, []
        for words in cut:
            at = np.fromiter(map(get, words), np.int64, len(words))
            size = self.memo_size[at]
            ends = np.cumsum(size)
            inner = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
            out.append(self.memo_ids[np.repeat(self.memo_from[at], size) + inner])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the space of the mark in front. The library takes over where ids are not those of a text:
        control pieces, broken byte runs, or bytes in front."""
        if not len(ids):
            return ""
        if not self._special[ids].any() and self.byte_ids[32] != ids[0]:
            try:
                text = b"".join(map(self._bytes.__getitem__, ids.tolist())).decode()
                return text[1:] if text[:1] == " " else text
            except UnicodeDecodeError:
                pass
        return self.library.decode(ids.tolist())


@lru_cache(maxsize=1)
def codec_of(model: bytes) -> PieceCodec:
    """The codec of a Python worker, kept for its next tasks without the words it has learned."""
    return PieceCodec(model)


def _encoded(batches: Iterator[pa.RecordBatch], codec: PieceCodec, schema: pa.Schema, columns: list[str], row) -> Iterator[pa.RecordBatch]:
    """The rows of a task. Its words are forgotten at the end: a worker goes on with other stages, which need the memory."""
    try:
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(first, BATCH_ROWS)
                found = texts(part)
                for start, end in runs(map(len, found), BATCH_CHARS):
                    ids = codec.encode(found[start:end])
                    kept = [part.column(part.schema.get_field_index(c)).slice(start, end - start) for c in columns]
                    yield batch_of(schema, *kept, *row(codec, ids))
    finally:
        codec._forget()


def _per_text(docs: DataFrame, model: str, schema: pa.Schema, columns: list[str], row) -> DataFrame:
    """Map texts batch by batch. The model file, a few MB at most, goes out from the driver."""
    with open(model, "rb") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(file.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(batches, codec_of(shipped.value), schema, columns, row)

    fields = ", ".join(f"{f.name} {_SPARK[f.type]}" for f in schema)
    return docs.select(*columns, "text").mapInArrow(encode, fields)


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256) of every row of ``docs`` (doc_id, text).

    ``ids_sha256`` is the hex digest of the decimal ids joined by commas. Null and empty texts have no ids; repeated rows give
    repeated results; a null doc_id stays null; other columns are ignored.
    """

    def row(_: PieceCodec, ids: list[np.ndarray]) -> list:
        offsets = np.cumsum([0, *map(len, ids)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
        return [[len(i) for i in ids], lists, [ids_digest(i) for i in ids]]

    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("ids_sha256", pa.string())])
    return _per_text(docs, model, schema, ["doc_id"], row)


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of encoded rows (doc_id, ids); null ids give an empty text."""
    with open(model, "rb") as file:
        shipped = encoded.sparkSession.sparkContext.broadcast(file.read())
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shipped.value)
        for batch in batches:
            found = [codec.decode(np.array(ids or [], np.int32)) for ids in values(batch, "ids")]
            yield batch_of(schema, batch.column(batch.schema.get_field_index("doc_id")), found)

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def ids_digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def round_trip_digests(docs: DataFrame, model: str) -> DataFrame:
    """Encode and decode every text; (doc_id, n_tokens, ids_sha256, decoded_sha256), rows as in :func:`encode_documents`."""

    def row(codec: PieceCodec, ids: list[np.ndarray]) -> list:
        decoded = [hashlib.sha256(codec.decode(i).encode()).hexdigest() for i in ids]
        return [[len(i) for i in ids], [ids_digest(i) for i in ids], decoded]

    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )
    return _per_text(docs, model, schema, ["doc_id"], row)
