"""Re-Pair grammar compression of token ids, in shards that can be read at random.

Documents are range partitioned by id and cut into shards of about ``SHARD_TOKENS`` ids. Within a shard, rounds replace frequent
pairs of neighbouring symbols by new symbols. A round takes the most frequent pairs of which none begins with a symbol that
another one ends with: their occurrences cannot overlap, so all are replaced at once. A pair of equal symbols takes alternate places
of a run, and its symbol is in no other pair of the round. Rounds go on until no pair occurs ``LEAST_COUNT`` times. No pair crosses
the end of a document, so every document is a run of symbols of its own and can be decoded alone.

File format, one Parquet row per shard, in ascending order of documents (all arrays little-endian):

=============  =========================================================================
part, shard    range partition and place in it; rows sort by them
doc_ids        int64 per document, with ``has_id`` (one byte per document) 0 for null
doc_symbols    int64 per document: symbols of its run
doc_tokens     int64 per document: ids after expansion
alphabet       uint32 per terminal symbol: its id
rules          uint32 pairs: symbols that nonterminal ``len(alphabet) + k`` stands for
lengths        uint32 per nonterminal: ids after expansion
symbols        uint16 or uint32 (``width`` bytes) per symbol of the compressed sequence
=============  =========================================================================
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from grainhouse.llm.common import batch_of, runs, texts, values
from grainhouse.sources.store import Store

SHARD_TOKENS = 1 << 19  # ids of a shard; a longer document is a shard of its own
LEAST_COUNT = 2  # a rule must replace so many pairs
PASSES = 20  # over all pairs that are left, when a round's pairs are chosen
END_ID = 2
MEMO_WORDS = 800_000
BATCH_CHARS = 2_000_000


# --- grammar


def _choose(keys: np.ndarray, counts: np.ndarray, base: int) -> np.ndarray:
    """The most frequent pairs such that no symbol both begins one and ends one, but for pairs of a symbol that is in no other.

    Pairs are taken in order of their counts. All pairs that no earlier one left can exclude are taken at once and those that a
    taken one excludes are dropped, ``PASSES`` times; what is left of long chains of pairs is gone through one by one.
    """
    order = np.argsort(-counts, kind="stable")
    a, b = keys[order] // base, keys[order] % base
    begins, ends = np.zeros(base, bool), np.zeros(base, bool)  # symbols that begin, end a chosen pair
    begin_at, end_at = np.empty(base, np.int64), np.empty(base, np.int64)  # the first pair left that a symbol begins, ends
    at, chosen = np.arange(len(keys)), []
    for _ in range(PASSES):
        if not len(at):
            break
        begin_at[b] = end_at[a] = len(keys)
        begin_at[a[::-1]], end_at[b[::-1]] = at[::-1], at[::-1]
        # a pair of equal symbols is the first of its symbol in both roles, or an earlier pair may exclude it
        free = (end_at[a] >= at) & (begin_at[b] >= at) & ((a != b) | ((begin_at[a] == at) & (end_at[a] == at)))
        chosen.append(at[free])
        begins[a[free]] = ends[b[free]] = True
        same = a == b
        left = ~(free | ends[a] | begins[b] | (same & (begins[a] | ends[a])))
        at, a, b = at[left], a[left], b[left]
    for k, x, y in zip(at.tolist(), a.tolist(), b.tolist(), strict=True):
        if not ends[x] and not begins[y] and (x != y or not begins[x]):
            begins[x] = ends[y] = True
            chosen.append([k])
    return np.sort(keys[order[np.concatenate(chosen)]]) if chosen else keys[:0]


def _ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids in order, and the place of each id among them."""
    if not len(ids) or int(ids.max()) >= 1 << 22:
        alphabet, flat = np.unique(ids, return_inverse=True)
        return alphabet, flat.astype(np.int64)
    seen = np.zeros(int(ids.max()) + 1, bool)
    seen[ids] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[ids]


def _slots(keys: np.ndarray) -> np.ndarray:
    """18 bits of each key."""
    if keys.dtype == np.uint32:
        return (keys * np.uint32(0x9E3779B1)) >> np.uint32(14)
    return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)


def compress(ids: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Re-Pair over documents of the given sizes that lie on end: alphabet, rules, lengths, symbols, doc_symbols."""
    alphabet, flat = _ranked(ids)
    last = np.zeros(len(flat), bool)
    last[np.cumsum(sizes)[sizes > 0] - 1] = True
    flat = flat.astype(np.uint32)
    rules, n = [np.empty((0, 2), np.int64)], len(alphabet)
    while len(flat) > 1:
        base = n + 1
        kind = np.uint32 if base < 1 << 16 else np.int64  # keys in as few bytes as they need
        keys = flat[:-1].astype(kind) * kind(base)
        keys += flat[1:]
        inside = ~last[:-1]
        # of a run of equal symbols every other pair, so that no occurrence overlaps another one
        same = np.flatnonzero(inside & (flat[:-1] == flat[1:]))
        first = np.flatnonzero(np.diff(same, prepend=-2) != 1)
        inside[same[(same - np.repeat(same[first], np.diff(np.append(first, len(same))))) % 2 == 1]] = False
        ordered = np.sort(keys[inside])
        at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, np.int64)
        counts = np.diff(np.append(at, len(ordered)))
        often = counts >= LEAST_COUNT
        chosen = _choose(ordered[at[often]].astype(np.int64), counts[often], base)
        if not len(chosen):
            break
        wanted = chosen.astype(kind)
        maybe = np.zeros(1 << 18, bool)  # by a hash of the key, so that few others are looked up
        maybe[_slots(wanted)] = True
        found = np.flatnonzero(inside & maybe[_slots(keys)])
        sought = keys[found]
        place = np.minimum(np.searchsorted(wanted, sought), len(wanted) - 1)
        hit = wanted[place] == sought
        found, place = found[hit], place[hit]
        rules.append(np.stack([chosen // base, chosen % base], 1))
        flat[found] = n + place
        last[found] = last[found + 1]
        stays = np.ones(len(flat), bool)
        stays[found + 1] = False
        flat, last, n = flat[stays], last[stays], n + len(chosen)
    ends = np.flatnonzero(last) + 1
    runs_ = np.zeros(len(sizes), np.int64)
    runs_[sizes > 0] = np.diff(np.append(0, ends))
    pairs = np.concatenate(rules)
    return {
        "alphabet": alphabet.astype("<u4"),
        "rules": pairs.astype("<u4"),
        "lengths": rule_lengths(pairs, len(alphabet))[len(alphabet) :].astype("<u4"),
        "symbols": flat.astype("<u2" if n <= 1 << 16 else "<u4"),
        "doc_symbols": runs_.astype("<i8"),
    }


def _levels(rules: np.ndarray, terminals: int) -> Iterator[np.ndarray]:
    """Rules in groups, each made of symbols of earlier groups alone; a round's rules never refer to each other."""
    start = 0
    while start < len(rules):
        above = np.flatnonzero(rules[start:].max(1) >= terminals + start)
        end = start + (int(above[0]) if len(above) else len(rules) - start)
        yield np.arange(start, end)
        start = end


def rule_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """Ids that each symbol, terminals first, expands to."""
    lengths = np.ones(terminals + len(rules), np.int64)
    for group in _levels(rules, terminals):
        lengths[terminals + group] = lengths[rules[group]].sum(1)
    return lengths


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ``flat`` on end."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


class Shard:
    """A shard read back: documents, or any run of ids of one, without expanding the rest."""

    def __init__(self, row: dict):
        self.doc_ids = np.frombuffer(row["doc_ids"], "<i8")
        self.has_id = np.frombuffer(row["has_id"], "u1").astype(bool)
        self.doc_tokens = np.frombuffer(row["doc_tokens"], "<i8")
        self.starts = np.append(0, np.cumsum(np.frombuffer(row["doc_symbols"], "<i8")))
        alphabet = np.frombuffer(row["alphabet"], "<u4")
        rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2).astype(np.int64)
        self.symbols = np.frombuffer(row["symbols"], f"<u{row['width']}").astype(np.int64)
        self.sizes = np.append(np.ones(len(alphabet), np.int64), np.frombuffer(row["lengths"], "<u4"))
        self.at = np.cumsum(self.sizes) - self.sizes
        self.expanded = np.empty(int(self.sizes.sum()), np.uint32)  # what each symbol stands for, on end
        self.expanded[self.at[: len(alphabet)]] = alphabet
        for group in _levels(rules, len(alphabet)):
            pair = rules[group].ravel()
            own = _gather(self.expanded, self.at[pair], self.sizes[pair])
            first = self.at[len(alphabet) + group[0]]
            self.expanded[first : first + len(own)] = own

    def ids(self, doc: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids from ``start`` to ``end`` of a document, found by expansion lengths."""
        run = self.symbols[self.starts[doc] : self.starts[doc + 1]]
        stops = np.cumsum(self.sizes[run])
        end = int(self.doc_tokens[doc]) if end is None else min(end, int(self.doc_tokens[doc]))
        if end <= start:
            return self.expanded[:0]
        a, b = np.searchsorted(stops, start, "right"), np.searchsorted(stops, end, "left") + 1
        before = int(stops[a - 1]) if a else 0
        return _gather(self.expanded, self.at[run[a:b]], self.sizes[run[a:b]])[start - before : end - before]


# --- tokens


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class WordEncoder:
    """Ids of texts by the tokenizers library, which sees each distinct word once.

    Cutting at space, tab and line ends is exact where the normaliser turns white space into one space and the pre-tokeniser
    drops it, as in vocabularies with word ends; others are refused.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_str(model)
        probe = ["a b", "a \t\n b", " a b ", "a\r\nb", "don't  stop at 12 — é́"]
        enc = lambda x: self.library.encode(x, add_special_tokens=False).ids
        if any(enc(p) != [i for w in self.words(p) for i in enc(w)] for p in probe):
            raise ValueError("this vocabulary has tokens across white space")
        # The library again without the steps that leave plain words as they are: many of them in one call
        self.plain = Tokenizer(self.library.model)
        self.plain.pre_tokenizer = WhitespaceSplit()
        ends = np.zeros(self.library.get_vocab_size() + 1, bool)
        ends[[i for token, i in self.library.get_vocab().items() if token.endswith(_WORD_END) and i < len(ends)]] = True
        self.word_ends = ends
        self.bytes_shown = {b: c for b, c in enumerate(_byte_letters()) if b > 127}
        self._forget()

    @staticmethod
    def words(text: str) -> list[str]:
        # str.split() also cuts at four control characters, which the library keeps
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return _BLANK.split(text)
        # Fewer distinct words, same ids: Latin-1 in lower case (but for special tokens), and a stop or comma apart from the
        # letters before it, unless some word here ends in a run of punctuation, which is one token, or in a letter that the
        # normaliser may take apart into a letter and a mark.
        if "<|" not in text and not _MARKS.search(text):
            text = text.lower() if _is_latin(text) else text
            text = text.replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n")
        return text.split()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.memo_from = self.memo_size = np.empty(0, np.int64)
        self.memo_ids = np.empty(0, np.uint32)

    def _plain_ids(self, new: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids on end, ids of each) of plain words; None where the ends of words cannot be told from their ids."""
        shown = "\n".join(new)
        shown = (shown if shown.isascii() else shown.encode().decode("latin-1").translate(self.bytes_shown)).split("\n")
        joined = [" ".join(shown[k : k + 256]) for k in range(0, len(shown), 256)]
        found = [e.ids for e in self.plain.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
        stops = np.flatnonzero(self.word_ends[np.minimum(ids, len(self.word_ends) - 1)]) + 1
        return (ids, np.diff(stops, prepend=0)) if len(stops) == len(new) and (not new or stops[-1] == len(ids)) else None

    def _learn(self, new: list[str]) -> None:
        plain: tuple[list, list, list] = ([], [], [])  # ASCII words, other plain words, all others
        for word in new:
            plain[int(not word.isascii()) if _PLAIN.fullmatch(word) else 2].append(word)
        new = plain[2]
        for words in plain[:2]:
            known = self._plain_ids(words)
            if known is None:
                new += words
            else:
                self._keep(words, *known)
        found = [e.ids for e in self.library.encode_batch_fast(new, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        self._keep(new, np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts)

    def _keep(self, new: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new)), strict=True))
        self.memo_from = np.concatenate([self.memo_from, len(self.memo_ids) + np.cumsum(counts) - counts])
        self.memo_size = np.concatenate([self.memo_size, counts])
        self.memo_ids = np.concatenate([self.memo_ids, ids])

    def encode(self, batch: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end, each with the end id; ids of each)."""
        cut = [self.words(t) for t in batch]
        if len(self.memo) > MEMO_WORDS:
            self._forget()
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = [*chain.from_iterable(cut)]
        at = np.fromiter(map(self.memo.get, flat, repeat(-1)), np.int64, len(flat))
        if len(unknown := np.flatnonzero(at < 0)):
            self._learn([*{flat[k] for k in unknown.tolist()}])
            at[unknown] = [self.memo[flat[k]] for k in unknown.tolist()]
        size = self.memo_size[at]
        # the end id is one more run behind the words of each text
        ends = np.cumsum(counts)
        start = np.insert(self.memo_from[at], ends, len(self.memo_ids))
        size = np.insert(size, ends, 1)
        ids = _gather(np.append(self.memo_ids, np.uint32(end_id)), start, size)
        stops = np.append(0, np.cumsum(size))[np.append(0, ends + np.arange(1, len(ends) + 1))]
        return ids, np.diff(stops)


_BLANK = re.compile("[ \t\n\r]+")
_MARKS = re.compile(r"[.,](?<=[^\w\s][.,]|_[.,]|[^\x00-\x7fÀ-ÿ][.,])\s")
_PLAIN = re.compile("[a-zß-öø-ÿ]+")  # one token run each, which the normaliser leaves as it is
_WORD_END = "</w>"


def _is_latin(text: str) -> bool:
    """No character beyond U+00FF: lower case is then one character a character, and nothing is composed."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=1)
def _encoder(model: str) -> WordEncoder:
    return WordEncoder(model)


_SHARD = pa.schema(
    [("part", pa.int32()), ("shard", pa.int32()), ("tokens", pa.int64()), ("width", pa.int32())]
    + [(c, pa.binary()) for c in ("doc_ids", "has_id", "doc_symbols", "doc_tokens", "alphabet", "rules", "lengths", "symbols")]
)


def _shard_row(part: int, shard: int, docs: list, ids: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    made = compress(ids, sizes)
    row = {
        "part": part,
        "shard": shard,
        "tokens": int(sizes.sum()),
        "width": made["symbols"].itemsize,
        "doc_ids": np.array([d or 0 for d in docs], "<i8").tobytes(),
        "has_id": np.array([d is not None for d in docs], "u1").tobytes(),
        "doc_tokens": sizes.astype("<i8").tobytes(),
    }
    row |= {name: array.tobytes() for name, array in made.items()}
    return pa.RecordBatch.from_pylist([row], schema=_SHARD)


def write_shards(docs: DataFrame, model: str, store: Store, name: str, end_id: int = END_ID) -> DataFrame:
    """Encode (doc_id, text), append ``end_id`` to every document, and write Re-Pair shards as table ``name``.

    Documents go in ascending doc_id, null first; rows that share a doc_id are ordered by a hash of their text. Null and empty
    texts are the end id alone. Other columns are ignored.
    """
    with open(model, encoding="utf-8") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file: a few MB

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shipped.value)
        part, shard, held = None, 0, ([], [], [], 0)  # doc ids, id arrays, sizes, ids so far
        for batch in batches:
            found, own = texts(batch), values(batch, "doc_id")
            part = values(batch, "_part")[0] if batch.num_rows else part
            for start, end in runs(map(len, found), BATCH_CHARS):
                ids, sizes = encoder.encode(found[start:end], end_id)
                cuts = np.append(0, np.cumsum(sizes))
                for a, b in runs([*map(int, sizes)], SHARD_TOKENS):
                    if held[0] and held[3] + cuts[b] - cuts[a] > SHARD_TOKENS:
                        yield _shard_row(part, shard, held[0], np.concatenate(held[1]), np.concatenate(held[2]))
                        shard, held = shard + 1, ([], [], [], 0)
                    held = (
                        held[0] + own[start + a : start + b],
                        [*held[1], ids[cuts[a] : cuts[b]]],
                        [*held[2], sizes[a:b]],
                        held[3] + int(cuts[b] - cuts[a]),
                    )
        if held[0]:
            yield _shard_row(part, shard, held[0], np.concatenate(held[1]), np.concatenate(held[2]))

    # the salt splits a doc_id that many rows share
    keys = [F.col("doc_id"), F.xxhash64("text")]
    placed = docs.select("doc_id", "text").repartitionByRange(*keys).sortWithinPartitions(*keys)
    fields = "part int, shard int, tokens long, width int, " + ", ".join(f"{f.name} binary" for f in _SHARD if f.type == pa.binary())
    return store.overwrite(placed.withColumn("_part", F.spark_partition_id()).mapInArrow(shards, fields), name)


def read_documents(shards: DataFrame) -> DataFrame:
    """Decode shards: (doc_id, start, n_tokens, ids_crc32); ``start`` counts the ids of all documents before it.

    Only totals per range partition are summed in one task, and totals per shard within a partition.
    """
    parts = shards.groupBy("part").agg(F.sum("tokens").alias("_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range partition
    parts = parts.select("part", F.coalesce(F.sum("_tokens").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    index = shards.select("part", "shard", F.coalesce(F.sum("tokens").over(within), F.lit(0)).alias("_within"))
    starts = index.join(parts, "part").select("part", "shard", (F.col("_before") + F.col("_within")).alias("start"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                own = [d if has else None for d, has in zip(shard.doc_ids.tolist(), shard.has_id, strict=True)]
                starts = row["start"] + np.cumsum(shard.doc_tokens) - shard.doc_tokens
                crc = [zlib.crc32(shard.ids(k).astype("<u4").tobytes()) for k in range(len(own))]
                yield batch_of(schema, own, starts, shard.doc_tokens, crc)

    joined = shards.join(starts, ["part", "shard"])
    return joined.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
