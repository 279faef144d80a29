"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Texts are folded first: compatibility forms and case, letters of other scripts that look like Latin ones, and digits or signs that
stand between letters in place of one. Terms are whole words or word beginnings (``stem*``). Their weights are smoothed log odds
of the labelled training rows that hold them, less two standard errors; each word of a text counts its best term, and words
inside an exception phrase count nothing. The weights found in a text, normalised by its length, and the best one go through a
logistic curve fitted on training rows that the lexicon has not seen.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainhouse.llm.common import batch_of, broadcast_checked, each_text, values

# Letters of other scripts that look like Latin ones, and signs written for letters.
HOMOGLYPHS = str.maketrans("авекмнорстухіјѕԁɡӏαβεηικνορτυχ", "abekmhopctyxijsdglabenikvoptux")
SIGNS = str.maketrans("0134578@$!", "oieastbasi")
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "clown fish", "class clown")

STEMS = range(3, 7)  # letters of a word beginning
LEAST_TOXIC = 5  # toxic training rows that must hold a term
LEAST_WEIGHT = 1.0
FIT_ROWS = 50_000  # rows the logistic curve is fitted on, at most
FLUSH = 200_000  # counts a task holds before it sends them on

_SIGN = re.compile(r"(?<=[^\W\d_])[0134578@$!](?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Lower case, compatibility forms, Latin look-alikes, and letters for signs between letters."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower().translate(HOMOGLYPHS)
    else:
        text = text.lower()
    return _SIGN.sub(lambda m: m[0].translate(SIGNS), text)


def terms_of(text: str) -> set[str]:
    """Every word of a folded text, and every beginning of one as ``stem*``."""
    words = set(_WORD.findall(text))
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) > k}


class Matcher:
    """Aho-Corasick over the terms of a lexicon and the exception phrases."""

    def __init__(self, weights: dict[str, float], exceptions: Sequence[str] = EXCEPTIONS):
        self.automaton = ahocorasick.Automaton()
        entries: dict[str, list[tuple[str, float]]] = {}
        for term, weight in weights.items():
            kind, key = ("stem", term[:-1]) if term.endswith("*") else ("word", term)
            entries.setdefault(key, []).append((kind, weight))
        for phrase in exceptions:
            entries.setdefault(fold(phrase), []).append(("exception", 0.0))
        for key, found in entries.items():
            if key:
                self.automaton.add_word(key, (len(key), found))
        if entries:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, float]]:
        """(start of the word, best weight) of each word of a folded text that holds a term."""
        best: dict[int, tuple[float, int]] = {}
        spared: list[tuple[int, int]] = []
        if not len(self.automaton):
            return []
        for last, (size, found) in self.automaton.iter(text):
            start, end = last - size + 1, last + 1
            if start and text[start - 1].isalnum():
                continue
            whole = end == len(text) or not text[end].isalnum()
            for kind, weight in found:
                if kind == "exception":
                    if whole:
                        spared.append((start, end))
                elif (kind == "word") == whole and weight > best.get(start, (0.0, 0))[0]:
                    best[start] = (weight, end)
        return [(s, w) for s, (w, e) in sorted(best.items()) if not any(a <= s and e <= b for a, b in spared)]

    def features(self, text: str) -> tuple[float, float, float]:
        """(all weights by the root of the words, best weight, logarithm of all weights) of a raw text."""
        folded = fold(text)
        weights = [w for _, w in self.hits(folded)]
        if not weights:
            return 0.0, 0.0, 0.0
        return sum(weights) / math.sqrt(1 + folded.count(" ")), max(weights), math.log1p(sum(weights))


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    curve: tuple[float, ...]  # of the features, then the constant
    exceptions: tuple[str, ...] = EXCEPTIONS

    def scores(self, matcher: Matcher, batch: Iterable[str]) -> np.ndarray:
        found = np.array([matcher.features(t) for t in batch]).reshape(-1, 3)
        return 1 / (1 + np.exp(-np.clip(found @ np.array(self.curve[:-1]) + self.curve[-1], -30, 30)))


def _count(rows: DataFrame) -> DataFrame:
    """(term, bad, clean): how many toxic and how many clean texts of rows (text, _toxic) hold each term, summed in each task first."""
    schema = pa.schema([("term", pa.string()), ("bad", pa.int64()), ("clean", pa.int64())])

    def batch(held: tuple[Counter[str], Counter[str]]) -> pa.RecordBatch:
        terms = [*held[1], *(held[0].keys() - held[1].keys())]
        return batch_of(schema, terms, [held[1][t] for t in terms], [held[0][t] for t in terms])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter[str], Counter[str]] = Counter(), Counter()  # of clean rows, of toxic rows
        for found in batches:
            for text, toxic in zip(each_text(found), values(found, "_toxic"), strict=True):
                held[toxic == 1].update(terms_of(fold(text)))
                if len(held[0]) + len(held[1]) > FLUSH:
                    yield batch(held)
                    held = Counter(), Counter()
        yield batch(held)

    counted = rows.select("text", "_toxic").mapInArrow(count, "term string, bad long, clean long")
    return counted.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("clean").alias("clean"))


def _sure(n_bad: int, n_clean: int) -> Column:
    """Smoothed log odds of a term's ``bad`` and ``clean`` rows, less two standard errors."""
    bad, clean = F.col("bad"), F.least("clean", F.lit(n_clean))
    odds = F.log((bad + 0.5) / (n_bad - bad + 0.5)) - F.log((clean + 0.5) / (n_clean - clean + 0.5))
    return odds - 2 * F.sqrt(1 / (bad + 0.5) + 1 / (clean + 0.5))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, ...]:
    """Ridge logistic regression by Newton's method; classes weigh as they occur."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - ridge * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta)), slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def fit(docs: DataFrame, labels: DataFrame, train: Column, calibrate: Column) -> ToxicityModel:
    """Learn a model from labelled rows; ``train`` and ``calibrate`` pick rows of ``labels`` (doc_id, toxic) for lexicon and curve.

    Term counts cover all training rows, and every term that passes the tests of its counts is weighed; only these come to the
    driver. The curve is fitted on at most ``FIT_ROWS`` rows with the smallest hash. A doc_id labelled twice is toxic if any label says so; null labels are left out. Without a toxic training
    row the lexicon is empty and every score is below one half.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    text = docs.select("doc_id", "text")

    def of(rows: Column) -> DataFrame:
        return text.join(broadcast_checked(known.where(rows)), "doc_id")

    sizes = {r["_toxic"]: r.n for r in of(train).groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_bad, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    passed = []
    if n_bad:
        counted = _count(of(train & F.col("_toxic").isin(0, 1))).where(F.col("bad") >= LEAST_TOXIC)
        passed = counted.withColumn("sure", _sure(n_bad, n_clean)).where(F.col("sure") >= LEAST_WEIGHT).collect()
    weights = _weights({r.term: r.sure for r in passed}, {r.term: r.bad for r in passed})
    curve = (0.0, 0.0, 0.0, -3.0)
    if weights:
        rows = _features(of(calibrate), weights).orderBy("at").limit(FIT_ROWS).collect()
        y = np.array([r.toxic for r in rows], float)
        if 0 < y.sum() < len(y):
            curve = _logistic(np.array([[r.a, r.b, r.c] for r in rows]), y)
        else:
            curve = (0.0, 1.0, 0.0, -float(np.median([*weights.values()])))
    return ToxicityModel(weights, curve)


def _weights(found: dict[str, float], bad: dict[str, int]) -> dict[str, float]:
    """Weights of the terms found, without those that another one stands for; ``bad`` has their toxic rows."""
    found = dict(found)
    # Of a term and its own beginnings keep the longest that is in (nearly) the same rows, and no longer one that is less sure.
    for term in sorted(found, key=lambda t: (-len(t), t)):
        word = term.rstrip("*")
        for stem in (f"{word[:k]}*" for k in STEMS if k < len(word) or (k == len(word) and not term.endswith("*"))):
            if term in found and stem in found:
                if bad[term] >= 0.9 * bad[stem]:
                    del found[stem]
                elif found[stem] >= found[term]:
                    del found[term]
    return {t: found[t] for t in sorted(found, key=lambda t: (-found[t], t))}


def _features(rows: DataFrame, weights: dict[str, float]) -> DataFrame:
    schema = pa.schema([("a", pa.float64()), ("b", pa.float64()), ("c", pa.float64()), ("toxic", pa.int32()), ("at", pa.int64())])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(weights)
        for batch in batches:
            if batch.num_rows:
                found = [matcher.features(t) for t in each_text(batch)]
                yield batch_of(schema, *map(list, zip(*found, strict=True)), values(batch, "toxic"), values(batch, "at"))

    return rows.select("text", F.col("_toxic").cast("int").alias("toxic"), F.xxhash64("doc_id").alias("at")).mapInArrow(
        features, "a double, b double, c double, toxic int, at long"
    )


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, predicted) of every row; null and empty texts score as texts without a term, other columns are ignored."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.weights, model.exceptions)
        for batch in batches:
            found = model.scores(matcher, each_text(batch))
            yield batch_of(schema, batch.column(0), found, (found >= 0.5).astype(np.int32))

    return docs.select("doc_id", "text").mapInArrow(rate, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` that score below one half, with all their columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.weights, model.exceptions)
        for batch in batches:
            yield batch.filter(pa.array(model.scores(matcher, each_text(batch)) < 0.5))

    return docs.mapInArrow(keep, docs.schema)


def fold_of(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def fit_folds(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Lexicon from folds 1 to 3, curve from fold 4; fold 0 stays unseen."""
    return fit(docs, labels, fold_of().isin(1, 2, 3), fold_of() == 4)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; a null doc_id is not held out."""
    return score(docs, fit_folds(docs, labels)).select(
        "doc_id", F.coalesce(fold_of() == 0, F.lit(False)).alias("held_out"), "score", "predicted"
    )
