"""Quality rules with risk-controlled thresholds.

A document is first measured: words, symbols, repeated lines, repeated word triples. Base limits reject what is too short or
repeats itself for the most part. Beyond them, one cutoff per rule and stratum (language) rejects more. Cutoffs come from labelled
rows: within a stratum, a rule's cutoffs are tried from the mildest to the strictest, and each is taken on only if the holdout shows that
it rejects at most the rule's share of ``RISK`` of the good documents: the exact binomial probability of so few false rejections, were
the true rate that share, must not exceed the rule's part of ``ERROR``. A rule ends at its first failure, which keeps its error at that part
(fixed-sequence testing); rules and strata divide ``ERROR`` by Holm's step-down. So with confidence 1 - ``ERROR`` no cutoff of
any stratum rejects more of its good documents than its share, and a document that some rule rejects is counted in the union: all rules together
reject at most ``RISK`` of the good documents of a stratum. Where labels are too few to show that, a rule stays silent; the first
sequence that fails at its mildest cutoff ends the ranking, so that small strata behind it are silent, too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainhouse.llm.common import batch_of, texts, values
from grainhouse.sources.store import Store

SYMBOLS = b"#*$%&|<>"
_OTHERS = bytes(sorted(set(range(256)) - set(SYMBOLS)))
_CONTINUED = bytes(range(128, 192))  # bytes inside a code point
_BLANKS = b" \t\n\x0b\x0c\r"

RISK = 0.05  # of the good documents of a stratum, for all rules together
ERROR = 0.05
#: Cutoffs of each rule, mildest first; a document fails where its value is above.
CUTOFFS = {
    "symbol_rate": [3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05, 0.03, 0.02, 0.01, 0.0],
    "dup_line_rate": [0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.0],
    "repeat_rate": [0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.0],
    "short_words": [-2.5, -3.0, -3.5, -3.75, -4.0, -4.25, -4.5, -4.75, -5.0, -5.25],  # mean characters of a word, negated
    "long_words": [20.0, 15.0, 12.0, 10.0, 9.0, 8.0, 7.0, 6.5, 6.25, 6.0, 5.75, 5.5],
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def measure_text(text: str) -> tuple[int, int, int, int, int, int]:
    """The values named in ``MEASURES`` of one whole text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(data.translate(None, _CONTINUED + _BLANKS))
    symbols = len(data.translate(None, _OTHERS))
    seen: set[bytes] = set()
    lines = 0
    for line in data.split(b"\n"):
        if line.strip(_BLANKS):
            lines += 1
            seen.add(line)
    return len(words), chars, symbols, lines - len(seen), _repeated(words), lines


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) < 4:
        return 0
    windows = [*zip(words, words[1:], words[2:], strict=False)]
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    hit = bytearray(len(words))
    for at, window in enumerate(windows):
        start = first.setdefault(window, at)
        if start != at:
            hit[at : at + 3] = hit[start : start + 3] = b"\1\1\1"
    return sum(hit)


def measure(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """(doc_id, stratum, *MEASURES) of every row; null texts count as empty, other columns are ignored."""
    schema = pa.schema([("doc_id", pa.int64()), ("stratum", pa.string()), *((m, pa.int64()) for m in MEASURES)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = zip(*map(measure_text, texts(batch)), strict=True)
                yield batch_of(schema, values(batch, "doc_id"), values(batch, "stratum"), *map(list, found))

    fields = "doc_id long, stratum string, " + ", ".join(f"{m} long" for m in MEASURES)
    return docs.select("doc_id", F.col(stratum).cast("string").alias("stratum"), "text").mapInArrow(count, fields)


def rule_values() -> dict[str, F.Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / words
    return {
        "symbol_rate": F.col("n_symbols") / words,
        "dup_line_rate": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_rate": F.col("n_repeat_words") / words,
        "short_words": -mean,
        "long_words": mean,
    }


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial X, exactly summed."""
    if k >= n:
        return 1.0
    at = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    return min(1.0, math.fsum(math.exp(at(i)) for i in range(k + 1)))


def upper_bound(k: int, n: int, error: float) -> float:
    """Clopper-Pearson upper confidence bound of a rate of which ``k`` of ``n`` were seen."""
    low, high = k / n if n else 0.0, 1.0
    if k >= n:
        return 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if binomial_tail(k, n, mid) > error else (low, mid)
    return high


def choose_cutoffs(good: dict[str, int], failed: dict[tuple[str, str], list[int]], risk: float, error: float) -> dict[tuple[str, str], float]:
    """The strictest safe cutoff of each (stratum, rule) from good holdout rows and how many of them fail each cutoff; ``risk`` is that of
    one rule.

    Holm: the sequences are ranked by the probability of their mildest cutoff; the i-th of m gets ``error / (m - i)``, and the
    first whose mildest cutoff fails ends the ranking.
    """
    tails = {key: [binomial_tail(k, good[key[0]], risk) for k in counts] for key, counts in failed.items()}
    chosen: dict[tuple[str, str], float] = {}
    for i, key in enumerate(sorted(tails, key=lambda key: (tails[key][0], key))):
        level = error / (len(tails) - i)
        safe = next((n for n, tail in enumerate(tails[key]) if tail > level), len(tails[key]))
        if not safe:
            break
        chosen[key] = CUTOFFS[key[1]][safe - 1]
    return chosen


def calibrate(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> dict[tuple[str, str], float]:
    """Cutoffs by (stratum, rule) from rows of ``labels`` (doc_id, quality); null labels and base failures are left out.

    One aggregate over all labelled rows; the driver sees one row per stratum. A null stratum is a stratum of its own, "".
    """
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    good = measured.join(known.where("_quality = 1"), "doc_id").where(~base_failed())
    found = rule_values()
    counts = [
        F.sum((found[rule] > F.lit(cut)).cast("long")).alias(f"{rule}_{n}")
        for rule, cuts in CUTOFFS.items()
        for n, cut in enumerate(cuts)
    ]
    rows = good.groupBy(F.coalesce("stratum", F.lit("")).alias("_stratum")).agg(F.count(F.lit(1)).alias("_good"), *counts).collect()
    failed = {(r["_stratum"], rule): [r[f"{rule}_{n}"] for n in range(len(cuts))] for r in rows for rule, cuts in CUTOFFS.items()}
    return choose_cutoffs({r["_stratum"]: r["_good"] for r in rows}, failed, risk / len(CUTOFFS), error)


def verdict(cutoffs: dict[tuple[str, str], float]) -> F.Column:
    """True where a measured row passes every cutoff of its stratum."""
    found = rule_values()
    passes = F.lit(True)
    for rule in CUTOFFS:
        own = [x for (s, r), cut in sorted(cutoffs.items()) if r == rule for x in (F.lit(s), F.lit(cut))]
        if own:
            limit = F.try_element_at(F.create_map(*own), F.coalesce("stratum", F.lit("")))
            passes = passes & F.coalesce(found[rule] <= limit, F.lit(True))
    return passes


def quality_rules(docs: DataFrame, labels: DataFrame, store: Store, stratum: str = "lang") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, stratum) of every row of ``docs``.

    Measures are written once. Repeated rows give repeated results; a null doc_id is measured and judged but has no label. Empty
    texts fail the base limits. Without labels ``kept`` is the base verdict.
    """
    measured = store.overwrite(measure(docs, stratum), "measures")
    cutoffs = calibrate(measured, labels)
    failed = base_failed()
    return measured.select(
        "doc_id", *MEASURES[:5], failed.alias("base_failed"), (~failed & verdict(cutoffs)).alias("kept"), "stratum"
    )
