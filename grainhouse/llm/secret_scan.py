"""Secret scans: pattern matches, and strings that a battery of randomness tests cannot tell from random ones.

Native Spark expressions only. Positions of matches follow from the lengths of the matches and of the pieces between them.

Candidates of the battery are runs of at least ``LEAST_LENGTH`` characters of the base64 alphabets that hold a digit and a letter and
touch no pattern match. Their encoding (hexadecimal, base32, letters and digits, base64) names the alphabet. Under the hypothesis that
its symbols are uniform and independent, three p-values are taken: chi-squared of the symbol counts (Wilson-Hilferty),
runs above and below the middle of the alphabet, and serial correlation at lag one; the battery's is three times the least. Strings
that are not random are found with a controlled share of false discoveries: Benjamini-Hochberg within each family of
encoding and length class, so that many short strings do not decide about few long ones. What is left is reported as a secret. Strings
too short for the tests to reject ordinary text at all are never candidates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The patterns of the contract.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")  # in the order of the contract, then the battery's
ASSIGN_LENGTH = 12

LEAST_LENGTH = 24
FALSE_DISCOVERIES = 0.05
RUN = r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_LENGTH
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "alnum": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
_BIN = 0.05  # width of a bin of -log10(p)
_BINS = 240


def _spans(text: str, pattern: str, found: str) -> Column:
    """array<(start, end, value)> of the non-empty matches ``found`` of a pattern, in code points, end exclusive."""
    gaps = F.split(F.col(text), F.lit(pattern), -1)
    pairs = F.zip_with(
        F.slice(gaps, 1, F.size(found)), F.col(found), lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("value"))
    )
    empty = F.expr("struct(0 as at, cast(array() as array<struct<start: int, end: int, value: string>>) as out)")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["gap"]
        end = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    none = F.expr("cast(array() as array<struct<start: int, end: int, value: string>>)")
    return F.when(F.size(found) > 0, F.aggregate(pairs, empty, step, lambda acc: acc["out"])).otherwise(none)


def _upper_normal(z: Column) -> Column:
    """P(Z > z) of a standard normal, by a rational approximation with an error below 8e-8."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _encoding(value: Column) -> Column:
    body = F.rtrim(value, F.lit("="))
    return (
        F.when(body.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(body.rlike("^[A-Z2-7]+$"), "base32")
        .when(body.rlike("^[A-Za-z0-9]+$"), "alnum")
        .otherwise("base64")
    )


def _letters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("."), F.lit(0))


def _counts(span: Column) -> Column:
    """Adds what the tests need to (start, end, encoding, body, alphabet)."""
    body, alphabet = span["body"], span["alphabet"]
    n, half = F.length(body), F.floor(F.length(alphabet) / 2).cast("int")
    squares = F.aggregate(
        _letters(alphabet), F.lit(0.0), lambda total, c: total + F.pow(n - F.length(F.replace(body, c, F.lit(""))), 2)
    )
    zeros, ones = F.repeat(F.lit("0"), half), F.repeat(F.lit("1"), F.length(alphabet) - half)
    return F.struct(
        span["start"].alias("start"),
        span["end"].alias("end"),
        span["encoding"].alias("encoding"),
        n.cast("double").alias("n"),
        F.length(alphabet).cast("double").alias("k"),
        squares.alias("squares"),
        F.call_function("translate", body, alphabet, F.concat(zeros, ones)).alias("bits"),
        F.transform(_letters(body), lambda c: F.instr(alphabet, c).cast("double")).alias("at"),
    )


def _statistics(span: Column) -> Column:
    """Normal scores of the three tests; null where a test has nothing to go by, which counts as not random."""
    n, k, bits, at = (span[name] for name in ("n", "k", "bits", "at"))
    df = k - 1
    chi = F.greatest(span["squares"] * k / n - n, F.lit(1e-9))
    z_chi = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    ones = F.length(F.replace(bits, F.lit("0"), F.lit(""))).cast("double")
    changes = sum(((n - F.length(F.replace(bits, F.lit(c), F.lit("")))) / 2 for c in ("01", "10")), F.lit(0.0))
    both = 2 * ones * (n - ones)
    variance = both * (both - n) / (n * n * (n - 1))
    z_runs = F.when(variance > 0, (changes - both / n) / F.sqrt(variance))
    mean = F.aggregate(at, F.lit(0.0), lambda total, x: total + x) / n
    spread = F.aggregate(at, F.lit(0.0), lambda total, x: total + (x - mean) * (x - mean))
    size = F.size(at)
    products = F.zip_with(F.slice(at, F.lit(1), size - 1), F.slice(at, F.lit(2), size - 1), lambda x, y: (x - mean) * (y - mean))
    lag = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    z_serial = F.when(spread > 0, (lag / spread * n + 1) / F.sqrt(n))
    return F.struct(
        *[span[name].alias(name) for name in ("start", "end", "encoding", "n")],
        z_chi.alias("chi"), F.abs(z_runs).alias("runs"), F.abs(z_serial).alias("serial"),
    )


def _judged(span: Column) -> Column:
    """(start, end, family, bin): the family by encoding and length class, the bin of -log10 of the battery's p-value."""
    p = 3 * F.least(
        _upper_normal(span["chi"]), F.coalesce(2 * _upper_normal(span["runs"]), F.lit(0.0)), F.coalesce(2 * _upper_normal(span["serial"]), F.lit(0.0))
    )
    level = F.floor(-F.log10(F.least(F.greatest(p, F.lit(1e-300)), F.lit(1.0))) / _BIN)
    family = F.concat_ws(":", span["encoding"], F.floor(F.log2(span["n"]) * 2).cast("string"))
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"), family.alias("family"), F.least(level, F.lit(_BINS)).cast("int").alias("bin")
    )


def _tested(candidates: str) -> Column:
    """array<(start, end, family, bin)> of array<(start, end, value)>."""
    alphabets = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])

    def named(span: Column) -> Column:
        return F.struct(
            span["start"].alias("start"), span["end"].alias("end"), span["value"].alias("value"), _encoding(span["value"]).alias("encoding")
        )

    def cleaned(span: Column) -> Column:
        hexed = F.when(span["encoding"] == "hex", F.lower(span["value"])).otherwise(span["value"])
        plain = F.rtrim(F.translate(hexed, "-_", "+/"), F.lit("="))
        return F.struct(
            *[span[name].alias(name) for name in ("start", "end", "encoding")],
            plain.alias("body"), F.element_at(alphabets, span["encoding"]).alias("alphabet"),
        )

    found = F.col(candidates)
    for step in (named, cleaned, _counts, _statistics, _judged):
        found = F.transform(found, step)
    return found


def _tagged(spans: str, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _scanned(docs: DataFrame) -> DataFrame:
    """``docs`` with _base: array<(start, kind number, end)> and _tested: candidates that touch none of them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.withColumn("_text", text).withColumns(
        {
            "_assign": F.regexp_extract_all("_text", F.lit(ASSIGN), F.lit(0)),
            "_access": F.regexp_extract_all("_text", F.lit(ACCESS), F.lit(0)),
            "_hex": F.regexp_extract_all("_text", F.lit(HEX), F.lit(0)),
            "_run": F.regexp_extract_all("_text", F.lit(RUN), F.lit(0)),
        }
    )
    spans = {"_assign": ASSIGN, "_access": ACCESS, "_hex": HEX, "_run": RUN}
    found = found.withColumns({name: _spans("_text", pattern, name) for name, pattern in spans.items()})
    long_value = lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_LENGTH
    found = found.withColumn("_assign", F.filter("_assign", long_value))
    tagged = [_tagged(name, k) for k, name in enumerate(("_assign", "_access", "_hex"))]
    found = found.withColumn("_base", F.array_sort(F.concat(*tagged)))
    candidate = lambda s: (
        s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]") & ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    found = found.withColumn("_run", F.filter("_run", candidate))
    return found.withColumn("_tested", _tested("_run")).drop("_assign", "_access", "_hex", "_run")


def thresholds(docs: DataFrame, rate: float = FALSE_DISCOVERIES) -> dict[str, int]:
    """For each family the lowest bin of -log10 p at which strings are discovered to be ordinary; one row per family.

    Counts by bin cover all candidates. A bin counts with its highest p-value, which can only discover less.
    """
    candidate = docs.where(F.col("text").rlike(RUN))  # most texts have none
    rows = _scanned(candidate.select("text")).select(F.explode("_tested").alias("t")).select("t.family", "t.bin")
    counted = rows.groupBy("family", "bin").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("family").orderBy(F.desc("bin"))  # at most _BINS rows
    whole = Window.partitionBy("family")
    found = counted.withColumns({"_seen": F.sum("n").over(down), "_all": F.sum("n").over(whole)})
    found = found.where(F.pow(F.lit(10.0), -F.col("bin") * _BIN) <= rate * F.col("_seen") / F.col("_all"))
    return {r.family: r.low for r in found.groupBy("family").agg(F.min("bin").alias("low")).collect()}


def with_spans(docs: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``: sorted array<(start, kind number, end)> of pattern matches, and of all secrets.

    Null texts count as empty. Columns are added under names that begin with an underscore; ``docs`` must not have these.
    """
    found = _scanned(docs)
    low = thresholds(docs, rate)
    random = F.col("_tested")
    if low:
        limits = F.create_map(*[F.lit(x) for pair in sorted(low.items()) for x in pair])
        random = F.filter(random, lambda s: s["bin"] < F.coalesce(F.try_element_at(limits, s["family"]), F.lit(_BINS + 1)))
    found = found.withColumn("_random", random)
    spans = F.array_sort(F.concat("_base", _tagged("_random", KINDS.index("random"))))
    return found.withColumn("_spans", spans).drop("_random").drop("_tested", "_text")


def _listed(spans: str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of every row of ``docs``.

    Repeated rows give repeated results; a null doc_id stays null; other columns are ignored.
    """
    found = with_spans(docs.select("doc_id", "text"))
    count = lambda spans, k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    counts = [count("_spans", k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts[:3], F.sha2(_listed("_base"), 256).alias("base_sha256"), _listed("_spans").alias("spans"), counts[3])


def mask(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mark; overlapping spans become one. Null texts stay null."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring("text", acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], before, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text")))

    # the row travels as one column, so its names cannot clash with those used here
    found = with_spans(docs.select("text", F.struct("*").alias("_row")))
    text = F.when(F.size("_spans") > 0, F.aggregate("_spans", start, step, finish)).otherwise(F.col("text"))
    return found.select(F.col("_row").withField("text", text).alias("_row")).select("_row.*")
