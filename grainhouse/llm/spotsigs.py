"""SpotSigs fingerprints: common words mark spots, and the content words that follow make the signatures.

Native Spark expressions only. A signature is an anchor (a common word) with the chain of the next ``CHAIN`` content words (words that are not
common) within ``REACH`` words behind it. Boilerplate has few spots, running text many, so a small edit moves few signatures. A
text with fewer than ``LEAST_SPOTS`` signatures, such as a table, is fingerprinted by chains behind every word instead, and one of too
few words for a chain by all its words. The fingerprint is the sorted set of 64-bit hashes of the signatures.

Sets are compared by Jaccard similarity. Sets whose lengths differ too much cannot be similar: the similarity is at most the
ratio of the lengths. Comparisons stop at that bound, and a join compares sets of the same or the next partition by length only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Common words of the four languages of the corpus.
ANCHORS = (
    "the of and to in is that for on with as it by at from are was be this an "
    "der die das und den von zu mit ist nicht ein eine auf für im sich "
    "le la les de des et en un une du que est pour dans par sur "
    "el los las del y es por con para se su"
).split()
CHAIN = 2
REACH = 8
LEAST_SPOTS = 3


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits of a whole text."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(plain, " "))


def _chains(found: Column) -> Column:
    """Hash of every spot, null for other words."""

    def spot(word: Column, at: Column) -> Column:
        content = F.filter(F.slice(found, at + 2, F.lit(REACH)), lambda w: ~w.isin(ANCHORS))
        # an array of one binds the content words, which would be found anew wherever they are named
        chain = F.transform(
            F.array(content), lambda c: F.when(F.size(c) >= CHAIN, F.xxhash64(word, *[F.get(c, F.lit(k)) for k in range(CHAIN)]))
        )
        return F.when(word.isin(ANCHORS), F.get(chain, F.lit(0)))

    return F.array_compact(F.transform(found, spot))


def signatures(found: Column) -> Column:
    """Sorted distinct signatures of an array of words; empty for no words."""
    spots = _chains(found)
    every = F.transform(
        F.slice(found, 1, F.greatest(F.size(found) - CHAIN, F.lit(1))),
        lambda w, at: F.xxhash64(w, *[F.get(found, at + k) for k in range(1, CHAIN + 1)]),
    )
    none = F.expr("cast(array() as array<bigint>)")
    plain = F.when(F.size(found) > 0, every).otherwise(none)
    return F.sort_array(F.array_distinct(F.when(F.size(spots) >= LEAST_SPOTS, spots).otherwise(plain)))


def digest(spots: str) -> Column:
    """A fingerprint as text: the number of signatures and a hash of the set. Equal texts have equal digests."""
    return F.concat_ws(":", F.size(spots).cast("string"), F.md5(F.array_join(F.transform(spots, lambda x: F.hex(x)), ",")))


def likeness(a: str, b: str, least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 without comparing where their lengths rule out ``least``; 1 for two empty sets."""
    low, high = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    exact = shared / (low + high - shared)
    return F.when(high == 0, 1.0).when(low == 0, 0.0).when(low < least * high, 0.0).otherwise(exact)


def _cuts(docs: DataFrame, parts: int) -> list[int]:
    """Bounds that deal doc_ids into ``parts`` runs of about the same number of rows."""
    shares = [k / parts for k in range(1, parts)]
    found = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * parts)).alias("c")).first()["c"] if shares else []
    return sorted(set(found or []))


def _run_of(cuts: list[int]) -> Column:
    """How many cuts are below doc_id, by bisection; null ids come before all."""
    if not cuts:
        return F.when(F.col("doc_id").isNull(), -1).otherwise(0)
    held = F.array(*map(F.lit, cuts)).cast("array<bigint>")

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        below = F.get(held, mid) < F.col("doc_id")
        go = acc["low"] < acc["high"]
        return F.struct(
            F.when(go & below, mid + 1).otherwise(acc["low"]).alias("low"), F.when(go & ~below, mid).otherwise(acc["high"]).alias("high")
        )

    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length() + 1))
    found = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high")), halve, lambda acc: acc["low"])
    return F.when(F.col("doc_id").isNull(), -1).otherwise(found)


def with_next_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text, spots, next_text, next_spots): text and signatures of a row and of the next one in descending doc_id, after the last the
    first; null ids come last.

    Rows are dealt into runs of ids, and the first row of the next run joins each run as a guest, so no window sees more than a run. Rows that share a
    doc_id are ordered by a hash of their text. Null texts are empty. Signatures are made once a row, behind the shuffle and before the window.
    """
    spark = docs.sparkSession
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = plain.withColumn("_run", _run_of(_cuts(docs, parts)))
    # one row per run comes to the driver
    heads = [(r["_run"], r["id"]) for r in placed.groupBy("_run").agg(F.max("doc_id").alias("id")).collect()]
    heads.sort(reverse=True)
    guests = [(run, heads[(k + 1) % len(heads)][1]) for k, (run, _) in enumerate(heads)]
    hosts = F.broadcast(spark.createDataFrame(guests, "_run int, _id long"))
    invited = plain.join(hosts, F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", "text", "_run", F.lit(1).alias("_guest"))
    rows = placed.withColumn("_guest", F.lit(0)).unionByName(invited)
    order = ["_guest", F.desc_nulls_last("doc_id"), "_hash"]
    rows = rows.withColumn("_hash", F.xxhash64("text")).repartition("_run").sortWithinPartitions("_run", *order)
    rows = rows.withColumn("_words", words(F.col("text"))).withColumn("spots", signatures(F.col("_words"))).drop("_words")
    window = Window.partitionBy("_run").orderBy(*order)
    found = rows.withColumns({f"next_{c}": F.lead(c).over(window) for c in ("text", "spots")})
    return found.where("_guest = 0").select("doc_id", "text", "spots", "next_text", "next_spots")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_spots) of every row.

    The edited text has the last third (rounded down) of a text replaced by as many first characters of the next one's, or all.
    A text without words has an empty set; two empty sets are alike. Repeated rows are each other's next. Other columns are ignored.
    """
    rows = with_next_text(docs)
    cut = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.select("doc_id", "text", F.col("spots").alias("_own"), F.col("next_spots").alias("_next"), edited.alias("_edited"))
    kept = ["doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"), "_own", "_next"]
    rows = rows.select(*kept, words(F.col("_edited")).alias("_edit"))
    rows = rows.withColumn("_edit", signatures(F.col("_edit")))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digest("_own").alias("fingerprint"),
        digest("_edit").alias("edited_fingerprint"),
        likeness("_own", "_edit").alias("near_edited"),
        likeness("_own", "_next").alias("near_next"),
        F.size("_own").cast("long").alias("n_spots"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, spots) of every row: the sorted signature set of its whole text; null texts are empty."""
    found = docs.select("doc_id", words(F.coalesce("text", F.lit(""))).alias("_words"))
    return found.select("doc_id", signatures(F.col("_words")).alias("spots"))


def similar_pairs(found: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, likeness) of different sets that reach ``least``, and (doc_id, class) of all rows of :func:`fingerprints`.

    Equal sets are one class, named by its smallest doc_id. Sets meet if they share one of their first signatures (in the order of
    hashes, as many as the threshold leaves undecided) and lie in the same or the next partition by length. Empty sets match none.
    """
    classes = found.groupBy("spots").agg(F.min("doc_id").alias("class"))
    members = found.join(classes, "spots").select("doc_id", "class")
    full = classes.where(F.size("spots") > 0).withColumn("_n", F.size("spots"))
    part = F.floor(F.log("_n") / math.log(1 / least) + 1e-9).cast("int")
    prefix = F.slice("spots", 1, (F.col("_n") - F.ceil(least * F.col("_n") - 1e-9) + 1).cast("int"))
    spread = full.select("class", "_n", part.alias("_part"), F.explode(prefix).alias("_key"))
    near = spread.withColumn("_part", F.explode(F.array("_part", F.col("_part") + 1)))
    left, right = spread.alias("l"), near.alias("r")
    fits = (F.least("l._n", "r._n") >= least * F.greatest("l._n", "r._n") - 1e-9) & (F.col("l.class") != F.col("r.class"))
    met = left.join(right, (F.col("l._part") == F.col("r._part")) & (F.col("l._key") == F.col("r._key")) & fits)
    pairs = met.select(F.least("l.class", "r.class").alias("a"), F.greatest("l.class", "r.class").alias("b")).distinct()
    sets = full.select("class", "spots")
    both = pairs.join(sets.withColumnsRenamed({"class": "a", "spots": "_sa"}), "a")
    both = both.join(sets.withColumnsRenamed({"class": "b", "spots": "_sb"}), "b")
    alike = both.select("a", "b", likeness("_sa", "_sb", least).alias("likeness"))
    return alike.where(F.col("likeness") >= least - 1e-9), members
