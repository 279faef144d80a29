"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainhouse.llm import mixing, pieces, secret_scan, sketch_dedup, toxicity
from grainhouse.llm.common import scratch, ship_package, small_batches, table


#: Similarity in percent from which two documents of the corpus are one.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted lexicon does not reject. The model is learned from the labels of these documents."""
    ship_package(spark)
    with small_batches(spark):  # written here, so that the setting holds while whole rows pass the workers
        kept = toxicity.drop_toxic(docs, toxicity.fit_folds(docs, table(spark, sf_dir, "labels")))
        return scratch(spark, "pipeline-toxicity").overwrite(kept, "kept")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    ship_package(spark)
    return sketch_dedup.drop_near_duplicates(docs, scratch(spark, "pipeline-near"), NEAR_PERCENT)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark and ``n_chars`` counted anew."""
    masked = secret_scan.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    ship_package(spark)
    return mixing.repeat_rows(docs, scratch(spark, "pipeline-mix"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256) of every row of the mix."""
    ship_package(spark)
    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# The lexicon's weights, the randomness tests and the encoding are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    store = scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store.overwrite(stage(spark, docs, sf_dir), name)
    return docs
