"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from grainhouse.llm import byte_pairs, filter_audit, html_text, lm_difference, mixing, pieces, quality_rules, repair, secret_scan, sketch_dedup, spotsigs, toxicity, variants
from grainhouse.llm.common import scratch, ship_package, small_batches, table

Query = Callable[[SparkSession, str], DataFrame]


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), scratch(spark, "quality")
    )


def _repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("word_bpe_49k.json")
    return repair.read_documents(repair.write_shards(table(spark, sf_dir, "documents"), model, scratch(spark, "repair"), "shards"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    with small_batches(spark):  # written here, so that the setting holds while the texts are scored
        scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
        return scratch(spark, "toxicity").overwrite(scored, "scored")


def _spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_pairs(table(spark, sf_dir, "documents"))


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def _lm_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = lm_difference.target_documents(table(spark, sf_dir, "labels"))
    return lm_difference.score_documents(table(spark, sf_dir, "documents"), target)


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), scratch(spark, "mixing"))


def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def _html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def _near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_dedup.near_duplicates(table(spark, sf_dir, "documents"), scratch(spark, "near"))


def _byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_pairs.round_trip_digests(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def _filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return filter_audit.filter_audit(docs, labels, scratch(spark, "filter-audit"))


def _variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"), scratch(spark, "variants"))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_quality_rules": _quality,
        "op2_repair_tokens": _repair,
        "op3_toxicity": _toxicity,
        "op4_spotsigs": _spotsigs,
        "op5_sentencepiece": _pieces,
        "op6_lm_difference": _lm_difference,
        "op7_mixing": _mixing,
        "op8_secrets": _secrets,
        "op9_html_text": _html_text,
        "op10_near_duplicates": _near_duplicates,
        "op11_byte_pairs": _byte_pairs,
        "op12_filter_audit": _filter_audit,
        "op13_variants": _variants,
    }
    return {name: _shipped(query) for name, query in found.items()}
