"""Every operator and stage on nulls, empty and very long texts, repeated rows, empty tables and clashing column names."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from support import shipped  # noqa: F401

import corpus_pipeline
from grainhouse.llm import html_text, lm_difference, mixing, pieces, quality_rules, repair, secret_scan, sketch_dedup, spotsigs, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LABELS = "doc_id long, quality int, toxic int"
LONG = "the quick fox of the hill and a lazy dog is in the house " * 6000

ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "fr", "b", 4),
    (4, LONG, "en", None, len(LONG)),
    (5, "one word after another makes a text of words", None, "b", 44),
    (5, "one word after another makes a text of words", None, "b", 44),
    (6, "one word after another makes a text of words", "en", "a", 44),
    (None, "a text that has no id, and so no name", "en", "a", 37),
    (None, None, None, None, None),
    (7, "x" * 200_000, "en", "b", 200_000),
]
# names that operators use themselves
CLASHES = ["size", "target", "score", "_toxic", "node", "kept", "n_tokens", "_run", "_base", "_spans", "_row", "_hash", "copies", "component"]


@pytest.fixture
def docs(spark):
    plain = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return plain.withColumns({name: F.lit("theirs") for name in CLASHES})


@pytest.fixture
def empty(docs):
    return docs.where("false")


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 1, 1), (5, 0, None), (None, 1, 1), (6, None, None), (99, 0, 1)], LABELS)


def operators(store, labels):
    return {
        "quality": lambda d: quality_rules.quality_rules(d, labels, store),
        "repair": lambda d: repair.read_documents(repair.write_shards(d, WORDS, store, "shards")),
        "toxicity": lambda d: toxicity.toxicity(d, labels),
        "spotsigs": spotsigs.edited_pairs,
        "pieces": lambda d: pieces.round_trip_digests(d, PIECES),
        "difference": lambda d: lm_difference.score_documents(d, lm_difference.target_documents(labels)),
        "mixing": lambda d: mixing.mixture(d, store),
        "secrets": secret_scan.scan,
        "near": lambda d: sketch_dedup.near_duplicates(d, store),
    }


NAMES = ["quality", "repair", "toxicity", "spotsigs", "pieces", "difference", "mixing", "secrets", "near"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_row(docs, store, labels, name):
    found = operators(store, labels)[name](docs).collect()
    assert len(found) == len(ROWS)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted((r[0] is None, r[0] or 0) for r in ROWS)
    # equal rows have equal results, but for places in a file and for neighbours
    if name not in ("repair", "spotsigs"):
        assert len({r for r in found if r.doc_id == 5}) == 1


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(empty, store, labels, name):
    assert operators(store, labels)[name](empty).collect() == []


@pytest.mark.parametrize("name", ["quality", "toxicity", "difference"])
def test_no_labels(docs, store, labels, name):
    assert operators(store, labels.where("false"))[name](docs).count() == len(ROWS)


def test_defined_results(docs, store, labels):
    by = {name: {r.doc_id: r for r in op(docs).collect() if r.doc_id is not None} for name, op in operators(store, labels).items()}
    nothing = hashlib.sha256(b"").hexdigest()
    for k in (1, 2):
        assert by["quality"][k].n_words == 0 and by["quality"][k].base_failed and not by["quality"][k].kept
        assert by["repair"][k].n_tokens == 1
        assert by["toxicity"][k].predicted == 0
        assert by["spotsigs"][k].n_chars == 0 and by["spotsigs"][k].edited_sha256 == nothing
        assert by["pieces"][k].n_tokens == 0 and by["pieces"][k].decoded_sha256 == nothing
        assert by["difference"][k].n_tokens == 1
        assert by["mixing"][k].size == 0 and by["mixing"][k].taken == 0
        assert by["secrets"][k].spans == "" and by["secrets"][k].base_sha256 == nothing
        assert by["near"][k].n_shingles == 0 and by["near"][k].component_id == k and by["near"][k].kept
    assert by["near"][6].component_id == 5 and not by["near"][6].kept
    assert by["quality"][4].n_words == len(LONG.split()) == by["mixing"][4].size
    assert by["pieces"][4].decoded_sha256 == hashlib.sha256(LONG.encode()).hexdigest()
    assert by["spotsigs"][4].n_chars == len(LONG)


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES) - 1))
def test_stages_keep_columns(spark, docs, empty, labels, tmp_path, k):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stage = corpus_pipeline.STAGES[k][1]
    found = stage(spark, docs, str(tmp_path))
    assert found.columns == docs.columns and found.dtypes == docs.dtypes
    rows = found.collect()
    assert rows and all(r[name] == "theirs" for r in rows for name in CLASHES)
    assert stage(spark, empty, str(tmp_path)).collect() == []


def test_last_stage(spark, docs, empty, tmp_path):
    stage = corpus_pipeline.STAGES[-1][1]
    assert stage(spark, docs, str(tmp_path)).count() == len(ROWS)
    assert stage(spark, empty, str(tmp_path)).collect() == []


def test_pages(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None, "x", "y"), (None, None, "", "x", "y"), (3, "u", "<p>a</p>" * 50_000, "x", "y"), (3, "u", "<b>" * 50_000, "x", "y")]
    found = html_text.extract(spark.createDataFrame(rows, schema)).collect()
    assert [(r.page_id, r.url) for r in found] == [(r[0], r[1]) for r in rows]
    assert found[0].text == found[1].text == found[3].text == "" and found[0].n_chars == 0
    assert found[2].text.split("\n\n") == ["a"] * 50_000
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []
