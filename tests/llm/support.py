"""Fixtures of the tests beside this file, which import them by name."""

import pytest
from conftest import SMALL

from grainhouse.llm.common import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def documents(spark):
    """Documents from texts, or from (text, source) pairs; ids count from 0."""

    def build(texts):
        rows = [t if isinstance(t, tuple) else (t, "s") for t in texts]
        rows = [(k, t, "en", s, None if t is None else len(t)) for k, (t, s) in enumerate(rows)]
        return spark.createDataFrame(rows, DOCS)

    return build


@pytest.fixture
def folder_texts(spark):
    """doc_id -> text of the smallest data folder."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def by_id(df):
    return {r.doc_id: r for r in df.collect()}
