from __future__ import annotations

import pytest

from tests.conftest import spark  # noqa: F401

# Null, empty, blank, repeated, tied, very long and special texts; clashing extra columns.
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from the angry old bear today."),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "The quick brown fox jumps over the lazy dog and runs far away from the angry old bear today."),
    (5, "The quick brown fox jumps over the lazy dog and runs far away from the angry old bear today."),
    (6, "one"),
    (7, "É'll don't <|endoftext|> Σίσυφος 123 日本 😀 " * 3),
    (8, "word " * 30_000),
    (9, "x" * 50_000),
    (10, "intro the quick brown fox jumps over the lazy dog and runs far away from the angry old bear today. outro"),
]


@pytest.fixture(scope="session")
def docs(spark):  # noqa: F811
    rows = [(i, t, "en", "block", len(t) if t else None) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, shard string, block string, n_tokens int").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.filter("false")
