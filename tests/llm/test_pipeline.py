from __future__ import annotations

import pytest

import corpus_pipeline
from storepulse.llm import pii
from storepulse.llm.common import table, written
from tests.llm.conftest import documents

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SMALL), f"test-{name}")
        if name != "encoding":
            assert out.columns == columns
        seen[name] = out.toPandas()
        docs = out
    first = table(spark, SMALL, "documents").toPandas()
    labels = table(spark, SMALL, "labels").toPandas()
    clean = set(first.doc_id) & set(labels[labels.quality == 1].doc_id)
    kept = set(seen["quality"].doc_id)
    assert len(clean & kept) >= 0.95 * len(clean)
    assert len(seen["near_duplicates"]) < len(seen["quality"])
    assert set(seen["near_duplicates"].doc_id) <= kept
    assert len(seen["personal_data"]) == len(seen["near_duplicates"])
    assert not any(pii.base_spans(t) for t in seen["personal_data"].text)
    assert (seen["personal_data"].n_chars == seen["personal_data"].text.str.len()).all()
    assert seen["mixture"].doc_id.value_counts().max() <= 2
    assert sorted(seen["encoding"].doc_id) == sorted(seen["mixture"].doc_id)


def test_run(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"} <= set(found.columns)
    assert found.count() > 0


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, "x"), (3, "a b c"), (3, "a b c")]])
def test_awkward_tables(spark, rows):
    docs = documents(spark, rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert name == "encoding" or docs.columns == columns
    docs.collect()
