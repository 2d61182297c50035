from __future__ import annotations

from zlib import crc32

import pandas as pd
import pytest

from storepulse.llm import quality_classifier, toxicity
from storepulse.llm.common import table
from storepulse.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD

MIDDLE = "/root/testdata/sf0.1"


def accuracy(spark, name, label):
    found = QUERIES[name](spark, MIDDLE).toPandas()
    labels = table(spark, MIDDLE, "labels").toPandas()
    assert len(found) == table(spark, MIDDLE, "documents").count()
    assert found.score.between(0, 1).all()
    expected = [crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]
    assert found.held_out.tolist() == expected
    both = found[found.held_out].merge(labels, on="doc_id")
    return (both.predicted == both[label]).mean(), both


def test_quality_held_out(spark):
    got, both = accuracy(spark, "op7_quality_classifier", "quality")
    assert got > 0.99
    assert (both[both.quality == 1].predicted == 1).mean() > 0.99


def test_toxicity_held_out(spark):
    got, both = accuracy(spark, "op1_toxicity", "toxic")
    assert got > 0.92
    assert (both[both.toxic == 0].predicted == 0).mean() > 0.98


def test_toxic_recall_held_out(spark):
    _, both = accuracy(spark, "op1_toxicity", "toxic")
    assert (both[both.toxic == 1].predicted == 1).mean() > 0.8
    assert (both[both.toxic == 0].predicted == 1).mean() < 0.005


def test_unseen_misspellings_share_subwords():
    clean = [f"a quiet page about gardens and rivers number {i} with words" for i in range(60)]
    bad = [f"a quiet page about gardens you wretched{s} person number {i}"
           for i, s in enumerate(["", "ly", "ness", "est", "er", "o"] * 10)]
    model = toxicity.Subwords.fit(clean + bad, [0] * 60 + [1] * 60)
    good, off = toxicity.Scorer(model).scores(
        ["a quiet page about rivers", "a quiet page you wretchedful person"])
    assert off > 0.7 > good


@pytest.mark.parametrize("labelled", [False, True])
def test_awkward_rows(spark, awkward, nothing, labelled):
    labels = spark.createDataFrame(
        [(6, 1, 0), (7, 0, 1), (1, None, None), (2, 1, 0), (None, 1, 1)] if labelled else [],
        "doc_id long, quality int, toxic int")
    described = quality_classifier.described(awkward)
    quality = quality_classifier.score(described, quality_classifier.train(described, labels))
    toxic = toxicity.score(awkward, toxicity.train(awkward, labels))
    for found in (quality.toPandas(), toxic.toPandas()):
        assert len(found) == len(AWKWARD)
        assert found.score.between(0, 1).all()
        assert found[found.doc_id == 7].score.nunique() == 1
    empty = quality_classifier.described(nothing)
    model = quality_classifier.train(empty, labels)
    assert quality_classifier.score(empty, model).count() == 0
    assert quality_classifier.accepted(nothing, model).columns == nothing.columns
    assert toxicity.score(nothing, toxicity.train(nothing, labels)).count() == 0


def test_accepted_is_what_the_score_says(spark, awkward):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    described = quality_classifier.described(docs)
    model = quality_classifier.train(described, labels)
    scored: pd.DataFrame = quality_classifier.score(described, model).toPandas()
    kept = quality_classifier.accepted(docs, model).toPandas()
    assert sorted(kept.doc_id) == sorted(scored[scored.predicted == 1].doc_id)
    assert kept.columns.tolist() == docs.columns
