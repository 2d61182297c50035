from __future__ import annotations

import random

import numpy as np
import pytest

from storepulse.llm import ann, near_dedup
from storepulse.llm.common import table
from storepulse.llm.near_dedup import Settings
from tests.llm.conftest import AWKWARD, documents

SMALL = "/root/testdata/sf0.01"


def expected_components(rows, words, percent):
    """By comparing all pairs of sets of word tuples."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(zip(*(w[k:] for k in range(words)))) if len(w) >= words else (
            frozenset([tuple(w)]) if w else frozenset())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = [i for i in sets if sets[i]]
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_classes_by_all_pairs(spark, words, percent):
    docs = table(spark, SMALL, "documents")
    expected = expected_components(
        [(r.doc_id, r.text) for r in docs.collect()], words, percent)
    found = near_dedup.classes(docs, Settings(words, percent)).collect()
    assert len(found) == len(expected)
    for row in found:
        assert (row.n_shingles, row.component_id) == expected[row.doc_id]
        assert row.kept == (row.doc_id == row.component_id)


def chain(n, step=3, size=120):
    """Texts of which each links with its neighbours only."""
    words = [f"w{i}" for i in range(size + step * n)]
    return [(100 + i, " ".join(words[step * i:step * i + size])) for i in range(n)]


def test_chains_and_large_groups(spark, monkeypatch):
    draw = random.Random(2)
    base = [f"v{i}" for i in range(150)]
    near = []
    for i in range(60):
        own = list(base)
        for place in draw.sample(range(150), draw.randint(0, 4)):
            own[place] = f"x{i}.{place}"
        near.append((1000 + i, " ".join(own)))
    rows = chain(12) + near + [(5000 + i, near[0][1]) for i in range(30)]
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    found = near_dedup.classes(documents(spark, rows), Settings(3, 85)).collect()
    expected = expected_components(rows, 3, 85)
    assert {r.doc_id: r.component_id for r in found} == {i: c for i, (_, c) in expected.items()}


def test_awkward_classes(spark, awkward, nothing):
    found = near_dedup.classes(awkward).collect()
    assert len(found) == len(AWKWARD)
    by_id = {r.doc_id: r for r in found}
    assert by_id[None].component_id is None and by_id[None].kept
    assert all(by_id[i].n_shingles == 0 and by_id[i].component_id == i for i in (1, 2, 3))
    kept = near_dedup.deduplicated(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 5, 6, 7, 8]
    assert near_dedup.classes(nothing).count() == 0
    assert near_dedup.deduplicated(nothing).columns == nothing.columns


def test_rows_of_one_doc_id_are_documents_of_their_own(spark):
    """What has no copy stays, whatever its doc_id; of copies one row stays."""
    text = [" ".join(f"{name}{i}" for i in range(30)) for name in "abcd"]
    rows = [(1, text[0]), (5, text[0]), (5, text[1]), (5, text[1]), (6, text[1] + " more"),
            (7, text[2] + " more"), (7, text[2]), (7, ""), (7, ""), (None, text[2]), (8, text[3])]
    kept = near_dedup.deduplicated(documents(spark, rows), Settings(3, 85)).collect()
    found = sorted((r.doc_id or 0, r.text) for r in kept)
    assert [(i, t) for i, t in found if i != 7] == [
        (0, text[2]), (1, text[0]), (5, text[1]), (8, text[3])]
    # Two near copies with the same doc_id are one document; empty texts are linked with nothing.
    assert sorted(t[:1] for i, t in found if i == 7) == ["", "", "c"]


def test_blocks_of_a_bucket_are_dealt_by_block(spark):
    schema = "bucket long, id binary, root binary, n long, registers binary, shingles binary"
    members = spark.createDataFrame([], schema).repartition("bucket")
    plan = near_dedup.leftover_links(members, Settings())._jdf.queryExecution().executedPlan().toString()
    import re
    assert re.search(r"hashpartitioning\(bucket#\d+L, low#\d+, high#\d+", plan)


def test_sketches_merge_and_estimate():
    settings = Settings(3, 85)
    draw = np.random.default_rng(4)
    values = near_dedup.mixed(draw.integers(0, 2 ** 63, 3000).astype(np.uint64))
    for similarity in (0.3, 0.6, 0.85):
        common = int(2 * 1000 * similarity / (1 + similarity))
        a, b = values[:1000], np.concatenate([values[:common], values[1000:2000 - common]])
        x, y = (near_dedup.sketch(v, settings.registers) for v in (a, b))
        merged = near_dedup.sketch(np.union1d(a, b), settings.registers)
        assert np.array_equal(np.maximum(x, y), merged)
        estimate = near_dedup.likely_similarity(
            np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([(x == y).sum()]),
            np.array([1000.]), np.array([1000.]))[0]
        assert abs(estimate - similarity) < 0.2


def test_bands_miss_little():
    for settings in (Settings(3, 85), Settings(5, 80), Settings(2, 50)):
        hit = (settings.percent / 100) ** settings.band
        assert (1 - hit) ** settings.bands <= near_dedup.MISSED


def nearest(rows, k, every):
    """All inner products, sorted."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for i, v in zip(ids, x):
        if i % every == 0:
            order = sorted((-s, j) for j, s in zip(ids.tolist(), (x @ v).tolist()) if j != i)
            out[int(i)] = [(j, -s) for s, j in order[:k]]
    return out


def test_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    expected = nearest(rows, 20, 20)
    found = {}
    for r in ann.search(table(spark, "/root/testdata/sf0.1", "embeddings")).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found.keys() == expected.keys()
    hits = [len({j for j, _ in found[i]} & {j for j, _ in expected[i]}) / 20 for i in expected]
    assert np.mean(hits) >= 0.9
    exact = dict(rows)
    for i, near in found.items():
        assert near == sorted(near, key=lambda p: (-p[1], p[0])) and len(near) == 20
        for j, score in near:
            assert abs(score - np.dot(np.array(exact[i], float), np.array(exact[j], float))) < 1e-12


@pytest.mark.parametrize("lengths", ["uniform", "lognormal"])
def test_recall_of_vectors_of_differing_lengths(spark, lengths):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x *= (draw.uniform(0.5, 1.5, (6000, 1)) if lengths == "uniform"
          else draw.lognormal(0, 0.5, (6000, 1)))
    rows = list(enumerate(x.tolist()))
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = nearest(rows, 20, 20)
    found = {}
    for r in ann.search(vectors).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = [len(found[i] & {j for j, _ in expected[i]}) / 20 for i in expected]
    assert np.mean(hits) >= 0.94


def test_few_and_odd_vectors(spark):
    rows = [(0, [1., 0.]), (1, [0., 1.]), (2, [2., 0.]), (3, [2., 0.]), (20, [0.5, 0.5]), (4, None),
            (5, []), (6, [0., 0.]), (7, [float("nan"), 1.]), (8, [float("inf"), 1.]), (9, [None, 1.]),
            (None, [1., 1.]), (2, [2., 0.])]
    vectors = spark.createDataFrame(
        [(i, v, "clash") for i, v in rows], "vec_id long, embedding array<float>, vector string")
    good = sorted((i, v) for i, v in rows if i in (0, 1, 2, 3, 20))
    found = {}
    for r in ann.search(vectors).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    # Both rows of 2 are candidates.
    assert found == nearest(good, 20, 20)
    assert [i for i, _ in found[0]].count(2) == 2


def test_each_row_of_a_repeated_query_has_its_results(spark):
    rows = [(20, [1., 0.]), (20, [0., 1.]), (1, [3., 1.])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(vectors).collect()]
    assert sorted(found) == [(20, 1, 1, 1.0), (20, 1, 1, 3.0), (20, 2, 20, 0.0), (20, 2, 20, 0.0)]
    assert ann.search(vectors.limit(0)).count() == 0


def test_hot_vector_is_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    draw = np.random.default_rng(6)
    rows = [(i, [1., 0., 0.]) for i in range(100)] + [
        (100 + i, v) for i, v in enumerate(draw.normal(size=(60, 3)).tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in ann.search(vectors).orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    for i in (0, 20, 80):
        assert len(found[i]) == 20 and i not in found[i]


def test_lists_are_balanced():
    x = np.random.default_rng(7).normal(size=(2000, 5))
    centres = ann.balanced(x, 20)
    assert len(centres) >= 20
    same = np.ones((500, 4))
    assert 1 <= len(ann.balanced(same, 8)) <= 64
