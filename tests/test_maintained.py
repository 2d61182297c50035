"""Running totals from batches that may be replaced, and co-located sales."""

from __future__ import annotations

import pytest

from storepulse.schemas import struct
from storepulse.sinks import manifest
from storepulse.streaming import maintained

EVENTS = struct("transaction_id string, category string, total_amount double, risk_score double")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), EVENTS)


def summary(spark, path):
    schema = maintained.schema_of(batch(spark), "category")
    return sorted((tuple(r) for r in maintained.running_summary(spark, path, schema).collect()), key=str)


FIRST = [("t1", "a", 10.0, 0.1), ("t2", "a", 0.1, 0.2), ("t3", None, 5.0, None)]
SECOND = [("t4", "a", 0.2, 0.3), ("t5", "b", 7.0, 0.5)]


def test_batches_add_up_and_a_replay_changes_nothing(spark, scratch):
    assert summary(spark, scratch) == []
    maintained.maintain(batch(spark, *FIRST), scratch, 0, "category")
    version = maintained.maintain(batch(spark, *SECOND), scratch, 1, "category")
    expected = [("a", 3, 10.3, 0.2), ("b", 1, 7.0, 0.5), (None, 1, 5.0, None)]
    assert summary(spark, scratch) == sorted(expected, key=str)
    assert maintained.maintain(
        batch(spark, *reversed(SECOND)).repartition(3), scratch, 1, "category") == version
    assert summary(spark, scratch) == sorted(expected, key=str)


def test_a_replaced_batch_is_taken_back(spark, scratch):
    maintained.maintain(batch(spark, *FIRST), scratch, 0, "category")
    maintained.maintain(batch(spark, *SECOND, ("t6", "z", 1.0, 0.1)), scratch, 1, "category")
    maintained.maintain(batch(spark, *SECOND[:1]), scratch, 1, "category")
    assert summary(spark, scratch) == sorted(
        [("a", 3, 10.3, 0.2), (None, 1, 5.0, None)], key=str)
    maintained.maintain(batch(spark), scratch, 1, "category")
    maintained.maintain(batch(spark), scratch, 0, "category")
    assert summary(spark, scratch) == []


def test_work_and_tables_do_not_grow_with_batches(spark, scratch):
    for n in range(6):
        maintained.maintain(batch(spark, (f"t{n}", "a", 1.0, 0.5)), scratch, n, "category", keep=2)
    assert summary(spark, scratch) == [("a", 6, 6.0, 0.5)]
    live = manifest.manifest(spark, scratch)
    assert sorted(live["partitions"]) == [maintained.batch_part(n) for n in (4, 5)] + ["running"]
    with pytest.raises(maintained.Closed):
        maintained.maintain(batch(spark, *FIRST), scratch, 3, "category", keep=2)
    assert summary(spark, scratch) == [("a", 6, 6.0, 0.5)]


def test_a_failure_before_the_swap_changes_nothing(spark, scratch, monkeypatch):
    maintained.maintain(batch(spark, *FIRST), scratch, 0, "category")
    before = summary(spark, scratch)
    with monkeypatch.context() as patched:
        patched.setattr(manifest, "_publish", lambda *_: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            maintained.maintain(batch(spark, *SECOND), scratch, 1, "category")
    assert summary(spark, scratch) == before
    maintained.maintain(batch(spark, *SECOND), scratch, 1, "category")
    assert summary(spark, scratch) == sorted(
        [("a", 3, 10.3, 0.2), ("b", 1, 7.0, 0.5), (None, 1, 5.0, None)], key=str)


def test_fingerprint_counts_rows_and_places(spark):
    rows = [("t1", None, 1.0, 0.1), ("t1", None, 1.0, 0.1), ("t2", "a", 2.0, None)]
    prints = [maintained.fingerprint(batch(spark, *r)) for r in (
        rows, rows[::-1], rows[1:], [rows[0], rows[2], rows[2]],
        [(None, "t1", 1.0, 0.1)] * 2 + rows[2:], [])]
    assert prints[0] == prints[1] and len(set(prints)) == 5
