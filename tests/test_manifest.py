"""Tables that are replaced at once, and batches compacted into days."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from storepulse.schemas import struct
from storepulse.sinks import manifest
from storepulse.sources import tables
from storepulse.streaming import batches, compaction

SCHEMA = struct("id bigint, month string")


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def held(spark, path, **more):
    return sorted((tuple(r) for r in manifest.read(spark, path, SCHEMA, "month", **more).collect()),
                  key=str)


def test_only_the_months_written_are_replaced(spark, scratch):
    assert manifest.replace(rows(spark, (1, "a"), (2, "b"), (3, None)), scratch, "month") == 1
    assert manifest.replace(rows(spark, (4, "b"), (5, "c")), scratch, "month") == 2
    assert held(spark, scratch) == [(1, "a"), (3, None), (4, "b"), (5, "c")]
    assert held(spark, scratch, only=["b"]) == [(4, "b")]
    first = manifest.manifest(spark, scratch, 1)
    assert held(spark, scratch, of=first) == [(1, "a"), (2, "b"), (3, None)]
    manifest.replace(rows(spark, (9, "z")), scratch, "month", whole=True)
    assert held(spark, scratch) == [(9, "z")]


def test_a_failure_before_the_swap_leaves_the_old_month(spark, scratch, monkeypatch):
    manifest.replace(rows(spark, (1, "a"), (2, "b")), scratch, "month")

    def fails(*_, **__):
        raise OSError("the driver died here")

    with monkeypatch.context() as patched:
        patched.setattr(manifest, "_publish", fails)
        with pytest.raises(OSError):
            manifest.replace(rows(spark, (3, "b")), scratch, "month")
    assert held(spark, scratch) == [(1, "a"), (2, "b")]
    assert len(list(Path(scratch, "data").iterdir())) == 2
    manifest.clean(spark, scratch)
    assert len(list(Path(scratch, "data").iterdir())) == 1
    assert held(spark, scratch) == [(1, "a"), (2, "b")]


def test_a_task_that_fails_leaves_the_old_month(spark, scratch):
    manifest.replace(rows(spark, (1, "a"), (2, "b")), scratch, "month")
    bad = rows(spark, (3, "b"), (0, "a")).withColumn("id", F.expr("10 div id"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        manifest.replace(bad, scratch, "month")
    assert held(spark, scratch) == [(1, "a"), (2, "b")]


def test_of_two_writers_one_fails(spark, scratch):
    manifest.replace(rows(spark, (1, "a")), scratch, "month")
    base = manifest.manifest(spark, scratch)
    one, two = (manifest.stage(rows(spark, (i, "a")), scratch, "month") for i in (2, 3))
    manifest.publish(spark, scratch, one, base)
    with pytest.raises(manifest.Conflict):
        manifest.publish(spark, scratch, two, base)
    assert held(spark, scratch) == [(2, "a")]
    assert [p.name for p in Path(scratch, "manifests").glob(".draft*")] == []


def test_cleaning_keeps_the_last_versions(spark, scratch):
    for i in range(5):
        manifest.replace(rows(spark, (i, "a")), scratch, "month")
    manifest.clean(spark, scratch, keep=2)
    assert manifest.versions(spark, scratch) == [4, 5]
    assert held(spark, scratch, of=manifest.manifest(spark, scratch, 4)) == [(3, "a")]


def test_months_are_pruned(spark, scratch):
    manifest.replace(rows(spark, (1, "a"), (2, "b")), scratch, "month")
    one = manifest.read(spark, scratch, SCHEMA, "month").filter("month = 'a'")
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().toString()


def test_sales_are_joined_once_for_both_writes(spark, small, monkeypatch):
    plans, replace = [], manifest.replace_sales_by_month

    def watched(sales, path, **more):
        plans.append(sales._jdf.queryExecution().optimizedPlan().toString())
        return replace(sales, path, **more)

    monkeypatch.setattr(manifest, "replace_sales_by_month", watched)
    found = entry.sales_months_replaced(spark, small)
    assert len(plans) == 2 and not any("Join" in plan for plan in plans)
    expected = tables.enriched_sales(spark, small).select(*found.columns)
    assert found.count() == expected.count() > 0
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


def test_no_table_has_no_rows(spark, scratch):
    assert held(spark, scratch) == []


EVENT = struct("event_id bigint, at timestamp")


def play(spark, out, first, last):
    for b in range(first, last):
        day = None if b % 7 == 0 else datetime(2024, 5, 1 + b // 80, 12)
        frame = spark.createDataFrame([(b * 10, day), (b * 10 + 1, day)], EVENT).coalesce(1)
        batches.write_batch(frame, out, "events", b)


def compacted(spark, out, upto):
    return compaction.compact(spark, out, "events", EVENT, F.col("at"), upto)


def test_two_hundred_batches_are_few_files(spark, scratch):
    play(spark, scratch, 0, 120)
    before = {tuple(r) for r in compaction.read_all(spark, scratch, "events", EVENT).collect()}
    compacted(spark, scratch, 117)
    assert {tuple(r) for r in compaction.read_all(spark, scratch, "events", EVENT).collect()} == before
    compaction.forget_batches(spark, scratch, "events")
    assert len(list(Path(scratch, "events").glob("batch_id=*"))) == 2
    play(spark, scratch, 120, 200)
    compacted(spark, scratch, 198)
    found = compaction.read_all(spark, scratch, "events", EVENT)
    assert len(found.inputFiles()) <= 4 * 2 + 1
    assert sorted((r.event_id, r.batch_id) for r in found.collect()) == [
        (b * 10 + i, b) for b in range(200) for i in (0, 1)]


def test_compaction_again_and_after_a_failure(spark, scratch, monkeypatch):
    play(spark, scratch, 0, 6)
    version = compacted(spark, scratch, 3)
    assert compacted(spark, scratch, 3) == version and compacted(spark, scratch, 2) == version
    with monkeypatch.context() as patched:
        patched.setattr(manifest, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compacted(spark, scratch, 4)
    compacted(spark, scratch, 4)
    found = compaction.read_all(spark, scratch, "events", EVENT).collect()
    assert sorted(r.event_id for r in found) == [b * 10 + i for b in range(6) for i in (0, 1)]
