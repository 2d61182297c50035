"""Collections of documents: whole or as they were."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from storepulse.sinks import documents

SCHEMA = "id bigint, name string, tags array<string>, at timestamp, inner struct<x: double>"


def rows(spark, *ids):
    return spark.range(5).filter(F.col("id").isin(*ids)).select(
        "id", F.when(F.col("id") != 2, F.concat(F.lit('é "q"\n'), "id")).alias("name"),
        F.array(F.lit("a"), F.lit(None).cast("string")).alias("tags"),
        F.expr("timestamp '2024-03-01 10:00:00.123'").alias("at"),
        F.struct(F.lit(0.1).alias("x")).alias("inner"))


def ids(spark, store):
    return sorted(r.id for r in documents.read_collection(spark, store, "c", SCHEMA).collect())


def test_a_collection_comes_back_as_it_was_written(spark, scratch):
    given = rows(spark, 0, 1, 2, 3, 4).repartition(3)
    documents.write_collection(given, scratch, "c")
    found = documents.read_collection(spark, scratch, "c", SCHEMA)
    assert sorted(found.collect()) == sorted(given.collect())
    assert documents.live(scratch, "c")["documents"] == 5


def test_an_overwrite_replaces_and_an_empty_one_empties(spark, scratch):
    documents.write_collection(rows(spark, 0, 1), scratch, "c")
    old = documents.read_collection(spark, scratch, "c", SCHEMA)
    documents.write_collection(rows(spark, 3), scratch, "c")
    assert ids(spark, scratch) == [3] and old.count() == 2
    documents.clean(scratch, "c")
    assert ids(spark, scratch) == [3] and len(list(Path(scratch, "c").iterdir())) == 2
    documents.export_collections({"c": rows(spark), "d": rows(spark, 4)}, scratch)
    assert ids(spark, scratch) == []
    with pytest.raises(FileNotFoundError):
        documents.read_collection(spark, scratch, "none", SCHEMA)


def test_a_failed_task_leaves_the_old_collection(spark, scratch):
    documents.write_collection(rows(spark, 0, 1), scratch, "c")
    bad = rows(spark, 2, 3, 4).repartition(3).withColumn("id", F.expr("12 div (id - 3)"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        documents.write_collection(bad, scratch, "c")
    assert ids(spark, scratch) == [0, 1]


def test_a_failure_at_the_swap_leaves_the_old_collection(spark, scratch):
    documents.write_collection(rows(spark, 0, 1), scratch, "c")
    writer = documents.CollectionWriter(f"{scratch}/c", "x")
    message = writer.write(iter([('{"id": 9}',)]))
    assert ids(spark, scratch) == [0, 1]
    writer.abort([message])
    assert not Path(scratch, "c", "write-x").exists()


def test_an_attempt_that_did_not_count_is_not_read(spark, scratch):
    writer = documents.CollectionWriter(f"{scratch}/c", "x")
    writer.write(iter([('{"id": 9}',)]))
    writer.commit([writer.write(iter([('{"id": 9}',)])), None])
    assert ids(spark, scratch) == [9]
