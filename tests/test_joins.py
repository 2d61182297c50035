from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from storepulse.operators.joins import hold_few, latest_per_key, lookup, lookup_few


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows under key 7, some under no key, some under an unknown one."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(
        F.col("id") % 120)
    return spark.range(3000).select("id", key.cast("long").alias("key"))


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(100).select(F.col("id").alias("key"), F.format_string("n%d", "id").alias("name"))


def bag(rows):
    return sorted((tuple(row) for row in rows.collect()), key=repr)


def test_left_join_keeps_facts_without_a_match(facts, dimension):
    names = {row["key"]: row["name"] for row in dimension.collect()}
    expected = [(row["key"], row["id"], names.get(row["key"])) for row in facts.collect()]
    assert bag(lookup(facts, dimension, "key")) == sorted(expected, key=repr)


def test_defaults_replace_what_is_missing(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "key int, v int")
    dimension = spark.createDataFrame([(1, "one", 5), (2, None, None)], "key int, name string, stock int")
    joined = lookup(facts, dimension, "key", {"name": "unknown", "stock": 0})
    assert bag(joined) == sorted(
        [(1, 10, "one", 5), (2, 20, "unknown", 0), (None, 30, "unknown", 0)], key=repr)


def test_few_rows_without_keys_keep_their_rows(spark, dimension):
    held = hold_few(spark.createDataFrame([(None, "a")], "key long, v string"), 5)
    assert bag(lookup_few(held, dimension, "key")) == [(None, "a", None)]


def test_few_rows_fetch_their_dimension_rows(spark, dimension):
    rows = spark.createDataFrame([(3, "a"), (None, "b"), (500, "c"), (3, "d")], "key long, v string")
    held = hold_few(rows, 10)
    assert bag(lookup_few(held, dimension, "key")) == sorted(
        [(3, "a", "n3"), (None, "b", None), (500, "c", None), (3, "d", "n3")], key=repr)
    assert hold_few(rows.orderBy("v"), 2).count() == 2


def test_few_rows_filter_the_scan(spark, small, capsys):
    parts = spark.read.parquet(f"{small}/part.parquet").select("p_partkey", "p_name")
    held = spark.createDataFrame([(3,), (5,)], "p_partkey long")
    lookup_few(held, parts, "p_partkey").explain()
    assert "PushedFilters: [In(p_partkey, [3,5])" in capsys.readouterr().out


def test_repeated_dimension_keys_multiply_facts_unless_reduced(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,)], "key int")
    repeated = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (2, "only", 1)], "key int, name string, version int")
    assert lookup(facts, repeated, "key").count() == 5
    latest = latest_per_key(repeated, "key", "version")
    assert latest.columns == repeated.columns
    assert bag(lookup(facts, latest, "key").select("key", "name")) == [
        (1, "new"), (1, "new"), (2, "only")]


def test_many_hot_keys_are_split_by_the_engine(spark):
    """3,000 keys, a third of the rows under one, no broadcast: no task holds a key whole."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    before = {key: spark.conf.get(key) for key in held}
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 3000)
    facts = spark.range(0, 400_000, 1, 8).select("id", key.alias("key"), F.uuid().alias("more"))
    dimension = spark.range(3000).select(F.col("id").alias("key"), F.format_string("n%d", "id").alias("name"))
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        joined = lookup(facts, dimension, "key").withColumn("task", F.spark_partition_id())
        tasks = joined.filter("key = 7").groupBy("task").count().collect()
        assert len(tasks) > 1 and sum(row["count"] for row in tasks) > 133_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
