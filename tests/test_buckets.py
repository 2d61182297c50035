"""Sale lines and orders laid out by order."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from storepulse.operators.joins import lookup
from storepulse.sinks import buckets
from storepulse.sources import tables


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_meet_their_orders_without_an_exchange(spark, scratch, small, no_broadcast):
    sold, placed = tables.sale_lines(spark, small), tables.sale_orders(spark, small)
    names = [f"t_{uuid.uuid4().hex}" for _ in range(3)]
    lines = buckets.write_bucketed(sold, names[0], f"{scratch}/lines", "order_id", 4)
    orders = buckets.write_bucketed(placed, names[1], f"{scratch}/orders", "order_id", 4)
    joined = lookup(lines, orders, "order_id")
    assert "Exchange" in plan(lookup(sold, placed, "order_id"))
    assert "Exchange" not in plan(joined)
    assert "Exchange" not in plan(joined.groupBy("order_id").count())
    expected = lookup(sold, placed, "order_id")
    assert joined.count() == expected.count() and joined.exceptAll(expected).count() == 0
    again = buckets.register(spark, names[2], f"{scratch}/orders", placed.schema, "order_id", 4)
    assert "Exchange" not in plan(lookup(lines, again, "order_id"))
    assert again.exceptAll(placed).count() == 0


def test_null_keys_and_empty_tables(spark, scratch):
    rows = spark.createDataFrame([(None, 1), (2, 2), (2, 3)], "order_id long, n int")
    name = f"t_{uuid.uuid4().hex}"
    table = buckets.write_bucketed(rows, name, f"{scratch}/a", "order_id", 4)
    assert sorted(map(tuple, table.collect()), key=str) == [(2, 2), (2, 3), (None, 1)]
    empty = buckets.write_bucketed(rows.limit(0), f"{name}_e", f"{scratch}/b", "order_id", 4)
    assert lookup(table, empty.withColumnRenamed("n", "m"), "order_id").count() == 3


def test_number_of_buckets(spark, small):
    assert buckets.planned_bytes(tables.sale_orders(spark, small)) > 0
    assert [buckets.buckets_for(n << 20) for n in (0, 256, 257, 1000, 100 << 20)] == [1, 1, 2, 4, 1 << 19]


def test_buckets_grow_with_what_a_sort_holds(spark, scratch):
    """Three million rows whose columns pack to next to nothing in the file."""
    path = f"{scratch}/packed"
    zero = [F.lit(0).cast("long").alias(f"c{i}") for i in range(5)]
    spark.range(3_000_000).select(F.col("id").alias("order_id"), *zero).write.parquet(path)
    rows = spark.read.parquet(path)
    planned = buckets.planned_bytes(rows)
    assert planned >= 3_000_000 * 6 * 8
    assert buckets.buckets_for(planned) == 2
    doubled = rows.unionAll(rows)
    assert buckets.planned_bytes(doubled) == 2 * planned
