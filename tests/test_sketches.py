"""Sketches of distinct customers, per period, over spans, and shared between spans."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from storepulse.operators import sketches


def sales(spark, rows):
    return spark.createDataFrame(rows, "day string, segment string, customer_id long, x int")


def day():
    return F.col("day")


def counted(frame):
    return {tuple(row)[:-1]: row[-1] for row in frame.collect()}


def test_customers_of_several_days_count_once(spark, scratch):
    rows = [("d1", "a", 1, 0), ("d1", "a", 1, 0), ("d2", "a", 1, 0), ("d2", "a", 2, 0),
            ("d2", "b", 1, 0), ("d3", None, None, 0), ("d3", None, 4, 0), (None, "a", 9, 0)]
    sketches.add_periods(sales(spark, rows), scratch, day(), "segment")
    stored = sketches.read_sketches(spark, scratch)
    assert counted(sketches.distinct_over(stored, "segment").select("segment", "n_sales", "n_keys")) == {
        ("a", 5): 3, ("b", 1): 1, (None, 2): 1}
    span = stored.filter("period <= 'd2'")
    assert counted(sketches.distinct_over(span, "segment").select("segment", "n_keys")) == {
        ("a",): 2, ("b",): 1}


def test_a_new_day_is_one_pass_over_its_own_sales(spark, scratch):
    first = [("d1", "a", i, 0) for i in range(10)]
    sketches.add_periods(sales(spark, first), scratch, day(), "segment")
    before = {p: p.stat().st_mtime_ns for p in Path(scratch).rglob("*d1/*.parquet")}
    # The facts of the first day are gone; only the second day's are given.
    sketches.add_periods(sales(spark, [("d2", "a", i, 0) for i in range(5, 15)]), scratch, day(),
                         "segment", first="d2", last="d2")
    assert {p: p.stat().st_mtime_ns for p in Path(scratch).rglob("*d1/*.parquet")} == before
    stored = sketches.read_sketches(spark, scratch)
    assert counted(sketches.distinct_over(stored, "segment").select("segment", "n_keys")) == {
        ("a",): 15}


def test_a_period_that_comes_again_is_replaced(spark, scratch):
    for _ in range(3):
        sketches.add_periods(sales(spark, [("d1", "a", 1, 0), ("d1", "a", 2, 0)]), scratch, day(),
                             "segment")
    (row,) = sketches.distinct_over(sketches.read_sketches(spark, scratch), "segment").collect()
    assert (row.n_sales, row.n_keys) == (2, 2)


def test_sales_outside_the_span_are_left_alone(spark, scratch):
    rows = [("d1", "a", 1, 0), ("d2", "a", 2, 0), ("d3", "a", 3, 0)]
    sketches.add_periods(sales(spark, rows), scratch, day(), "segment", first="d2", last="d2")
    assert {row.period for row in sketches.read_sketches(spark, scratch).collect()} == {"d2"}


def test_shared_customers(spark, scratch):
    rows = [("d1", s, i, 0) for s in ("a", None) for i in range(10)]
    rows += [("d2", s, i, 0) for s in ("a", None) for i in range(6, 20)]
    sketches.add_periods(sales(spark, rows), scratch, day(), "segment")
    stored = sketches.read_sketches(spark, scratch)
    days = [sketches.merged(stored.filter(F.col("period") == d), "segment") for d in ("d1", "d2")]
    assert counted(sketches.shared_by_all(days, "segment")) == {("a",): 4, (None,): 4}


@pytest.mark.parametrize("days", [1, 7])
def test_estimates_stay_within_their_bound(spark, scratch, days):
    n = 200_000
    rows = spark.range(2 * n).select(
        F.format_string("d%d", F.col("id") % days).alias("day"),
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("segment"),
        (F.xxhash64(F.col("id") % n)).alias("customer_id"))
    exact = counted(rows.groupBy("segment").agg(F.countDistinct("customer_id")))
    sketches.add_periods(rows, scratch, day(), "segment")
    found = counted(sketches.distinct_over(sketches.read_sketches(spark, scratch), "segment").select(
        "segment", "n_keys"))
    assert found.keys() == exact.keys()
    for group, n_keys in found.items():
        assert abs(n_keys - exact[group]) <= sketches.relative_error() * exact[group]
        assert n_keys != exact[group]


def test_no_sales_give_no_counts(spark, scratch):
    assert sketches.distinct_over(sketches.sketch_by(sales(spark, []), day(), "segment"), "segment"
                                  ).collect() == []
    assert sketches.stored_periods(spark, scratch + "/none") is None
