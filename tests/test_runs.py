"""Rows kept sorted by a key, and read value by value without a shuffle."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from storepulse.schemas import struct
from storepulse.sinks import manifest, runs
from storepulse.sinks.buckets import row_bytes
from storepulse.sources import tables

SCHEMA = struct("id bigint, month string")
# 60 % of the rows have one month, a twentieth none.
MONTH = ("case when id % 20 = 0 then null when id % 10 < 6 then '1997-03' "
         "else concat('1996-', lpad(cast(id % 12 + 1 as string), 2, '0')) end")


def kept(spark, path, n=2000):
    rows = spark.range(0, n, 1, 5).selectExpr("id", f"{MONTH} as month")
    return rows, runs.write_sorted(rows, f"{path}/sorted", "month")


def dealt(rows):
    """Values and rows of each task."""
    of = rows.groupBy(F.spark_partition_id().alias("task")).agg(
        F.collect_set(F.coalesce("month", F.lit("none"))).alias("months"), F.count("*").alias("n"))
    return [(set(r.months), r.n) for r in of.collect()]


def test_tasks_hold_few_neighbouring_values(spark, scratch):
    rows, sales = kept(spark, scratch)
    found = runs.gathered(sales, "month", task_bytes=200 * row_bytes(SCHEMA))
    assert rows.exceptAll(found).count() == found.exceptAll(rows).count() == 0
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    tasks = dealt(found)
    assert len(tasks) > 3 and sum(n for _, n in tasks) == 2000
    assert all(len(months) == 1 for months, _ in tasks if months & {"none", "1997-03"})
    assert sum("1997-03" in months for months, _ in tasks) > 2
    assert max(n for _, n in tasks) < 800


def test_each_file_is_sorted(spark, scratch):
    _, sales = kept(spark, scratch)
    for file in sales.inputFiles():
        months = [r.month or "" for r in spark.read.parquet(file).collect()]
        assert months == sorted(months)


def test_filtered_and_empty_rows(spark, scratch):
    rows, sales = kept(spark, scratch)
    wanted = "id < 700 and month >= '1996-09'"
    found, expected = runs.gathered(sales.filter(wanted), "month"), rows.filter(wanted)
    assert expected.count() > 0
    assert expected.exceptAll(found).count() == found.exceptAll(expected).count() == 0
    assert runs.gathered(sales.filter("id < 0"), "month").count() == 0


def test_ranges():
    counts = [(None, 1), ("a", 2), ("b", 3), ("c", 9), ("d", 1)]
    assert runs.ranges(counts, 5) == [
        (None, None, 1), ("a", "b", 5), ("c", "c", 9), ("d", "d", 1)]
    assert runs.ranges([("a", 5), ("b", 5), (None, 1)], 100) == [("a", "b", 10), (None, None, 1)]


def test_the_setting_on_shuffles_is_as_before(spark, scratch):
    before = spark.conf.get(runs.CLEAN_UP, None)
    with pytest.raises(ZeroDivisionError):
        with runs.no_shuffle_kept(spark):
            assert spark.conf.get(runs.CLEAN_UP) == "true"
            1 / 0
    assert spark.conf.get(runs.CLEAN_UP, None) == before


def test_neither_write_by_month_shuffles(spark, small, monkeypatch):
    """Each write is one job of one stage; gathering months anew made it two."""
    context, replace, stages = spark.sparkContext, manifest.replace_sales_by_month, []

    def watched(sales, path, *more, **others):
        group = f"write-{len(stages)}-{path}"
        context.setJobGroup(group, "a write by month")
        try:
            version = replace(sales, path, *more, **others)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        tracker = context.statusTracker()
        stages.append([len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group)])
        return version

    monkeypatch.setattr(manifest, "replace_sales_by_month", watched)
    found = entry.sales_months_replaced(spark, small)
    assert stages == [[1], [1]]
    expected = tables.enriched_sales(spark, small).select(*found.columns)
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


def test_lines_meet_narrow_sides_first(spark, small):
    """Each lookup that shuffles takes along what those before it have added."""
    plan = tables.enriched_sales(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    keys = re.findall(r"Join LeftOuter, \((\w+)#", plan)
    assert keys.index("order_id") < keys.index("product_id") < keys.index("store_id")
