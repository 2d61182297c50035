"""Rows kept as files that are each sorted by a key, and read from them value by value.

A table partitioned by month wants the rows of a month together. A shuffle gathers them by
writing every row once more, at three times what it takes in columns. In files that are each
sorted by month the rows of a month lie together already: parquet finds them by the bounds of
row groups and pages, so a task reads its months from all files and nothing is moved. For keys
of some hundred values at most, as a value with many rows is a scan of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, SparkSession, functions as F

from storepulse.sinks.buckets import BUCKET_BYTES, row_bytes

# Fixed value: Spark's setting to remove an execution's shuffle files when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def no_shuffle_kept(spark: SparkSession) -> Iterator[None]:
    """What is written in here leaves no shuffle files behind.

    Else they stay until the driver happens to collect the plan that made them.
    """
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def write_sorted(rows: DataFrame, path: str, by: str) -> DataFrame:
    """Write each task's rows as a file sorted by ``by``; gives the rows as they are kept."""
    with no_shuffle_kept(rows.sparkSession):
        rows.sortWithinPartitions(by).write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def ranges(counts: Iterable[tuple[object, int]], most: int) -> list[tuple[object, object, int]]:
    """First and last value and rows of what is read together, of values in order.

    Neighbours share a range of at most ``most`` rows; a value with more, and NULL, which has
    no neighbours, has one of its own.
    """
    found: list[tuple[object, object, int]] = []
    for value, n in counts:
        if found and None not in (value, found[-1][0]) and found[-1][2] + n <= most:
            found[-1] = (found[-1][0], value, found[-1][2] + n)
        else:
            found.append((value, value, n))
    return found


def gathered(rows: DataFrame, by: str, task_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of sorted files, dealt so that a task has those of a few neighbouring values.

    What is read together goes to two tasks, or to as many as hold it, each of which reads some
    of the files. Two at least, as Spark makes one task of a union of single ones. ``rows`` may
    be filtered beforehand; values that are gone are not looked for.
    """
    counts = [tuple(row) for row in rows.groupBy(by).count().orderBy(by).collect()]
    if not counts:
        return rows
    total = sum(n for _, n in counts)
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    # Few rows are spread over all cores.
    most = max(1, min(task_bytes // row_bytes(rows.schema), ceil(total / tasks)))

    def part(first: object, last: object, n: int) -> DataFrame:
        wanted = F.col(by).isNull() if first is None else F.col(by).between(F.lit(first), F.lit(last))
        return rows.filter(wanted).coalesce(max(2, ceil(n / most)))

    return reduce(DataFrame.union, (part(*found) for found in ranges(counts, 2 * most)))
