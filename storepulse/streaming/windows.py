"""Event-time windows that close, and the events that came after their window had closed.

One query does both, so both go by the same batches and the same watermark: the windows are
Spark's own, in append mode, and next to them the query passes every event's time and group
on. What came too late is worked out from those per batch, by the rule Spark drops by: a
window's end at or before the watermark that held for the batch before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from storepulse.schemas import struct
from storepulse.streaming.aggregates import windowed_summary
from storepulse.streaming.batches import batch_path, read_output, start, write_batch

PASSED = "passed"
CLOCK = struct("newest timestamp")


def passed_on(events: DataFrame, width: str, lateness: str, group: str = "category") -> DataFrame:
    """Closed windows, and of each event its time, window and group."""
    closed = windowed_summary(events, width, lateness)
    span = F.window("event_timestamp", width)
    seen = events.filter(F.col("event_timestamp").isNotNull()).select(
        "event_timestamp", span.alias("span"), group).select(
        "event_timestamp", F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"), group)
    return closed.withColumn("is_window", F.lit(True)).unionByName(
        seen.withColumn("is_window", F.lit(False)), allowMissingColumns=True)


def newest_before(spark: SparkSession, out: str, batch_id: int) -> Column:
    """The newest event time of all batches up to this one; NULL if there is none.

    Every batch's clock holds the newest of all until then, so one row is read.
    """
    if batch_id < 0:
        return F.lit(None).cast("timestamp")
    row = spark.read.schema(CLOCK).parquet(batch_path(out, "clock", batch_id)).first()
    return F.lit(row.newest if row else None).cast("timestamp")


def window_writer(out: str, lateness: str, schema: StructType,
                  group: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for what ``passed_on`` passes.

    The batch is computed once, into a table; its windows, its late events and its clock
    are read from there. All are replaced when the batch is replayed, and the clocks of
    earlier batches, which they are worked out from, no longer change.
    """
    windows = [f.name for f in schema.fields if f.name not in ("is_window", "event_timestamp")]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        write_batch(batch, out, PASSED, batch_id)
        rows = spark.read.schema(schema).parquet(batch_path(out, PASSED, batch_id))
        write_batch(rows.filter("is_window").select(*windows), out, "windows", batch_id)
        closed = newest_before(spark, out, batch_id - 2) - F.expr(f"interval {lateness}")
        late = rows.filter(~F.col("is_window") & (F.col("window_end") <= closed))
        write_batch(late.groupBy("window_start", "window_end", group).agg(
            F.count(F.lit(1)).alias("n_late"), F.min("event_timestamp").alias("oldest"),
        ), out, "late", batch_id)
        newest = rows.filter("not is_window").agg(F.max("event_timestamp").alias("newest"))
        write_batch(newest.select(F.greatest(
            "newest", newest_before(spark, out, batch_id - 1)).alias("newest")).coalesce(1),
            out, "clock", batch_id)

    return write


def start_windows(events: DataFrame, out: str, width: str = "10 seconds",
                  lateness: str = "10 minutes", group: str = "category",
                  **trigger: object) -> StreamingQuery:
    """Start windows over event time, with outputs ``windows`` and ``late``.

    A window is written once, when the newest event is ``lateness`` ahead of its end; its
    state is let go then. Events that come after that are in no window; ``late`` counts
    them by batch, window and group.
    """
    rows = passed_on(events, width, lateness, group)
    return start(rows, out, window_writer(out, lateness, rows.schema, group), **trigger)


def read_windows(spark: SparkSession, out: str, windows: StructType, group: str = "category"
                 ) -> DataFrame:
    """Closed windows with the events that came too late for them, over all batches.

    ``windows`` is the schema of ``windowed_summary``. A window all of whose events came
    too late has no summary, and no events in it.
    """
    keys = ["window_start", "window_end", group]
    closed = read_output(spark, out, "windows", windows).drop("batch_id")
    counted = struct("window_start timestamp, window_end timestamp, n_late bigint")
    counted = StructType(counted.fields + [windows[group]])
    late = read_output(spark, out, "late", counted).groupBy(*keys).agg(
        F.sum("n_late").alias("n_late")).select(*[F.col(k).alias(f"_{k}") for k in keys], "n_late")
    same = F.lit(True)
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    return closed.join(late, same, "full").select(
        *[F.coalesce(k, f"_{k}").alias(k) for k in keys],
        *[f.name for f in windows.fields if f.name not in keys],
        F.coalesce("n_late", F.lit(0)).alias("n_late")).fillna(0, ["n_events"])
