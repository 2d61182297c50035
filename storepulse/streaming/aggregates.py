"""Stateful summaries over event time and over everything seen so far.

All run in update mode: a batch emits only the groups it changed, as its own
partition, and ``latest`` gives the current row of each group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from storepulse.functions.numbers import exact, mean_of, shown
from storepulse.streaming.batches import start, summary_by, write_batch


def windowed_summary(events: DataFrame, width: str = "10 seconds",
                     lateness: str = "10 minutes") -> DataFrame:
    """Summary per category and event-time window, whatever the batch boundaries.

    Events later than ``lateness`` behind the newest are dropped, and windows that
    far behind leave the state.
    """
    summary = summary_by(
        events.withWatermark("event_timestamp", lateness),
        F.window("event_timestamp", width).alias("span"), "category",
    )
    return summary.select(
        F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
        "category", "n_events", "revenue", "mean_risk",
    )


def running_totals(orders: DataFrame) -> DataFrame:
    """Orders placed and their amount per district; state is one row per district."""
    placed = orders.filter(F.col("event_type") == "placed")
    return placed.groupBy("district").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(exact(F.col("total_amount"))).alias("total"),
    ).select("district", "n_orders", shown(F.col("total")).alias("amount"))


def cancellations_by_reason(orders: DataFrame) -> DataFrame:
    cancelled = orders.filter(F.col("event_type") == "cancelled")
    return cancelled.groupBy("cancel_reason").agg(F.count(F.lit(1)).alias("n_cancelled"))


def delay_alerts(orders: DataFrame, limit_minutes: float = 30) -> DataFrame:
    """Delayed orders beyond the limit; stateless."""
    return orders.filter(
        (F.col("event_type") == "delayed") & (F.col("delay_minutes") > limit_minutes)
    ).select(
        "order_id", "district", "courier_id", "delay_minutes", "delay_reason", "event_timestamp"
    )


def ratings_by_courier(orders: DataFrame) -> DataFrame:
    """Rated deliveries and the sum of their ratings, per courier.

    The condition on the mean is left to ``low_ratings``: applied here, a courier
    whose mean recovers would emit nothing, and the old alert would stay.
    """
    rated = orders.filter((F.col("event_type") == "delivered") & exact(F.col("rating")).isNotNull())
    return rated.groupBy("courier_id").agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.sum(exact(F.col("rating"))).alias("ratings"),
    )


def low_ratings(current: DataFrame, limit: float = 2.5) -> DataFrame:
    """Couriers whose mean rating is now below the limit."""
    mean = mean_of(F.col("ratings"), F.col("n_ratings"))
    bound = F.col("n_ratings") * F.lit(limit).cast("decimal(10,4)")
    return current.filter(F.col("ratings") < bound).select(
        "courier_id", "n_ratings", mean.alias("mean_rating")
    )


def update_writer(out: str, name: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes the rows of each batch, and no more."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, out, name, batch_id)

    return write


def start_updates(summary: DataFrame, out: str, name: str, **trigger: object) -> StreamingQuery:
    return start(summary, out, update_writer(out, name), mode="update", **trigger)


def latest(updates: DataFrame, *keys: str) -> DataFrame:
    """The newest row per group among all batches' updates."""
    values = [c for c in updates.columns if c not in keys and c != "batch_id"]
    newest = F.max_by(F.struct(*values), "batch_id").alias("row")
    return updates.groupBy(*keys).agg(newest).select(*keys, "row.*")
