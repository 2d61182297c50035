"""Alerts that begin and end: a row only where a running mean crosses its limit.

The running means themselves are ``aggregates.ratings_by_courier``, which says what is so
now. This says when it became so, and so what to tell anyone: keyed state holds the count,
the exact sum and whether an alert is on, and a batch gives rows only for couriers whose
mean has crossed the limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from storepulse.functions.numbers import MICROS, WIDE, exact, mean_of
from storepulse.schemas import struct
from storepulse.streaming.aggregates import update_writer
from storepulse.streaming.batches import start

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = struct("n bigint, total string, low boolean")
CROSSING = ("courier_id string, alert string, n_ratings long, ratings decimal(38,6), "
            "order_id string, event_timestamp timestamp")


def crossings(total: int, n: int, low: bool, micros: list[int], limit: int
              ) -> tuple[int, int, bool, np.ndarray, np.ndarray]:
    """Running totals after each value, and the places where the mean crosses ``limit``.

    Whole-number arithmetic of any size: no order of addition and no tie can tip it.
    """
    totals = np.cumsum(np.array([total, *micros], object))[1:]
    counts = np.arange(n + 1, n + 1 + len(micros))
    below = (totals < limit * counts.astype(object)).astype(bool)
    at = np.flatnonzero(below != np.concatenate([[low], below[:-1]]))
    return int(totals[-1]), int(counts[-1]), bool(below[-1]), totals, at


class Crossings(StatefulProcessor):
    """State of one courier: ratings so far, their sum in millionths, and whether it is low."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("ratings", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values
                        ) -> Iterator[pd.DataFrame]:
        n, total, low = self.state.get() if self.state.exists() else (0, "0", False)
        # A batch has no order of its own; a courier's share of it is read in time order.
        rated = pd.concat(list(rows)).sort_values(
            ["event_timestamp", "order_id"], kind="stable", na_position="first")
        total, last, low, totals, at = crossings(
            int(total), n, low, [int(x) for x in rated.micros], self.limit)
        self.state.update((last, str(total), low))
        if not len(at):
            return
        # Alerts begin and end by turns.
        begins = (np.arange(len(at)) + (low != (len(at) % 2 == 1))) % 2 == 0
        yield pd.DataFrame({
            "courier_id": key[0], "alert": np.where(begins, "begin", "end"),
            "n_ratings": n + 1 + at, "ratings": [Decimal(int(totals[i])).scaleb(-6) for i in at],
            "order_id": rated.order_id.to_numpy()[at],
            "event_timestamp": rated.event_timestamp.to_numpy()[at],
        })

    def close(self) -> None:
        pass


def rating_crossings(orders: DataFrame, limit: float = 2.5) -> DataFrame:
    """``courier_id, alert, n_ratings, mean_rating, order_id, event_timestamp``.

    ``alert`` is begin where a courier's mean rating falls below the limit, end where it is
    back at it; the order is the one whose rating did it. Ratings that are none are left
    out. Within a batch a courier's ratings count in order of time and order_id; batches
    count as they come. State is three values per courier, and needs a state store that
    takes them (``rocks``).
    """
    rated = orders.filter((F.col("event_type") == "delivered") & exact(F.col("rating")).isNotNull())
    values = rated.select(
        "courier_id", "order_id", "event_timestamp",
        F.round(exact(F.col("rating")) * MICROS).cast(WIDE).cast("string").alias("micros"))
    rows = values.groupBy("courier_id").transformWithStateInPandas(
        Crossings(round(limit * MICROS)), CROSSING, outputMode="Update", timeMode="None")
    return rows.select(
        "courier_id", "alert", "n_ratings",
        mean_of(F.col("ratings"), F.col("n_ratings")).alias("mean_rating"),
        "order_id", "event_timestamp")


@contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state needs, for queries started meanwhile."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def start_crossings(orders: DataFrame, out: str, limit: float = 2.5, **trigger: object
                    ) -> StreamingQuery:
    """Start writing alerts as they begin and end, under ``crossings``."""
    with rocks(orders.sparkSession):
        return start(rating_crossings(orders, limit), out, update_writer(out, "crossings"),
                     mode="update", **trigger)


def alerts_on(written: DataFrame) -> DataFrame:
    """Couriers whose last crossing began an alert, with that crossing."""
    last = F.max_by(
        F.struct("alert", "n_ratings", "mean_rating", "order_id", "event_timestamp", "batch_id"),
        F.struct("batch_id", "n_ratings"))
    return written.groupBy("courier_id").agg(last.alias("row")).select(
        "courier_id", "row.*").filter("alert = 'begin'").drop("alert")
