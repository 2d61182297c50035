"""Lookup joins: attach columns of a dimension to facts without losing facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def lookup(facts: DataFrame, dimension: DataFrame, key: str,
           defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Left join on ``key``; ``defaults`` replace what no dimension row supplied.

    No broadcast hint: Spark broadcasts a dimension it measures below
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges a larger one. A hot key
    is then split by AQE, which measures the shuffled partitions: nothing is counted
    beforehand, and any number of keys can be hot.
    """
    joined = facts.join(dimension, key, "left")
    if defaults:
        joined = joined.withColumns(
            {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
        )
    return joined


def hold_few(rows: DataFrame, n: int) -> DataFrame:
    """The at most ``n`` rows of a top-n or preview, fetched once and kept.

    Without this, everything built on those rows would find them anew.
    """
    return rows.sparkSession.createDataFrame(rows.limit(n).toArrow(), rows.schema)


def lookup_few(held: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join for rows kept by ``hold_few``.

    Their keys become a filter on the dimension, which parquet applies to row
    groups: of a dimension of any size only the rows of those few keys are joined.
    """
    keys = {row[0] for row in held.select(key).collect()} - {None}
    found = dimension.filter(F.col(key).isin(*keys))
    return held.join(found, key, "left")


def latest_per_key(rows: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key, the one with the highest ``version``.

    Guards a lookup against repeated dimension keys, which would multiply facts.
    An aggregate rather than a window, so that a key repeated without end is
    reduced before the shuffle.
    """
    others = [name for name in rows.columns if name != key]
    newest = F.max_by(F.struct(*others), F.struct(version, *others)).alias("row")
    return rows.groupBy(key).agg(newest).select(key, "row.*").select(*rows.columns)
