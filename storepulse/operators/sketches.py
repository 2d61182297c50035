"""Distinct counts that merge: sketches per day and group, counted over any span.

A distinct count cannot be added up: a customer of two days is one customer. A theta sketch
can: the union over days, and the intersection of two groups, are sketches again. Sketches of
old days are never rebuilt, so a new day costs one pass over its own sales.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Nominal entries are 2 to this power: up to so many distinct keys a sketch is exact, above
# that the relative standard error is 1 / sqrt(entries - 1).
ENTRIES_LOG2 = 12


def relative_error(deviations: float = 3.0, entries_log2: int = ENTRIES_LOG2) -> float:
    """The relative error that an estimate stays within, at so many standard deviations."""
    return deviations / (2 ** entries_log2 - 1) ** 0.5


def sketch_by(sales: DataFrame, period: Column, *groups: str, key: str = "customer_id",
              entries_log2: int = ENTRIES_LOG2) -> DataFrame:
    """Per period and group: sales, and a sketch of their distinct keys.

    Partial aggregation leaves one sketch of bounded size per task and group, so a group
    that holds a third of all sales is no hot group of the shuffle. NULL keys count as
    sales, not as keys; sales without a period or a group have theirs under NULL.
    """
    return sales.groupBy(period.alias("period"), *groups).agg(
        F.count(F.lit(1)).alias("n_sales"),
        F.theta_sketch_agg(key, entries_log2).alias("keys"),
    )


def stored_periods(spark: SparkSession, path: str) -> DataFrame | None:
    """The periods that have sketches; None before the first."""
    try:
        return spark.read.parquet(f"{path}/rows").select("period").distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def add_periods(sales: DataFrame, path: str, period: Column, *groups: str,
                key: str = "customer_id", first: object = None, last: object = None) -> None:
    """Sketch the periods from ``first`` to ``last`` and store them; the others stay.

    Sales outside the span are filtered out before anything else, and so are never read if
    the table is partitioned or sorted by time. A period that is stored already is
    replaced, so a replay and late sales of a day both end in one sketch per group.
    """
    wanted = sales.withColumn("_period", period)
    if first is not None:
        wanted = wanted.filter(F.col("_period") >= F.lit(first))
    if last is not None:
        wanted = wanted.filter(F.col("_period") <= F.lit(last))
    rows = sketch_by(wanted, F.col("_period"), *groups, key=key)
    rows.withColumn("of", F.coalesce(F.col("period").cast("string"), F.lit("none"))).write.mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("of").parquet(
            f"{path}/rows")


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop("of")


def distinct_over(sketches: DataFrame, *groups: str | Column,
                  entries_log2: int = ENTRIES_LOG2) -> DataFrame:
    """Sales and distinct keys per group, over all periods in ``sketches``.

    Filter the sketches by period for another span; no fact is read again.
    """
    return merged(sketches, *groups, entries_log2=entries_log2).withColumn(
        "n_keys", F.theta_sketch_estimate("keys")).drop("keys")


def merged(sketches: DataFrame, *groups: str | Column,
           entries_log2: int = ENTRIES_LOG2) -> DataFrame:
    """One sketch per group, which can be merged and intersected further."""
    return sketches.groupBy(*groups).agg(
        F.sum("n_sales").alias("n_sales"),
        F.theta_union_agg("keys", entries_log2).alias("keys"),
    )


def shared_by_all(groups: Sequence[DataFrame], *by: str) -> DataFrame:
    """Per ``by``, distinct keys that are in the sketches of every one of ``groups``.

    Each holds one sketch per ``by``. NULLs in ``by`` meet each other.
    """
    def both(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("keys").alias("_keys"))
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
        return left.join(right, same).select(
            *by, F.theta_intersection("keys", "_keys").alias("keys"))

    common = reduce(both, [g.select(*by, "keys") for g in groups])
    return common.select(*by, F.theta_sketch_estimate("keys").alias("n_keys"))
