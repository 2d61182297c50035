"""Partial sales totals that can be merged along any chain of keys.

A report by city, category or segment does not join facts. It reduces the facts
to one row per foreign key (combined on the map side, so a key that holds a third
of all sales leaves each task as one row), joins those rows, and merges them. All
three columns are sums, so merging is exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storepulse.functions.numbers import (
    PART, PART_BITS, exact, joined_sum, mean_of, plain_micros, shown,
)


def totals(sales: DataFrame, *keys: str, amount: str = "amount") -> DataFrame:
    """Per key: sales, sales with a readable amount, and the sum of the amounts.

    Amounts of whole millionths below a million are summed as bigints in two parts; only
    others become decimals, row by row. Both sums are exact, and so is their sum.
    """
    micros = F.col("_micros")
    split = sales.select(*keys, plain_micros(F.col(amount)).alias("_micros"), F.col(amount).alias("_amount"))
    split = split.select(
        *keys, F.shiftright(micros, PART_BITS).alias("_high"),
        micros.bitwiseAND(F.lit(PART - 1)).alias("_low"),
        F.when(micros.isNull(), exact(F.col("_amount"))).alias("_rest"))
    summed = split.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_sales"),
        F.count("_high").alias("_n_plain"),
        F.sum("_high").alias("_high"), F.sum("_low").alias("_low"),
        # The filter keeps the rows that have none from touching the decimal.
        F.expr("count(_rest) filter (where _rest is not null)").alias("_n_rest"),
        F.expr("sum(_rest) filter (where _rest is not null)").alias("_rest"),
    )
    n_amounts = F.col("_n_plain") + F.col("_n_rest")
    return summed.select(
        *keys, "n_sales", n_amounts.alias("n_amounts"),
        joined_sum(F.col("_high"), F.col("_low"), F.col("_rest"), n_amounts).alias("total"))


def merge(partials: DataFrame, *keys: str) -> DataFrame:
    """Partial totals of a coarser key."""
    return partials.groupBy(*keys).agg(
        F.sum("n_sales").alias("n_sales"),
        F.sum("n_amounts").alias("n_amounts"),
        F.sum("total").alias("total"),
    )


def rollup_to(partials: DataFrame, *groups: str, **extra: Column) -> DataFrame:
    """Final totals per report group."""
    return partials.groupBy(*groups).agg(
        F.sum("n_sales").alias("n_sales"),
        F.sum("n_amounts").alias("n_amounts"),
        F.sum("total").alias("total"),
        *[column.alias(name) for name, column in extra.items()],
    )


def revenue() -> Column:
    return shown(F.col("total"))


def mean_amount() -> Column:
    return mean_of(F.col("total"), F.col("n_amounts"))
