"""Looking at tables: profile, preview, random sample."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, number of columns and column names of each table.

    Counting reads no column data; parquet answers from its footers.
    """
    counts = [
        table.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            F.lit(len(table.columns)).cast("long").alias("n_columns"),
            F.lit(",".join(table.columns)).alias("column_names"),
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def preview(rows: DataFrame, n: int = 10, *order: Column) -> DataFrame:
    """n rows to look at: any n, or the first n of an order."""
    return (rows.orderBy(*order) if order else rows).limit(n)


def sample_with_replacement(rows: DataFrame, key: Sequence[str], fraction: float, seed: str,
                            draws: int = 4) -> DataFrame:
    """Random rows, each drawn up to ``draws`` times; ``fraction`` is the expected share.

    A draw takes a row if an md5 of seed, draw and key is below a threshold, so the same
    rows come out on any engine, in any order and on every retry. ``draw`` is its number.
    """
    bits = 32
    below = f"{round(fraction / draws * (1 << bits)):0{bits // 4}x}"
    named = F.concat_ws(":", F.lit(seed), "draw", *key)
    return (
        rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw"))
        .filter(F.substring(F.md5(named.cast("binary")), 1, bits // 4) < below)
    )
