"""Top-n and ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Tasks that the rows of one count are dealt over.
SLOTS = 64


def top_n(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of a total order; each task keeps only n."""
    return rows.orderBy(*order).limit(n)


def rank_by_count(rows: DataFrame, count: str, rank: str = "rank") -> DataFrame:
    """``rank()`` over the whole table by a count, highest first, ties equal.

    A window over all rows would run in one task. The rank depends only on how
    many rows lie above, so the window runs over the distinct counts instead, one
    row each. Counts that add up to N facts have at most sqrt(2N) distinct values:
    about a million for 600 billion facts.
    """
    levels = rows.groupBy(count).agg(F.count(F.lit(1)).alias("_rows"))
    above = Window.orderBy(F.desc(count)).rowsBetween(Window.unboundedPreceding, -1)
    position = F.coalesce(F.sum("_rows").over(above), F.lit(0)) + 1
    # Most rows share a few low counts: each level is laid out once per slot, and the
    # rows of a count are dealt over the slots.
    slots = F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))).alias("_slot")
    ranks = levels.select(count, position.alias(rank)).select("*", slots)
    dealt = rows.withColumn("_slot", F.pmod(F.xxhash64(*rows.columns), F.lit(SLOTS)).cast("int"))
    return dealt.join(ranks, [count, "_slot"]).drop("_slot").select(*rows.columns, rank)
