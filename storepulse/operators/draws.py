"""Random draws of an exact number of rows, the same on every engine and every retry.

Rows have an order that a seed shuffles: that of an md5 of seed and key. Without replacement
the first n are drawn; with replacement every draw names a place in that order, and may name
one many times. Places are found by counting rows per share of the md5's range, so nothing is
sorted as a whole and no row passes the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# Hex digits of an md5 that name a share, and those that name a draw's place.
SHARE_DIGITS, PLACE_DIGITS = 4, 15


def shuffled(rows: DataFrame, key: Sequence[str], seed: str) -> DataFrame:
    """Rows with ``_order``, the md5 they are drawn by, and ``_share`` of its range.

    Rows of one key are ordered by their other columns; NULLs in a key count as a text.
    """
    named = F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("null"))
                                            for c in key])
    order = F.md5(named.cast("binary"))
    return rows.withColumn("_order", order).withColumn(
        "_share", F.conv(F.substring("_order", 1, SHARE_DIGITS), 16, 10).cast("int"))


def share_starts(rows: DataFrame) -> DataFrame:
    """``_share, _rows, _start``: the rows of each share, and of all before it.

    The window runs over the shares, of which there are 65,536 at most.
    """
    earlier = W.orderBy("_share").rowsBetween(W.unboundedPreceding, -1)
    counts = rows.groupBy("_share").agg(F.count(F.lit(1)).alias("_rows"))
    return counts.withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))


def within_share(columns: Sequence[str]) -> Column:
    return F.row_number().over(W.partitionBy("_share").orderBy("_order", *columns)) - 1


def draw(rows: DataFrame, n: int, key: Sequence[str], seed: str) -> DataFrame:
    """Exactly ``n`` rows, each at most once; all of them if there are no more.

    Shares that lie below the n-th row as a whole are taken as they come. Only the rows of
    the one share that it lies in are put in order.
    """
    columns = rows.columns
    mixed = shuffled(rows, key, seed)
    placed = mixed.join(share_starts(mixed).filter(F.col("_start") < n), "_share")
    whole = placed.filter(F.col("_start") + F.col("_rows") <= n)
    border = placed.filter(F.col("_start") + F.col("_rows") > n)
    cut = border.withColumn("_place", F.col("_start") + within_share(columns)).filter(
        F.col("_place") < n)
    return whole.select(columns).unionByName(cut.select(columns))


def draw_again(rows: DataFrame, n: int, key: Sequence[str], seed: str) -> DataFrame:
    """Rows with ``times``: ``n`` draws with replacement, each of any row alike.

    ``times`` adds up to ``n`` unless there are no rows. A draw's place is a 60-bit hash of
    its number, scaled to the number of rows. Draws are numbered by Spark, so there may be
    any number of them; those of one row are added up before they meet it.
    """
    columns = rows.columns
    mixed = shuffled(rows, key, seed)
    starts = share_starts(mixed)
    spark = rows.sparkSession
    total = starts.agg(F.sum("_rows")).scalar().cast("decimal(18,0)")
    hashed = F.md5(F.concat(F.lit(f"{seed}:draw:"), F.col("id").cast("string")).cast("binary"))
    digits = F.conv(F.substring(hashed, 1, PLACE_DIGITS), 16, 10).cast("decimal(19,0)")
    place = F.expr(f"cast(_digits * _total as decimal(38,0)) div {16 ** PLACE_DIGITS}BD")
    drawn = spark.range(n).select(digits.alias("_digits"), total.alias("_total")).filter(
        F.col("_total") > 0).select(place.cast("long").alias("_place"))
    drawn = drawn.groupBy("_place").agg(F.count(F.lit(1)).alias("times"))
    ordered = mixed.join(starts.select("_share", "_start"), "_share").withColumn(
        "_place", F.col("_start") + within_share(columns))
    return ordered.join(drawn, "_place").select(*columns, "times")
