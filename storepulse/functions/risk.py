"""Risk score and alert rule of a sale event."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Score range of each tier in hundredths, the amount from which a
# sale counts as large, and the score from which an event counts as risky.
LOW_STOCK_TIER = (70, 95)
LARGE_AMOUNT_TIER = (40, 75)
ORDINARY_TIER = (5, 45)
LARGE_AMOUNT = 1500
RISKY_SCORE = 0.70


def risk_score(stock: Column, stock_minimum: Column, amount: Column, position: Column) -> Column:
    """Two-decimal score inside the tier that stock and amount select.

    ``position`` is a non-negative whole number that fixes the place inside the
    tier. It must come from the row (a key, or a hash of one), so that a retried
    task or a replayed batch gives the same score.
    """
    def within(tier: tuple[int, int]) -> Column:
        low, high = tier
        return F.lit(low) + position % F.lit(high - low + 1)

    points = (
        F.when(stock <= stock_minimum, within(LOW_STOCK_TIER))
        .when(amount >= LARGE_AMOUNT, within(LARGE_AMOUNT_TIER))
        .otherwise(within(ORDINARY_TIER))
    )
    return points.cast("double") / 100


def key_position(*keys: Column) -> Column:
    """A position from key columns, for data that carries no number of its own."""
    return F.pmod(F.xxhash64(*keys), F.lit(2**31 - 1))


def is_risky(score: Column) -> Column:
    return score >= RISKY_SCORE


def needs_alert(flag: Column, score: Column, stock: Column, stock_minimum: Column) -> Column:
    """True as soon as one branch is; unknown branches do not hide a known one."""
    return flag | (score >= RISKY_SCORE) | (stock <= stock_minimum)
