"""Money and rounding as exact column expressions.

Amounts are summed as decimals with six digits after the point and rounded only when
they are shown, so small amounts count and no order of addition matters.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WIDE = "decimal(38,0)"
# Whole micros below 2^40 are summed in two parts of at most 20 bits each, so that bigints
# hold the sums of 2^43 rows. Any such number of micros is what its double stands for.
PART_BITS = 20
PART = 1 << PART_BITS
EXACT = "decimal(38,6)"
MICROS = 1_000_000


def exact(value: Column) -> Column:
    """A double as a decimal; NaN and the infinities, which no decimal holds, are NULL."""
    return value.try_cast(EXACT)


def plain_micros(value: Column) -> Column:
    """A double's millionths as a bigint if they are a whole number below 2^40, else NULL.

    The number found is divided again: only a double that is the nearest to those millionths
    passes, and a double that has fewer than 16 digits is the nearest to one such number.
    """
    micros = F.rint(value * MICROS)
    return F.when((F.abs(micros) < PART * PART) & (micros / MICROS == value), micros.cast("bigint"))


def joined_sum(high: Column, low: Column, rest: Column, count: Column) -> Column:
    """The exact total of the parts of `plain_micros` and of the other amounts; NULL of none."""
    micros = (F.coalesce(high, F.lit(0)).cast("decimal(20,0)") * F.lit(PART).cast("decimal(7,0)")
              + F.coalesce(low, F.lit(0)).cast("decimal(20,0)"))
    plain = (micros * F.lit("0.000001").cast("decimal(6,6)")).cast(EXACT)
    return F.when(count > 0, (plain + F.coalesce(rest, F.lit(0).cast(EXACT))).cast(EXACT))


def shown(total: Column) -> Column:
    """An exact total to two decimals, ties away from zero."""
    return F.round(total, 2).cast("double")


def half_up_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator to the nearest whole number, ties away from zero.

    Whole-number arithmetic throughout, so no intermediate rounding can tip a tie.
    NULL where there is nothing to divide by.
    """
    wide = denominator.cast(WIDE) * 2
    above = F.abs(numerator.cast(WIDE)) * 2 + denominator.cast(WIDE)
    size = F.round((above - above % F.nullif(wide, F.lit(0).cast(WIDE))) / F.nullif(
        wide, F.lit(0).cast(WIDE))).cast(WIDE)
    return F.when(numerator < 0, -size).otherwise(size)


def mean_hundredths(total: Column, count: Column) -> Column:
    """Mean rounded to two decimals, from a sum of hundredths and a count."""
    return half_up_ratio(total, count).cast("double") / 100


def mean_of(total: Column, count: Column) -> Column:
    """Mean of exact values to two decimals, without rounding in between."""
    micros = F.round(total * MICROS).cast(WIDE)
    return half_up_ratio(micros, count * (MICROS // 100)).cast("double") / 100


def line_amount(unit_price: Column, quantity: Column) -> Column:
    """Price times quantity, to the cent."""
    return F.round(unit_price * quantity, 2)


def thousands_label(value: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(value, 0)
