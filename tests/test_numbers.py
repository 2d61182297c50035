from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings, strategies as st
from hypothesis import HealthCheck
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from storepulse.functions import numbers
from storepulse.functions.numbers import exact
from storepulse.operators.totals import totals


def means(spark, pairs):
    rows = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)],
                                 "i int, total long, n long")
    out = rows.select("i", numbers.mean_hundredths(F.col("total"), F.col("n")).alias("mean"))
    return [row["mean"] for row in out.orderBy("i").collect()]


def test_ties_round_away_from_zero(spark):
    assert means(spark, [(549, 18), (201, 2), (-201, 2), (1, 2), (-1, 2)]) == [
        0.31, 1.01, -1.01, 0.01, -0.01
    ]


def test_nothing_to_average_is_null(spark):
    assert means(spark, [(None, 0), (0, 0)]) == [None, None]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(1, 10**9)),
                min_size=1, max_size=60))
def test_mean_equals_decimal_arithmetic(spark, pairs):
    expected = [
        float((Decimal(total) / n).quantize(Decimal(1), ROUND_HALF_UP) / 100) for total, n in pairs
    ]
    assert means(spark, pairs) == expected


def exact_sums(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    value = numbers.exact(F.col("v"))
    total, count = F.sum(value).alias("total"), F.count(value).alias("n")
    found = rows.agg(total, count).select(
        numbers.shown(F.col("total")), numbers.mean_of(F.col("total"), F.col("n")))
    return tuple(found.first())


def test_awkward_doubles_sum_exactly(spark):
    assert exact_sums(spark, [0.07, 1.15, 2.675, -0.0]) == (3.90, 0.97)
    assert exact_sums(spark, [0.1] * 10 + [0.2] * 10) == (3.0, 0.15)


def test_small_amounts_count(spark):
    assert exact_sums(spark, [0.004] * 1000) == (4.0, 0.0)


def test_large_amounts_count_and_no_number_does_not(spark):
    assert exact_sums(spark, [2e13, 1e20, 0.01]) == (float("100000020000000000000.01"),
                                                     float("33333340000000000000"))
    assert exact_sums(spark, [float("nan"), float("inf"), 2.0, None]) == (2.0, 2.0)
    assert exact_sums(spark, [float("nan")]) == (None, None)


def test_amount_and_label(spark):
    row = spark.createDataFrame([(329.02, 5, 25432459.2)], "p double, q int, v double").select(
        numbers.line_amount(F.col("p"), F.col("q")), numbers.thousands_label(F.col("v"))
    ).first()
    assert tuple(row) == (1645.1, "25,432,459")


def test_totals_are_those_of_decimals(spark):
    """Whole millionths go another way than all else, to the same sums."""
    draw = random.Random(8)
    odd = [0.0, -0.0, 0.004, 1e-6, 5e-7, 4.9999999e-7, 0.1 + 0.2, -0.005, 1_099_511.627775,
           1_099_511.627776, -1_099_511.627775, 1e9 + 0.01, 1e15, 9.9e31, 1e32, -1e308, math.inf,
           -math.inf, math.nan, None, 1.0000005, 2.5e-6, 123456.7890125, 2 ** 53 + 0.0]
    rows = [("odd", v) for v in odd]
    rows += [("cents", draw.randint(-10 ** 7, 10 ** 7) / 100) for _ in range(3000)]
    rows += [("any", draw.uniform(-1, 1) * 10 ** draw.randint(-8, 12)) for _ in range(3000)]
    rows += [("none", None), ("none", math.nan)]
    sales = spark.createDataFrame(rows, "key string, amount double").repartition(5)
    found = totals(sales, "key")
    plain = sales.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_sales"), F.count(exact(F.col("amount"))).alias("n_amounts"),
        F.sum(exact(F.col("amount"))).alias("total"))
    assert sorted(found.collect(), key=str) == sorted(plain.collect(), key=str)
    assert found.schema["total"].dataType == DecimalType(38, 6)
