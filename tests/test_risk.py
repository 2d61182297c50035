from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from storepulse.functions import risk


def scores(spark, stock, minimum, amount):
    rows = spark.range(200).withColumns({
        "stock": F.lit(stock), "minimum": F.lit(minimum), "amount": F.lit(amount)})
    out = rows.select(risk.risk_score(F.col("stock"), F.col("minimum"), F.col("amount"), F.col("id")))
    return {row[0] for row in out.collect()}


@pytest.mark.parametrize("stock, minimum, amount, low, high", [
    (10, 10, 20.0, 0.70, 0.95),      # stock at the minimum
    (9, 10, 5000.0, 0.70, 0.95),     # stock wins over amount
    (11, 10, 1500.0, 0.40, 0.75),    # amount at the limit
    (11, 10, 1499.99, 0.05, 0.45),
    (0, 0, 1.0, 0.70, 0.95),         # an unknown product counts as out of stock
])
def test_tiers_are_filled_from_end_to_end(spark, stock, minimum, amount, low, high):
    found = scores(spark, stock, minimum, amount)
    assert (min(found), max(found)) == (low, high)
    assert len(found) == round((high - low) * 100) + 1


def test_position_depends_on_the_key_alone(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    a, b, again = (r[0] for r in rows.select(risk.key_position(F.col("k"))).collect())
    assert a == again != b and min(a, b) >= 0


@pytest.mark.parametrize("flag, score, stock, minimum, expected", [
    (True, None, None, None, True),
    (None, 0.70, None, None, True),
    (None, None, 5, 5, True),
    (None, None, None, None, None),
    (False, 0.69, 6, 5, False),
    (False, None, 6, 5, None),
])
def test_alert_is_three_valued(spark, flag, score, stock, minimum, expected):
    rows = spark.createDataFrame([(flag, score, stock, minimum)],
                                 "flag boolean, score double, stock int, minimum int")
    assert rows.select(risk.needs_alert(*map(F.col, rows.columns))).first()[0] is expected


def test_risky_from_seventy(spark):
    rows = spark.createDataFrame([(0.7,), (0.69,), (None,)], "s double")
    assert [r[0] for r in rows.select(risk.is_risky(F.col("s"))).collect()] == [True, False, None]
