from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from storepulse.functions import texts


def parsed(spark, *lines):
    rows = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    out = rows.select("i", texts.parse_log_line(F.col("line")).alias("f")).orderBy("i")
    return [tuple(row["f"]) for row in out.collect()]


def test_ids_are_zero_padded(spark):
    row = spark.range(7, 8).select(
        texts.padded_id(texts.CUSTOMER_ID, F.col("id")), texts.padded_id(texts.SALE_ID, F.col("id")),
        texts.padded_id(texts.EVENT_ID, F.col("id")), texts.padded_id(texts.CAMPAIGN_ID, F.col("id")),
        texts.padded_id(texts.PRODUCT_ID, F.col("id")),
    ).first()
    assert tuple(row) == ("CLI-000007", "TRX-00000007", "EVT-000007", "CMP-00007", "PROD-000007")


def test_line_round_trip_keeps_brackets_in_the_detail(spark):
    moment = datetime(2025, 3, 4, 5, 6, 7)
    rows = spark.createDataFrame([(moment, "a] [b [c]")], "t timestamp, detail string")
    line = rows.select(texts.log_line(
        F.col("t"), F.lit("INFO"), F.lit("Plaza, Norte"), F.lit("OPEN"), F.col("detail")
    )).first()[0]
    assert line == "[2025-03-04 05:06:07] [INFO] [Plaza, Norte] [OPEN] [a] [b [c]]"
    assert parsed(spark, line) == [(moment, "INFO", "Plaza, Norte", "OPEN", "a] [b [c]")]


def test_other_lines_give_nulls(spark):
    nothing = (None,) * 5
    assert parsed(spark, "", "free text", "[a] [b]", "[a] [b] [c] [d] [e", None) == [nothing] * 5


def test_unreadable_time_loses_only_the_time(spark):
    assert parsed(spark, "[soon] [INFO] [S] [OPEN] [d]") == [(None, "INFO", "S", "OPEN", "d")]


def test_times_in_and_out(spark):
    row = spark.createDataFrame([("2024-02-29T23:59:58", "2024-13-01")], "a string, b string").select(
        texts.iso_seconds(texts.moment(F.col("a"))), texts.moment(F.col("b"))
    ).first()
    assert tuple(row) == ("2024-02-29T23:59:58", None)
