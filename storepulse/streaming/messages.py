"""Keyed JSON messages: enriching, writing and reading them.

Every function maps a DataFrame to a DataFrame without running anything, and
serves batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from storepulse.functions.numbers import exact, line_amount
from storepulse.functions.risk import is_risky, key_position, risk_score
from storepulse.functions.texts import iso_seconds, moment
from storepulse.operators.joins import lookup
from storepulse.schemas import SALE_EVENT

# Fixed value: what a message says where the sale's customer or product is unknown.
UNKNOWN = "desconocido"

CUSTOMER_DEFAULTS = {"customer_name": UNKNOWN, "city": UNKNOWN}
PRODUCT_DEFAULTS = {"product_name": UNKNOWN, "category": UNKNOWN, "stock": 0, "stock_minimum": 0}


def enrich_events(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Sales with customer, city, product, category and stock, or their defaults."""
    customers = customers.select("customer_id", *CUSTOMER_DEFAULTS)
    products = products.select("product_id", *PRODUCT_DEFAULTS)
    bought = lookup(sales, customers, "customer_id", CUSTOMER_DEFAULTS)
    known = lookup(bought, products, "product_id", PRODUCT_DEFAULTS)
    return known.withColumn("store", F.coalesce("store", F.lit(UNKNOWN)))


def score_events(enriched: DataFrame, position: Column | None = None) -> DataFrame:
    """The 17 message fields, with amount, risk score and risk flag worked out."""
    if position is None:
        position = key_position(F.col("transaction_id"))
    amount = line_amount(F.col("unit_price"), F.col("quantity"))
    priced = enriched.withColumn("total_amount", amount)
    score = risk_score(F.col("stock"), F.col("stock_minimum"), F.col("total_amount"), position)
    scored = priced.withColumn("risk_score", score)
    return scored.withColumns({
        "is_risk": is_risky(F.col("risk_score")),
        "event_timestamp": iso_seconds(F.col("event_time")),
    }).withColumnsRenamed({"stock": "stock_actual", "stock_minimum": "stock_minimo"})


def to_messages(events: DataFrame, schema: StructType, key: str, timestamp: Column) -> DataFrame:
    """One message per event: key and JSON value as bytes, and the time it was sent."""
    body = F.to_json(F.struct(*schema.fieldNames()))
    return events.select(
        F.col(key).cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        timestamp.cast("timestamp").alias("timestamp"),
    )


def parse_messages(messages: DataFrame, schema: StructType = SALE_EVENT) -> DataFrame:
    """Typed events, one row per message.

    A message that is not readable JSON stays as a row of NULLs, so that counts
    are those of the topic. A single unreadable field or event time, and a number that sums
    cannot hold (NaN, infinite, 1e32 and beyond), is NULL by itself: no message can stop the
    stream, and no amount leaves a sum unseen. In all these cases ``corrupt_record`` keeps
    the text.
    """
    text = F.col("value").cast("string")
    readable = StructType(schema.fields + [StructField("corrupt_record", StringType())])
    body = F.from_json(text, readable, {"columnNameOfCorruptRecord": "corrupt_record"})
    rows = messages.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        text.alias("_text"),
        body.alias("_body"),
    ).select("message_key", "kafka_timestamp", "_text", "_body.*")
    checked = {
        field.name: F.when(exact(F.col(field.name)).isNotNull(), F.col(field.name))
        for field in schema.fields if isinstance(field.dataType, DoubleType)
    }
    checked["event_timestamp"] = moment(F.col("event_timestamp"))
    unreadable = F.col("_text").isNull()
    for name, value in checked.items():
        unreadable |= F.col(name).isNotNull() & value.isNull()
    return rows.withColumns({
        "corrupt_record": F.coalesce(
            "corrupt_record", F.when(unreadable, F.coalesce("_text", F.lit("")))
        ),
        **checked,
        "processing_timestamp": F.current_timestamp(),
    }).drop("_text")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Messages that could not be read in full, with their text."""
    return parsed.filter(F.col("corrupt_record").isNotNull()).select(
        "message_key", "kafka_timestamp", "corrupt_record"
    )
