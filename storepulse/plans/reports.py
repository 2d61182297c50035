"""Small reports derived from the indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from storepulse.functions.numbers import MICROS, WIDE, half_up_ratio, thousands_label
from storepulse.operators.joins import hold_few, lookup_few
from storepulse.operators.ranking import top_n


def top_cities(by_city: DataFrame, n: int = 10) -> DataFrame:
    return top_n(by_city, n, F.desc("revenue"), F.col("city"))


def top_low_stock(low_stock: DataFrame, n: int = 10) -> DataFrame:
    return top_n(low_stock, n, F.col("stock"), F.col("product_id")).select(
        "product_id", "product_name", "stock"
    )


def top_products_by_units(sales: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The n products sold most often by units; names are fetched for those n only."""
    units = sales.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    best = hold_few(top_n(units, n, F.desc("units"), F.col("product_id")), n)
    names = products.select("product_id", "product_name")
    return lookup_few(best, names, "product_id").select("product_id", "product_name", "units")


def revenue_share(grouped: DataFrame, group: str) -> DataFrame:
    """Share of all revenue per group, in percent with one decimal.

    The total is a scalar subquery over the grouped totals, whose shuffle it
    shares; no row passes through an unpartitioned window.
    """
    everything = grouped.agg(F.sum("total")).scalar()
    permille = half_up_ratio(F.col("micros") * 1000, F.col("all_micros"))
    return grouped.select(
        group, (F.col("total") * MICROS).cast(WIDE).alias("micros"),
        (everything * MICROS).cast(WIDE).alias("all_micros"),
    ).select(
        group, (permille.cast("double") / 10).alias("share_pct")
    )


def revenue_labels(report: DataFrame, group: str, value: str = "revenue") -> DataFrame:
    return report.select(group, value, thousands_label(F.col(value)).alias("label"))


def campaign_calendar(campaigns: DataFrame) -> DataFrame:
    """Campaigns with the date each one ends."""
    return campaigns.withColumn("end_date", F.date_add("start_date", F.col("duration_days")))


def event_type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"))


def log_counts(log: DataFrame) -> DataFrame:
    """Log lines per level, store and event; unreadable lines count under NULL."""
    return log.groupBy("level", "store", "event").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min("logged_at").alias("first_logged_at"),
        F.max("logged_at").alias("last_logged_at"),
    )
