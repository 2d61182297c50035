"""Delivery indicators: orders, delivery times, delays, cancellations, couriers.

Orders carry ``order_id``, ``customer_id`` and ``ordered_at``; shipments carry
``order_id``, ``courier_id``, ``shipped_at`` and ``cancelled``. An order counts as
delivered on its last shipment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from storepulse.functions.numbers import mean_hundredths
from storepulse.operators.ranking import rank_by_count


def orders_by_district(orders: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders"))
    joined = per_customer.join(customers.select("customer_id", "city"), "customer_id", "left")
    return joined.groupBy("city").agg(F.sum("n_orders").alias("n_orders"))


def delivery_days(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Days from order to last shipment.

    Shipments are reduced to one row per order before the join, so an order with
    any number of shipments joins as a single row.
    """
    last = shipments.groupBy("order_id").agg(F.max("shipped_at").alias("shipped_at"))
    joined = last.join(orders.select("order_id", "customer_id", "ordered_at"), "order_id")
    return joined.select(
        "order_id", "customer_id", F.datediff("shipped_at", "ordered_at").alias("days")
    )


def mean_delivery_days(days: DataFrame, customers: DataFrame) -> DataFrame:
    """Mean delivery time per district over orders not dated after their shipment.

    ``n_invalid`` counts the orders left out: those shipped before they were placed, and
    those without a date.
    """
    valid = F.col("days") >= 0
    per_customer = days.groupBy("customer_id").agg(
        F.count_if(valid).alias("n_orders"),
        F.sum(F.when(valid, F.col("days"))).alias("days"),
        F.count_if(~F.coalesce(valid, F.lit(False))).alias("n_invalid"),
    )
    joined = per_customer.join(customers.select("customer_id", "city"), "customer_id", "left")
    return joined.groupBy("city").agg(
        F.sum("n_orders").alias("n_orders"), F.sum("days").alias("days"),
        F.sum("n_invalid").alias("n_invalid"),
    ).select(
        "city", "n_orders", "n_invalid",
        mean_hundredths(F.col("days") * 100, F.col("n_orders")).alias("mean_days")
    )


def delayed_orders(days: DataFrame, limit_days: int = 30) -> DataFrame:
    return days.filter(F.col("days") > limit_days)


def cancellations_by_district(orders: DataFrame, shipments: DataFrame,
                              customers: DataFrame) -> DataFrame:
    """Orders with a cancelled item, and cancelled items, per district."""
    per_order = (
        shipments.filter("cancelled").groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))
    )
    per_customer = (
        per_order.join(orders.select("order_id", "customer_id"), "order_id", "left")
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("n_items").alias("n_items"))
    )
    joined = per_customer.join(customers.select("customer_id", "city"), "customer_id", "left")
    return joined.groupBy("city").agg(
        F.sum("n_orders").alias("n_orders"), F.sum("n_items").alias("n_items")
    )


def courier_ranking(shipments: DataFrame, couriers: DataFrame) -> DataFrame:
    """Couriers by completed deliveries."""
    done = (
        shipments.filter(~F.col("cancelled"))
        .groupBy("courier_id")
        .agg(F.count(F.lit(1)).alias("n_deliveries"))
    )
    return rank_by_count(done, "n_deliveries").join(couriers, "courier_id", "left").select(
        "courier_id", "courier_name", "n_deliveries", "rank"
    )
