"""Sales with their customer and product attached."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from storepulse.operators.joins import lookup


def enrich_sales(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Every sale, with NULLs where its customer or product is unknown."""
    bought = lookup(sales, customers, "customer_id")
    return lookup(bought, products, "product_id")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make frames available to ``spark.sql`` under their names."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
