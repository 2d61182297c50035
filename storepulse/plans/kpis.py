"""The six sales indicators and the sales count by store.

Sales indicators take partial totals (``operators.totals``) that hold one row per
foreign key, and the dimension that key leads to. No indicator joins a table it
does not need, and none joins facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from storepulse.functions.numbers import mean_hundredths
from storepulse.operators.totals import mean_amount, merge, revenue, rollup_to


def totals_by(per_key: DataFrame, dimension: DataFrame, key: str, group: str) -> DataFrame:
    """Totals per dimension attribute; facts without a dimension row group under NULL."""
    joined = per_key.join(dimension.select(key, group), key, "left")
    return rollup_to(joined, group)


def revenue_report(grouped: DataFrame, group: str) -> DataFrame:
    """Sales, revenue and average ticket per group, highest revenue first."""
    return grouped.select(
        group, "n_sales", revenue().alias("revenue"), mean_amount().alias("mean_ticket")
    ).orderBy(F.desc("revenue"), group)


def revenue_by_category(per_product: DataFrame, products: DataFrame) -> DataFrame:
    return revenue_report(totals_by(per_product, products, "product_id", "category"), "category")


def revenue_by_city(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    return revenue_report(totals_by(per_customer, customers, "customer_id", "city"), "city")


def segment_totals(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Totals per segment with the number of distinct customers.

    ``per_customer`` arrives distributed by customer, which already keeps the rows
    of a segment's customer together: the inner merge needs no shuffle, and turns
    the distinct count into a plain one even if a customer is listed twice.
    """
    joined = per_customer.join(customers.select("customer_id", "segment"), "customer_id", "left")
    each = merge(joined, "segment", "customer_id")
    return rollup_to(each, "segment", n_customers=F.count("customer_id"))


def spend_by_segment(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct customers, spend and average spend per sale by segment."""
    return segment_totals(per_customer, customers).select(
        "segment", "n_customers", revenue().alias("spend"), mean_amount().alias("mean_spend")
    ).orderBy(F.desc("spend"), "segment")


def low_stock(products: DataFrame) -> DataFrame:
    """Products at or below their minimum stock, scarcest first."""
    return (
        products.filter(F.col("stock") <= F.col("stock_minimum"))
        .select("product_id", "product_name", "category", "stock", "stock_minimum", "supplier")
        .orderBy("stock", "product_id")
    )


def campaign_totals(campaigns: DataFrame, *keys: str) -> DataFrame:
    """Per key: campaigns, campaigns with a discount, and the sum of the discounts."""
    return campaigns.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_campaigns"),
        F.count("discount_pct").alias("n_discounts"),
        F.sum("discount_pct").alias("discounts"),
    )


def merge_campaigns(partials: DataFrame, *keys: str) -> DataFrame:
    return partials.groupBy(*keys).agg(
        F.sum("n_campaigns").alias("n_campaigns"),
        F.sum("n_discounts").alias("n_discounts"),
        F.sum("discounts").alias("discounts"),
    )


def campaigns_by_segment(partials: DataFrame) -> DataFrame:
    """Campaigns and mean discount per segment and channel."""
    return merge_campaigns(partials, "segment", "channel").select(
        "segment", "channel", "n_campaigns",
        mean_hundredths(F.col("discounts") * 100, F.col("n_discounts")).alias("mean_discount"),
    ).orderBy(F.desc("n_campaigns"), "segment", "channel")


def revenue_by_store(per_store: DataFrame) -> DataFrame:
    """Sales and revenue per store, from the sales themselves."""
    return rollup_to(per_store, "store").select(
        "store", "n_sales", revenue().alias("revenue")
    ).orderBy(F.desc("revenue"), "store")


def sales_count_by_store(per_store: DataFrame) -> DataFrame:
    """Number of sales per store; the amounts are never read."""
    return per_store.groupBy("store").agg(F.sum("n_sales").alias("n_sales")).orderBy(
        F.desc("n_sales"), "store"
    )
