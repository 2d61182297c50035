"""The given parquet tables as sales, customers, products, campaigns and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from storepulse import schemas
from storepulse.functions import texts
from storepulse.operators.joins import lookup
from storepulse.operators.totals import merge, totals
from storepulse.plans.kpis import campaign_totals
from storepulse.sources.streams import parquet_files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation as city."""
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city")
    )
    located = lookup(table(spark, sf_dir, "customer"), nations, "c_nationkey")
    return located.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        "city",
        F.col("c_mktsegment").alias("segment"),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their segment, for reports that need no city."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") * 10).alias("stock"),
        (F.col("p_partkey") % 31 + 10).cast("int").alias("stock_minimum"),
        F.col("p_brand").alias("supplier"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("ordered_at"),
        F.col("o_orderpriority").alias("channel"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale lines; the customer stands on the order."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("amount"),
        F.rint(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
        F.col("l_shipdate").alias("shipped_at"),
        (F.col("l_returnflag") == "R").alias("cancelled"),
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).withColumnRenamed("store_id", "courier_id")


def enriched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sale line with its order, customer, product and store.

    Where no side is small enough to broadcast, each lookup shuffles the lines with all that
    they have by then. So the store comes first, which adds least to a line, then the product;
    customers are attached to the orders, which are several times fewer. The orders come last:
    then the lines of an order lie together, and files of them pack well.
    """
    sold, placed = sale_lines(spark, sf_dir), sale_orders(spark, sf_dir)
    known_stores, known_products = stores(spark, sf_dir), products(spark, sf_dir)
    with_store = lookup(sold, known_stores, "store_id")
    with_product = lookup(with_store, known_products, "product_id")
    known_orders = lookup(placed, customers(spark, sf_dir), "customer_id")
    sides = (sold, known_products, known_stores, known_orders)
    columns = (name for side in sides for name in side.columns)
    return lookup(with_product, known_orders, "order_id").select(
        *dict.fromkeys(["order_id", "store_id", "product_id", *columns]))


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).drop("discount_pct", "shipped_at", "cancelled")


def sale_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select(
        "order_id", "customer_id", F.col("ordered_at").alias("sold_at")
    )


def totals_per_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(lines(spark, sf_dir), "product_id")


def totals_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are reduced to their order before the order's customer is looked up."""
    per_order = totals(lines(spark, sf_dir), "order_id")
    buyers = orders(spark, sf_dir).select("order_id", "customer_id")
    return merge(lookup(per_order, buyers, "order_id"), "customer_id")


def totals_per_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_store = totals(lines(spark, sf_dir), "store_id")
    return lookup(per_store, stores(spark, sf_dir), "store_id")


def campaign_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns, one per sale line, counted by customer segment and order channel."""
    per_order = campaign_totals(lines(spark, sf_dir), "order_id")
    where = orders(spark, sf_dir).select("order_id", "customer_id", "channel")
    # Dealt by customer alone: the grouping and the lookup after it share one shuffle.
    bought = lookup(per_order, where, "order_id").repartition("customer_id")
    per_customer = bought.groupBy("customer_id", "channel").agg(
        F.sum("n_campaigns").alias("n_campaigns"),
        F.sum("n_discounts").alias("n_discounts"),
        F.sum("discounts").alias("discounts"),
    )
    return lookup(per_customer, segments(spark, sf_dir), "customer_id")


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns, one per order, lasting 5 to 30 days."""
    return orders(spark, sf_dir).select(
        texts.padded_id(texts.CAMPAIGN_ID, F.col("order_id")).alias("campaign_id"),
        F.col("ordered_at").cast("date").alias("start_date"),
        (F.lit(5) + F.col("order_id") % 26).cast("int").alias("duration_days"),
    )


def events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The events table at rest or as a stream, with the number in ``props`` as ``k``."""
    path = f"{sf_dir}/events.parquet"
    schema = schemas.TABLES["events"]
    raw = parquet_files(spark, path, schema) if stream else spark.read.schema(schema).parquet(path)
    return raw.withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))


def event_store(user: Column) -> Column:
    return F.format_string("Store %d", user % 5)


def named_products(spark: SparkSession, sf_dir: str) -> int:
    """How many product keys events name: a quarter more than there are."""
    highest = table(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0] or 0
    return highest * 5 // 4 + 1


def event_sales(raw: DataFrame, n_products: int) -> DataFrame:
    """Events as sales: who bought how many of what, where and when."""
    return raw.select(
        "event_id",
        F.col("user_id").alias("customer_id"),
        (F.col("event_id") % n_products).alias("product_id"),
        event_store(F.col("user_id")).alias("store"),
        (F.col("k") % 5 + 1).alias("quantity"),
        F.col("value").alias("unit_price"),
        F.col("ts").alias("event_time"),
        "k",
    )


def text_ids(scored: DataFrame) -> DataFrame:
    """Numeric keys of enriched events as the padded text ids messages carry."""
    return scored.withColumns({
        "transaction_id": texts.padded_id(texts.SALE_ID, F.col("event_id")),
        "customer_id": texts.padded_id(texts.CUSTOMER_ID, F.col("customer_id")),
        "product_id": texts.padded_id(texts.PRODUCT_ID, F.col("product_id")),
        "event_id": texts.padded_id(texts.EVENT_ID, F.col("event_id")),
    })


# Kind of delivery message each event type stands for.
ORDER_KINDS = {
    "purchase": "placed",
    "signup": "placed",
    "view": "delivered",
    "click": "delayed",
    "error": "cancelled",
}


def order_events(raw: DataFrame, buyers: DataFrame) -> DataFrame:
    """Events as delivery messages; each kind fills its own fields only."""
    kind = F.create_map(*[F.lit(x) for pair in ORDER_KINDS.items() for x in pair])[F.col("event_type")]
    k = F.col("k")

    def for_kinds(value: Column, *kinds: str) -> Column:
        return F.when(F.col("event_type").isin(*kinds), value)

    reason = F.format_string("reason %d", k % 5)
    located = lookup(
        raw.withColumnRenamed("user_id", "customer_id"),
        buyers.select("customer_id", F.col("city").alias("district")),
        "customer_id",
    )
    return located.withColumn("event_type", kind).select(
        texts.padded_id(texts.EVENT_ID, F.col("event_id")).alias("event_id"),
        texts.padded_id(texts.SALE_ID, F.col("event_id")).alias("order_id"),
        "event_type",
        "district",
        F.col("customer_id").cast("string").alias("courier_id"),
        for_kinds(F.col("value"), "placed", "delivered", "cancelled").alias("total_amount"),
        for_kinds(k + 10, "placed").alias("estimated_minutes"),
        for_kinds(k % 7 + 1, "placed").alias("item_count"),
        for_kinds(k + 5, "delivered").alias("actual_minutes"),
        for_kinds(k / 20, "delivered").alias("rating"),
        for_kinds(F.col("value"), "delayed").alias("delay_minutes"),
        for_kinds(reason, "delayed").alias("delay_reason"),
        for_kinds(reason, "cancelled").alias("cancel_reason"),
        texts.iso_seconds(F.col("ts")).alias("event_timestamp"),
        F.col("ts").alias("event_time"),
    )


def log_lines(raw: DataFrame) -> DataFrame:
    """Events as bracketed log lines."""
    level = F.when(F.col("event_type") == "error", "ERROR").when(
        F.col("event_type") == "signup", "WARNING").otherwise("INFO")
    return raw.select(
        texts.log_line(F.col("ts"), level, event_store(F.col("user_id")), F.upper("event_type"),
                       F.col("props")).alias("value")
    )
