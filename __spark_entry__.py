"""

Wiring only. Each query maps the given tables onto the library's sales model and
calls the library.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracles import ORACLES
from storepulse.functions.numbers import line_amount
from storepulse.functions import texts
from storepulse.functions.texts import parse_log_line
from storepulse.operators.inspect import preview, profile, sample_with_replacement
from storepulse.operators import draws, sketches
from storepulse.operators.joins import lookup
from storepulse.plans import delivery, kpis, reports
from storepulse.schemas import (
    MESSAGE, MORE_TABLES, ORDER_EVENT, SALE_EVENT, TABLES, struct,
)
from storepulse.sinks import buckets, documents, manifest, runs
from storepulse.sinks.reports import plain_numbers, write_report_csv
from storepulse.sinks.tables import (
    export_tables, write_csv, write_json, write_lines, write_sales_by_month,
)
from storepulse.sources import arrays, files, quarantine, tables
from storepulse.sources.scratch import scratch_path
from storepulse.sources.streams import parquet_files
from storepulse.streaming import (
    aggregates, batches, compaction, crossings, maintained, messages, served, windows,
)

Query = Callable[[SparkSession, str], DataFrame]

# What tells the sale lines of the given table apart, as far as anything does.
DRAWN = ("order_id", "line_number", "product_id", "store_id", "quantity", "discount_pct")


def training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data operators, where that subpackage is installed."""
    try:
        import corpus_pipeline
        from storepulse.llm.oracles import ORACLES as sql
        from storepulse.llm.queries import QUERIES as found
    except ModuleNotFoundError:
        # It, or a library that only it needs, is not there.
        return {}, {}
    sql = dict(sql)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**found, "pipeline": corpus_pipeline.run}, sql


def with_plain_times(rows: DataFrame) -> DataFrame:
    """Dates and timestamps without time zone, as the given tables hold them."""
    return rows.withColumns({
        field.name: F.col(field.name).cast("timestamp_ntz")
        for field in rows.schema.fields if field.dataType.typeName() in ("timestamp", "date")
    })


# Sales at rest

def sales_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by month and read back."""
    path = scratch_path(spark, "sales-enriched")
    enriched = tables.enriched_sales(spark, sf_dir)
    write_sales_by_month(enriched, path)
    return files.read_parquet(spark, path, enriched.schema).select(*enriched.columns)


def sales_months_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by month whose sales of 1997 are wrong at first, then replaced at once."""
    path, joined = scratch_path(spark, "sales-months"), scratch_path(spark, "sales-joined")
    enriched = manifest.with_month(tables.enriched_sales(spark, sf_dir))
    # Joined once for both writes: as files a sale takes a fraction of what joining it shuffles.
    # Each file is sorted by month, so that neither write shuffles the sales by month.
    sales = runs.write_sorted(enriched, joined, "month")
    wrong = F.when(F.year("sold_at") == 1997, F.col("amount") + 1).otherwise(F.col("amount"))
    for rows in (sales.withColumn("amount", wrong), sales.filter(F.year("sold_at") == 1997)):
        manifest.replace_sales_by_month(runs.gathered(rows, "month"), path, gathered=True)
    return manifest.read(spark, path, enriched.schema, "month").drop("month")


def sales_enriched_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and orders laid out by order beforehand: their join moves no rows."""
    sides = {"lines": tables.sale_lines(spark, sf_dir), "orders": tables.sale_orders(spark, sf_dir)}
    count = buckets.buckets_for(max(map(buckets.planned_bytes, sides.values())))
    sold, placed = (
        buckets.write_bucketed(rows, f"{name}_{uuid.uuid4().hex}",
                               scratch_path(spark, f"bucketed-{name}"), "order_id", count)
        for name, rows in sides.items())
    known = lookup(lookup(sold, placed, "order_id"), tables.customers(spark, sf_dir), "customer_id")
    with_product = lookup(known, tables.products(spark, sf_dir), "product_id")
    return lookup(with_product, tables.stores(spark, sf_dir), "store_id")


def kpi_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.revenue_by_category(
        tables.totals_per_product(spark, sf_dir), tables.products(spark, sf_dir)
    )


def kpi_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.revenue_by_city(
        tables.totals_per_customer(spark, sf_dir), tables.customers(spark, sf_dir)
    )


def kpi_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.spend_by_segment(
        tables.totals_per_customer(spark, sf_dir), tables.segments(spark, sf_dir)
    )


def kpi_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.revenue_by_store(tables.totals_per_store(spark, sf_dir))


def store_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.sales_count_by_store(tables.totals_per_store(spark, sf_dir))


def low_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.low_stock(tables.products(spark, sf_dir))


def campaigns_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.campaigns_by_segment(tables.campaign_partials(spark, sf_dir))


def sale_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = tables.products(spark, sf_dir).select("product_id", "price")
    sold = tables.lines(spark, sf_dir).select("order_id", "line_number", "product_id", "quantity")
    return lookup(sold, prices, "product_id").withColumn(
        "amount", line_amount(F.col("price"), F.col("quantity"))
    )


def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All the given tables, by the schemas in their files."""
    return profile({name: files.read_parquet(spark, f"{sf_dir}/{name}.parquet")
                    for name in (*TABLES, *MORE_TABLES)})


def sales_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten sale lines, enriched after they have been picked; one lazy plan."""
    order = ("order_id", "product_id", "store_id", "line_number", "shipped_at", "amount")
    shown = preview(tables.lines(spark, sf_dir), 10, *map(F.col, order))
    shown = lookup(shown, tables.sale_orders(spark, sf_dir), "order_id")
    shown = lookup(shown, tables.customers(spark, sf_dir), "customer_id")
    return lookup(shown, tables.products(spark, sf_dir), "product_id").select(
        "order_id", "customer_name", "product_name", "category", "quantity", "amount", "stock"
    )


def sample_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_with_replacement(
        tables.lines(spark, sf_dir), ("order_id", "line_number"), 0.01, seed="sales-7"
    ).select("order_id", "line_number", "product_id", "store_id", "quantity", "amount", "draw")


# Mergeable distinct counts

def segment_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of each month and segment, stored year by year as they come."""
    path = scratch_path(spark, "sketches")
    sold = lookup(tables.orders(spark, sf_dir), tables.segments(spark, sf_dir), "customer_id")
    month = F.date_format("ordered_at", "yyyy-MM")
    for first, last in (("0000-00", "1995-12"), ("1996-01", "9999-12")):
        sketches.add_periods(sold, path, month, "segment", first=first, last=last)
    return sketches.read_sketches(spark, path)


def customers_per_segment_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and distinct customers per segment and year, from sketches of months."""
    year = F.substring("period", 1, 4).alias("year")
    return sketches.distinct_over(segment_sketches(spark, sf_dir), "segment", year).select(
        "segment", "year", F.col("n_sales").alias("n_orders"),
        F.col("n_keys").alias("n_customers"))


def returning_customers_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per segment who ordered both up to 1995 and after, and in all three spans."""
    stored = segment_sketches(spark, sf_dir)
    spans = [sketches.merged(stored.filter(span), "segment") for span in (
        "period <= '1995-12'", "period between '1996-01' and '1997-12'", "period >= '1998-01'")]
    both = sketches.shared_by_all(spans[:2], "segment").withColumnRenamed("n_keys", "n_both")
    return both.join(sketches.shared_by_all(spans, "segment"), "segment").select(
        "segment", "n_both", F.col("n_keys").alias("n_all"))


def draw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand sale lines, each at most once."""
    sold = tables.lines(spark, sf_dir).select(*DRAWN)
    return draws.draw(sold, 1_000, DRAWN, "sales-8")


def draw_sales_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred thousand draws of any sale line, and how often each line was drawn."""
    sold = tables.lines(spark, sf_dir).select(*DRAWN)
    return draws.draw_again(sold, 100_000, DRAWN, "sales-9")


# Files

def as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers under the names of the customer file."""
    return tables.customers(spark, sf_dir).select(
        texts.padded_id(texts.CUSTOMER_ID, F.col("customer_id")).alias("id_cliente"),
        F.col("customer_name").alias("nombre"), F.lit("A, \"B\"").alias("apellido"),
        (F.col("customer_id") % 80 + 18).cast("int").alias("edad"),
        F.col("city").alias("ciudad"), F.col("segment").alias("segmento"),
        F.lit(None).cast("string").alias("email"),
    )


def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written with a header line, read back typed by field."""
    path = scratch_path(spark, "csv")
    write_csv(as_files(spark, sf_dir), path)
    return files.read_customers(spark, path)


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer lines of which some are short, misspelt or unclosed: typed rows and rejects."""
    path = scratch_path(spark, "csv-quarantine")
    key = F.col("customer_id").cast("string")
    whole = F.concat_ws(",", key, F.concat(F.lit('"'), "customer_name", F.lit(', ""x"""')),
                        (F.col("customer_id") % 80 + 18).cast("string"), "segment")
    line = (
        F.when(F.col("customer_id") % 10 == 1, F.concat_ws(",", key, "customer_name"))
        .when(F.col("customer_id") % 10 == 2, F.concat(key, F.lit(",Eva,old,"), "segment"))
        .when(F.col("customer_id") % 10 == 3, F.concat(key, F.lit(',"Eva,30,'), "segment"))
        .otherwise(whole)
    )
    write_lines(tables.segments(spark, sf_dir).join(
        tables.customers(spark, sf_dir).select("customer_id", "customer_name"), "customer_id",
    ).select(line.alias("value")), path)
    split = quarantine.read_csv_split(
        spark, path, struct("customer_id bigint, name string, age int, segment string"),
        header=False)
    return split.good.unionByName(
        split.rejected.select(F.col("text").alias("rejected")), allowMissingColumns=True,
    ).fillna(-1, ["customer_id", "age"])


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products written as JSON lines and read back."""
    path = scratch_path(spark, "json")
    write_json(tables.products(spark, sf_dir).select(
        F.col("product_id").cast("string").alias("id_producto"),
        F.col("product_name").alias("nombre"), F.col("category").alias("categoria"),
        F.col("price").alias("precio"), F.col("stock").alias("stock_actual"),
        F.col("stock_minimum").alias("stock_minimo"), F.col("supplier").alias("proveedor"),
    ), path)
    return files.read_products(spark, path, one_document=False)


def json_array_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products in files of one array each, ten thousand ids a file, read back by block."""
    path = scratch_path(spark, "json-arrays")
    products = tables.products(spark, sf_dir)
    rows = products.select(
        F.floor(F.col("product_id") / 10_000).alias("chunk"), F.col("product_id").alias("line"),
        F.to_json(F.struct(*products.columns)).alias("document"))
    first = rows.groupBy("chunk").agg(F.min("line").alias("first"))
    mark = F.when(F.col("line") == F.col("first"), "[").otherwise(",")
    lines = rows.join(first, "chunk").select(
        "chunk", "line", F.concat(mark, "document").alias("value")
    ).unionByName(first.select("chunk", F.lit((1 << 63) - 1).alias("line"), F.lit("]").alias("value")))
    lines.repartition("chunk").sortWithinPartitions("chunk", "line").select(
        "chunk", "value").write.partitionBy("chunk").text(path)
    return arrays.read_json_array(spark, path, products.schema)


def report_reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as one CSV file, replaced, and read back."""
    path = scratch_path(spark, "report") + ".csv"
    report = kpi_store(spark, sf_dir)
    for _ in range(2):
        write_report_csv(plain_numbers(report), path, F.desc("revenue"), "store")
    return files.read_csv(spark, path, report.schema)


def tables_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched sales and reports copied twice by name; rows of each copy."""
    path = scratch_path(spark, "export")
    copied = {"sales": tables.lines(spark, sf_dir), "low_stock": low_stock(spark, sf_dir),
              "kpi_store": kpi_store(spark, sf_dir)}
    for _ in range(2):
        export_tables(copied, "parquet", "path", prefix=f"{path}/")
    return profile({name: files.read_parquet(spark, f"{path}/{name}") for name in copied})


def collections_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collections of documents, the products wrong at first; products as they are read."""
    store = scratch_path(spark, "collections")
    products = tables.products(spark, sf_dir)
    documents.write_collection(products.withColumn("stock", F.lit(-1)), store, "products")
    documents.export_collections(
        {"products": products, "kpi_store": kpi_store(spark, sf_dir)}, store)
    return documents.read_collection(spark, store, "products", products.schema)


# Reports

def top_products_by_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_products_by_units(
        tables.lines(spark, sf_dir), tables.products(spark, sf_dir)
    )


def top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_cities(kpi_city(spark, sf_dir))


def top_low_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_low_stock(low_stock(spark, sf_dir))


def revenue_share_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_share(
        kpis.totals_by(tables.totals_per_customer(spark, sf_dir),
                       tables.segments(spark, sf_dir), "customer_id", "segment"),
        "segment",
    )


def revenue_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_labels(kpi_category(spark, sf_dir), "category")


def campaign_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_plain_times(reports.campaign_calendar(tables.campaigns(spark, sf_dir)))


def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.event_type_counts(tables.events(spark, sf_dir))


def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines written as text, scanned, parsed and counted."""
    path = scratch_path(spark, "log-lines")
    write_lines(tables.log_lines(tables.events(spark, sf_dir)), path)
    lines = files.read_lines(spark, path)
    parsed = lines.select(parse_log_line(F.col("value")).alias("line")).select("line.*")
    return with_plain_times(reports.log_counts(parsed))


# Delivery

def orders_by_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.orders_by_district(
        tables.orders(spark, sf_dir), tables.customers(spark, sf_dir)
    )


def days_to_deliver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.delivery_days(tables.orders(spark, sf_dir), tables.shipments(spark, sf_dir))


def avg_delivery_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.mean_delivery_days(
        days_to_deliver(spark, sf_dir), tables.customers(spark, sf_dir)
    )


def delayed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.delayed_orders(days_to_deliver(spark, sf_dir))


def cancellations_by_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.cancellations_by_district(
        tables.orders(spark, sf_dir), tables.shipments(spark, sf_dir),
        tables.customers(spark, sf_dir),
    )


def courier_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    couriers = tables.stores(spark, sf_dir).withColumnsRenamed(
        {"store_id": "courier_id", "store": "courier_name"}
    )
    return delivery.courier_ranking(tables.shipments(spark, sf_dir), couriers)


# Sale events in motion

def sale_events(spark: SparkSession, sf_dir: str, stream: bool) -> DataFrame:
    enriched = messages.enrich_events(
        tables.event_sales(tables.events(spark, sf_dir, stream),
                           tables.named_products(spark, sf_dir)),
        tables.customers(spark, sf_dir), tables.products(spark, sf_dir),
    )
    return tables.text_ids(messages.score_events(enriched, F.col("k")))


def sale_messages(spark: SparkSession, sf_dir: str, stream: bool) -> DataFrame:
    return messages.to_messages(
        sale_events(spark, sf_dir, stream), SALE_EVENT, "transaction_id", F.col("event_time")
    )


def parsed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.parse_messages(sale_messages(spark, sf_dir, stream=True))


def run_batches(spark: SparkSession, sf_dir: str, name: str, *outputs: str) -> DataFrame:
    """Run the sales stream to the end of its source; gives all batches of one output."""
    out = scratch_path(spark, "sales-stream")
    parsed = parsed_stream(spark, sf_dir)
    batches.run_to_end(batches.start_sales_stream(parsed, out, outputs, availableNow=True))
    schema = parsed.schema if name == "events" else batches.DERIVED[name](parsed).schema
    return batches.read_output(spark, out, name, schema)


def run_rows(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Run a stateless stream to the end of its source; gives all its rows."""
    out = scratch_path(spark, "rows")
    writer = aggregates.update_writer(out, "rows")
    batches.run_to_end(batches.start(rows, out, writer, availableNow=True))
    return batches.read_output(spark, out, "rows", rows.schema).drop("batch_id")


def run_updates(spark: SparkSession, summary: DataFrame, *keys: str) -> DataFrame:
    """Run a stateful summary to the end of its source; gives its final state."""
    out = scratch_path(spark, "updates")
    batches.run_to_end(aggregates.start_updates(summary, out, "updates", availableNow=True))
    return aggregates.latest(batches.read_output(spark, out, "updates", summary.schema), *keys)


def derived_output(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return with_plain_times(run_batches(spark, sf_dir, name, name))

    return query


def events_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = sale_messages(spark, sf_dir, stream=False)
    return sent.select(F.col("key").cast("string"), F.col("value").cast("string"))


def stream_events_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fan-out: events, alerts, both summaries and dead letters."""
    written = run_batches(spark, sf_dir, "events", *batches.DERIVED)
    # The processing time is the clock's, which no oracle knows.
    return with_plain_times(written.drop("processing_timestamp", "corrupt_record"))


def stream_parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_plain_times(run_rows(spark, parsed_stream(spark, sf_dir)).select(
        "message_key", "kafka_timestamp", *SALE_EVENT.fieldNames()
    ))


def stream_enrich_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream joined to static tables, with defaults where they have no row."""
    return run_rows(spark, sale_events(spark, sf_dir, stream=True).select(
        "event_id", "customer_id", "product_id", "customer_name", "city", "product_name",
        "category", "store", "stock_actual", "stock_minimo",
    ))


def risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sale_events(spark, sf_dir, stream=False).select(
        "event_id", "total_amount", "stock_actual", "stock_minimo", "risk_score", "is_risk"
    )


def stream_windowed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's windows over the table at rest, which is not in time order."""
    parsed = messages.parse_messages(sale_messages(spark, sf_dir, stream=False))
    return with_plain_times(aggregates.windowed_summary(parsed, "10 seconds"))


def stream_summary_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of a topic kept as files: the stream ends and goes on for each."""
    topic, out = scratch_path(spark, "topic"), scratch_path(spark, "sales-stream")
    sent = sale_messages(spark, sf_dir, stream=False)
    number = F.regexp_extract(F.col("key").cast("string"), "([0-9]+)$", 1).cast("long")
    sent.limit(0).write.parquet(topic)
    parsed = messages.parse_messages(parquet_files(spark, topic, MESSAGE))
    for part in range(3):
        sent.filter(number % 3 == part).write.mode("append").parquet(topic)
        batches.run_to_end(batches.start_sales_stream(
            parsed, out, ["summary_by_category"], availableNow=True))
    schema = batches.DERIVED["summary_by_category"](parsed).schema
    return batches.read_output(spark, out, "summary_by_category", schema)


def stream_events_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of events, of which the first two have been moved into their days."""
    topic, out = scratch_path(spark, "topic"), scratch_path(spark, "compacted")
    sent = sale_messages(spark, sf_dir, stream=False)
    number = F.regexp_extract(F.col("key").cast("string"), "([0-9]+)$", 1).cast("long")
    sent.limit(0).write.parquet(topic)
    parsed = messages.parse_messages(parquet_files(spark, topic, MESSAGE))
    for part in range(3):
        sent.filter(number % 3 == part).write.mode("append").parquet(topic)
        batches.run_to_end(batches.start_sales_stream(parsed, out, [], availableNow=True))
        compaction.compact(
            spark, out, "events", parsed.schema, F.col("event_timestamp"), upto=part - 1)
        compaction.forget_batches(spark, out, "events")
    rows = compaction.read_all(spark, out, "events", parsed.schema)
    return with_plain_times(rows.drop("processing_timestamp", "corrupt_record"))


def stream_summary_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of three batches; the second lacks half its events at first, and is replaced."""
    topic, out = scratch_path(spark, "topic"), scratch_path(spark, "maintained")
    sent = sale_messages(spark, sf_dir, stream=False)
    number = F.regexp_extract(F.col("key").cast("string"), "([0-9]+)$", 1).cast("long")
    sent.limit(0).write.parquet(topic)
    parsed = messages.parse_messages(parquet_files(spark, topic, MESSAGE))
    for part in range(3):
        held = sent.filter(number % 3 == part)
        if part == 1:
            held = held.filter(number % 2 == 0)
        held.write.mode("append").parquet(topic)
        batches.run_to_end(maintained.start_maintained(parsed, out, "category", availableNow=True))
    whole = messages.parse_messages(sent.filter(number % 3 == 1)).select(
        "transaction_id", "total_amount", "risk_score", "category")
    for _ in range(2):
        maintained.maintain(whole, f"{out}/totals", 1, "category")
    return maintained.running_summary(
        spark, f"{out}/totals", maintained.schema_of(whole, "category"))


def stream_windows_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows of a stream in which every tenth event comes two batches late.

    The events of five days make a batch, in the order of their days. The stream ends and
    goes on for each.
    """
    topic, out = scratch_path(spark, "late-topic"), scratch_path(spark, "windows")
    sent = sale_messages(spark, sf_dir, stream=False)
    number = F.regexp_extract(F.col("key").cast("string"), "([0-9]+)$", 1).cast("long")
    first = F.date_trunc("day", F.lit(sent.agg(F.min("timestamp")).scalar()))
    part = F.floor(F.datediff("timestamp", first) / 5) + F.when(number % 10 == 0, 2).otherwise(0)
    sent = sent.withColumn("part", part)
    sent.limit(0).drop("part").write.parquet(topic)
    parsed = messages.parse_messages(parquet_files(spark, topic, MESSAGE))
    for n in range((sent.agg(F.max("part")).first()[0] or 0) + 1):
        sent.filter(F.col("part") == n).drop("part").write.mode("append").parquet(topic)
        batches.run_to_end(windows.start_windows(
            parsed, out, "1 day", "1 day", availableNow=True))
    schema = aggregates.windowed_summary(parsed, "1 day", "1 day").schema
    return with_plain_times(windows.read_windows(spark, out, schema))


# Delivery messages in motion

def order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = messages.to_messages(
        tables.order_events(
            tables.events(spark, sf_dir, stream=True), tables.customers(spark, sf_dir),
        ),
        ORDER_EVENT, "order_id", F.col("event_time"),
    )
    return messages.parse_messages(sent, ORDER_EVENT)


def stream_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_updates(
        spark, aggregates.running_totals(order_stream(spark, sf_dir)), "district"
    )


def stream_cancellations_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_updates(
        spark, aggregates.cancellations_by_reason(order_stream(spark, sf_dir)), "cancel_reason"
    )


def stream_delay_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = aggregates.delay_alerts(order_stream(spark, sf_dir))
    return with_plain_times(run_rows(spark, late))


def stream_low_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = aggregates.ratings_by_courier(order_stream(spark, sf_dir))
    return aggregates.low_ratings(run_updates(spark, ratings, "courier_id"))


def order_topic(spark: SparkSession, sf_dir: str, files: int = 8) -> DataFrame:
    """Delivery messages kept as files, of which each batch takes one."""
    topic = scratch_path(spark, "order-topic")
    messages.to_messages(
        tables.order_events(tables.events(spark, sf_dir), tables.customers(spark, sf_dir)),
        ORDER_EVENT, "order_id", F.col("event_time"),
    ).repartition(files).write.parquet(topic)
    return messages.parse_messages(
        parquet_files(spark, topic, MESSAGE, files_per_batch=1), ORDER_EVENT)


def run_served(spark: SparkSession, summary: DataFrame, *keys: str) -> DataFrame:
    """Run a running summary over several batches; gives its rows as they are served."""
    out = scratch_path(spark, "served")
    batches.run_to_end(
        served.start_served(summary, out, "updates", *keys, every=3, availableNow=True))
    return served.current(spark, out, "updates", summary.schema, *keys)


def stream_running_totals_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_served(
        spark, aggregates.running_totals(order_topic(spark, sf_dir)), "district")


def stream_cancellations_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_served(
        spark, aggregates.cancellations_by_reason(order_topic(spark, sf_dir)), "cancel_reason")


def stream_low_rating_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = aggregates.ratings_by_courier(order_topic(spark, sf_dir))
    return aggregates.low_ratings(run_served(spark, ratings, "courier_id"))


def crossings_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of ratings; the stream ends and goes on for each."""
    topic, out = scratch_path(spark, "rating-topic"), scratch_path(spark, "crossings")
    sent = messages.to_messages(
        tables.order_events(tables.events(spark, sf_dir), tables.customers(spark, sf_dir)),
        ORDER_EVENT, "order_id", F.col("event_time"))
    number = F.regexp_extract(F.col("key").cast("string"), "([0-9]+)$", 1).cast("long")
    sent.limit(0).write.parquet(topic)
    orders = messages.parse_messages(parquet_files(spark, topic, MESSAGE), ORDER_EVENT)
    for part in range(3):
        sent.filter(number % 3 == part).write.mode("append").parquet(topic)
        batches.run_to_end(crossings.start_crossings(orders, out, availableNow=True))
    return batches.read_output(
        spark, out, "crossings", crossings.rating_crossings(orders).schema)


def stream_rating_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_plain_times(crossings_written(spark, sf_dir))


def stream_rating_alerts_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_plain_times(crossings.alerts_on(crossings_written(spark, sf_dir)))


def queries() -> dict[str, Query]:
    """Every query: (spark, directory of the tables) to DataFrame."""
    return {
        "sales_enriched": sales_enriched,
        "sales_months_replaced": sales_months_replaced,
        "sales_enriched_bucketed": sales_enriched_bucketed,
        "kpi_category": kpi_category,
        "kpi_city": kpi_city,
        "kpi_segment": kpi_segment,
        "kpi_store": kpi_store,
        "store_counts": store_counts,
        "low_stock": low_stock,
        "campaigns_by_segment": campaigns_by_segment,
        "sale_amount": sale_amount,
        "dataset_profile": dataset_profile,
        "preview": sales_preview,
        "sample_sales": sample_sales,
        "customers_per_segment_sketch": customers_per_segment_sketch,
        "returning_customers_sketch": returning_customers_sketch,
        "draw_sales": draw_sales,
        "draw_sales_again": draw_sales_again,
        "csv_files": csv_files,
        "csv_quarantine": csv_quarantine,
        "json_lines": json_lines,
        "json_array_documents": json_array_documents,
        "report_reread": report_reread,
        "tables_export": tables_export,
        "collections_export": collections_export,
        "top_products_by_units": top_products_by_units,
        "top_cities": top_cities,
        "top_low_stock": top_low_stock,
        "revenue_share_by_segment": revenue_share_by_segment,
        "revenue_labels": revenue_labels,
        "campaign_calendar": campaign_calendar,
        "event_type_counts": event_type_counts,
        "log_parse": log_parse,
        "orders_by_district": orders_by_district,
        "avg_delivery_time": avg_delivery_time,
        "delayed_orders": delayed_orders,
        "cancellations_by_district": cancellations_by_district,
        "courier_ranking": courier_ranking,
        "events_to_json": events_to_json,
        "risk_score": risk_score,
        "stream_parse_events": stream_parse_events,
        "stream_enrich_events": stream_enrich_events,
        "stream_events_sink": stream_events_sink,
        "stream_alerts": derived_output("alerts"),
        "stream_summary_category": derived_output("summary_by_category"),
        "stream_summary_city": derived_output("summary_by_city"),
        "stream_windowed_summary": stream_windowed_summary,
        "stream_summary_batches": stream_summary_batches,
        "stream_events_compacted": stream_events_compacted,
        "stream_summary_maintained": stream_summary_maintained,
        "stream_windows_late": stream_windows_late,
        "stream_running_totals": stream_running_totals,
        "stream_cancellations_by_reason": stream_cancellations_by_reason,
        "stream_delay_alerts": stream_delay_alerts,
        "stream_low_rating": stream_low_rating,
        "stream_rating_crossings": stream_rating_crossings,
        "stream_rating_alerts_on": stream_rating_alerts_on,
        "stream_running_totals_served": stream_running_totals_served,
        "stream_cancellations_served": stream_cancellations_served,
        "stream_low_rating_served": stream_low_rating_served,
        **training_data()[0],
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query."""
    return {**ORACLES, **training_data()[1]}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: revenue and average ticket by product category."""
    return kpi_category(spark, "/root/testdata/sf0.001")
