"""The batch job: raw files in; enriched sales and report files out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from storepulse.operators.inspect import profile
from storepulse.operators.joins import latest_per_key
from storepulse.operators.totals import totals
from storepulse.plans import kpis
from storepulse.plans.sales import enrich_sales, register_views
from storepulse.sinks.reports import plain_numbers, write_report_csv
from storepulse.sinks.tables import export_tables, write_sales_by_month
from storepulse.sources import files

# Order of the lines in each report file.
REPORT_ORDER = {
    "revenue_by_category": (F.desc, "revenue", "category"),
    "revenue_by_city": (F.desc, "revenue", "city"),
    "spend_by_segment": (F.desc, "spend", "segment"),
    "low_stock": (F.asc, "stock", "product_id"),
    "campaigns_by_segment": (F.desc, "n_campaigns", "segment", "channel"),
    "revenue_by_store": (F.desc, "revenue", "store"),
    "sales_count_by_store": (F.desc, "n_sales", "store"),
}


def sales_totals(sales: DataFrame, out: str) -> dict[str, DataFrame]:
    """Totals by product, customer and store, written so that reports share them."""
    keys = ("product_id", "customer_id", "store")
    for key in keys:
        totals(sales, key).write.mode("overwrite").parquet(f"{out}/{key}")
    return {key: files.read_parquet(sales.sparkSession, f"{out}/{key}") for key in keys}


def reports(by: dict[str, DataFrame], customers: DataFrame, products: DataFrame,
            campaigns: DataFrame) -> dict[str, DataFrame]:
    """All indicators by name, from the totals by product, customer and store."""
    return {
        "revenue_by_category": kpis.revenue_by_category(by["product_id"], products),
        "revenue_by_city": kpis.revenue_by_city(by["customer_id"], customers),
        "spend_by_segment": kpis.spend_by_segment(by["customer_id"], customers),
        "low_stock": kpis.low_stock(products),
        "campaigns_by_segment": kpis.campaigns_by_segment(
            kpis.campaign_totals(campaigns, "segment", "channel")
        ),
        "revenue_by_store": kpis.revenue_by_store(by["store"]),
        "sales_count_by_store": kpis.sales_count_by_store(by["store"]),
    }


def run(spark: SparkSession, raw: str, out: str, one_document: bool = True
        ) -> dict[str, DataFrame]:
    """Read the four raw files, write their profile, enriched sales, totals and every report.

    ``one_document`` says that the JSON files hold an array each, which one task reads;
    pass False for JSON lines. Of a customer or product listed twice one row counts, so
    that no sale is counted twice. Everything is registered as a view under its name.
    """
    # Names of the input files.
    sales = files.read_sales(spark, f"{raw}/transacciones_ventas.csv")
    customers = files.read_customers(spark, f"{raw}/clientes.csv")
    products = files.read_products(spark, f"{raw}/inventario_productos.json", one_document)
    campaigns = files.read_campaigns(spark, f"{raw}/campanas_marketing.json", one_document)
    profiled = profile({"sales": sales, "customers": customers, "products": products,
                        "campaigns": campaigns})
    write_report_csv(profiled, f"{out}/reports/profile.csv", "table_name")
    customers = latest_per_key(customers, "customer_id", "customer_name")
    products = latest_per_key(products, "product_id", "product_name")

    write_sales_by_month(enrich_sales(sales, customers, products), f"{out}/sales_enriched")
    # From here on sales come from the columnar copy; no report parses CSV again.
    enriched = files.read_parquet(spark, f"{out}/sales_enriched")
    by = sales_totals(enriched, f"{out}/totals")
    results = reports(by, customers, products, campaigns)
    for name, report in results.items():
        first, column, *others = REPORT_ORDER[name]
        # A row per product, unlike the others with a row per group.
        one_file = name != "low_stock"
        path = f"{out}/reports/{name}.csv" if one_file else f"{out}/reports/{name}"
        write_report_csv(plain_numbers(report), path, first(column), *others, one_file=one_file)
    register_views({"sales": sales, "customers": customers, "products": products,
                    "campaigns": campaigns, "sales_enriched": enriched, **results})
    return {"sales_enriched": enriched, **results}


def export(tables: dict[str, DataFrame], format: str, name_option: str, **options: str) -> None:
    """Copy the enriched sales and the reports to an external store."""
    export_tables(tables, format, name_option, **options)
