from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from storepulse.operators.ranking import rank_by_count, top_n
from storepulse.operators.inspect import preview, profile, sample_with_replacement
from storepulse.operators.totals import merge, totals
from storepulse.plans import kpis, reports
from storepulse.plans.sales import enrich_sales


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame([
        ("t1", "c1", "p1", 1, 1.00, "Norte"),
        ("t2", "c1", "p1", 2, 1.01, "Norte"),
        ("t3", "c2", "p2", 5, 10.00, "Sur"),
        ("t4", "c9", "p1", 1, 2.00, "Sur"),      # no such customer
        ("t5", "c2", "p9", 1, None, "Sur"),      # no such product, no amount
        ("t6", None, None, 1, 4.00, None),
    ], "sale_id string, customer_id string, product_id string, quantity int, amount double, store string")


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([("c1", "Ana", "Lima", "Premium"), ("c2", "Luz", "Cusco", "Regular")],
                                 "customer_id string, customer_name string, city string, segment string")


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [("p1", "Bota", "Calzado", 10, 10, "A"), ("p2", "Polo", "Ropa", 11, 10, "B"),
         ("p3", "Silla", "Hogar", 0, 5, "B"), ("p4", "Mesa", "Hogar", None, 5, "B")],
        "product_id string, product_name string, category string, stock int, stock_minimum int, supplier string")


def rows(frame):
    return [tuple(row) for row in frame.collect()]


def test_category_keeps_sales_without_a_product(sales, products):
    report = kpis.revenue_by_category(totals(sales, "product_id"), products)
    assert rows(report) == [
        ("Ropa", 1, 10.0, 10.0),
        ("Calzado", 3, 4.01, 1.34),
        (None, 2, 4.0, 4.0),           # the missing amount counts as a sale, not in the mean
    ]


def test_city_and_segment(sales, customers):
    per_customer = totals(sales, "customer_id")
    assert rows(kpis.revenue_by_city(per_customer, customers)) == [
        ("Cusco", 2, 10.0, 10.0), (None, 2, 6.0, 3.0), ("Lima", 2, 2.01, 1.01)]
    assert rows(kpis.spend_by_segment(per_customer, customers)) == [
        ("Regular", 1, 10.0, 10.0), (None, 1, 6.0, 3.0), ("Premium", 1, 2.01, 1.01)]


def test_segment_counts_a_repeated_customer_once(spark, sales, customers):
    twice = customers.unionByName(customers)
    report = kpis.spend_by_segment(totals(sales, "customer_id"), twice)
    assert {row["segment"]: row["n_customers"] for row in report.collect()} == {
        "Regular": 1, "Premium": 1, None: 1}


def test_store_reports(sales):
    per_store = totals(sales, "store")
    assert rows(kpis.revenue_by_store(per_store)) == [
        ("Sur", 3, 12.0), (None, 1, 4.0), ("Norte", 2, 2.01)]
    assert rows(kpis.sales_count_by_store(per_store)) == [("Sur", 3), ("Norte", 2), (None, 1)]


def test_merging_totals_is_the_same_in_any_order(sales):
    direct = totals(sales, "store")
    by_steps = merge(merge(totals(sales, "store", "product_id", "customer_id"), "store", "product_id"), "store")
    assert sorted(rows(direct), key=repr) == sorted(rows(by_steps), key=repr)


def test_low_stock_includes_the_minimum_and_skips_unknown(products):
    assert [row["product_id"] for row in kpis.low_stock(products).collect()] == ["p3", "p1"]
    assert rows(reports.top_low_stock(kpis.low_stock(products), 1)) == [("p3", "Silla", 0)]


def test_campaigns(spark):
    campaigns = spark.createDataFrame(
        [("Premium", "email", 5), ("Premium", "email", 10), ("Premium", "email", 10),
         ("Nuevo", "push", None)], "segment string, channel string, discount_pct int")
    partials = kpis.campaign_totals(campaigns, "segment", "channel")
    assert rows(kpis.campaigns_by_segment(partials)) == [
        ("Premium", "email", 3, 8.33), ("Nuevo", "push", 1, None)]


def test_enriched_sales_keep_every_sale(sales, customers, products):
    enriched = enrich_sales(sales, customers, products)
    assert enriched.count() == sales.count()
    assert enriched.filter("city is null").count() == 2
    assert {"customer_name", "product_name"} <= set(enriched.columns)


def test_reports(spark, sales, products, customers):
    assert rows(reports.top_products_by_units(sales, products, 2)) == [
        ("p2", "Polo", 5), ("p1", "Bota", 4)]
    by_city = kpis.revenue_by_city(totals(sales, "customer_id"), customers)
    assert [row["city"] for row in reports.top_cities(by_city, 2).collect()] == ["Cusco", None]
    grouped = kpis.totals_by(totals(sales, "customer_id"), customers, "customer_id", "segment")
    assert dict(rows(reports.revenue_share(grouped, "segment"))) == {
        "Regular": 55.5, "Premium": 11.2, None: 33.3}
    assert rows(reports.revenue_labels(by_city.limit(1), "city")) == [("Cusco", 10.0, "10")]


def test_rank_leaves_gaps_after_ties(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 1), ("e", 5)], "who string, n long")
    assert sorted(rows(rank_by_count(counts, "n").select("who", "rank"))) == [
        ("a", 2), ("b", 1), ("c", 2), ("d", 5), ("e", 2)]
    assert [r["who"] for r in top_n(counts, 2, F.desc("n"), F.col("who")).collect()] == ["b", "a"]


def test_looking_at_tables(spark, sales, products):
    found = {row["table_name"]: row for row in profile({"sales": sales, "products": products}).collect()}
    assert (found["sales"]["n_rows"], found["sales"]["n_columns"]) == (6, 6)
    assert found["products"]["column_names"].startswith("product_id,product_name")
    assert preview(sales, 2).count() == 2
    assert [r["sale_id"] for r in preview(sales, 2, F.desc("sale_id")).collect()] == ["t6", "t5"]


def test_sample_draws_with_replacement_and_repeatably(spark):
    table = spark.range(20_000)
    drawn = sample_with_replacement(table, ["id"], 0.5, "three")
    assert abs(drawn.count() - 10_000) < 500
    assert drawn.select("id").distinct().count() < drawn.count()
    again = sample_with_replacement(table.repartition(7), ["id"], 0.5, "three")
    assert drawn.exceptAll(again).isEmpty()

def test_indicators_agree_on_the_whole(spark, small):
    sold = spark.read.parquet(f"{small}/lineitem.parquet").count()
    found = {
        name: entry.queries()[name](spark, small).agg(
            F.sum("n_sales"), F.round(F.sum("revenue"), 2)).first()
        for name in ("kpi_category", "kpi_city", "kpi_store")
    }
    assert len({tuple(row) for row in found.values()}) == 1
    assert found["kpi_city"][0] == sold
    assert entry.queries()["store_counts"](spark, small).agg(F.sum("n_sales")).first()[0] == sold
