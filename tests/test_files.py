"""Readers, writers, and the batch job that joins them up."""

from __future__ import annotations

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from storepulse import schemas
from storepulse.plans import batch_job
from storepulse.session import sized_for
from storepulse.sinks import reports as report_files, tables as sinks
from storepulse.sources import files, streams
from storepulse.sources.scratch import scratch_path

SALES = """id_transaccion,id_cliente,id_producto,cantidad,precio_unitario,monto_total,fecha,tienda
TRX-00000001,CLI-000001,PROD-000001,2,10.50,21.00,2024-01-31 23:59:59,"Plaza, Norte"
TRX-00000002,CLI-000002,PROD-000002,1,99.99,99.99,2024-02-01 00:00:00,Sur
TRX-00000003,CLI-000009,PROD-000001,x,10.50,10.50,2024-02-01 10:00:00,Sur
"""
CUSTOMERS = """id_cliente,nombre,apellido,edad,ciudad,segmento,email
CLI-000001,Ana,Ñuñez,30,Lima,Premium,a@example.org
CLI-000002,Luz,Paz,40,Cusco,Regular,l@example.org
"""
PRODUCTS = [
    {"id_producto": "PROD-000001", "nombre": "Lámpara", "categoria": "Hogar", "precio": 10.5,
     "stock_actual": 5, "stock_minimo": 5, "proveedor": "A"},
    {"id_producto": "PROD-000002", "nombre": "Bota", "categoria": "Calzado", "precio": 99.99,
     "stock_actual": 50, "stock_minimo": 5, "proveedor": "B"},
]
CAMPAIGNS = [
    {"id_campana": "CMP-00001", "nombre": "Campaña 1", "segmento_objetivo": "Premium", "canal": "SMS",
     "fecha_inicio": "2024-02-27", "fecha_fin": "2024-03-10", "descuento_porcentaje": 15},
]


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "transacciones_ventas.csv").write_text(SALES, encoding="utf-8")
    (folder / "clientes.csv").write_text(CUSTOMERS, encoding="utf-8")
    for name, content in (("inventario_productos", PRODUCTS), ("campanas_marketing", CAMPAIGNS)):
        (folder / f"{name}.json").write_text(
            json.dumps(content, ensure_ascii=False, indent=2), encoding="utf-8")
    return str(folder)


def test_csv_is_typed_and_quoted_commas_stay_in_the_field(spark, raw):
    first, _, third = files.read_sales(spark, f"{raw}/transacciones_ventas.csv").orderBy("sale_id").collect()
    assert first["store"] == "Plaza, Norte"
    assert first["sold_at"] == datetime(2024, 1, 31, 23, 59, 59)
    assert (first["quantity"], first["amount"]) == (2, 21.0)
    assert third["quantity"] is None and third["store"] == "Sur"
    assert files.read_customers(spark, f"{raw}/clientes.csv").first()["last_name"] == "Ñuñez"


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text(SALES.replace("monto_total", "total"), encoding="utf-8")
    with pytest.raises(Exception, match="CSV header"):
        files.read_sales(spark, str(path)).collect()


def test_json_documents_and_lines(spark, raw, scratch):
    products = files.read_products(spark, f"{raw}/inventario_productos.json")
    assert {row["product_name"] for row in products.collect()} == {"Lámpara", "Bota"}
    campaign = files.read_campaigns(spark, f"{raw}/campanas_marketing.json").first()
    assert (campaign["start_date"], campaign["end_date"]) == (date(2024, 2, 27), date(2024, 3, 10))
    lines = f"{scratch}/lines"
    sinks.write_json(products, lines)
    assert files.read_json(spark, lines, products.schema).exceptAll(products).isEmpty()


def test_missing_input_fails_at_once(spark, scratch):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_sales(spark, f"{scratch}/none.csv")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_lines(spark, f"{scratch}/none.txt")


def test_text_lines_round_trip(spark, scratch):
    lines = spark.createDataFrame([("[a] [b]",), ("ñ, \"q\"",)], "value string")
    sinks.write_lines(lines, f"{scratch}/log")
    assert files.read_lines(spark, f"{scratch}/log").exceptAll(lines).isEmpty()


def test_csv_report_round_trip(spark, scratch):
    report = spark.createDataFrame([("Sur", 2), ("Norte, alto", 1)], "store string, n long")
    sinks.write_csv(report, f"{scratch}/report")
    again = files.read_csv(spark, f"{scratch}/report", report.schema)
    assert again.exceptAll(report).isEmpty() and again.count() == 2


def test_connectors_are_the_deployments(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        streams.kafka_messages(spark, "localhost:1", "topic", max_offsets=10)
    messages = spark.createDataFrame([(b"k", b"v")], "key binary, value binary")
    with pytest.raises(AnalysisException, match="kafka"):
        sinks.write_messages(messages, "localhost:1", "topic")
    with pytest.raises(Exception, match="mongodb"):
        sinks.write_table(messages, "mongodb", collection="c")


def test_tables_are_exported_by_name(spark, scratch):
    tables = {"one": spark.range(3), "two": spark.range(5)}
    sinks.export_tables(tables, "parquet", "path", prefix=f"{scratch}/")
    sinks.export_tables(tables, "parquet", "path", prefix=f"{scratch}/")
    assert [spark.read.parquet(f"{scratch}/{name}").count() for name in tables] == [3, 5]


def test_sales_are_partitioned_by_month(spark, scratch):
    sales = spark.range(90).select("id", F.expr("timestamp'2024-01-01' + make_dt_interval(id)").alias("sold_at"))
    sinks.write_sales_by_month(sales, scratch + "/sales")
    months = sorted(p.name for p in Path(scratch, "sales").glob("month=*"))
    assert months == ["month=2024-01", "month=2024-02", "month=2024-03"]
    back = spark.read.parquet(scratch + "/sales")
    assert back.select("id", "sold_at").exceptAll(sales).isEmpty() and back.count() == 90


def test_report_is_one_plain_file_replaced_each_time(spark, scratch):
    path = f"{scratch}/report.csv"
    report = spark.createDataFrame([("b", 25432459.2), ("a", 1e9), ("c", None)], "k string, v double")
    for _ in range(2):
        report_files.write_report_csv(report_files.plain_numbers(report), path, F.desc("v"), "k")
    assert Path(path).read_text().splitlines() == ["k,v", "a,1000000000.00", "b,25432459.20", "c,"]
    assert sorted(p.name for p in Path(scratch).iterdir() if not p.name.startswith(".")) == ["report.csv"]


def test_report_has_the_form_the_caller_names(spark, scratch):
    report_files.write_report_csv(spark.range(1000), f"{scratch}/long", "id", one_file=False)
    assert files.read_csv(spark, f"{scratch}/long", spark.range(1).schema).count() == 1000
    report_files.write_report_csv(spark.range(200_000), f"{scratch}/one.csv", "id")
    assert Path(scratch, "one.csv").is_file()
    with pytest.raises(FileExistsError):
        report_files.write_report_csv(spark.range(3), f"{scratch}/long")
    with pytest.raises(FileExistsError):
        report_files.write_report_csv(spark.range(3), f"{scratch}/one.csv", one_file=False)
    assert files.read_csv(spark, f"{scratch}/long", spark.range(1).schema).count() == 1000


def test_empty_report_still_has_its_header(spark, scratch):
    report_files.write_report_csv(spark.range(0), f"{scratch}/empty.csv")
    assert Path(scratch, "empty.csv").read_text() == "id\n"


def test_batch_job(spark, raw, scratch):
    out = f"{scratch}/out"
    results = batch_job.run(spark, raw, out)
    enriched = spark.read.parquet(f"{out}/sales_enriched")
    assert enriched.count() == 3 and enriched.filter("city is null").count() == 1
    read = {p.stem: p.read_text().splitlines() for p in Path(out, "reports").glob("*.csv")}
    assert set(read) == set(results) - {"sales_enriched", "low_stock"} | {"profile"}
    assert read["profile"][1].startswith('campaigns,1,7,"campaign_id,')
    assert read["revenue_by_category"] == [
        "category,n_sales,revenue,mean_ticket", "Calzado,1,99.99,99.99", "Hogar,2,31.50,15.75"]
    assert read["spend_by_segment"][1:] == [
        "Regular,1,99.99,99.99", "Premium,1,21.00,21.00", ",1,10.50,10.50"]
    assert read["revenue_by_store"][1:] == ["Sur,2,110.49", '"Plaza, Norte",1,21.00']
    low = [line for part in Path(out, "reports", "low_stock").glob("*.csv") for line in part.read_text().splitlines()]
    assert low[1:] == ["PROD-000001,Lámpara,Hogar,5,5,A"]
    assert read["campaigns_by_segment"][1:] == ["Premium,SMS,1,15.00"]
    again = files.read_csv(spark, f"{out}/reports/revenue_by_store.csv",
                           schemas.struct("store string, n_sales bigint, revenue double"))
    assert {tuple(row) for row in again.collect()} == {("Sur", 2, 110.49), ("Plaza, Norte", 1, 21.0)}
    assert spark.sql("select sum(quantity) from sales_enriched where segment = 'Premium'").first()[0] == 2
    batch_job.export(results, "json", "path", prefix=f"{out}/export/")
    assert spark.read.json(f"{out}/export/sales_enriched").count() == 3


def test_batch_job_of_json_lines_and_repeated_customers(spark, raw, scratch):
    for name, content in (("inventario_productos", PRODUCTS), ("campanas_marketing", CAMPAIGNS)):
        Path(raw, f"{name}.json").write_text("\n".join(map(json.dumps, content)), encoding="utf-8")
    Path(raw, "clientes.csv").write_text(CUSTOMERS + CUSTOMERS.splitlines()[1] + "\n", encoding="utf-8")
    results = batch_job.run(spark, raw, f"{scratch}/out", one_document=False)
    assert results["sales_enriched"].count() == 3
    assert results["revenue_by_category"].count() == 2


class Session:
    """As much of a session as choosing a scratch folder takes."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default):
        return self.settings.get(key.replace(".", "_"), default)


def test_scratch_is_where_the_cluster_says():
    cluster = Session(spark_master="yarn", spark_checkpoint_dir="hdfs://shared/scratch/")
    first, second = scratch_path(cluster, "x"), scratch_path(cluster, "x")
    assert first.startswith("hdfs://shared/scratch/x-") and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(spark_master="yarn"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(spark_master="local-cluster[2,1,1024]"), "x")
    assert scratch_path(Session(spark_master="local[2]"), "x").startswith("/")


def test_schemas_need_no_session():
    assert schemas.file_schema(schemas.SALES_FIELDS).fieldNames()[0] == "id_transaccion"
    assert len(schemas.SALE_EVENT) == 17


def test_sizes_follow_the_data():
    small, large = (list(sized_for(size).values()) for size in (1 << 20, 100 << 40))
    assert small == ["200", "256m", str(128 << 20)]
    assert large == ["50000", "256m", str(1 << 30)]
