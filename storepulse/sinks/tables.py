"""Table writers: parquet, text formats, and any format a connector provides."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def write_sales_by_month(sales: DataFrame, path: str, time_column: str = "sold_at") -> None:
    """Overwrite a parquet table partitioned by month.

    The rebalance hint gathers each month into files of the advisory size. AQE cuts
    a month that is too large for one task, and joins months that are small.
    """
    by_month = sales.withColumn("month", F.date_format(time_column, "yyyy-MM"))
    by_month.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Text lines from a frame with one string column."""
    lines.write.mode("overwrite").text(path)


def write_table(rows: DataFrame, format: str, **options: str) -> None:
    """Overwrite one table or collection of an external store.

    The connector and its address come with the deployment, as in
    ``write_table(sales, "mongodb", database="shop", collection="sales")``.
    Executors write their own partitions.
    """
    rows.write.format(format).options(**options).mode("overwrite").save()


def export_tables(tables: Mapping[str, DataFrame], format: str, name_option: str,
                  prefix: str = "", **options: str) -> None:
    """Write several frames, each under its name given in ``name_option``."""
    for name, rows in tables.items():
        write_table(rows, format, **{**options, name_option: prefix + name})


def write_messages(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send keyed messages to a topic, from the executors.

    ``options`` go to the connector as they are, with dots as double underscores, as in
    ``kafka__security__protocol="SSL"``.
    """
    given = {name.replace("__", "."): value for name, value in options.items()}
    messages.select("key", "value").write.format("kafka").options(**given).option(
        "kafka.bootstrap.servers", servers
    ).option("topic", topic).save()
