"""Readers for files at rest. Missing paths fail when the reader is called."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from storepulse import schemas


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line, UTF-8. The header must name the schema's fields.

    Quoted fields may contain commas.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: StructType,
              one_document: bool = False) -> DataFrame:
    """JSON lines, or with ``one_document`` files that hold one array each.

    An array document cannot be split: each file is one task. Prefer lines.
    """
    return spark.read.schema(schema).option("multiLine", one_document).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in a column ``value``."""
    return spark.read.text(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _renamed(raw: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    return raw.withColumnsRenamed({name: column for name, (column, _) in fields.items()})


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    fields = schemas.SALES_FIELDS
    return _renamed(read_csv(spark, path, schemas.file_schema(fields)), fields)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    fields = schemas.CUSTOMER_FIELDS
    return _renamed(read_csv(spark, path, schemas.file_schema(fields)), fields)


def read_products(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    fields = schemas.PRODUCT_FIELDS
    return _renamed(read_json(spark, path, schemas.file_schema(fields), one_document), fields)


def read_campaigns(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    fields = schemas.CAMPAIGN_FIELDS
    return _renamed(read_json(spark, path, schemas.file_schema(fields), one_document), fields)
