"""Tables laid out by a key, so that joins on that key move no rows.

A table is written once, dealt by the key into buckets that are each sorted by it. Two tables
with the same number of buckets join bucket by bucket, with no exchange on either side; each
task sorts its bucket, which is sorted already, so that costs little. It pays where large tables are joined on the same key again and again, as sale lines
and their orders are. One file a bucket keeps the order; the price is one shuffle at writing.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BUCKET_BYTES = 256 << 20
# What a sort holds of a row besides its fields of 8 bytes: header and pointers (with 6 fields
# 112 bytes a row were measured). What a text takes besides its field, as Spark guesses it.
ROW_BYTES, TEXT_BYTES = 64, 20


def buckets_for(data_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for a table of that size; tables to be joined need the same number.

    A power of two, so that of two tables with different numbers the one with more can
    still be read by the other's.
    """
    return 1 << (max(1, ceil(data_bytes / bucket_bytes)) - 1).bit_length()


def row_bytes(schema: StructType) -> int:
    """What a row takes in the memory of a sort.

    Files are no measure: packed columns take a small part of what a sort holds of them.
    """
    text = sum(f.dataType.typeName() in ("string", "binary") for f in schema.fields)
    return ROW_BYTES + 8 * len(schema.fields) + TEXT_BYTES * text


def planned_bytes(rows: DataFrame) -> int:
    """What the rows take in a sort; counts them, which parquet does by footers."""
    return rows.count() * row_bytes(rows.schema)


def write_bucketed(rows: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write rows as a table by buckets of ``key``, sorted by it; gives the table.

    Rows are dealt as the buckets are, so each bucket is one file and none is written by
    many tasks. NULL keys share a bucket. A key with very many rows makes a long file,
    read by one task: lay tables out by keys that no single value rules.
    """
    rows.repartition(buckets, key).sortWithinPartitions(key).write.mode("overwrite").bucketBy(
        buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


def register(spark: SparkSession, name: str, path: str, schema: StructType, key: str,
             buckets: int) -> DataFrame:
    """Make a table written before known to this session's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
        f"SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)
