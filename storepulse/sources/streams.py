"""Unbounded sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def kafka_messages(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                   max_offsets: int = 5_000_000, **options: str) -> DataFrame:
    """Keyed messages of one topic: ``key``, ``value`` and ``timestamp``.

    The connector jar comes with the deployment. ``max_offsets`` bounds a batch,
    so that catching up on a backlog does not arrive as one batch. ``options`` go to the
    connector as they are, with dots as double underscores: ``minPartitions="64"``,
    ``kafka__security__protocol="SSL"``.
    """
    given = {name.replace("__", "."): value for name, value in options.items()}
    return (
        spark.readStream.format("kafka")
        .options(**given)
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", max_offsets)
        .load().select("key", "value", "timestamp")
    )


def parquet_files(spark: SparkSession, path: str, schema: StructType | str,
                  files_per_batch: int = 10_000) -> DataFrame:
    """Parquet files as a stream, at most ``files_per_batch`` of them per batch.

    The bound keeps a backlog from arriving as one batch. It is wide, because each
    batch reads the static side of its joins anew.

    ``path`` may be a directory or a single file. The file source takes a single
    file only as a pattern, so the last letter is put in a pattern of its own.
    """
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(pattern)
    )
