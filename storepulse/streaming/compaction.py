"""Closed batches gathered into day partitions.

A batch every ten seconds is three million folders a year, for each output. Compaction moves
the rows of closed batches into a table by day: a few files a day, ``batch_id`` kept as a
column. The table's manifest says up to which batch it has come, in the same rename that
makes the rows visible, so an interrupted run has done nothing and a repeated one has nothing
to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from storepulse.sinks import manifest
from storepulse.streaming.batches import batch_path, remove_batch
from storepulse.streaming.served import numbered

DAYS = "days"


def days_path(out: str, name: str) -> str:
    return f"{out}/{DAYS}/{name}"


def tail(spark: SparkSession, out: str, name: str, schema: StructType, after: int,
         upto: int | None = None) -> DataFrame:
    """The rows of whole batches after one batch and up to another, with their batch_id."""
    full = StructType(list(schema.fields)).add("batch_id", "long")
    found = [n for n in numbered(spark, f"{out}/{name}", "batch_id")
             if n > after and (upto is None or n <= upto)]
    if not found:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{out}/{name}").parquet(
        *[batch_path(out, name, n) for n in found])


def compacted_schema(schema: StructType) -> StructType:
    return StructType(list(schema.fields)).add("batch_id", "long").add("day", "string")


def compact(spark: SparkSession, out: str, name: str, schema: StructType, day: Column,
            upto: int) -> int:
    """Move batches up to ``upto``, all of them closed, into their days; gives the version.

    A batch is closed when a later one is committed: only the last can be replayed. Days
    that get rows are written anew, with what they had; the others stay as they are, so a
    run costs the batches since the last one and the days they are of. Rows whose day is
    NULL are a day of their own.
    """
    path = days_path(out, name)
    base = manifest.manifest(spark, path)
    after = base["facts"].get("upto", -1)
    if upto <= after:
        return base["version"]
    new = tail(spark, out, name, schema, after, upto).withColumn(
        "day", F.date_format(day, "yyyy-MM-dd"))
    full = compacted_schema(schema)
    touched = {row.day or manifest.NO_VALUE for row in new.select("day").distinct().collect()}
    old = manifest.read(spark, path, full, "day", base, touched)
    staged = manifest.stage(old.unionByName(new), path, "day") if touched else {}
    return manifest.publish(spark, path, staged, base, upto=upto)


def read_all(spark: SparkSession, out: str, name: str, schema: StructType) -> DataFrame:
    """All rows of an output with their batch_id: the days, and the batches not yet in them."""
    path = days_path(out, name)
    base = manifest.manifest(spark, path)
    days = manifest.read(spark, path, compacted_schema(schema), "day", base).drop("day")
    return days.unionByName(tail(spark, out, name, schema, base["facts"].get("upto", -1)))


def forget_batches(spark: SparkSession, out: str, name: str) -> None:
    """Delete the folders of the batches that their days hold.

    To be called when readers that started before the last ``compact`` are done.
    """
    upto = manifest.manifest(spark, days_path(out, name))["facts"].get("upto", -1)
    for n in numbered(spark, f"{out}/{name}", "batch_id"):
        if n <= upto:
            remove_batch(spark, out, name, n)
