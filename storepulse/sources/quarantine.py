"""CSV files with rows that cannot be read: typed rows, and rejects with their text."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

REJECTED = "_rejected"


class Split(NamedTuple):
    """Rows that could be read in full, and lines that could not."""

    good: DataFrame
    rejected: DataFrame


def read_csv_split(spark: SparkSession, path: str, schema: StructType,
                   header: bool = True) -> Split:
    """Typed rows, and ``file, text`` of the lines that have no such row.

    A line is rejected if it has fewer or more fields than the schema, a field that is not
    of its type, or a quote that is not closed. An empty field is a NULL, not an error; two
    quotes inside quotes are one.
    Nothing is lost between the two: each line other than headers and blank ones is in
    exactly one. Both read the same files; whichever columns are asked for, lines are
    judged by all their fields.
    """
    rows = (
        spark.read.schema(StructType(list(schema.fields)).add(REJECTED, "string"))
        .option("header", header)
        .option("enforceSchema", not header)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .csv(path)
    )
    unread = F.col(REJECTED).isNotNull()
    # The reader judges a line by the fields that are asked for. This asks for all of them,
    # in a way that is always true but that no optimizer rule sees through.
    every = F.pmod(F.xxhash64(*[F.col(f.name) for f in schema.fields]), F.lit(1)) == 0
    return Split(
        rows.filter(~unread & every).select(*schema.fieldNames()),
        rows.filter(unread & every).select(
            F.col("_metadata.file_path").alias("file"), F.col(REJECTED).alias("text")),
    )


def summary(split: Split) -> DataFrame:
    """``kind, n_rows``: how many lines are good and how many rejected."""
    count = F.count(F.lit(1)).alias("n_rows")
    return split.good.agg(count).select(F.lit("good").alias("kind"), "n_rows").unionByName(
        split.rejected.agg(count).select(F.lit("rejected").alias("kind"), "n_rows"))
