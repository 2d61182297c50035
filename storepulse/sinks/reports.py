"""Report files: one CSV file with a name of its own."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, FloatType


def plain_numbers(report: DataFrame) -> DataFrame:
    """Doubles as two-decimal numbers, which text files show without an exponent."""
    return report.withColumns({
        field.name: report[field.name].cast("decimal(28,2)")
        for field in report.schema.fields
        if isinstance(field.dataType, (DoubleType, FloatType))
    })


def write_report_csv(report: DataFrame, path: str, *order: object, one_file: bool = True) -> None:
    """Replace the CSV report at ``path``, as the caller says in one file or a folder of files.

    One file is written by one task: for reports with a row per group. The report is
    written beside the target; the old one is moved aside, not deleted, until the new one
    is in its place. A folder is never replaced by a file, nor a file by a folder.
    """
    spark = report.sparkSession
    folder = f"{path}._building-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    target, aside = hadoop(path), hadoop(f"{folder}/old")
    if files.exists(target) and files.getFileStatus(target).isFile() != one_file:
        raise FileExistsError(f"{path} is not {'a file' if one_file else 'a folder'}")
    try:
        rows = report
        if one_file:
            rows = rows.repartition(1).sortWithinPartitions(*order) if order else rows.repartition(1)
        elif order:
            rows = rows.orderBy(*order)
        rows.write.option("header", True).csv(f"{folder}/csv")
        ready = hadoop(f"{folder}/csv")
        if one_file:
            ready = files.globStatus(hadoop(ready, "part-*"))[0].getPath()
        if files.exists(target) and not files.rename(target, aside):
            raise OSError(f"could not move the old report from {path}")
        if not files.rename(ready, target):
            files.rename(aside, target)
            raise OSError(f"could not move the report to {path}")
    finally:
        files.delete(hadoop(folder), True)
