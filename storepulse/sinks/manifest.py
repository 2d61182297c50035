"""Partitioned parquet tables whose live folders are named in a manifest.

An overwrite in place deletes before it writes: a job that dies in between leaves neither the
old month nor the new one. Here a write goes to folders of its own, and becomes the table by
one rename of a small file that says which folder holds which partition. Readers see the
version before it or the one after. Of two writers that start from the same version one
fails, and its folders are garbage that ``clean`` removes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# What is written where a partition's value is NULL. Fixed value: Spark's own name for it.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another writer has replaced the table since this one read it."""


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _names(spark: SparkSession, folder: str) -> list[str]:
    files = _files(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    return sorted(e.getPath().getName() for e in files.listStatus(_path(spark, folder)))


def versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n[1:-5]) for n in _names(spark, f"{path}/manifests")
            if n.startswith("v") and n.endswith(".json")]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """``version``, the folder of each partition, and the facts that writers have noted."""
    found = versions(spark, path)
    if not found and version is None:
        return {"version": 0, "partitions": {}, "facts": {}}
    version = found[-1] if version is None else version
    name = _path(spark, f"{path}/manifests/v{version:012}.json")
    stream = _files(spark, path).open(name)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {"version": version, **json.loads(text)}


def _publish(spark: SparkSession, path: str, version: int, content: dict) -> None:
    """Make this the manifest of a version, unless the version has one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = _files(spark, path)
    draft = _path(spark, f"{path}/manifests/.draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(json.dumps(content).encode())
    finally:
        stream.close()
    target = _path(spark, f"{path}/manifests/v{version:012}.json")
    nothing = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context = hadoop.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, nothing)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise Conflict(f"{path} has a version {version} already") from error
        raise


def stage(rows: DataFrame, path: str, by: str, gathered: bool = False) -> dict[str, str]:
    """Write rows to folders of their own; gives the folder of each partition in them.

    Nothing reads those folders until ``publish`` names them. Of ``gathered`` rows a task has
    those of a few partitions already (see ``sinks/runs.py``); others are shuffled.
    """
    spark = rows.sparkSession
    write = uuid.uuid4().hex
    folder = f"{path}/data/write={write}"
    # Each partition is gathered into files of the advisory size; AQE cuts a large one.
    dealt = rows if gathered else rows.hint("rebalance", by)
    dealt.write.partitionBy(by).parquet(folder)
    return {name.split("=", 1)[1]: write for name in _names(spark, folder)
            if name.startswith(f"{by}=")}


def publish(spark: SparkSession, path: str, staged: dict[str, str], base: dict,
            whole: bool = False, empty: Iterable[str] = (), **facts: object) -> int:
    """Replace the partitions in ``staged`` by their new folders; gives the new version.

    ``base`` is the manifest that the rows were worked out from. With ``whole`` only the
    staged partitions stay; those in ``empty`` go.
    """
    live = {} if whole else dict(base["partitions"])
    live.update(staged)
    for name in empty:
        live.pop(name, None)
    version = base["version"] + 1
    _publish(spark, path, version, {
        "partitions": live, "facts": {**base["facts"], **facts}})
    return version


def replace(rows: DataFrame, path: str, by: str, whole: bool = False,
            gathered: bool = False) -> int:
    """Replace the partitions that ``rows`` has rows of, or the whole table, at once."""
    base = manifest(rows.sparkSession, path)
    return publish(rows.sparkSession, path, stage(rows, path, by, gathered), base, whole)


def read(spark: SparkSession, path: str, schema: StructType, by: str,
         of: dict | None = None, only: Iterable[str] | None = None) -> DataFrame:
    """The table as of its newest manifest, or of the one given.

    ``schema`` includes the partition column. ``only`` names the partitions to read; a
    filter on the partition column prunes folders just as well.
    """
    of = of or manifest(spark, path)
    live = {name: write for name, write in of["partitions"].items()
            if only is None or name in only}
    if not live:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/write={write}/{by}={name}" for name, write in sorted(live.items())]
    full = StructType(list(schema.fields)).add("write", "string")
    return spark.read.schema(full).option("basePath", f"{path}/data").parquet(*folders).select(
        *schema.fieldNames())


def clean(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove what the last ``keep`` versions do not name.

    To be called when no writer is at work: what it has staged is not named yet.
    """
    found = versions(spark, path)
    kept = found[-keep:]
    named = {write for v in kept for write in manifest(spark, path, v)["partitions"].values()}
    files = _files(spark, path)
    for name in _names(spark, f"{path}/data"):
        if name.split("=")[-1] not in named:
            files.delete(_path(spark, f"{path}/data/{name}"), True)
    for name in _names(spark, f"{path}/manifests"):
        if name.startswith(".draft-") or name.startswith("v") and int(name[1:-5]) not in kept:
            files.delete(_path(spark, f"{path}/manifests/{name}"), False)


def with_month(sales: DataFrame, time_column: str = "sold_at") -> DataFrame:
    return sales.withColumn("month", F.date_format(time_column, "yyyy-MM"))


def replace_sales_by_month(sales: DataFrame, path: str, time_column: str = "sold_at",
                           whole: bool = False, gathered: bool = False) -> int:
    """Replace the months that ``sales`` has sales of; the other months stay as they are."""
    return replace(with_month(sales, time_column), path, "month", whole, gathered)
