"""Running results that can be read at any age of the stream.

Update mode writes the groups that each batch changed, so the current rows lie scattered
over all batches ever run. Here every few batches are folded into a snapshot: the current row
of each group so far. A reader takes the newest whole snapshot and the few batches after it,
a writer folds only those, so neither does more as the stream grows older.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from storepulse.streaming.aggregates import latest
from storepulse.streaming.batches import batch_path, remove_batch, start, write_batch

SNAPSHOT = "snapshot"


def numbered(spark: SparkSession, folder: str, key: str) -> list[int]:
    """The numbers of the whole ``key=number`` folders: those whose write has ended."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = []
    for entry in files.listStatus(path):
        name = entry.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
        if name.startswith(f"{key}=") and files.exists(done):
            found.append(int(name.split("=")[1]))
    return sorted(found)


def snapshots(spark: SparkSession, out: str, name: str) -> list[int]:
    """The last batch of each whole snapshot."""
    return numbered(spark, f"{out}/{SNAPSHOT}/{name}", "upto")


def snapshot_path(out: str, name: str, upto: int) -> str:
    return f"{out}/{SNAPSHOT}/{name}/upto={upto}"


def current(spark: SparkSession, out: str, name: str, schema: StructType, *keys: str,
            upto: int | None = None) -> DataFrame:
    """The newest row per group: the last snapshot, and the batches after it.

    ``upto`` leaves out what came after that batch. A batch is replayed only as long as it
    is the last one, so no batch in a snapshot changes any more.
    """
    before = [n for n in snapshots(spark, out, name) if upto is None or n < upto]
    newest = before[-1] if before else -1
    tail = [n for n in numbered(spark, f"{out}/{name}", "batch_id")
            if n > newest and (upto is None or n <= upto)]
    full = StructType(list(schema.fields)).add("batch_id", "long")
    rows = spark.createDataFrame([], full) if not before else spark.read.schema(full).parquet(
        snapshot_path(out, name, newest))
    if tail:
        read = spark.read.schema(full).option("basePath", f"{out}/{name}")
        rows = rows.unionByName(read.parquet(*[batch_path(out, name, n) for n in tail]))
    return latest(rows, *keys)


def fold(spark: SparkSession, out: str, name: str, schema: StructType, *keys: str,
         upto: int) -> None:
    """Write the snapshot of everything up to a batch; the same again if it is replayed."""
    rows = current(spark, out, name, schema, *keys, upto=upto)
    rows.withColumn("batch_id", F.lit(upto).cast("long")).write.mode("overwrite").parquet(
        snapshot_path(out, name, upto))


def forget(spark: SparkSession, out: str, name: str, keep: int = 2) -> None:
    """Delete all but the last ``keep`` snapshots, and the batches that those all hold.

    A reader that started on an older snapshot is left time until ``keep`` newer ones exist.
    """
    done = snapshots(spark, out, name)
    if len(done) < keep:
        return
    for old in done[:-keep]:
        remove_path(spark, snapshot_path(out, name, old))
    for old in numbered(spark, f"{out}/{name}", "batch_id"):
        if old <= done[-keep]:
            remove_batch(spark, out, name, old)


def remove_path(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folding_writer(out: str, name: str, schema: StructType, keys: tuple[str, ...], every: int,
                   keep: int | None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the batch's updates, and a snapshot every few batches."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, out, name, batch_id)
        if batch_id % every == every - 1:
            fold(batch.sparkSession, out, name, schema, *keys, upto=batch_id)
            if keep:
                forget(batch.sparkSession, out, name, keep)

    return write


def start_served(summary: DataFrame, out: str, name: str, *keys: str, every: int = 60,
                 keep: int | None = 2, **trigger: object) -> StreamingQuery:
    """Start a running summary whose current rows ``current`` reads.

    ``every`` batches make a snapshot; ``keep`` of them, with the batches since the oldest
    kept one, are all that stays. None keeps every batch, as a history.
    """
    write = folding_writer(out, name, summary.schema, keys, every, keep)
    return start(summary, out, write, mode="update", **trigger)
