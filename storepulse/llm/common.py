"""What the operators share: the given tables, scratch tables, the held-out fold."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from storepulse.sources.scratch import scratch_path

# Fixed value: what separates words, as a Java and RE2 character class.
WORD = r"[^\x20\x09-\x0D]+"
# Fixed value: the same separators as characters.
SPACES = " \t\n\x0b\x0c\r"
# Fixed value: Spark's setting of the rows in a batch for a Python worker.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Bytes of rows that a worker turns into columns of Python objects at a time.
SLICE = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def rows_at_once(spark: SparkSession, most: int | None) -> Iterator[None]:
    """Queries that run within send Python workers at most so many rows in a batch."""
    before = spark.conf.get(BATCH)
    if most is not None:
        spark.conf.set(BATCH, most)
    try:
        yield
    finally:
        if most is not None:
            spark.conf.set(BATCH, before)


def written(rows: DataFrame, purpose: str, at_once: int | None = None) -> DataFrame:
    """The rows as a table in the shared folder, computed once.

    Cuts the lineage: a lost executor costs a reread of files, not a recomputation.
    ``at_once``: rows of a batch that a Python worker gets, if they are large.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, purpose)
    with rows_at_once(spark, at_once):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def learning_fold(doc_id: Column) -> Column:
    """Whether labels of this document may be learned from; NULL ids count as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 != 1


def give_back() -> None:
    """Returns to the system what this worker freed: Spark keeps workers from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a task's batches, in batches of about ``SLICE`` bytes, or one row."""
    give_back()
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE // max(batch.nbytes, 1))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()


def map_rows(
    rows: DataFrame, schema: str, of_batch: Callable[[pa.RecordBatch], list[list]],
) -> DataFrame:
    """One pass over Arrow batches, a slice at a time; ``of_batch`` gives its columns."""
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = of_batch(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) if isinstance(c, list) else c.cast(f.type)
                 for c, f in zip(columns, out, strict=True)],
                schema=out,
            )

    return rows.mapInArrow(run, schema)
