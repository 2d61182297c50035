"""JSON files that hold one long array of objects, read by as many tasks as they have blocks.

Spark's multi-line reader gives each such file to one task. Here a file is read as text that
is parted at closing braces, which Spark does block by block. Whether a brace ends an element
depends on all that is before it: on whether it lies in a string, and on how deep. What a
block does to these two is known without its beginning, for either state it may begin in, so
the blocks' effects are added up, a row a block, and each block then knows where it begins.
An element that crosses blocks is put together from its pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import StructType

CLOSE = "}"


def times(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, place, text`` and what each piece does: ``flips`` the state of being in
    a string or not, and opens objects, if it begins outside (``opens_0``) or inside one."""
    raw = spark.read.option("lineSep", CLOSE).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("text"))
    # No escape crosses a piece: a brace is never escaped.
    bare = F.regexp_replace("text", r"(?s)\\.", "")
    outside = r'(?s)"[^"]*("|$)'
    return raw.withColumn("bare", bare).withColumns({
        "flips": times(F.col("bare"), '"') % 2,
        "opens_0": times(F.regexp_replace("bare", outside, ""), "{"),
        "opens_1": times(
            F.regexp_replace(F.regexp_replace("bare", r'(?s)^[^"]*("|$)', ""), outside, ""), "{"),
    }).drop("bare")


def change(starts_inside: Column) -> Column:
    """By how much a piece goes deeper, its closing brace counted if that lies outside strings."""
    opens = F.when(starts_inside, F.col("opens_1")).otherwise(F.col("opens_0"))
    ends_inside = starts_inside != (F.col("flips") == 1)
    return opens - F.when(ends_inside, 0).otherwise(1)


def placed(found: DataFrame) -> DataFrame:
    """The pieces with ``element``: how many elements of the file have ended before each."""
    own = ["file", "block"]
    in_block = W.partitionBy(*own).orderBy("place")
    before = in_block.rowsBetween(W.unboundedPreceding, -1)
    blocks_before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)

    def total_before(column: str | Column, over) -> Column:
        return F.coalesce(F.sum(column).over(over), F.lit(0))

    flipped = found.withColumn("turned", total_before("flips", before) % 2 == 1)
    effects = flipped.groupBy(*own).agg(
        F.sum("flips").alias("flips"),
        F.sum(change(F.col("turned"))).alias("change_0"),
        F.sum(change(~F.col("turned"))).alias("change_1"))
    begun = effects.withColumn("inside", total_before("flips", blocks_before) % 2 == 1).withColumn(
        "change", F.when(F.col("inside"), F.col("change_1")).otherwise(F.col("change_0"))
    ).select(*own, "inside", total_before("change", blocks_before).alias("depth"))

    inside = F.col("turned") != F.col("inside")
    ends_inside = inside != (F.col("flips") == 1)
    depths = flipped.join(begun, own).withColumn("change", change(inside)).withColumn(
        "after", F.col("depth") + F.sum("change").over(in_block)).withColumn(
        "ends", (~ends_inside & (F.col("after") == 0)).cast("long"))
    ended = depths.groupBy(*own).agg(F.sum("ends").alias("n_ends")).select(
        *own, total_before("n_ends", blocks_before).alias("n_before"))
    return depths.withColumn("n_here", total_before("ends", before)).join(ended, own).select(
        *own, "place", "text", (F.col("n_before") + F.col("n_here")).alias("element"), "ends")


def elements(spark: SparkSession, path: str) -> DataFrame:
    """``file, element, text``: each object of the arrays as JSON text.

    Objects only; numbers or strings beside them go to the object after them and are left
    out with the commas. What is after the last object is left out too, also an object
    that is cut off. The work of a task is a block, or the pieces of its elements.
    """
    parts = placed(pieces(spark, path))
    whole = parts.groupBy("file", "element").agg(
        F.array_sort(F.collect_list(F.struct("block", "place", "text"))).alias("parts"),
        F.max("ends").alias("ends"),
    ).filter("ends = 1")
    text = F.concat(F.array_join(F.col("parts.text"), CLOSE), F.lit(CLOSE))
    return whole.select("file", "element", F.regexp_replace(text, r"(?s)^[^{]*", "").alias("text"))


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows the multi-line reader gives for files of one array, read by block.

    An object that does not parse is a row of NULLs. Rows come in no order.
    """
    return elements(spark, path).select(F.from_json("text", schema).alias("row")).select("row.*")
