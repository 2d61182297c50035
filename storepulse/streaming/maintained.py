"""Running totals kept up to date from batches, also when a batch is replaced.

A batch's own totals are kept beside the running ones. When the batch comes again with other
rows, its old totals are taken away and its new ones added; when it comes again as it was,
nothing is written. Both tables are partitions of one table with a manifest, so they change
together, by one rename, or not at all. All totals are counts and exact decimal sums: the order of
batches and rows does not matter, and what was added can be taken away to the last digit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DecimalType, LongType, StructType

from storepulse.functions.numbers import exact, mean_of, shown
from storepulse.sinks import manifest
from storepulse.streaming.batches import start

# Name of the partition that holds the running totals.
RUNNING = "running"
SUMS = {"n_events": LongType(), "n_scored": LongType(), "total": DecimalType(38, 6),
        "risk": DecimalType(38, 6)}


class Closed(ValueError):
    """The batch is too old to be replaced: its own totals are no longer kept."""


def batch_part(batch_id: int) -> str:
    return f"batch-{batch_id:012}"


def event_totals(events: DataFrame, *groups: str) -> DataFrame:
    """Per group: events, scored events, and the sums of amounts and scores."""
    score = exact(F.col("risk_score"))
    return events.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count(score).alias("n_scored"),
        F.coalesce(F.sum(exact(F.col("total_amount"))), F.lit(0)).cast(SUMS["total"]).alias("total"),
        F.coalesce(F.sum(score), F.lit(0)).cast(SUMS["risk"]).alias("risk"),
    )


def fingerprint(rows: DataFrame) -> str:
    """The same text for the same rows in any order, repeated rows counted.

    The number of rows and two sums of their 64-bit hashes: computed before the shuffle,
    which carries three numbers a task. NULLs are hashed with their place. Two different
    bags share it with a chance of about 2^-128.
    """
    columns = [F.col(f"`{name}`") for name in sorted(rows.columns)]
    row: list[Column] = [*columns, *[c.isNull() for c in columns]]
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(38,0)")).alias(f"sum_{seed}")
          for seed in (1, 2)],
    ).first()
    return "|".join(str(value) for value in found)


def schema_of(events: DataFrame, *groups: str) -> StructType:
    """Columns of the table: the groups, the sums, and the partition they lie in."""
    schema = StructType([events.schema[name] for name in groups])
    for name, kind in SUMS.items():
        schema = schema.add(name, kind)
    return schema.add("part", "string")


def added(rows: DataFrame, *groups: str) -> DataFrame:
    """Totals of totals; groups that have no event left are gone."""
    return rows.groupBy(*groups).agg(
        *[F.sum(name).cast(kind).alias(name) for name, kind in SUMS.items()]
    ).filter("n_events <> 0")


def maintain(events: DataFrame, path: str, batch_id: int, *groups: str, keep: int = 100) -> int:
    """Take a batch into the running totals, or replace it there; gives the version.

    ``keep`` batches can be replaced; the totals of older ones are let go, and to replace
    one raises ``Closed``. The work is the batch's rows, its old totals and the groups,
    whatever the number of batches before. Of two writers at once one fails.
    """
    spark = events.sparkSession
    base = manifest.manifest(spark, path)
    prints: dict[str, str] = base["facts"].get("prints", {})
    closed = base["facts"].get("closed", -1)
    name, own = batch_part(batch_id), fingerprint(events)
    if prints.get(name) == own:
        return base["version"]
    if batch_id <= closed:
        raise Closed(f"batch {batch_id} is closed; the last closed one is {closed}")

    schema = schema_of(events, *groups)
    held = manifest.read(spark, path, schema, "part", base, {RUNNING, name})
    new = event_totals(events, *groups)
    taken = held.filter(F.col("part") == name).withColumns(
        {column: (-F.col(column)).cast(kind) for column, kind in SUMS.items()})
    running = added(
        held.filter(F.col("part") == RUNNING).drop("part").unionByName(taken.drop("part"))
        .unionByName(new), *groups)
    rows = running.withColumn("part", F.lit(RUNNING)).unionByName(
        new.withColumn("part", F.lit(name)))
    staged = manifest.stage(rows, path, "part")

    prints = {**prints, name: own}
    let_go = sorted(prints)[:-keep]
    closed = max([closed, *(int(old.removeprefix("batch-")) for old in let_go)])
    for old in let_go:
        del prints[old]
    # A partition that was not staged again has no rows any more.
    gone = {*let_go, *({RUNNING, name} - staged.keys())}
    return manifest.publish(
        spark, path, {part: write for part, write in staged.items() if part not in let_go},
        base, empty=gone, prints=prints, closed=closed)


def running_totals(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The exact running totals, one row a group."""
    return manifest.read(spark, path, schema, "part", only={RUNNING}).drop("part")


def running_summary(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Events, revenue and mean risk per group, over all batches."""
    return running_totals(spark, path, schema).withColumns({
        "revenue": shown(F.col("total")),
        "mean_risk": mean_of(F.col("risk"), F.col("n_scored")),
    }).drop("total", "risk", "n_scored")


def maintaining_writer(path: str, *groups: str, keep: int = 100) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function; a replayed batch changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        maintain(batch, path, batch_id, *groups, keep=keep)

    return write


def start_maintained(parsed: DataFrame, out: str, *groups: str, keep: int = 100,
                     columns: tuple[str, ...] = ("transaction_id", "total_amount", "risk_score"),
                     **trigger: object) -> StreamingQuery:
    """Start running totals of a sales stream, kept in ``out/totals``.

    Only ``columns`` and the groups are taken from an event: they are what a batch is
    recognised by. The time an event was processed, say, is another in each replay.
    """
    taken = parsed.select(*dict.fromkeys([*columns, *groups]))
    return start(taken, out, maintaining_writer(f"{out}/totals", *groups, keep=keep), **trigger)
