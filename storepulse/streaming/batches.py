"""What is written for each micro-batch of sale events."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from storepulse.functions.numbers import exact, mean_of, shown
from storepulse.functions.risk import needs_alert
from storepulse.streaming.messages import dead_letters


def summary_by(events: DataFrame, *groups: object) -> DataFrame:
    """Events, revenue and mean risk per group."""
    return events.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(exact(F.col("total_amount"))).alias("total"),
        F.sum(exact(F.col("risk_score"))).alias("risk"),
        F.count(exact(F.col("risk_score"))).alias("n_scored"),
    ).withColumns({
        "revenue": shown(F.col("total")),
        "mean_risk": mean_of(F.col("risk"), F.col("n_scored")),
    }).drop("total", "risk", "n_scored")


def alert_rule() -> Column:
    return needs_alert(
        F.col("is_risk"), F.col("risk_score"), F.col("stock_actual"), F.col("stock_minimo")
    )


def alerts(events: DataFrame) -> DataFrame:
    """Events that need attention: flagged, risky, or at minimum stock."""
    return events.filter(alert_rule()).select(
        "transaction_id", "customer_name", "product_name", "category", "city", "total_amount",
        "stock_actual", "stock_minimo", "risk_score", "event_timestamp",
    )


DERIVED: dict[str, Callable[[DataFrame], DataFrame]] = {
    "alerts": alerts,
    "summary_by_category": lambda events: summary_by(events, "category"),
    "summary_by_city": lambda events: summary_by(events, "city"),
    "dead_letter": dead_letters,
}

# Outputs that hold the rows found in a batch, and are not written where there are none.
FOUND = ("alerts", "dead_letter")


def batch_path(out: str, name: str, batch_id: int) -> str:
    return f"{out}/{name}/batch_id={batch_id}"


def write_batch(rows: DataFrame, out: str, name: str, batch_id: int) -> None:
    """Write one output of one batch; a replay of the batch replaces it."""
    rows.write.mode("overwrite").parquet(batch_path(out, name, batch_id))


def remove_batch(spark: SparkSession, out: str, name: str, batch_id: int) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(batch_path(out, name, batch_id))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def batch_writer(out: str, outputs: Iterable[str] = tuple(DERIVED)) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes the events and what derives from them.

    The source is read once, into the events output. Everything else is computed
    from that written table: it reads only the columns it needs, nothing is held
    in executor memory, and a lost executor costs no second read of the source. An
    empty batch writes nothing; a batch without alerts or dead letters has no such
    output.
    """
    outputs = tuple(outputs)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, out, "events", batch_id)
        written = batch.sparkSession.read.schema(batch.schema).parquet(
            batch_path(out, "events", batch_id)
        )
        # Asked of the written rows: asking the batch would read the source twice.
        if written.isEmpty():
            remove_batch(batch.sparkSession, out, "events", batch_id)
            return
        for name in outputs:
            rows = DERIVED[name](written)
            if name not in FOUND or not rows.isEmpty():
                write_batch(rows, out, name, batch_id)

    return write


def start(rows: DataFrame, out: str, write: Callable[[DataFrame, int], None],
          mode: str = "append", **trigger: object) -> StreamingQuery:
    """Start a query whose outputs and checkpoint live and die together under ``out``.

    Batch numbers restart with the checkpoint. Kept apart, a new checkpoint would
    overwrite the batches of the old one.
    """
    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", f"{out}/_checkpoint")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def start_sales_stream(parsed: DataFrame, out: str, outputs: Iterable[str] = tuple(DERIVED),
                       **trigger: object) -> StreamingQuery:
    """Start the sales stream.

    The query's progress reports, under ``received``, how many events, alerts and
    dead letters each batch had. They are counted on the way, without a job.
    """
    counted = parsed.observe(
        "received",
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(alert_rule()).alias("n_alerts"),
        F.count("corrupt_record").alias("n_dead_letters"),
    )
    return start(counted, out, batch_writer(out, outputs), **trigger)


def read_output(spark: SparkSession, out: str, name: str, schema: StructType) -> DataFrame:
    """All batches of one output with their ``batch_id``; empty if there are none.

    A path that no query was ever started on fails like any missing input.
    """
    full = StructType(list(schema.fields)).add("batch_id", "long")
    try:
        return spark.read.schema(full).parquet(f"{out}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.read.text(f"{out}/_checkpoint/metadata")
        return spark.createDataFrame([], full)


def served_alerts(alert_rows: DataFrame) -> DataFrame:
    """Alerts in reading order, riskiest first."""
    return alert_rows.orderBy(F.desc("risk_score"), "transaction_id")


def served_summary(summary: DataFrame, group: str) -> DataFrame:
    """A summary in reading order: by batch, highest revenue first."""
    return summary.orderBy("batch_id", F.desc("revenue"), group)


def run_to_end(query: StreamingQuery, seconds: float | None = None) -> None:
    """Wait for an ``availableNow`` query; one that fails or takes longer raises here."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"the stream has not come to its end in {seconds} s")


def run_for(query: StreamingQuery, seconds: float) -> None:
    """Let a query run for a while, then stop it."""
    if not query.awaitTermination(seconds):
        query.stop()
