"""Session settings this library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# No master: that belongs to the deployment.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    # Row-level joins rely on AQE: it switches to broadcast only after measuring
    # the side, and splits a partition that one hot key has blown up.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Streaming state on local disk instead of the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


GIB = 1 << 30


def sized_for(data_bytes: int) -> dict[str, str]:
    """Scan and shuffle sizes for a job over that much data.

    Spark's default of 200 shuffle partitions would make 500 GB partitions of
    100 TB. One per GiB fits an executor core; AQE joins small ones up to the
    advisory size. Both sides are bounded, since every map task keeps a block per
    shuffle partition: 100,000 by 50,000 leaves 20 KB blocks of 100 TB. Streaming
    state goes by ``spark.sql.shuffle.partitions`` instead, fixed at first start.
    """
    partitions = min(max(200, -(-data_bytes // GIB)), 50_000)
    scan_bytes = min(max(GIB // 8, data_bytes // 100_000), GIB)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": str(scan_bytes),
    }


def builder(app_name: str = "storepulse", data_bytes: int | None = None) -> SparkSession.Builder:
    """A session builder with the recommended settings; add master and memory."""
    settings = dict(RECOMMENDED)
    if data_bytes is not None:
        settings.update(sized_for(data_bytes))
    result = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        result = result.config(key, value)
    return result
