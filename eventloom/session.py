"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes and splits shuffle partitions at run time. The force flag lets it split a
# skewed join partition even when the split costs one more (already reduced) shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows travel to Python workers in batches bounded by size, not only by number.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # A task that writes a table split by day keeps the files of so many days open instead of sorting its rows
    # by day. A scan puts 32 files at most into a task; one with more days sorts the rows of the others.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def configure(spark: SparkSession, initial_partitions: int | None = None) -> SparkSession:
    """Apply the runtime settings to a session somebody else created.

    `initial_partitions` is what every shuffle starts with before small ones are merged at
    run time. Choose it for the largest shuffle, about one per 100 MB of shuffled data; the
    small shuffles of the same job shrink by themselves.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if initial_partitions is not None:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions))
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, call `configure` instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("eventloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
