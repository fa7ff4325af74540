"""Session settings the engine relies on.

``configure`` sets only what can be changed on a running session, so it works on a
session the caller already owns; ``local_session`` builds one for tests and the bench.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # All instants are UTC; dates and hours are derived from UTC instants.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # JSON objects that name a key twice are read, the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Conditions that list values reach the Bloom filters one by one (sources.warehouse.FEW_KEYS).
    "spark.sql.parquet.pushdown.inFilterThreshold": "100",
    # AQE picks broadcast or sort-merge from measured sizes, splits skewed join sides,
    # and sizes the write partitions of the REBALANCE hint.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

CLUSTER_SETTINGS = {
    # Text compresses about eightfold into Parquet: large splits give archive files of a
    # useful size without a shuffle.
    "spark.sql.files.maxPartitionBytes": "512m",
    # Logs are many small files: let a task take more of them.
    "spark.sql.files.openCostInBytes": "512k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Upper bound for shuffles; AQE coalesces downwards from here.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16000",
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.parquet.compression.codec": "zstd",
}


def small_file_settings(spark: SparkSession) -> dict[str, str]:
    """For settings the session leaves at Spark's defaults, which are made for large files."""
    return {
        # More than 32 paths are listed by a job of one task per path, up to 10,000 of them: for a
        # trigger of 1,000 files that takes longer than reading them. Some tasks per core do.
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(
            2 * spark.sparkContext.defaultParallelism
        ),
        # 250 small logs to a task, not 32, and to the archive file that the task writes.
        "spark.sql.files.openCostInBytes": "512k",
    }


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in small_file_settings(spark).items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*", name: str = "logledger", memory: str = "8g"
) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        # Small data: tasks of a few MB keep all cores busy in rebalanced writes.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.sql.files.openCostInBytes", "128k")
        # One listing task per core, not per folder.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
