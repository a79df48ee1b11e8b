"""Session settings the models rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

MB = 1 << 20

# All of these are Spark's own adaptive features; none changes a result.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Start from many shuffle partitions; AQE merges small ones to the advisory size.
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
    # Hot keys: a partition above the threshold is read by several tasks.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * MB),
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def shuffle_partitions(shuffled_bytes: int, slots: int) -> int:
    """Partitions for a shuffle: at most 128 MB each, and at least one per task slot."""
    return max(slots, -(-shuffled_bytes // (128 * MB)))


def tune(spark: SparkSession, shuffled_bytes: int | None = None) -> SparkSession:
    """Apply the settings to a running session.

    ``shuffled_bytes`` is the largest shuffle expected, for instance the pruned size of the game
    table; 10 TB give about 80,000 partitions.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if shuffled_bytes is not None:
        count = shuffle_partitions(shuffled_bytes, spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return spark


def local_session(cores: int, app: str = "seasonmart", memory: str = "8g", **conf: str) -> SparkSession:
    """A session on one machine, for tests and timings.

    It has the settings of ``tune``, but small shuffles are read by all cores instead of being
    merged to the size that suits a cluster.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        # Recording the Python call site of every column costs several calls into the JVM each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    local = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "true"}
    for key, value in {**SETTINGS, **local, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
