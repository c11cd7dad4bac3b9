"""Session settings the operators are written for.

The operators never need a particular configuration to be correct. These
settings make them fast and skew-tolerant at scale: adaptive execution
re-plans joins from measured shuffle sizes (runtime broadcast conversion),
splits skewed join partitions, and coalesces small shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings; all of them can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one more shuffle
    # afterwards (the operators often aggregate on a finer key right after a
    # person_id join, and that aggregate then spreads the hot person).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_conf(
    largest_input_bytes: int, partition_bytes: int = 256 * 1024**2, max_shuffle_partitions: int | None = None
) -> dict[str, str]:
    """Partition sizing for a cluster run, from the size of the largest input.

    Scan splits and shuffle partitions target ``partition_bytes`` so a task's
    sort and aggregation buffers fit executor memory (spilling beyond that);
    adaptive execution starts from that many shuffle partitions and
    coalesces the small ones. A shuffle partition over twice the target (and
    5x the median) counts as skewed and is split at joins.

    The shuffle partition count follows the input size. Shuffled data is often
    smaller (columns are pruned, rows filtered and partially aggregated before
    the exchange) and the number of shuffle blocks grows with map tasks x
    reduce partitions; ``max_shuffle_partitions`` lowers the count where the
    shuffled size is known to be smaller.
    """
    partitions = max(200, -(-largest_input_bytes // partition_bytes))
    if max_shuffle_partitions is not None:
        partitions = min(partitions, max_shuffle_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``RUNTIME_CONF`` to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    master: str = "local[8]",
    app_name: str = "cohortkit",
    shuffle_partitions: int = 8,
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the benchmark (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. ``fallback`` is only used where the
    setting is absent (tests on one machine).
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        context = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (Spark Connect)
        context = None
    if not path and context is not None:
        path = context.getCheckpointDir()
    if not path and fallback:
        path = fallback
    if path and context is not None:
        context.setCheckpointDir(path)
    return path
