"""Session settings that the reports rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SIZE_FACTOR = "spark.sql.sources.fileCompressionFactor"

# Runtime settings only: sizes of the cluster (memory, cores, shuffle partitions) belong to whoever owns it.
SETTINGS = {
    # Dates carry no zone; text rendering and bare timestamp literals must not shift them.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, switch to broadcast when a side turns out
    # small, and split hot join partitions, also where the split costs one more exchange afterwards.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What one task takes on is bounded, however large the tables: grouping in front of a shuffle keeps most rows of a task
    # where keys hardly repeat, and beyond these sizes it would spill.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # Intermediate tables are written with zstd, about 1.6 times smaller than the default: a side that would be too large to
    # broadcast must not pass for small by that.
    SIZE_FACTOR: "1.6",
    # Prune the large side of a selective join before its shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}

# Adaptive execution merges shuffle partitions and splits none, so a shuffle has to start with enough of them.  The largest
# one of the reports is about three times the stored input, so a partition begins below the size that it may be merged to.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
INPUT_BYTES_PER_PARTITION = 8 << 20
# Beyond 80 GB of input the owner's spark.sql.shuffle.partitions decides, which always counts where it is higher.
MOST_INITIAL_PARTITIONS = 10_000


def tune(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session, deal its shuffles for ``input_bytes`` of input, and return it."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    parts = min(-(-input_bytes // INPUT_BYTES_PER_PARTITION), MOST_INITIAL_PARTITIONS)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(parts))
    else:
        spark.conf.unset(INITIAL_PARTITIONS)
    return spark


@contextmanager
def sizes_times(spark: SparkSession, factor: float) -> Iterator[None]:
    """Joins that run inside count files ``factor`` times, to tell whether a side is small enough to be broadcast."""
    before = spark.conf.get(SIZE_FACTOR)
    spark.conf.set(SIZE_FACTOR, str(factor))
    try:
        yield
    finally:
        spark.conf.set(SIZE_FACTOR, before)
