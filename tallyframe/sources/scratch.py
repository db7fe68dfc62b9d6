"""Intermediate tables of a report, written once and read by all of its branches."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Intermediate tables go with the application, so they may be smaller than what other readers would need.
COMPRESSION = "zstd"

# The driver builds what is broadcast, and a row of a few keys takes 64 bytes or more there, however well its file packs it.
MOST_BROADCAST_ROWS = 500_000


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, which executors share; it goes when the application ends.

    Where that is unset the path lies in the warehouse, which executors share as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files at ``path``; zero where there is nothing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(place).getLength() if files.exists(place) else 0


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written as Parquet now and read from there: work that several branches share is done once.

    It also survives lost executors, and its true size is known to the plans that read it.
    """
    spark = frame.sparkSession
    path = new_folder(spark, f"tallyframe-{name}")
    frame.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def stored_together(write, **frames: DataFrame) -> list[DataFrame]:
    """``write`` (such as :func:`stored`) for frames that do not depend on each other, as concurrent jobs."""
    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(write, frames.values(), frames))


def dealt_if_long(frame: DataFrame) -> DataFrame:
    """``frame``, a stored table, kept from broadcasts where it has more than :data:`MOST_BROADCAST_ROWS` rows.

    Spark goes by the size of the files, in which rising keys take a byte or two each.
    """
    return frame.hint("merge") if frame.count() > MOST_BROADCAST_ROWS else frame
