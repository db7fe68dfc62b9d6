"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, one inside the warehouse, which is shared as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"


def new_folder(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A path that does not exist yet; unless ``keep``, what is written there goes when the application ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not keep:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def released(spark: SparkSession) -> None:
    """Have the driver collect its garbage: the shuffles of plans that nothing refers to any more go with that."""
    gc.collect()
    spark._jvm.System.gc()


def dropped(*frames: DataFrame) -> None:
    """Delete the tables that hold ``frames``, which :func:`written` gave; nothing may read them any more."""
    for frame in frames:
        spark = frame.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written once as Parquet and read again: cuts the lineage and survives lost executors."""
    spark = frame.sparkSession
    path = new_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
