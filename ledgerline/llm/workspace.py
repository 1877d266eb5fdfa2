"""Tables written between two steps of an operator, in the folder that all machines share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, one below the warehouse, which is shared as well."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def keep(frame: DataFrame) -> DataFrame:
    """Write `frame` and read it again: later steps start from files, whichever executors are lost."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Shuffle files of frames that nothing refers to any more are deleted once the driver collects its garbage; this asks for it."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
