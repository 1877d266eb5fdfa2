"""Cut long plans at a written copy of the rows."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session, or where that is
    unset one below the warehouse, which they share as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir", None).rstrip("/") + "/_work"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read that.

    A lost executor costs no recomputation, and later reads still prune columns and push
    filters down, unlike those of an RDD checkpoint. Old copies are for the folder's owner to
    expire, as with any checkpoint.
    """
    path = f"{shared_folder(df.sparkSession)}/ledgerline/{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
