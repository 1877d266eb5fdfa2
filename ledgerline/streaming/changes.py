"""Apply deliveries of invoice changes as they arrive.

Structured Streaming remembers which files were taken and hands over the new ones alone. A batch that was applied but not yet
noted when the driver was lost comes again: a change that was merged before changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.plans.incremental import CHANGES, IncrementalBilling


def apply_on_arrival(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    store: IncrementalBilling,
    cadence: str | None = None,
    files_per_batch: int = 1000,
    schema: T.StructType = CHANGES,
) -> StreamingQuery:
    """Merge the Parquet files of ``landing`` in batches; only new files are read.

    With ``cadence=None`` the files that wait are merged and the query ends. ``checkpoint`` and the store's root lie
    in folders that all machines share.
    """
    changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)

    def merge(batch: DataFrame, batch_id: int) -> None:
        store.apply(batch)

    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    if cadence is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=cadence).start()
