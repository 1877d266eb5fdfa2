"""As-of joins: to every row the last entry of a log that is not later than the row.

No join compares times for being earlier or later. The log is carried forward to the times that rows ask for, in buckets of time,
and rows are then joined with that by equality: a hot key or time can be split like that of any join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Bucket = Callable[[Column], Column]


def month_bucket(day: Column) -> Column:
    return F.trunc(day, "month")


def carried_forward(
    asked: DataFrame, log: DataFrame, by: Sequence[str], time: str, log_time: str, columns: Sequence[str], bucket: Bucket = month_bucket
) -> DataFrame:
    """Each (by, time) of ``asked`` once, with ``log_time`` and ``columns`` of the last entry of its key at or before it.

    Of several entries of a key and time the one with the largest ``columns`` counts, NULL lowest. Entries without
    key or time are left out, as asked times are; a time before the first entry has NULL. A window holds one key
    and bucket, or one key and its buckets, each time once; so a month and the number of months bound them for days.
    """
    known = lambda rows, t: reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, t]])
    times = asked.where(known(asked, time)).select(*by, F.col(time).alias("_t")).distinct()
    entries = log.where(known(log, log_time)).groupBy(*by, F.col(log_time).alias("_t")).agg(F.max(F.struct(*columns)).alias("_v"))
    entries = entries.select(*by, "_t", F.struct("_t", "_v").alias("_entry"))
    merged = entries.unionByName(times, allowMissingColumns=True).groupBy(*by, "_t").agg(F.max("_entry").alias("_entry"))
    merged = merged.withColumn("_bucket", bucket(F.col("_t")))
    # The last entry before each bucket, from the last one of every bucket.
    last = merged.groupBy(*by, "_bucket").agg(F.max("_entry").alias("_last"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    opening = last.select(*by, "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_opening"))
    inside = Window.partitionBy(*by, "_bucket").orderBy("_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = merged.withColumn("_own", F.last("_entry", ignorenulls=True).over(inside)).join(opening, [*by, "_bucket"])
    entry = F.coalesce("_own", "_opening")
    told = found.select(*by, F.col("_t").alias(time), entry["_t"].alias(log_time), *[entry["_v"][c].alias(c) for c in columns])
    return told.join(times.withColumnRenamed("_t", time), [*by, time], "left_semi")


def as_of_join(
    rows: DataFrame, log: DataFrame, by: Sequence[str], time: str, log_time: str, columns: Sequence[str], bucket: Bucket = month_bucket
) -> DataFrame:
    """``rows`` with ``log_time`` and ``columns`` of the last entry at or before their time, NULL where there is none.

    All rows stay, those without key or time too. The log carried to the asked times is joined by equality with the
    hash of the key as well, so that it is dealt out for this join and a hot key and time can be split.
    """
    told = carried_forward(rows, log, by, time, log_time, columns, bucket)
    key = [*by, time]
    told = told.select(*[F.col(c).alias(f"_{c}") for c in key], log_time, *columns)
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in key])
    same &= F.xxhash64(*key) == F.xxhash64(*[f"_{c}" for c in key])
    return rows.join(told, same, "left").drop(*[f"_{c}" for c in key])
