"""Intervals of validity out of snapshots, whole or one snapshot at a time.

An interval is a stretch of snapshots in which a key is there with the same values: ``valid_from`` is the first day and
``valid_to`` the day of the first snapshot that no longer shows it, NULL while the last one does. A key that is
missing from a snapshot has its interval closed, and another one opened when it comes back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.lineage import cut_lineage

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def _values(columns: Sequence[str], table: str = "") -> Column:
    return F.struct(*[F.col(f"{table}{c}") for c in columns])


def one_per_day(snapshots: DataFrame, key: str, day: str, columns: Sequence[str]) -> DataFrame:
    """One row for each key and day: the largest values, NULL lowest. Combined before the shuffle, so a hot key sends
    one row a task and day, and no key has more rows than there are days. Rows without key or day are left out."""
    known = snapshots.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    kept = known.groupBy(key, day).agg(F.max(_values(columns)).alias("kept"))
    return kept.select(key, day, *[F.col(f"kept.{c}").alias(c) for c in columns])


def one_per_key(snapshot: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``one_per_day`` of a single day. Grouped by the key alone, so a join by key needs no other shuffle or sort."""
    return snapshot.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(_values(columns)).alias("now"))


def intervals(snapshots: DataFrame, key: str, day: str, columns: Sequence[str]) -> DataFrame:
    """Key, ``columns``, valid_from and valid_to over all snapshots.

    The window over a key is bounded: it has one row a day at most. So is the table of days, of
    which there are as many as snapshots, and which is told to all tasks.
    """
    # Written, because the days are read first and the rows after them.
    rows = cut_lineage(one_per_day(snapshots, key, day, columns))
    days = rows.select(F.col(day).alias("shown")).distinct()
    following = days.select("shown", F.lead("shown").over(Window.orderBy("shown")).alias("next_shown"))
    by_key = Window.partitionBy(key).orderBy(day)
    told = rows.join(F.broadcast(following), F.col(day) == F.col("shown"))
    told = told.withColumns({"before": F.lag(_values(columns)).over(by_key), "before_next": F.lag("next_shown").over(by_key)})
    goes_on = F.col("before_next").eqNullSafe(F.col(day)) & F.col("before").eqNullSafe(_values(columns))
    # One row for each stretch of days without a change or a gap.
    stretches = told.withColumn("stretch", F.sum(F.when(goes_on, 0).otherwise(1)).over(by_key))
    found = stretches.groupBy(key, "stretch").agg(
        F.min(day).alias(VALID_FROM),
        F.max(F.struct(day, "next_shown", *columns)).alias("last"),
    )
    return found.select(key, *[F.col(f"last.{c}").alias(c) for c in columns], VALID_FROM, F.col("last.next_shown").alias(VALID_TO))


def advance(history: DataFrame, snapshot: DataFrame, day: Column, key: str, columns: Sequence[str]) -> DataFrame:
    """The history after one more snapshot, of a later day than all before.

    Closed intervals are passed through; open ones and the snapshot have one row a key and are joined once. The result
    is that of ``intervals`` over all snapshots, if none was without any row.
    """
    now = one_per_key(snapshot.where(day.isNotNull()), key, columns).select(F.col(key).alias("now_key"), "now")
    open_ones = history.where(F.col(VALID_TO).isNull()).select(key, _values(columns).alias("then"), VALID_FROM)
    met = open_ones.join(now, F.col(key) == F.col("now_key"), "full_outer")
    same = F.col(key).isNotNull() & F.col("now_key").isNotNull() & F.col("then").eqNullSafe(F.col("now"))
    old = F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("k"), F.col("then").alias("v"), F.col(VALID_FROM).alias("f"), F.when(~same, day).alias("t")))
    new = F.when(F.col("now_key").isNotNull() & ~same, F.struct(F.col("now_key").alias("k"), F.col("now").alias("v"), day.alias("f"), F.lit(None).cast("date").alias("t")))
    rows = met.select(F.explode(F.array_compact(F.array(old, new))).alias("i"))
    rows = rows.select(F.col("i.k").alias(key), *[F.col(f"i.v.{c}").alias(c) for c in columns], F.col("i.f").alias(VALID_FROM), F.col("i.t").alias(VALID_TO))
    return history.where(F.col(VALID_TO).isNotNull()).select(rows.columns).unionByName(rows)
