"""The subscription book: what is in force at the start of every month, from the history of subscriptions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import month_of
from ledgerline.functions.text import clean_label
from ledgerline.operators.history import VALID_FROM, VALID_TO, advance, intervals
from ledgerline.schemas import MART_MONEY
from ledgerline.sources.versions import Change, current_version

#: Names of parts of a kept history.
OPEN, CLOSED = "open", "closed-"
TRACKED = ["customer_id", "plan_name", "monthly_price", "status"]


def subscription_history(snapshots: DataFrame) -> DataFrame:
    """One row for each subscription and stretch of snapshots with the same customer, plan, price and status.

    ``snapshots`` has ``snapshot_date`` beside the raw columns. Labels are cleaned first, so that another spelling is no change.
    """
    return intervals(_cleaned(snapshots), "subscription_id", "snapshot_date", TRACKED)


def _cleaned(snapshots: DataFrame) -> DataFrame:
    return snapshots.withColumns({c: clean_label(F.col(c)) for c in ("plan_name", "status")})


class SnapshotTooOld(Exception):
    """A snapshot of a day before the last one that was added."""


class HistoryStore:
    """The history kept up to date by daily snapshots.

    Open intervals are one part and closed ones are parts by the month they ended in. A snapshot is joined with the open
    ones alone; it writes these and the month of its day, whatever has gone before stays as it is.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def add(self, day: date, snapshot: DataFrame) -> list[str]:
        """Take the raw subscriptions of a day, and return the parts written.

        A day that was added before changes nothing; one before the last is an error, as intervals after it are closed.
        """
        change = Change(self.spark, self.root)
        days = change.now.parts("days")
        if str(day) in days:
            return []
        if days and str(day) < max(days):
            raise SnapshotTooOld(f"{day} is before {max(days)}")
        cleaned = _cleaned(snapshot)
        kinds = dict(cleaned.select("subscription_id", *TRACKED).dtypes)
        schema = self.spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in {**kinds, VALID_FROM: "date", VALID_TO: "date"}.items())).schema
        held = change.now.read("history", [OPEN], schema)
        closed = f"{CLOSED}{day:%Y-%m}"
        rows = advance(held, cleaned, F.lit(day), "subscription_id", TRACKED).unionByName(change.now.read("history", [closed], schema))
        part = F.when(F.col(VALID_TO).isNull(), OPEN).otherwise(F.concat(F.lit(CLOSED), F.date_format(VALID_TO, "yyyy-MM")))
        # Two parts, one of them nearly all rows: each task of the join writes its rows of both.
        written = change.replace("history", rows, part, [OPEN, closed], dealt=True)
        change.replace("days", self.spark.createDataFrame([(day,)], "day date"), F.col("day"), [str(day)])
        change.commit()
        return written

    def history(self) -> DataFrame:
        return current_version(self.spark, self.root).read("history")


def _next_start(day: Column) -> Column:
    """The first month start that is not before ``day``."""
    return F.when(day == month_of(day), day).otherwise(F.add_months(month_of(day), 1))


def book_mrr_monthly(history: DataFrame, last_month: Column) -> DataFrame:
    """Active subscriptions, their prices, and what came and went, for each plan and month up to ``last_month``.

    A subscription counts in a month if it is active, with a price above zero, on the month's first day. No interval is written out
    month by month: it adds its price where it begins and takes it off where it ends, these are summed per plan and
    month before the shuffle, and running sums go over months alone. Every plan has a row for each month from its first to the last.
    """
    active = history.where((F.col("status") == "active") & (F.col("monthly_price") > 0))
    begin, end = _next_start(F.col(VALID_FROM)), _next_start(F.col(VALID_TO))
    # One that ends before a month begins is in no month.
    counted = active.where(F.col(VALID_TO).isNull() | (begin < end)).where(begin <= last_month)
    event = lambda month, sign: F.struct(month.alias("book_month"), F.lit(sign).alias("n"))
    events = counted.select("plan_name", "monthly_price", F.explode(F.array(event(begin, 1), event(end, -1))).alias("e"))
    events = events.where((F.col("e.book_month") <= last_month) & F.col("e.book_month").isNotNull())
    come, gone = F.col("e.n") > 0, F.col("e.n") < 0
    price = F.col("monthly_price")
    moves = events.groupBy("plan_name", F.col("e.book_month").alias("book_month")).agg(
        F.sum("e.n").alias("net"),
        F.sum(F.when(come, price).otherwise(0)).alias("gained"),
        F.sum(F.when(gone, price).otherwise(0)).alias("lost"),
    )
    first = moves.groupBy("plan_name").agg(F.min("book_month").alias("first"))
    months = first.select(F.col("plan_name").alias("plan"), F.explode(F.sequence("first", last_month, F.expr("interval 1 month"))).alias("book_month"))
    moves = moves.withColumnRenamed("book_month", "moved_in")
    by_month = Window.partitionBy("plan").orderBy("book_month")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    same = F.col("plan").eqNullSafe(F.col("plan_name")) & (F.col("book_month") == F.col("moved_in"))
    return months.join(moves, same, "left").select(
        F.col("plan").alias("plan_name"),
        "book_month",
        F.sum(zero("net")).over(by_month).cast("long").alias("active_subscriptions"),
        F.sum(zero("gained") - zero("lost")).over(by_month).cast(MART_MONEY).alias("book_mrr_eur"),
        zero("gained").cast(MART_MONEY).alias("gained_eur"),
        zero("lost").cast(MART_MONEY).alias("lost_eur"),
    )
