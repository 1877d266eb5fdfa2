"""Exact median of a money column without gathering or sorting the values."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Width in cents of the bins of each pass. A decimal(18,2) has up to 10^18 cents, so no pass
# counts more than 10^6 bins, however the values are spread.
BIN_WIDTHS = [10**12, 10**6, 1]


def _bin_of(width: int) -> str:
    """Whole bins by integer division, also below zero."""
    return f"(cents - pmod(cents, {width}L)) div {width}L"


def _cents_at(cents: DataFrame, ranks: list[int]) -> list[int]:
    """Values at ``ranks`` (0 is the smallest): each pass narrows every rank down to one bin."""
    found = [(0, rank) for rank in ranks]  # bin of the last pass, rank within it
    rows, outer = cents.withColumn("outer", F.lit(0).cast("long")), None
    for width in BIN_WIDTHS:
        if outer is not None:
            rows = cents.withColumn("outer", F.expr(_bin_of(outer)))
            rows = rows.where(F.col("outer").isin([bin_ for bin_, _ in found]))
        bins = rows.groupBy("outer", F.expr(_bin_of(width)).alias("bin")).agg(
            F.count(F.lit(1)).alias("n")
        )
        # One task orders the bins of an outer bin, at most a million rows.
        upto = F.sum("n").over(Window.partitionBy("outer").orderBy("bin"))
        held = [
            (F.col("outer") == bin_) & (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
            for bin_, rank in found
        ]
        hits = bins.withColumn("upto", upto).where(reduce(lambda a, b: a | b, held)).collect()
        found = [
            next(
                (h["bin"], rank - h["upto"] + h["n"])
                for h in hits
                if h["outer"] == bin_ and h["upto"] - h["n"] <= rank < h["upto"]
            )
            for bin_, rank in found
        ]
        outer = width
    return [bin_ for bin_, _ in found]


def exact_median(df: DataFrame, column: str) -> Decimal | None:
    """Median of a decimal(18,2) column, the mean of the two middle values for even counts.

    Runs four counting jobs over ``df``; pass a frame that is cheap to read again.
    """
    cents = df.where(F.col(column).isNotNull()).select(
        (F.col(column) * 100).cast("long").alias("cents")
    )
    n = cents.count()
    if n == 0:
        return None
    middle = _cents_at(cents, sorted({(n - 1) // 2, n // 2}))
    return Decimal(sum(middle) * (3 - len(middle))) / 200
