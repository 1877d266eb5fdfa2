"""Quantiles of parts that are stored as sketches and merged: one number in a hundred or so is misplaced, see ``RANK_ERROR``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch, and how far the share of rows below a returned value may be off.
K, RANK_ERROR = 400, 0.02


def sketched(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One sketch for each group of a decimal(_,2) column, in cents. NULL values are not in it, nor in ``n``.

    Tasks sketch what they read, so a hot group sends a few kilobytes a task.
    """
    cents = rows.where(F.col(value).isNotNull()).select(*by, F.round(F.col(value) * 100).cast("long").alias("cents"))
    return cents.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("cents", F.lit(K)).alias("sketch"))


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """One sketch for each coarser group, from those of its parts."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, shares: dict[str, float]) -> DataFrame:
    """The groups with a column for each share, decimal(18,2), in place of the sketch."""
    kept = [c for c in sketches.columns if c != "sketch"]
    values = [(F.kll_sketch_get_quantile_bigint("sketch", F.lit(share)).cast("decimal(20,0)") / 100).cast("decimal(18,2)").alias(name) for name, share in shares.items()]
    return sketches.select(*kept, *values)


def share_below(rows: DataFrame, found: DataFrame, by: Sequence[str], value: str, columns: Sequence[str]) -> DataFrame:
    """For every group and column of ``found`` the exact shares of rows below and up to its value: one count per group.

    ``found`` has one row a group and is joined by Spark's size check.
    """
    told = found.select(*by, *columns)
    joined = rows.where(F.col(value).isNotNull()).select(*by, value).join(told, list(by))
    counts = [F.count_if(F.col(value) < F.col(c)).alias(f"{c}_below") for c in columns] + [F.count_if(F.col(value) <= F.col(c)).alias(f"{c}_upto") for c in columns]
    return joined.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *counts)
