"""Whether a run rejects more rows than runs before it did."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.schemas import CUSTOMER_REASONS, INVOICE_REASONS, SUBSCRIPTION_REASONS

REASONS = {"customers": CUSTOMER_REASONS, "subscriptions": SUBSCRIPTION_REASONS, "invoices": INVOICE_REASONS}
HISTORY = "table_name string, run long, quarantine_reason string, row_count long, table_rows long"
PER = 1_000_000


@dataclass(frozen=True)
class Band:
    """How far a share of rows may lie above the median of earlier runs.

    The larger of ``deviations`` robust standard deviations (1.4826 times the median distance from the median),
    ``rise`` of the median itself, and ``least`` rows in a million. Nothing is judged before ``least_runs`` runs.
    """

    runs: int = 12
    least_runs: int = 5
    deviations: float = 5.0
    rise: float = 0.5
    least: float = 1000.0


def counts_per_run(classified: DataFrame, table: str, run: Column) -> DataFrame:
    """HISTORY: rows of every reason of the table in each run, 0 included. One aggregate, combined before the shuffle."""
    reasons = REASONS[table]
    counted = classified.withColumn("run", run.cast("long")).where("run IS NOT NULL").groupBy("run").agg(
        F.count(F.lit(1)).alias("table_rows"), *[F.count_if(F.col("quarantine_reason") == r).alias(f"n{k}") for k, r in enumerate(reasons)]
    )
    pairs = F.array(*[F.struct(F.lit(r).alias("quarantine_reason"), F.col(f"n{k}").alias("row_count")) for k, r in enumerate(reasons)])
    told = counted.select("run", "table_rows", F.inline(pairs))
    return told.select(F.lit(table).alias("table_name"), "run", "quarantine_reason", "row_count", "table_rows")


def counts_of_run(tables: dict[str, DataFrame], run: int) -> DataFrame:
    return reduce(DataFrame.unionByName, [counts_per_run(rows, name, F.lit(run)) for name, rows in tables.items()])


def _median(ordered: Column) -> Column:
    """Of a sorted array, NULL for an empty one."""
    n = F.size(ordered)
    middle = (F.element_at(ordered, F.floor((n + 1) / 2).cast("int")) + F.element_at(ordered, (F.floor(n / 2) + 1).cast("int"))) / 2
    return F.when(n > 0, middle)


def judged_runs(history: DataFrame, band: Band = Band()) -> DataFrame:
    """Every run and reason with its share, the median and spread of the ``band.runs`` runs before, the limit and ``is_spike``.

    A window holds the runs of one reason, and a list of it ``band.runs`` numbers at most. Of a run that was recorded twice one record counts.
    """
    rows = history.groupBy("table_name", "quarantine_reason", "run").agg(F.max(F.struct("row_count", "table_rows")).alias("r"))
    rows = rows.select("table_name", "quarantine_reason", "run", "r.*")
    rows = rows.withColumn("per_million", F.coalesce(F.floor(F.try_divide(F.col("row_count") * PER, F.col("table_rows"))), F.lit(0)).cast("double"))
    earlier = Window.partitionBy("table_name", "quarantine_reason").orderBy("run").rowsBetween(-band.runs, -1)
    told = rows.withColumn("before", F.array_sort(F.collect_list("per_million").over(earlier)))
    told = told.withColumn("usual", _median(F.col("before")))
    told = told.withColumn("spread", _median(F.array_sort(F.transform("before", lambda x: F.abs(x - F.col("usual"))))))
    width = F.greatest(F.col("spread") * (band.deviations * 1.4826), F.col("usual") * band.rise, F.lit(band.least))
    enough = F.size("before") >= band.least_runs
    told = told.withColumns({"earlier_runs": F.size("before"), "upper": F.when(enough, F.col("usual") + width)})
    return told.select(
        "table_name", "quarantine_reason", "run", "row_count", "table_rows", "per_million", "earlier_runs", "usual", "spread", "upper",
        F.coalesce(F.col("per_million") > F.col("upper"), F.lit(False)).alias("is_spike"),
    )


def spike_results(history: DataFrame, run: int, tables: Sequence[str], band: Band = Band()) -> DataFrame:
    """One check result per table: how many reasons spike in ``run``."""
    spiking = judged_runs(history, band).where(F.col("run") == run).groupBy("table_name").agg(F.count_if("is_spike").alias("failures"))
    return spiking.where(F.col("table_name").isin(list(tables))).select(
        F.lit("quarantine").alias("layer"), "table_name", F.lit("reason_spike").alias("check_name"), F.lit("quarantine_reason").alias("column_name"),
        F.lit("warn").alias("severity"), "failures", (F.col("failures") == 0).alias("passed"),
    )


def recent(history: DataFrame, run: int, runs: int) -> DataFrame:
    """What later runs can still be judged by."""
    return history.where(F.col("run") > run - runs)
