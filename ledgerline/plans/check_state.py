"""Check results as counts per month, which add up to the results of the whole table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.config import BillingConfig
from ledgerline.functions.dates import is_after
from ledgerline.plans import checks, quarantine, staging
from ledgerline.plans.classify import is_silent_drop
from ledgerline.plans.checks import ERROR, WARN, RowCheck, Table

PLACE = ["layer", "table_name", "check_name", "column_name", "severity"]


def _counts(frame: DataFrame, part: Column, table: Table, found: list[RowCheck]) -> DataFrame:
    """Failing rows of every check and part, 0 included: one aggregate, combined before the shuffle."""
    names = [f"failures_{i}" for i in range(len(found))]
    totals = frame.groupBy(part.alias("part")).agg(*[F.expr(f"count_if({c.fails}) AS {n}") for n, c in zip(names, found, strict=True)])
    rows = [
        F.struct(*[F.lit(v).alias(k) for k, v in zip(PLACE, (*table, c.name, c.column, c.severity), strict=True)], F.col(n).alias("failures"))
        for n, c in zip(names, found, strict=True)
    ]
    return totals.select("part", F.inline(F.array(*rows)))


def invoice_check_counts(classified: DataFrame, config: BillingConfig) -> DataFrame:
    """Counts of all row checks on invoices (raw, staging, quarantine), of silent drops and of lost after-end flags.

    ``part`` is the month. Unique keys and relationships are not counts of rows of a month and are not among them.
    """
    month = F.trunc("invoice_date", "month")
    invoice = "invoices"
    staged = classified.where(staging.CONDITION).selectExpr(*staging.invoices(config))
    rejected = classified.where(quarantine.CONDITION).selectExpr(*quarantine.columns(invoice))
    late = is_after(F.col("invoice_date"), F.col("end_date")) & ~F.coalesce(F.col("is_after_end_date"), F.lit(False))
    judged = classified.withColumns({"dropped": is_silent_drop(), "unflagged": F.col("is_staged") & (F.expr("lower(trim(status))") == "paid") & late})
    own = [RowCheck(("staging", invoice), "silent_drops", "invoice_id", WARN, "dropped"), RowCheck(("staging", invoice), "after_end_flagged", "invoice_date", ERROR, "unflagged")]
    frames = [(("raw", invoice), classified), (("staging", invoice), staged), (("quarantine", invoice), rejected)]
    parts = [_counts(frame, month, table, checks.row_checks(table, config)) for table, frame in frames]
    return reduce(DataFrame.unionByName, [*parts, _counts(judged, month, ("staging", invoice), own)])


def results(counts: DataFrame) -> DataFrame:
    """One row per check over all parts."""
    summed = counts.groupBy(*PLACE).agg(F.sum("failures").alias("failures"))
    return summed.withColumn("passed", F.col("failures") == 0)
