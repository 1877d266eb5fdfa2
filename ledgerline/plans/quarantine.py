"""Quarantine: rejected and suspect rows, close to their raw form, with one reason each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import RAW

CONDITION = "quarantine_reason IS NOT NULL"

# Cleaned in quarantine; every other column, the plan name too, stays as it came.
CLEANED = {
    "customers": {},
    "subscriptions": {"status": "lower(trim(status)) AS status"},
    "invoices": {
        "currency": "upper(trim(currency)) AS currency",
        "status": "lower(trim(status)) AS status",
    },
}


def columns(name: str) -> list[str]:
    """Columns of a quarantine table as SQL over the classified one."""
    return [*[CLEANED[name].get(c, c) for c in RAW[name].names], "quarantine_reason"]


def quarantine(name: str, classified: DataFrame) -> DataFrame:
    return classified.where(CONDITION).selectExpr(*columns(name))


def reason_counts(quarantined: DataFrame) -> DataFrame:
    """Rows per reason, counted before the shuffle."""
    return quarantined.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("row_count"))
