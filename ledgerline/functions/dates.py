"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.config import BillingConfig


def month_of(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "month")


def as_of(config: BillingConfig) -> Column:
    return F.current_date() if config.as_of is None else F.lit(config.as_of)


def is_after(day: Column, limit: Column) -> Column:
    """True when ``day`` is strictly after a known ``limit``; an open limit is never passed."""
    return limit.isNotNull() & (day > limit)
