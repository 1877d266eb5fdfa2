"""Conversion to the reporting currency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.config import BillingConfig
from ledgerline.schemas import MONEY


def to_reporting_currency(amount: Column, currency: Column, config: BillingConfig) -> Column:
    """Amount in the reporting currency, rounded half away from zero; NULL if there is no rate.

    The few configured rates become branches of one CASE inside the generated code, so that no
    join is needed.
    """
    converted = F.when(currency == config.reporting_currency, amount.cast(MONEY))
    for code, rate in config.fx_rates.items():
        converted = converted.when(currency == code, F.round(amount * F.lit(rate), 2))
    return converted.cast("decimal(14,2)")
