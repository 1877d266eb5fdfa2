"""Conversion at the rate of the invoice's day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.config import BillingConfig
from ledgerline.functions.text import clean_currency
from ledgerline.operators.as_of import as_of_join


def priced_by_day(invoices: DataFrame, rates: DataFrame, config: BillingConfig, max_age_days: int | None = None) -> DataFrame:
    """Invoices with ``currency_code``, ``rate_date``, ``rate`` and ``amount_eur``.

    ``rates`` has currency, valid_from and rate, the price of one unit in the reporting currency. A rate holds from its day
    until the next one of its currency, for ``max_age_days`` at most if given. Of two rates of a day the larger one holds; one that is NULL is no rate, and the one
    before goes on. The reporting currency needs none. Without a valid rate the amount is NULL: nothing is guessed.
    """
    code = clean_currency(F.col("currency"))
    known = rates.where(F.col("rate").isNotNull()).select(code.alias("currency_code"), F.col("valid_from").alias("rate_date"), "rate")
    coded = invoices.withColumn("currency_code", code)
    priced = as_of_join(coded, known, ["currency_code"], "invoice_date", "rate_date", ["rate"])
    if max_age_days is not None:
        fresh = F.datediff("invoice_date", "rate_date") <= max_age_days
        priced = priced.withColumns({"rate": F.when(fresh, F.col("rate")), "rate_date": F.when(fresh, F.col("rate_date"))})
    own = F.col("currency_code") == config.reporting_currency
    amount = F.when(own, F.col("amount")).otherwise(F.round(F.col("amount") * F.col("rate"), 2))
    return priced.withColumns(
        {
            "rate_date": F.when(~F.coalesce(own, F.lit(False)), F.col("rate_date")),
            "rate": F.when(~F.coalesce(own, F.lit(False)), F.col("rate")),
            "amount_eur": amount.cast("decimal(14,2)"),
        }
    )


def missing_rates(priced: DataFrame) -> DataFrame:
    """Invoices with an amount and a currency but no rate, by currency and month."""
    lacking = priced.where("amount_eur IS NULL AND amount IS NOT NULL AND currency_code IS NOT NULL")
    return lacking.groupBy("currency_code", F.trunc("invoice_date", "month").alias("invoice_month")).agg(F.count(F.lit(1)).alias("invoices"), F.sum("amount").cast("decimal(18,2)").alias("amount"))
