"""Staging: accepted rows, typed and cleaned, with their flags."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerline.config import BillingConfig

# The catalog's views have the same columns, so these are SQL.
CONDITION = "is_staged"
CUSTOMERS = [
    "customer_id",
    "nullif(trim(customer_name), '') AS customer_name",
    "nullif(trim(email), '') AS email",
    "coalesce(nullif(upper(trim(country)), ''), 'UNKNOWN') AS country",
    "created_at",
    "is_invalid_email",
    "is_missing_country",
    "is_future_created_at",
    "is_invalid_email OR is_missing_country OR is_future_created_at AS has_quality_issue",
]
SUBSCRIPTIONS = [
    "subscription_id",
    "customer_id",
    "lower(trim(plan_name)) AS plan_name",
    "monthly_price",
    "start_date",
    "end_date",
    "lower(trim(status)) AS status",
    "is_orphan_customer",
    "is_invalid_price",
    "is_invalid_date_range",
    "is_orphan_customer OR is_invalid_price OR is_invalid_date_range AS has_quality_issue",
]


def invoices(config: BillingConfig) -> list[str]:
    return [
        "invoice_id",
        "subscription_id",
        "invoice_date",
        "trunc(invoice_date, 'month') AS invoice_month",
        "amount AS amount_original",
        "upper(trim(currency)) AS currency_original",
        "amount_eur",
        f"'{config.reporting_currency}' AS reporting_currency",
        "lower(trim(status)) AS status",
        "plan_name",
        "is_orphan_subscription",
        "is_invalid_amount",
        "is_after_end_date",
        "is_orphan_subscription OR is_invalid_amount OR is_after_end_date OR amount_eur IS NULL"
        " AS has_quality_issue",
    ]


def columns(name: str, config: BillingConfig) -> list[str]:
    """Columns of a staging table as SQL over the classified one."""
    return {"customers": CUSTOMERS, "subscriptions": SUBSCRIPTIONS, "invoices": invoices(config)}[name]


def stage_customers(classified: DataFrame) -> DataFrame:
    return classified.where(CONDITION).selectExpr(*CUSTOMERS)


def stage_subscriptions(classified: DataFrame) -> DataFrame:
    return classified.where(CONDITION).selectExpr(*SUBSCRIPTIONS)


def stage_invoices(classified: DataFrame, config: BillingConfig) -> DataFrame:
    return classified.where(CONDITION).selectExpr(*invoices(config))
