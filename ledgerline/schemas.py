"""Column types of the raw layer and the value domains of the cleaned layers."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
MART_MONEY = T.DecimalType(18, 2)


def _schema(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in columns])


RAW_CUSTOMERS = _schema(
    ("customer_id", T.StringType(), False),
    ("customer_name", T.StringType(), False),
    ("email", T.StringType(), False),
    ("country", T.StringType(), True),
    ("created_at", T.DateType(), False),
)

RAW_SUBSCRIPTIONS = _schema(
    ("subscription_id", T.StringType(), False),
    ("customer_id", T.StringType(), False),
    ("plan_name", T.StringType(), False),
    ("monthly_price", MONEY, False),
    ("start_date", T.DateType(), False),
    ("end_date", T.DateType(), True),
    ("status", T.StringType(), False),
)

RAW_INVOICES = _schema(
    ("invoice_id", T.StringType(), False),
    ("subscription_id", T.StringType(), False),
    ("invoice_date", T.DateType(), False),
    ("amount", MONEY, True),
    ("currency", T.StringType(), False),
    ("status", T.StringType(), False),
)

RAW = {
    "customers": RAW_CUSTOMERS,
    "subscriptions": RAW_SUBSCRIPTIONS,
    "invoices": RAW_INVOICES,
}

# The domains of the cleaned columns and the quarantine reasons.
COUNTRIES = ["DE", "NL", "FR", "ES", "SE", "IT", "NO", "PT", "FI", "PL", "UNKNOWN"]
PLANS = ["starter", "growth", "scale"]
SUBSCRIPTION_STATUSES = ["active", "cancelled", "paused"]
INVOICE_STATUSES = ["paid", "failed", "open"]
CUSTOMER_REASONS = ["duplicate_customer_id", "invalid_email", "missing_country", "other"]
SUBSCRIPTION_REASONS = [
    "duplicate_subscription_id",
    "orphan_customer_id",
    "non_positive_monthly_price",
    "end_before_start",
    "other",
]
INVOICE_REASONS = [
    "orphan_subscription_id",
    "null_amount",
    "non_positive_amount",
    "unsupported_currency",
    "invoice_after_end_date",
    "other",
]
