"""Column comments of the raw, staging and quarantine tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAW = {
    "customers": {
        "customer_id": "Customer as exported; may come several times",
        "customer_name": "Name as exported",
        "email": "Address as exported, not checked",
        "country": "Country code as exported; may be missing or padded",
        "created_at": "Day the customer was created; may lie in the future",
    },
    "subscriptions": {
        "subscription_id": "Subscription as exported; may come several times",
        "customer_id": "Its customer, who may be unknown",
        "plan_name": "Plan as exported",
        "monthly_price": "List price of a month; may be zero or less",
        "start_date": "First day",
        "end_date": "Last day, NULL while it runs; may be before the start",
        "status": "Status in any spelling",
    },
    "invoices": {
        "invoice_id": "Invoice as exported",
        "subscription_id": "Its subscription, which may be unknown",
        "invoice_date": "Day of the invoice",
        "amount": "Amount in the invoice's currency; may be missing, zero or less",
        "currency": "Currency code in any spelling",
        "status": "Status in any spelling",
    },
}

STAGING = {
    "customers": {
        "customer_id": "Customer, one row each",
        "customer_name": "Trimmed name",
        "email": "Trimmed address, bad ones included",
        "country": "Upper-case code, UNKNOWN when missing",
        "created_at": "Day the customer was created",
        "is_invalid_email": "Address missing or malformed",
        "is_missing_country": "No country was exported",
        "is_future_created_at": "Created after the reporting day",
        "has_quality_issue": "Any of the flags",
    },
    "subscriptions": {
        "subscription_id": "Subscription, one row each",
        "customer_id": "A staged customer",
        "plan_name": "Lower-case plan",
        "monthly_price": "List price of a month, above zero",
        "start_date": "First day",
        "end_date": "Last day, NULL while it runs",
        "status": "active, cancelled or paused",
        "is_orphan_customer": "Customer unknown; never true here",
        "is_invalid_price": "Price of zero or less; never true here",
        "is_invalid_date_range": "Ends before it starts",
        "has_quality_issue": "Any of the flags",
    },
    "invoices": {
        "invoice_id": "Invoice",
        "subscription_id": "A staged subscription",
        "invoice_date": "Day of the invoice",
        "invoice_month": "First day of its month",
        "amount_original": "Amount in the invoice's currency",
        "currency_original": "Upper-case currency code",
        "amount_eur": "Amount in the reporting currency",
        "reporting_currency": "Currency of amount_eur",
        "status": "paid, failed or open",
        "plan_name": "Plan of the subscription",
        "is_orphan_subscription": "Subscription unknown; never true here",
        "is_invalid_amount": "Amount missing, zero or less; never true here",
        "is_after_end_date": "Dated after the end of the subscription",
        "has_quality_issue": "Any of the flags, or no amount in the reporting currency",
    },
}

REASON = "First rule that the row breaks; some rules only report, and the row is staged as well"
QUARANTINE = {name: {**columns, "quarantine_reason": REASON} for name, columns in RAW.items()}


def described(rows: DataFrame, comments: dict[str, str]) -> DataFrame:
    """The rows with comments on their columns, which travel with the table."""
    return rows.select(*[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c) for c in rows.columns])


def view_columns(names: list[str], comments: dict[str, str]) -> str:
    """Column list of a view, with the comments."""
    quoted = {c: comments[c].replace("'", "\\'") for c in names}
    return ", ".join(f"{c} COMMENT '{quoted[c]}'" for c in names)
