"""Classify every raw row once; staging and quarantine are two filters over the result.

A classified frame holds the raw columns, the flags, ``quarantine_reason`` (NULL if there is
none) and ``is_staged``. Judged frames are the same without the duplicates, which are never
staged. A filter on ``is_staged`` lets Spark turn the left join to the parent into an inner
one, so that staging does not pay for quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.config import BillingConfig
from ledgerline.functions.dates import as_of, is_after
from ledgerline.functions.money import to_reporting_currency
from ledgerline.functions.text import clean_currency, is_blank, is_invalid_email
from ledgerline.operators.dedupe import first_per_key, rows_after_first
from ledgerline.operators.parents import PARENT_KEY, attach_parent
from ledgerline.operators.rules import Rule, first_reason, is_accepted

# Order in which the first row of a key is chosen.
CUSTOMER_ORDER = ["created_at", "email"]
SUBSCRIPTION_ORDER = ["start_date", "status"]


# Whether a defect keeps a row out of staging; the others are only reported.
REJECTS = {
    "invalid_email": False,
    "missing_country": False,
    "orphan_customer_id": True,
    "non_positive_monthly_price": True,
    "end_before_start": False,
    "null_amount": True,
    "non_positive_amount": True,
    "unsupported_currency": True,
    "orphan_subscription_id": True,
    "invoice_after_end_date": False,
}


def _rule(reason: str, applies: Column) -> Rule:
    return Rule(reason, applies, REJECTS[reason])


def first_customers(raw: DataFrame) -> DataFrame:
    return first_per_key(raw, "customer_id", CUSTOMER_ORDER)


def first_subscriptions(raw: DataFrame) -> DataFrame:
    return first_per_key(raw, "subscription_id", SUBSCRIPTION_ORDER)


def repeated_customers(raw: DataFrame) -> DataFrame:
    return rows_after_first(raw, "customer_id", CUSTOMER_ORDER)


def repeated_subscriptions(raw: DataFrame) -> DataFrame:
    return rows_after_first(raw, "subscription_id", SUBSCRIPTION_ORDER)


def _with_copies(judged: DataFrame, copies: DataFrame, reason: str) -> DataFrame:
    """Judged rows plus the rows that lost the dedupe, whose reason is settled and whose flags
    stay unknown."""
    rejected = copies.withColumns(
        {"quarantine_reason": F.lit(reason), "is_staged": F.lit(False)}
    )
    return judged.unionByName(rejected, allowMissingColumns=True)


def judge_customers(raw: DataFrame, config: BillingConfig) -> DataFrame:
    """First row of every customer, with its verdict."""
    flagged = first_customers(raw).withColumns(
        {
            "is_invalid_email": is_invalid_email(F.col("email")),
            "is_missing_country": is_blank(F.col("country")),
            "is_future_created_at": F.col("created_at") > as_of(config),
        }
    )
    # Both rules only report: a customer with a bad address still has revenue.
    rules = [
        _rule("invalid_email", F.col("is_invalid_email")),
        _rule("missing_country", F.col("is_missing_country")),
    ]
    return flagged.withColumns(
        {"quarantine_reason": first_reason(rules), "is_staged": F.lit(True)}
    )


def judge_subscriptions(raw: DataFrame, customers: DataFrame) -> DataFrame:
    """First row of every subscription, with its verdict. ``customers`` are the staged ones;
    only their keys are read."""
    price, start, end = F.col("monthly_price"), F.col("start_date"), F.col("end_date")
    flagged = (
        attach_parent(first_subscriptions(raw), customers, "customer_id")
        .withColumns(
            {
                "is_orphan_customer": F.col(PARENT_KEY).isNull(),
                "is_invalid_price": price <= 0,
                "is_invalid_date_range": start.isNotNull() & is_after(start, end),
            }
        )
        .drop(PARENT_KEY)
    )
    rules = [
        _rule("orphan_customer_id", F.col("is_orphan_customer")),
        _rule("non_positive_monthly_price", F.col("is_invalid_price")),
        _rule("end_before_start", F.col("is_invalid_date_range")),
    ]
    return flagged.withColumns(
        {"quarantine_reason": first_reason(rules), "is_staged": is_accepted(rules)}
    )


def classify_customers(raw: DataFrame, config: BillingConfig) -> DataFrame:
    return _with_copies(
        judge_customers(raw, config), repeated_customers(raw), "duplicate_customer_id"
    )


def classify_subscriptions(raw: DataFrame, customers: DataFrame) -> DataFrame:
    return _with_copies(
        judge_subscriptions(raw, customers),
        repeated_subscriptions(raw),
        "duplicate_subscription_id",
    )


def classify_invoices(
    raw: DataFrame, subscriptions: DataFrame, config: BillingConfig
) -> DataFrame:
    """``subscriptions`` are the staged ones. Adds their customer, plan and end date, so that
    the marts need no second join, and the amount in the reporting currency. Invoices are not
    deduplicated."""
    amount, currency = F.col("amount"), clean_currency(F.col("currency"))
    matched = (
        attach_parent(
            raw, subscriptions, "subscription_id", ["customer_id", "plan_name", "end_date"]
        )
        .withColumns(
            {
                "amount_eur": to_reporting_currency(amount, currency, config),
                "is_orphan_subscription": F.col(PARENT_KEY).isNull(),
                "is_invalid_amount": amount.isNull() | (amount <= 0),
                "is_after_end_date": is_after(F.col("invoice_date"), F.col("end_date")),
            }
        )
        .drop(PARENT_KEY)
    )
    # Amount and currency come before the orphan test: the invoices of a rejected subscription
    # would otherwise all be called orphans.
    rules = [
        _rule("null_amount", amount.isNull()),
        _rule("non_positive_amount", amount <= 0),
        _rule("unsupported_currency", ~currency.isin(config.supported_currencies)),
        _rule("orphan_subscription_id", F.col("is_orphan_subscription")),
        _rule("invoice_after_end_date", F.col("is_after_end_date")),
    ]
    return matched.withColumns(
        {"quarantine_reason": first_reason(rules), "is_staged": is_accepted(rules)}
    )


def is_silent_drop() -> Column:
    """Neither staged nor quarantined for a rejecting reason.

    Such rows come from a NULL where the raw contract promises a value: the rules cannot decide,
    so the row is not staged, and no rejecting reason names it.
    """
    soft = [name for name, rejects in REJECTS.items() if not rejects]
    reason = F.col("quarantine_reason")
    return ~F.coalesce(F.col("is_staged"), F.lit(False)) & (reason.isNull() | reason.isin(soft))


def silent_drops(classified: DataFrame) -> DataFrame:
    return classified.where(is_silent_drop())
