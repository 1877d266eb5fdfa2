"""Marts: monthly recurring revenue, customer lifetime value and churn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import month_of
from ledgerline.functions.text import clean_label
from ledgerline.plans import descriptions
from ledgerline.schemas import MART_MONEY


# Column comments of the published tables.
DESCRIPTIONS: dict[str, dict[str, str]] = {
    "mrr_monthly": {
        "invoice_month": "First day of the month of the invoices",
        "plan_name": "Plan of the subscription billed",
        "paid_invoice_count": "Paid invoices in mrr_eur",
        "mrr_eur": "Cash paid for the month and plan, in the reporting currency",
    },
    "customer_ltv": {
        "customer_id": "Customer, one row each",
        "customer_name": "Name as exported, trimmed",
        "country": "Country code, UNKNOWN when missing",
        "ltv_eur": "Cash paid to date in the reporting currency, 0 when none",
        "paid_invoice_count": "Paid invoices in ltv_eur",
        "plan_mix": "Plans paid for, sorted; NULL when none",
        "subscription_statuses": "Statuses of all staged subscriptions, sorted; NULL when none",
        "has_active_subscription": "Whether any staged subscription is active",
    },
    "churn_monthly": {
        "churn_month": "First day of the month the subscriptions ended",
        "cancelled_subscriptions": "Cancelled subscriptions, future end dates included",
        "mrr_lost_eur": "Sum of their list prices, which are assumed to be in the reporting currency",
    },
}


def described(mart: str, rows: DataFrame) -> DataFrame:
    """The mart with its column comments, which travel with the table."""
    return descriptions.described(rows, DESCRIPTIONS[mart])


def paid_invoices(classified_invoices: DataFrame) -> DataFrame:
    """Staged invoices that were paid and not billed after the subscription ended."""
    return classified_invoices.where(
        F.col("is_staged")
        & (clean_label(F.col("status")) == "paid")
        & ~F.coalesce(F.col("is_after_end_date"), F.lit(False))
    ).select(
        "customer_id",
        "plan_name",
        month_of(F.col("invoice_date")).alias("invoice_month"),
        "amount_eur",
    )


def mrr_monthly(classified_invoices: DataFrame) -> DataFrame:
    """Cash collected per month and plan."""
    return (
        paid_invoices(classified_invoices)
        .groupBy("invoice_month", "plan_name")
        .agg(
            F.count(F.lit(1)).alias("paid_invoice_count"),
            F.sum("amount_eur").cast(MART_MONEY).alias("mrr_eur"),
        )
    )


def _joined(values: Column) -> Column:
    """Comma-separated sorted values, NULL when there are none."""
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), ", "))


def customer_revenue(classified_invoices: DataFrame) -> DataFrame:
    """Revenue, paid invoices and plans per customer.

    Summed per customer and plan first: that step is a plain hash aggregate which combines the
    invoices on the map side, and the lists are then built from a few rows per customer.
    """
    per_plan = (
        paid_invoices(classified_invoices)
        .groupBy("customer_id", "plan_name")
        .agg(F.sum("amount_eur").alias("amount"), F.count(F.lit(1)).alias("invoices"))
    )
    return revenue_of_plans(per_plan)


def revenue_of_plans(per_plan: DataFrame) -> DataFrame:
    """Revenue per customer from one row per customer and plan."""
    return per_plan.groupBy("customer_id").agg(
        F.sum("amount").cast(MART_MONEY).alias("ltv_eur"),
        F.sum("invoices").alias("paid_invoice_count"),
        _joined(F.collect_list("plan_name")).alias("plan_mix"),
    )


def customer_status(subscriptions: DataFrame) -> DataFrame:
    """Statuses over all staged subscriptions of a customer, paid for or not."""
    per_status = subscriptions.select("customer_id", "status").distinct()
    return per_status.groupBy("customer_id").agg(
        _joined(F.collect_list("status")).alias("subscription_statuses"),
        F.bool_or(F.col("status") == "active").alias("has_active_subscription"),
    )


def customer_ltv(
    customers: DataFrame, subscriptions: DataFrame, classified_invoices: DataFrame
) -> DataFrame:
    """One row per staged customer, with zero revenue where nothing was paid.

    All three sides have one row per customer and share a partitioning; no join shuffles again.
    """
    return ltv_of(customers, subscriptions, customer_revenue(classified_invoices))


def ltv_of(customers: DataFrame, subscriptions: DataFrame, revenue: DataFrame) -> DataFrame:
    """``revenue`` has one row per customer."""
    status = customer_status(subscriptions)
    return (
        customers.select("customer_id", "customer_name", "country")
        .join(revenue, "customer_id", "left")
        .join(status, "customer_id", "left")
        .select(
            "customer_id",
            "customer_name",
            "country",
            F.coalesce("ltv_eur", F.lit(0).cast(MART_MONEY)).alias("ltv_eur"),
            F.coalesce("paid_invoice_count", F.lit(0).cast("long")).alias("paid_invoice_count"),
            "plan_mix",
            "subscription_statuses",
            F.coalesce("has_active_subscription", F.lit(False)).alias("has_active_subscription"),
        )
    )


def churn_monthly(subscriptions: DataFrame) -> DataFrame:
    """Cancellations per end month, at list price; prices are taken as reporting currency."""
    return (
        subscriptions.where(
            (F.col("status") == "cancelled")
            & F.col("end_date").isNotNull()
            & ~F.col("is_invalid_date_range")
            & (F.col("monthly_price") > 0)
        )
        .groupBy(month_of(F.col("end_date")).alias("churn_month"))
        .agg(
            F.count(F.lit(1)).alias("cancelled_subscriptions"),
            F.sum("monthly_price").cast(MART_MONEY).alias("mrr_lost_eur"),
        )
    )
