"""Profiling queries over the raw and staged tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import as_of
from ledgerline.functions.text import clean_label
from ledgerline.operators.lineage import cut_lineage
from ledgerline.operators.median import exact_median
from ledgerline.operators.parents import with_parent, without_parent
from ledgerline.plans.billing import Billing
from ledgerline.plans.marts import paid_invoices
from ledgerline.schemas import MART_MONEY


def _count() -> Column:
    return F.count(F.lit(1))


def grain(billing: Billing) -> DataFrame:
    """Rows and distinct keys per table; keys are counted first, so no key gathers its rows."""
    keys = {
        "customers": "customer_id",
        "subscriptions": "subscription_id",
        "invoices": "invoice_id",
    }
    parts = [
        billing.table("raw", table)
        .groupBy(key)
        .agg(_count().alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("row_count"),
            F.count(key).alias("distinct_keys"),
        )
        .select(F.lit(table).alias("table_name"), "row_count", "distinct_keys")
        for table, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def multi_subscription(subscriptions: DataFrame) -> DataFrame:
    """Customers with several staged subscriptions, and how many of them are active."""
    return (
        subscriptions.groupBy("customer_id")
        .agg(
            _count().alias("subscription_count"),
            F.count_if(F.col("status") == "active").alias("active_count"),
        )
        .where("subscription_count > 1")
    )


def subscriptions_without_invoices(subscriptions: DataFrame, raw_invoices: DataFrame) -> DataFrame:
    return without_parent(subscriptions, raw_invoices, "subscription_id").select(
        "subscription_id", "plan_name", "start_date"
    )


def duplicate_billing(raw_invoices: DataFrame) -> DataFrame:
    """Subscriptions billed more than once on a day."""
    return (
        raw_invoices.groupBy("subscription_id", "invoice_date")
        .agg(_count().alias("invoice_count"))
        .where("invoice_count > 1")
    )


def price_mismatch(raw_invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Invoices whose amount is not the list price of their staged subscription."""
    return (
        with_parent(
            raw_invoices.select("invoice_id", "subscription_id", "amount"),
            subscriptions,
            "subscription_id",
            ["monthly_price"],
        )
        .where(~F.col("amount").eqNullSafe(F.col("monthly_price")))
        .select("invoice_id", "subscription_id", "amount", "monthly_price")
    )


def status_share(billing: Billing) -> DataFrame:
    """Share of each cleaned status per table; the total is a scalar, not a window over all."""
    parts = []
    for table in ("subscriptions", "invoices"):
        frame = billing.table("raw", table)
        total = frame.agg(_count().cast("double")).scalar()
        parts.append(
            frame.groupBy(clean_label(F.col("status")).alias("status"))
            .agg(_count().alias("row_count"))
            .select(
                F.lit(table).alias("table_name"),
                "status",
                "row_count",
                (F.col("row_count").cast("double") / total).alias("share"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def revenue_share_by_plan(classified_invoices: DataFrame) -> DataFrame:
    per_plan = (
        paid_invoices(classified_invoices)
        .groupBy("plan_name")
        .agg(
            _count().alias("paid_invoice_count"),
            F.sum("amount_eur").cast(MART_MONEY).alias("revenue_eur"),
        )
    )
    # The total reads both columns, so that it is the same shuffle as the groups and runs once.
    total = (
        per_plan.agg(F.struct(F.sum("revenue_eur"), F.sum("paid_invoice_count")).alias("sums"))
        .select(F.when(F.col("sums.col2") > 0, F.col("sums.col1").cast(MART_MONEY).cast("double")))
        .scalar()
    )
    return per_plan.withColumn("share", F.col("revenue_eur").cast("double") / total)


def top_countries(customer_ltv: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` countries with the highest revenue."""
    return (
        customer_ltv.groupBy("country")
        .agg(F.sum("ltv_eur").cast(MART_MONEY).alias("revenue_eur"), _count().alias("customers"))
        .orderBy(F.desc("revenue_eur"), "country")
        .limit(n)
    )


def ltv_distribution(customer_ltv: DataFrame) -> DataFrame:
    """Minimum, exact median and maximum of the lifetime value."""
    values = cut_lineage(customer_ltv.select("ltv_eur"))
    median = exact_median(values, "ltv_eur")
    return values.agg(
        _count().alias("customers"),
        F.min("ltv_eur").alias("min_ltv_eur"),
        F.lit(median).cast("decimal(18,3)").alias("median_ltv_eur"),
        F.max("ltv_eur").alias("max_ltv_eur"),
    )


def active_book_by_plan(subscriptions: DataFrame) -> DataFrame:
    """List price of the active subscriptions per plan."""
    return (
        subscriptions.where(F.col("status") == "active")
        .groupBy("plan_name")
        .agg(
            _count().alias("active_subscriptions"),
            F.sum("monthly_price").cast(MART_MONEY).alias("list_price_eur"),
        )
    )


def domains(billing: Billing) -> DataFrame:
    """Distinct values of the coded columns as they came, with their number of rows.

    Each table is read once: every row yields one pair per column, which are counted before
    the shuffle.
    """
    pairs = {
        "customers": {"country": F.col("country")},
        "subscriptions": {
            "plan_name, monthly_price": F.concat_ws(
                " @ ", "plan_name", F.col("monthly_price").cast("string")
            ),
            "status": F.col("status"),
        },
        "invoices": {"currency": F.col("currency"), "status": F.col("status")},
    }
    parts = [
        billing.table("raw", table)
        .select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(name).alias("column_name"), value.alias("value"))
                        for name, value in columns.items()
                    ]
                )
            )
        )
        .groupBy("column_name", "value")
        .agg(_count().alias("row_count"))
        .select(F.lit(table).alias("table_name"), "column_name", "value", "row_count")
        for table, columns in pairs.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def future_dates(billing: Billing) -> DataFrame:
    """Customers created, and subscriptions cancelled, after the reporting day."""
    today = as_of(billing.config)
    created = billing.table("staging", "customers").where(F.col("created_at") > today).select(
        F.lit("customer_created").alias("event"),
        F.col("customer_id").alias("entity_id"),
        F.col("created_at").alias("event_date"),
    )
    cancelled = billing.table("staging", "subscriptions").where(
        (F.col("status") == "cancelled") & (F.col("end_date") > today)
    ).select(
        F.lit("subscription_cancelled").alias("event"),
        F.col("subscription_id").alias("entity_id"),
        F.col("end_date").alias("event_date"),
    )
    return created.unionByName(cancelled)
