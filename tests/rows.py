"""Small raw tables for the tests."""

from datetime import date
from decimal import Decimal

from pyspark.sql import types as T

from ledgerline.config import BillingConfig
from ledgerline.plans.billing import Billing
from ledgerline.schemas import RAW

CONFIG = BillingConfig(as_of=date(2026, 12, 3))


def customer(customer_id="C1", name="Ann", email="ann@example.com", country="DE", created="2024-01-01"):
    return (customer_id, name, email, country, created and date.fromisoformat(created))


def subscription(
    subscription_id="S1",
    customer_id="C1",
    plan="starter",
    price="29.00",
    start="2024-01-01",
    end=None,
    status="active",
):
    return (
        subscription_id,
        customer_id,
        plan,
        price and Decimal(price),
        start and date.fromisoformat(start),
        end and date.fromisoformat(end),
        status,
    )


def invoice(
    invoice_id="I1",
    subscription_id="S1",
    day="2024-02-15",
    amount="29.00",
    currency="EUR",
    status="paid",
):
    return (
        invoice_id,
        subscription_id,
        day and date.fromisoformat(day),
        amount and Decimal(amount),
        currency,
        status,
    )


def raw_table(spark, name, rows):
    """Rows may break the contract of the raw layer, so nothing is declared NOT NULL."""
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in RAW[name].fields])
    return spark.createDataFrame(rows, loose)


def billing(spark, customers=(), subscriptions=(), invoices=(), config=CONFIG):
    rows = {"customers": customers, "subscriptions": subscriptions, "invoices": invoices}
    return Billing(lambda name: raw_table(spark, name, list(rows[name])), config)


def dicts(df):
    return [row.asDict() for row in df.collect()]


def by_key(df, key):
    return {row[key]: row.asDict() for row in df.collect()}
