"""Row rules of classification, staging and quarantine."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import CONFIG, billing, by_key, customer, dicts, invoice, subscription

from ledgerline.functions.money import to_reporting_currency
from ledgerline.functions.text import is_invalid_email
from ledgerline.operators.bloom import bloom_words, may_be_among
from ledgerline.plans.classify import silent_drops


@pytest.mark.parametrize(
    ("email", "invalid"),
    [
        ("a@b.c", False),
        ("first.last+tag@sub.example.com", False),
        (" a@b.c", True),
        ("a@b.c ", True),
        ("a@b.c\n", True),
        ("a\t@b.c", True),
        ("a@b", True),
        ("a@@b.c", True),
        ("a@b.c@d", True),
        ("@b.c", True),
        ("not-an-email", True),
        ("", True),
        (None, True),
    ],
)
def test_email_rule(spark, email, invalid):
    df = spark.createDataFrame([(email,)], "email string")
    assert df.select(is_invalid_email(F.col("email"))).first()[0] is invalid


@pytest.mark.parametrize(
    ("amount", "currency", "expected"),
    [
        ("29.00", "EUR", "29.00"),
        ("11.50", "SEK", "1.00"),
        ("0.05", "SEK", "0.00"),
        ("0.06", "SEK", "0.01"),
        ("-0.50", "SEK", "-0.04"),
        ("9999999999.99", "SEK", "870000000.00"),
        ("10.00", "USD", None),
        ("10.00", None, None),
        (None, "EUR", None),
    ],
)
def test_conversion(spark, amount, currency, expected):
    df = spark.createDataFrame(
        [(amount and Decimal(amount), currency)], "amount decimal(12,2), currency string"
    )
    converted = df.select(
        to_reporting_currency(F.col("amount"), F.col("currency"), CONFIG).alias("eur")
    )
    assert converted.first().eur == (expected and Decimal(expected))
    assert converted.schema["eur"].dataType.simpleString() == "decimal(14,2)"


def test_customer_cleaning_and_flags(spark):
    b = billing(
        spark,
        customers=[
            customer("C1", "  Ann ", " ann@example.com", " de ", "2024-01-01"),
            customer("C2", "   ", "bob@example.com", "  ", "2026-12-03"),
            customer("C3", "Cy", None, None, "2026-12-04"),
            customer("C4", "\tDi", "di@example.com", "FR", None),
        ],
    )
    staged = by_key(b.table("staging", "customers"), "customer_id")
    assert staged["C1"] == {
        "customer_id": "C1",
        "customer_name": "Ann",
        "email": "ann@example.com",
        "country": "DE",
        "created_at": date(2024, 1, 1),
        "is_invalid_email": True,
        "is_missing_country": False,
        "is_future_created_at": False,
        "has_quality_issue": True,
    }
    assert staged["C2"]["customer_name"] is None
    assert staged["C2"]["country"] == "UNKNOWN"
    assert staged["C2"]["is_missing_country"] and not staged["C2"]["is_future_created_at"]
    assert staged["C3"]["is_future_created_at"] and staged["C3"]["is_invalid_email"]
    assert staged["C4"]["customer_name"] == "\tDi"
    assert staged["C4"]["is_future_created_at"] is None
    assert staged["C4"]["has_quality_issue"] is None

    reasons = by_key(b.table("quarantine", "customers"), "customer_id")
    assert {k: v["quarantine_reason"] for k, v in reasons.items()} == {
        "C1": "invalid_email",
        "C2": "missing_country",
        "C3": "invalid_email",
    }
    assert reasons["C1"]["email"] == " ann@example.com"  # quarantine keeps what came
    assert reasons["C2"]["country"] == "  "


def test_future_customer_alone_is_not_quarantined(spark):
    b = billing(spark, customers=[customer(created="2999-01-01")])
    assert b.table("quarantine", "customers").count() == 0
    assert b.table("staging", "customers").first().has_quality_issue


def test_duplicates_keep_the_first_row_nulls_last(spark):
    b = billing(
        spark,
        customers=[
            customer("C1", "late", created="2024-05-01"),
            customer("C1", "early", created="2024-01-01"),
            customer("C1", "early", created="2024-01-01"),
            customer("C2", "undated", created=None),
            customer("C2", "dated", created="2025-01-01"),
            customer("C3", "no email", email=None),
            customer("C3", "email", email="z@example.com"),
            customer(None, "nobody"),
            customer(None, "also nobody"),
        ],
    )
    names = {r.customer_id: r.customer_name for r in b.table("staging", "customers").collect()}
    assert names == {"C1": "early", "C2": "dated", "C3": "email", None: "also nobody"}
    rejected = b.table("quarantine", "customers").where(
        "quarantine_reason = 'duplicate_customer_id'"
    )
    assert sorted((r.customer_id or "", r.customer_name) for r in rejected.collect()) == [
        ("", "nobody"),
        ("C1", "early"),
        ("C1", "late"),
        ("C2", "undated"),
        ("C3", "no email"),
    ]


def test_duplicate_wins_over_every_other_reason(spark):
    b = billing(
        spark,
        customers=[customer(), customer(email="broken", created="2025-01-01", country=None)],
        subscriptions=[
            subscription(start="2024-01-01"),
            subscription(customer_id="C9", price="-1.00", start="2024-02-01", end="2024-01-01"),
        ],
    )
    assert [r.quarantine_reason for r in b.table("quarantine", "customers").collect()] == [
        "duplicate_customer_id"
    ]
    assert [r.quarantine_reason for r in b.table("quarantine", "subscriptions").collect()] == [
        "duplicate_subscription_id"
    ]


def test_subscription_reasons_by_priority(spark):
    b = billing(
        spark,
        customers=[customer()],
        subscriptions=[
            subscription("S1", "C9", price="-1.00", start="2024-02-01", end="2024-01-01"),
            subscription("S2", price="0.00", start="2024-02-01", end="2024-01-01"),
            subscription("S3", start="2024-02-01", end="2024-01-01", plan=" Growth ", status="CANCELLED "),
            subscription("S4", start="2024-02-01", end="2024-02-01"),
            subscription("S5", customer_id=None),
            subscription("S6", customer_id=" C1"),
            subscription("S7", price=None),
            subscription("S8", price=None, start="2024-02-01", end="2024-01-01"),
        ],
    )
    held = by_key(b.table("quarantine", "subscriptions"), "subscription_id")
    assert {k: v["quarantine_reason"] for k, v in held.items()} == {
        "S1": "orphan_customer_id",
        "S2": "non_positive_monthly_price",
        "S3": "end_before_start",
        "S5": "orphan_customer_id",
        "S6": "orphan_customer_id",
        "S8": "end_before_start",
    }
    assert held["S3"]["status"] == "cancelled" and held["S3"]["plan_name"] == " Growth "
    staged = by_key(b.table("staging", "subscriptions"), "subscription_id")
    assert set(staged) == {"S3", "S4"}
    assert staged["S3"]["plan_name"] == "growth" and staged["S3"]["is_invalid_date_range"]
    assert not staged["S4"]["has_quality_issue"]
    dropped = silent_drops(b.table("classified", "subscriptions"))
    assert sorted(r.subscription_id for r in dropped.collect()) == ["S7", "S8"]


def test_invoice_reasons_by_priority(spark):
    b = billing(
        spark,
        customers=[customer()],
        subscriptions=[subscription(end="2024-03-31", status="cancelled")],
        invoices=[
            invoice("I1", "S9", amount=None, currency="USD"),
            invoice("I2", "S9", amount="0.00", currency="USD"),
            invoice("I3", "S9", currency="usd"),
            invoice("I4", "S9", day="2024-05-01"),
            invoice("I5", day="2024-04-01", currency=" eur ", status="PAID "),
            invoice("I6", day="2024-03-31"),
            invoice("I7", currency=None),
            invoice("I8", currency=None, day="2024-04-01"),
            invoice("I9", amount="100.00", currency="sek"),
            invoice("I10", day=None),
            invoice("I11", subscription_id=None),
        ],
    )
    held = by_key(b.table("quarantine", "invoices"), "invoice_id")
    assert {k: v["quarantine_reason"] for k, v in held.items()} == {
        "I1": "null_amount",
        "I2": "non_positive_amount",
        "I3": "unsupported_currency",
        "I4": "orphan_subscription_id",
        "I5": "invoice_after_end_date",
        "I8": "invoice_after_end_date",
        "I11": "orphan_subscription_id",
    }
    assert held["I3"]["currency"] == "USD" and held["I5"]["status"] == "paid"
    staged = by_key(b.table("staging", "invoices"), "invoice_id")
    assert set(staged) == {"I5", "I6", "I9", "I10"}
    assert staged["I9"]["amount_eur"] == Decimal("8.70")
    assert staged["I9"]["currency_original"] == "SEK"
    assert staged["I5"]["invoice_month"] == date(2024, 4, 1)
    assert staged["I5"]["is_after_end_date"] and staged["I5"]["has_quality_issue"]
    assert not staged["I6"]["is_after_end_date"]
    assert staged["I10"]["is_after_end_date"] is None
    dropped = silent_drops(b.table("classified", "invoices"))
    assert sorted(r.invoice_id for r in dropped.collect()) == ["I7", "I8"]


def test_orphans_cascade_through_rejected_parents(spark):
    b = billing(
        spark,
        customers=[customer()],
        subscriptions=[subscription("S1", "C9"), subscription("S2", price="-99.00")],
        invoices=[invoice("I1", "S1"), invoice("I2", "S2"), invoice("I3", "S2", amount="-99.00")],
    )
    held = by_key(b.table("quarantine", "invoices"), "invoice_id")
    assert {k: v["quarantine_reason"] for k, v in held.items()} == {
        "I1": "orphan_subscription_id",
        "I2": "orphan_subscription_id",
        "I3": "non_positive_amount",
    }


def test_output_columns_and_types(spark):
    b = billing(spark, [customer()], [subscription()], [invoice()])
    types = {
        (layer, name): {f.name: f.dataType.simpleString() for f in b.table(layer, name).schema}
        for layer, name in [
            ("staging", "subscriptions"),
            ("staging", "invoices"),
            ("marts", "mrr_monthly"),
            ("marts", "customer_ltv"),
            ("marts", "churn_monthly"),
        ]
    }
    assert types["staging", "subscriptions"]["monthly_price"] == "decimal(12,2)"
    assert list(types["staging", "invoices"]) == [
        "invoice_id",
        "subscription_id",
        "invoice_date",
        "invoice_month",
        "amount_original",
        "currency_original",
        "amount_eur",
        "reporting_currency",
        "status",
        "plan_name",
        "is_orphan_subscription",
        "is_invalid_amount",
        "is_after_end_date",
        "has_quality_issue",
    ]
    assert types["staging", "invoices"]["invoice_month"] == "date"
    assert types["marts", "mrr_monthly"] == {
        "invoice_month": "date",
        "plan_name": "string",
        "paid_invoice_count": "bigint",
        "mrr_eur": "decimal(18,2)",
    }
    assert types["marts", "customer_ltv"]["ltv_eur"] == "decimal(18,2)"
    assert types["marts", "churn_monthly"]["cancelled_subscriptions"] == "bigint"
    assert dicts(b.table("marts", "churn_monthly")) == []


@pytest.mark.parametrize("words", [1, 64, 1 << 18])
def test_filter_of_keys_loses_none(spark, words):
    """A filter that is too small lets more rows pass, and no fewer."""
    rows = spark.range(2000).selectExpr("IF(id % 50 = 0, NULL, concat('k', id)) AS k", "id")
    keys = rows.where("id % 7 = 0")
    passed = {r.id for r in may_be_among(rows, "k", bloom_words(keys, "k", words), words).collect()}
    wanted = {r.id for r in rows.collect() if r.id % 7 == 0 or r.k is None}
    assert wanted <= passed
    if words == 1 << 18:
        assert passed == wanted
