"""Marts, profiles and the exact median."""

import statistics
from datetime import date
from decimal import Decimal

import pytest
from rows import billing, by_key, customer, dicts, invoice, subscription

from ledgerline.operators.median import exact_median
from ledgerline.plans import profiles
from ledgerline.plans.marts import customer_status


def small(spark):
    return billing(
        spark,
        customers=[customer("C1"), customer("C2", country=None), customer("C3")],
        subscriptions=[
            subscription("S1", "C1", "scale", "299.00"),
            subscription("S2", "C1", "Starter", "29.00", end="2024-03-31", status="Cancelled"),
            subscription("S3", "C2", "growth", "99.00", status="paused"),
            subscription("S4", "C2", "growth", "99.00", "2024-05-02", "2024-05-01", "cancelled"),
        ],
        invoices=[
            invoice("I1", "S1", "2024-02-01", "299.00"),
            invoice("I2", "S1", "2024-02-29", "299.00", status="failed"),
            invoice("I3", "S2", "2024-02-10", "29.00", status=" PAID"),
            invoice("I4", "S2", "2024-04-10", "29.00"),
            invoice("I5", "S1", "2024-03-01", "1000.00", "SEK"),
            invoice("I6", "S3", "2024-03-01", "99.00", status="open"),
        ],
    )


def test_mrr_counts_paid_cash_before_the_end(spark):
    rows = {
        (r.invoice_month, r.plan_name): (r.paid_invoice_count, r.mrr_eur)
        for r in small(spark).table("marts", "mrr_monthly").collect()
    }
    assert rows == {
        (date(2024, 2, 1), "scale"): (1, Decimal("299.00")),
        (date(2024, 2, 1), "starter"): (1, Decimal("29.00")),
        (date(2024, 3, 1), "scale"): (1, Decimal("87.00")),
    }


def test_ltv_keeps_customers_without_revenue(spark):
    rows = by_key(small(spark).table("marts", "customer_ltv"), "customer_id")
    assert rows["C1"] == {
        "customer_id": "C1",
        "customer_name": "Ann",
        "country": "DE",
        "ltv_eur": Decimal("415.00"),
        "paid_invoice_count": 3,
        "plan_mix": "scale, starter",
        "subscription_statuses": "active, cancelled",
        "has_active_subscription": True,
    }
    assert rows["C2"]["ltv_eur"] == 0 and rows["C2"]["paid_invoice_count"] == 0
    assert rows["C2"]["plan_mix"] is None
    assert rows["C2"]["subscription_statuses"] == "cancelled, paused"
    assert rows["C2"]["has_active_subscription"] is False
    assert rows["C2"]["country"] == "UNKNOWN"
    assert rows["C3"]["subscription_statuses"] is None
    assert rows["C3"]["has_active_subscription"] is False


def test_mrr_and_ltv_add_up(spark):
    b = small(spark)
    mrr = b.table("marts", "mrr_monthly").groupBy().sum("mrr_eur").first()[0]
    assert mrr == b.table("marts", "customer_ltv").groupBy().sum("ltv_eur").first()[0]


def test_churn_uses_list_price_and_skips_inverted_ranges(spark):
    assert dicts(small(spark).table("marts", "churn_monthly")) == [
        {
            "churn_month": date(2024, 3, 1),
            "cancelled_subscriptions": 1,
            "mrr_lost_eur": Decimal("29.00"),
        }
    ]


def test_unknown_status_stays_unknown(spark):
    rows = spark.createDataFrame(
        [("C1", None), ("C2", None), ("C2", "active")], "customer_id string, status string"
    )
    found = by_key(customer_status(rows), "customer_id")
    assert found["C1"]["subscription_statuses"] is None
    assert found["C1"]["has_active_subscription"] is None
    assert found["C2"]["subscription_statuses"] == "active"
    assert found["C2"]["has_active_subscription"] is True


@pytest.mark.parametrize(
    "values",
    [
        ["5.00"],
        ["1.00", "2.01"],
        ["0.00", "0.00", "0.00", "7.77"],
        ["90071992547409.93"] * 3,
        ["9007199254740993.01"] * 3,
        ["-90071992547409.93", "-0.01", "-12345678.91", "3.00"],
        ["3.10", "1.00", "2.00", None, "9999999999999999.99"],
        [str(i * i % 997) + ".37" for i in range(500)],
        [None],
    ],
)
def test_exact_median(spark, values):
    numbers = [v and Decimal(v) for v in values]
    df = spark.createDataFrame([(v,) for v in numbers], "v decimal(18,2)")
    known = [v for v in numbers if v is not None]
    assert exact_median(df, "v") == (statistics.median(known) if known else None)


def test_profiles(spark):
    b = small(spark)
    assert by_key(profiles.grain(b), "table_name")["subscriptions"]["distinct_keys"] == 4
    staged = b.table("staging", "subscriptions")
    assert by_key(profiles.multi_subscription(staged), "customer_id")["C1"]["active_count"] == 1
    idle = profiles.subscriptions_without_invoices(staged, b.table("raw", "invoices"))
    assert [r.subscription_id for r in idle.collect()] == ["S4"]
    odd = profiles.price_mismatch(b.table("raw", "invoices"), staged)
    assert [r.invoice_id for r in odd.collect()] == ["I5"]
    shares = {
        (r.table_name, r.status): r.share for r in profiles.status_share(b).collect()
    }
    assert shares["invoices", "paid"] == 4 / 6 and shares["subscriptions", "cancelled"] == 0.5
    plans = by_key(profiles.revenue_share_by_plan(b.table("classified", "invoices")), "plan_name")
    assert plans["scale"]["share"] == pytest.approx(386 / 415)
    top = profiles.top_countries(b.table("marts", "customer_ltv"), 1).collect()
    assert [(r.country, r.customers) for r in top] == [("DE", 2)]
    spread = profiles.ltv_distribution(b.table("marts", "customer_ltv")).first()
    assert (spread.min_ltv_eur, spread.median_ltv_eur, spread.max_ltv_eur) == (0, 0, 415)
