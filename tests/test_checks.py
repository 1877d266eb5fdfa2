"""Data-quality checks."""

import pytest
from rows import billing, customer, invoice, subscription

from ledgerline.plans import checks


def clean(spark):
    return billing(spark, [customer()], [subscription()], [invoice()])


def dirty(spark):
    return billing(
        spark,
        customers=[
            customer("C1"),
            customer("C1", created="2025-01-01"),
            customer("C2", email=None, country="XX"),
            customer(None),
            customer(None),
        ],
        subscriptions=[
            subscription("S1", end="2024-12-31"),
            subscription("S2", "C9"),
            subscription("S3", None),
            subscription("S4", start="2024-02-01", end="2024-01-01", status="cancelled"),
            subscription("S4", start="2024-03-01", end="2024-01-01", status="cancelled"),
            subscription("S5", plan="gold", status="unknown"),
            subscription("S6", price="-1.00"),
        ],
        invoices=[
            invoice("I1"),
            invoice("I1"),
            invoice("I2", amount=None),
            invoice("I3", amount="-1.00"),
            invoice("I4", "S9"),
            invoice("I4", "S9"),
            invoice("I5", amount="0.05", currency="SEK"),
            invoice("I6", day="2025-01-01"),
        ],
    )


def failures(df):
    return {
        (r.layer, r.table_name, r.check_name, r.column_name): r.failures
        for r in df.collect()
        if not r.passed
    }


def test_every_contract_has_its_number_of_checks():
    assert sum(len(c) for c in checks.NOT_NULL.values()) == 42
    assert sum(len(c) for c in checks.ACCEPTED.values()) == 10
    assert sum(len(c) for c in checks.EXPRESSIONS.values()) == 5
    assert (len(checks.UNIQUE), len(checks.UNIQUE_COMBINATION)) == (7, 2)
    assert len(checks.RELATIONSHIPS) == 4
    assert len(checks.BUSINESS_CHECKS) + 2 == 7
    warnings = [s for _, s in checks.UNIQUE.values() if s == checks.WARN]
    warnings += [s for _, _, s in checks.RELATIONSHIPS.values() if s == checks.WARN]
    warnings += [c for c in checks.BUSINESS_CHECKS if c.severity == checks.WARN]
    assert len(warnings) == 6


def test_clean_data_misses_only_the_planted_defects(spark):
    results = checks.check_summary(clean(spark))
    assert results.count() == 80
    assert failures(results) == {
        ("quarantine", "all", "planted_defects", "quarantine_reason"): 10
    }


def test_empty_tables_have_results_too(spark):
    results = checks.check_summary(billing(spark))
    assert results.count() == 80
    assert set(failures(results)) == {
        ("quarantine", "all", "planted_defects", "quarantine_reason")
    }


def test_dirty_data_fails_where_it_should(spark):
    results = checks.check_summary(dirty(spark))
    assert failures(results) == {
        ("raw", "customers", "not_null", "customer_id"): 2,
        ("raw", "customers", "not_null", "email"): 1,
        ("raw", "customers", "unique", "customer_id"): 1,
        ("raw", "subscriptions", "not_null", "customer_id"): 1,
        ("raw", "subscriptions", "unique", "subscription_id"): 1,
        ("raw", "subscriptions", "relationships", "customer_id"): 1,
        ("raw", "subscriptions", "raw_dates_sane", "end_date"): 2,
        ("raw", "invoices", "unique", "invoice_id"): 2,
        ("raw", "invoices", "relationships", "subscription_id"): 2,
        ("raw", "invoices", "raw_amounts_sane", "amount"): 2,
        ("staging", "customers", "not_null", "customer_id"): 1,
        ("staging", "customers", "not_null", "email"): 1,
        ("staging", "customers", "accepted_values", "country"): 1,
        ("staging", "subscriptions", "accepted_values", "plan_name"): 1,
        ("staging", "subscriptions", "accepted_values", "status"): 1,
        ("staging", "subscriptions", "active_without_end", "end_date"): 1,
        ("staging", "invoices", "unique", "invoice_id"): 1,
        ("staging", "invoices", "expression_is_true", "amount_eur"): 1,
        ("staging", "invoices", "paid_positive", "amount_eur"): 1,
        ("quarantine", "customers", "not_null", "customer_id"): 1,
        ("quarantine", "all", "planted_defects", "quarantine_reason"): 1,
        ("marts", "customer_ltv", "not_null", "customer_id"): 1,
    }
    missing = checks.missing_defect_classes(dirty(spark)).collect()
    assert [r.missing_quarantine_reason for r in missing] == ["missing_country"]


def test_violating_rows(spark):
    b = dirty(spark)
    keys = checks.duplicated_keys(b, ("raw", "invoices")).collect()
    assert sorted((r.invoice_id, r.row_count) for r in keys) == [("I1", 2), ("I4", 2)]
    orphans = checks.orphans(b, ("raw", "invoices")).collect()
    assert [r.subscription_id for r in orphans] == ["S9", "S9"]
    amounts = checks.business_violations(b, "raw_amounts_sane")
    assert amounts.columns == ["invoice_id", "amount", "status"]
    assert sorted(r.invoice_id for r in amounts.collect()) == ["I2", "I3"]
    stored = checks.stored_failures(b)
    assert len(stored) == 9
    assert stored["raw_dates_sane"].count() == 2


def test_a_lost_flag_is_noticed(spark):
    """The regression checks fire when staging stops flagging."""
    b = dirty(spark)
    from pyspark.sql import functions as F

    unflagged = b.table("classified", "invoices").withColumn("is_after_end_date", F.lit(False))
    late = checks.after_end_unflagged(unflagged)
    assert [r.invoice_id for r in late.collect()] == ["I6"]
    b.set_table(
        "staging",
        "subscriptions",
        b.table("staging", "subscriptions").withColumn("is_invalid_date_range", F.lit(False)),
    )
    rows = checks.business_violations(b, "dates_flagged").collect()
    assert [r.subscription_id for r in rows] == ["S4"]


@pytest.mark.parametrize("kind", ["not_null", "accepted_values", "expression_is_true"])
def test_contract_results_agree_with_the_summary(spark, kind):
    summary = failures(checks.check_summary(dirty(spark)).where(f"check_name = '{kind}'"))
    assert failures(checks.contract_results(dirty(spark), kind)) == summary
