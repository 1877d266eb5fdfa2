"""The whole refresh, and refreshes on arrival."""

from decimal import Decimal

import pytest
from rows import CONFIG, customer, invoice, raw_table, subscription

from ledgerline.plans import pipeline
from ledgerline.plans.pipeline import ChecksFailed, LoadMismatch, run_pipeline
from ledgerline.streaming.refresh import refresh_on_arrival

# Every defect class, and nothing that fails a check of severity "error".
ROWS = {
    "customers": [
        customer("C1"),
        customer("C1"),
        customer("C2", email="not-an-email"),
        customer("C3", country=None, created="2999-01-01"),
    ],
    "subscriptions": [
        subscription("S1"),
        subscription("S1"),
        subscription("S2", "C9"),
        subscription("S3", "C2", price="-99.00", status="cancelled", end="2024-03-01"),
        subscription("S4", "C3", start="2024-05-02", end="2024-05-01", status="cancelled"),
        subscription("S5", "C2", "growth", "99.00", status="CANCELLED", end="2024-04-30"),
    ],
    "invoices": [
        invoice("I1", "S1"),
        invoice("I2", "S1", amount=None),
        invoice("I3", "S3", amount="-99.00"),
        invoice("I4", "S9"),
        invoice("I5", "S4", day="2024-06-01"),
        invoice("I6", "S5", amount="99.00", status="PAID "),
        invoice("I7", "S5", amount="99.00", currency="SEK"),
        invoice("I8", "S5", amount="99.00", currency="USD"),
    ],
}


def source_of(spark, rows):
    return lambda name: raw_table(spark, name, rows[name])


def test_full_run_and_second_refresh(spark, tmp_path):
    results = run_pipeline(spark, source_of(spark, ROWS), str(tmp_path), CONFIG)
    assert len(results) == 83
    assert all(r.passed or r.severity == "warn" for r in results)
    assert sum(not r.passed for r in results) == 6
    assert {r.mrr_eur for r in spark.table("marts.mrr_monthly").collect()} == {
        Decimal("29.00"),
        Decimal("107.61"),
    }
    assert spark.table("marts.customer_ltv").count() == 3
    assert spark.table("marts.churn_monthly").first().mrr_lost_eur == Decimal("99.00")
    comments = {c.name: c.description for c in spark.catalog.listColumns("marts.churn_monthly")}
    assert "list prices" in comments["mrr_lost_eur"]
    for layer in ("raw", "staging", "quarantine"):
        for name in ROWS:
            assert all(c.description for c in spark.catalog.listColumns(f"{layer}.{name}")), (layer, name)
    assert spark.table("raw.invoices").count() == 8
    assert spark.table("staging_invoices").count() == 4
    scan = spark.table("staging_invoices").select("invoice_id")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_staged,true)" in plan
    assert "ReadSchema: struct<invoice_id:string,is_staged:boolean>" in plan
    assert spark.table("quarantine_invoices").count() == 5
    session = spark.newSession()
    for layer in ("staging", "quarantine"):
        for name in ROWS:
            view = session.table(f"{layer}.{name}")
            assert view.schema.simpleString() == spark.table(f"{layer}_{name}").schema.simpleString()
            assert sorted(view.collect(), key=str) == sorted(spark.table(f"{layer}_{name}").collect(), key=str)
    assert spark.table("audit.raw_amounts_sane").count() == 2

    more = {**ROWS, "invoices": [*ROWS["invoices"], invoice("I9", "S1", amount="1.00")]}
    run_pipeline(spark, source_of(spark, more), str(tmp_path), CONFIG)
    assert spark.table("raw.invoices").count() == 9
    assert spark.table("staging_invoices").count() == spark.newSession().table("staging.invoices").count() == 5


def test_failed_check_stops_before_the_marts(spark, tmp_path):
    run_pipeline(spark, source_of(spark, ROWS), str(tmp_path), CONFIG)
    before = spark.table("marts.customer_ltv").collect()
    bad = {
        **ROWS,
        "customers": [*ROWS["customers"], customer("C4")],
        "subscriptions": [*ROWS["subscriptions"], subscription("S6", end="2024-12-31")],
    }
    with pytest.raises(ChecksFailed, match=r"staging.subscriptions active_without_end\(end_date\): 1"):
        run_pipeline(spark, source_of(spark, bad), str(tmp_path), CONFIG)
    assert spark.table("marts.customer_ltv").collect() == before
    results = run_pipeline(spark, source_of(spark, bad), str(tmp_path), CONFIG, stop_on_error=False)
    assert any(r.severity == "error" and not r.passed for r in results)
    assert spark.table("marts.customer_ltv").count() == 4


def test_short_load_is_not_published(spark, tmp_path, monkeypatch):
    run_pipeline(spark, source_of(spark, ROWS), str(tmp_path), CONFIG)
    short = {**ROWS, "invoices": ROWS["invoices"][:2]}
    conform = pipeline.conform
    monkeypatch.setattr(pipeline, "conform", lambda df, schema: conform(df, schema).limit(1))
    with pytest.raises(LoadMismatch, match="invoices: 2 != 1"):
        run_pipeline(spark, source_of(spark, short), str(tmp_path), CONFIG)
    assert spark.table("raw.invoices").count() == 8


def test_refresh_runs_once_per_arrival(spark, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    landing.mkdir()
    runs = []

    def wake():
        query = refresh_on_arrival(
            spark, str(landing), checkpoint, lambda: runs.append(1), cadence=None
        )
        query.awaitTermination(60)

    (landing / "raw_invoices.csv").write_text("not a marker\n")
    wake()
    assert len(runs) == 0
    (landing / "2026-12-03.ready").write_text("done\n")
    wake()
    wake()
    assert len(runs) == 1
    (landing / "2026-12-04.ready").write_text("done\n")
    wake()
    assert len(runs) == 2
