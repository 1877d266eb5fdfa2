"""All registered queries, over the billing projection of a benchmark directory."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.config import BillingConfig
from ledgerline.functions.dates import month_of
from ledgerline.functions.money import to_reporting_currency
from ledgerline.functions.text import clean_country, clean_currency, clean_label, clean_text
from ledgerline.operators import quantiles
from ledgerline.operators.key_index import KeyIndex
from ledgerline.operators.lineage import cut_lineage, shared_folder
from ledgerline.plans import book, checks, classify, dated_rates, marts, profiles, quarantine, spikes
from ledgerline.plans.billing import ENTITIES, Billing
from ledgerline.plans.incremental import IncrementalBilling
from ledgerline.sources.projection import projected_billing
from ledgerline.sources.reconcile import reconcile_counts, row_counts

# The reporting day of all registered queries, so that results can be repeated.
CONFIG = BillingConfig(as_of=date(2026, 12, 3))


Query = Callable[[Billing], DataFrame]


def _tables(b: Billing, layer: str) -> dict[str, DataFrame]:
    return {name: b.table(layer, name) for name in ENTITIES}


def _kept(b: Billing) -> Billing:
    """For queries over many tables: classify once, write the result, read that."""
    return b.keeping(lambda name, rows: cut_lineage(rows))


def _reason_counts(b: Billing) -> DataFrame:
    parts = [
        quarantine.reason_counts(rows).withColumn("table_name", F.lit(table))
        for table, rows in _tables(b, "quarantine").items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _cleaned_strings(b: Billing) -> DataFrame:
    """Every cleaned text value next to its row and column."""

    def pairs(rows: DataFrame, key: str, **values) -> DataFrame:
        return rows.select(
            F.col(key).alias("row_key"),
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(name).alias("column_name"), value.alias("value"))
                        for name, value in values.items()
                    ]
                )
            ),
        )

    customers = pairs(
        b.table("raw", "customers"),
        "customer_id",
        customer_name=clean_text(F.col("customer_name")),
        email=clean_text(F.col("email")),
        country=F.coalesce(clean_country(F.col("country")), F.lit("UNKNOWN")),
    )
    subscriptions = pairs(
        b.table("raw", "subscriptions"),
        "subscription_id",
        plan_name=clean_label(F.col("plan_name")),
        status=clean_label(F.col("status")),
    )
    return customers.unionByName(subscriptions)


def _quality_issue_rate(b: Billing) -> DataFrame:
    parts = [
        rows.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if("has_quality_issue").alias("issue_count"),
        ).select(
            F.lit(table).alias("table_name"),
            "row_count",
            "issue_count",
            F.try_divide(
                F.col("issue_count").cast("double"), F.col("row_count").cast("double")
            ).alias("issue_rate"),
        )
        for table, rows in _tables(b, "staging").items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _silent_drops(b: Billing) -> DataFrame:
    keys = {"customers": "customer_id", "subscriptions": "subscription_id", "invoices": "invoice_id"}
    parts = [
        classify.silent_drops(b.table("classified", table)).select(
            F.lit(table).alias("table_name"), F.col(key).alias("row_key"), "quarantine_reason"
        )
        for table, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _unique_combination(b: Billing) -> DataFrame:
    mrr = checks.duplicated_keys(b, ("marts", "mrr_monthly")).select(
        F.lit("mrr_monthly").alias("table_name"),
        F.col("invoice_month").alias("month"),
        "plan_name",
        "row_count",
    )
    churn = checks.duplicated_keys(b, ("marts", "churn_monthly")).select(
        F.lit("churn_monthly").alias("table_name"),
        F.col("churn_month").alias("month"),
        F.lit(None).cast("string").alias("plan_name"),
        "row_count",
    )
    return mrr.unionByName(churn)


def _flagged(frame: str, key: str, shown: str, flag: str) -> Query:
    """Key, inspected column and flag of every staged row."""
    return lambda b: b.table("staging", frame).select(key, shown, flag)


def _after_changes(b: Billing, deliveries: tuple[int, ...] = (2, 1)) -> IncrementalBilling:
    """Base tables, then two deliveries of changes, the second one first."""
    spark = b.table("raw", "invoices").sparkSession
    store = IncrementalBilling(spark, f"{shared_folder(spark)}/incremental/{uuid4().hex}", b.config)
    store.load(_tables(b, "raw"))
    changes = b.table("raw", "invoice_changes")
    for delivery in deliveries:
        store.apply(changes.where(F.col("delivery") == delivery))
    return store


def _unique_across_deliveries(b: Billing) -> DataFrame:
    """Repeated invoice ids over three deliveries, the second one sent twice."""
    invoices = b.table("raw", "invoices")
    spark = invoices.sparkSession
    index = KeyIndex(spark, f"{shared_folder(spark)}/keys/{uuid4().hex}", "invoice_id", buckets=8)
    # A number of the row and not of its key, so that copies come in different deliveries.
    numbered = invoices.withColumn("delivery", F.pmod(F.xxhash64(*[c for c in invoices.columns if c != "invoice_id"]), F.lit(3)))
    for delivery in (0, 1, 2, 1):
        index.add(f"d{delivery}", numbered.where(F.col("delivery") == delivery))
    return index.repeated()


def _paid_amount_sketches(b: Billing) -> DataFrame:
    """Per month and plan the number of paid amounts, and whether the sketch's quartiles lie where they should among the exact rows."""
    paid, by, shares = marts.paid_invoices(b.table("classified", "invoices")), ["invoice_month", "plan_name"], {"low": 0.25, "middle": 0.5, "high": 0.75}
    paid = cut_lineage(paid)
    found = quantiles.quantiles(quantiles.sketched(paid, by, "amount_eur"), shares)
    exact = quantiles.share_below(paid, found, by, "amount_eur", list(shares))
    near = [
        (F.col(f"{c}_below") <= F.col("rows") * (q + quantiles.RANK_ERROR) + 1) & (F.col(f"{c}_upto") >= F.col("rows") * (q - quantiles.RANK_ERROR) - 1)
        for c, q in shares.items()
    ]
    return exact.select(*by, F.col("rows").alias("invoices"), reduce(lambda x, y: x & y, near).alias("quartiles_hold"))


def _history_by_snapshot(b: Billing) -> DataFrame:
    """The history after the snapshots were added day by day, some of them twice."""
    snapshots = b.table("raw", "subscription_snapshots")
    spark = snapshots.sparkSession
    store = book.HistoryStore(spark, f"{shared_folder(spark)}/history/{uuid4().hex}")
    days = sorted(r.snapshot_date for r in snapshots.select("snapshot_date").distinct().collect())  # one row a snapshot
    for day in (*days, days[-1]):
        store.add(day, snapshots.where(F.col("snapshot_date") == day))
    return store.history()


def _priced(b: Billing) -> DataFrame:
    return dated_rates.priced_by_day(b.table("raw", "invoices"), b.table("raw", "exchange_rates"), CONFIG, max_age_days=30)


def _broken(b: Billing) -> Billing:
    """The same tables as a faulty build would leave them, so that every check finds something."""
    broken = Billing(lambda name: b.table("raw", name), b.config)

    def change(layer: str, name: str, columns: dict | None = None, copied: str | None = None, kept: str | None = None) -> None:
        rows = b.table(layer, name).withColumns(columns or {})
        if copied:
            rows = rows.withColumn("copy", F.expr(f"explode(array_repeat(true, IF({copied}, 2, 1)))")).drop("copy")
        broken.set_table(layer, name, rows.where(kept) if kept else rows)

    change("staging", "customers", copied="customer_id LIKE '%3'", kept="customer_id NOT LIKE '%55'")
    change("staging", "subscriptions", {"is_invalid_date_range": F.lit(False)}, "subscription_id LIKE '%77'", "subscription_id NOT LIKE '%5'")
    change("staging", "invoices", {"amount_eur": F.expr("IF(invoice_id LIKE '%9-2', -amount_eur, amount_eur)").cast("decimal(14,2)")})
    change("classified", "customers", kept="NOT quarantine_reason <=> 'invalid_email'")
    change("classified", "subscriptions", kept="NOT quarantine_reason <=> 'end_before_start'")
    change("classified", "invoices", {"is_after_end_date": F.expr("is_after_end_date AND invoice_id NOT LIKE '%-1'")})
    change("marts", "customer_ltv", copied="customer_id LIKE '%8'")
    change("marts", "mrr_monthly", copied="plan_name = 'growth'")
    change("marts", "churn_monthly", copied="month(churn_month) = 1")
    return broken


def _on_broken(name: str) -> Query:
    """A check on the tables of the faulty build."""
    return lambda b: QUERIES[name](_broken(b))


# Checks without a failing row on the tables as they are built.
SILENT_CHECKS = [
    "check_unique_stg_customers",
    "check_unique_stg_subscriptions",
    "check_unique_customer_ltv",
    "check_unique_combination",
    "check_relationships_stg_subscriptions",
    "check_relationships_stg_invoices",
    "check_paid_positive",
    "check_dates_flagged",
    "check_after_end_flagged",
    "check_planted_defects",
]


QUERIES: dict[str, Query] = {
    # sources
    "load_raw_customers": lambda b: b.table("raw", "customers"),
    "load_raw_subscriptions": lambda b: b.table("raw", "subscriptions"),
    "load_raw_invoices": lambda b: b.table("raw", "invoices"),
    "row_count_reconcile": lambda b: reconcile_counts(
        row_counts(_tables(b, "raw")), row_counts({n: cut_lineage(rows) for n, rows in _tables(b, "raw").items()})
    ),
    # layers
    "stg_customers": lambda b: b.table("staging", "customers"),
    "stg_subscriptions": lambda b: b.table("staging", "subscriptions"),
    "stg_invoices": lambda b: b.table("staging", "invoices"),
    "qrt_customers": lambda b: b.table("quarantine", "customers"),
    "qrt_subscriptions": lambda b: b.table("quarantine", "subscriptions"),
    "qrt_invoices": lambda b: b.table("quarantine", "invoices"),
    "mrr_monthly": lambda b: b.table("marts", "mrr_monthly"),
    "customer_ltv": lambda b: b.table("marts", "customer_ltv"),
    "churn_monthly": lambda b: b.table("marts", "churn_monthly"),
    # single operators
    "dedupe_customers": lambda b: classify.first_customers(b.table("raw", "customers")),
    "dedupe_subscriptions": lambda b: classify.first_subscriptions(b.table("raw", "subscriptions")),
    "duplicate_customers": lambda b: classify.repeated_customers(b.table("raw", "customers")),
    "duplicate_subscriptions": lambda b: classify.repeated_subscriptions(b.table("raw", "subscriptions")),
    "normalize_strings": _cleaned_strings,
    "fx_normalize": lambda b: b.table("raw", "invoices").select(
        "invoice_id",
        "amount",
        clean_currency(F.col("currency")).alias("currency_code"),
        to_reporting_currency(
            F.col("amount"), clean_currency(F.col("currency")), CONFIG
        ).alias("amount_eur"),
    ),
    "flag_invalid_email": _flagged("customers", "customer_id", "email", "is_invalid_email"),
    "flag_missing_country": _flagged("customers", "customer_id", "country", "is_missing_country"),
    "flag_future_created_at": _flagged(
        "customers", "customer_id", "created_at", "is_future_created_at"
    ),
    "flag_invalid_date_range": _flagged(
        "subscriptions", "subscription_id", "end_date", "is_invalid_date_range"
    ),
    "orphan_subscriptions": lambda b: b.table("judged", "subscriptions").where(
        "is_orphan_customer"
    ).select("subscription_id", "customer_id"),
    "orphan_invoices": lambda b: b.table("classified", "invoices").where("is_orphan_subscription").select(
        "invoice_id", "subscription_id"
    ),
    "invoices_after_end": lambda b: b.table("classified", "invoices").where("is_after_end_date").select(
        "invoice_id", "subscription_id", "invoice_date", "end_date"
    ),
    "unsupported_currency": lambda b: b.table("raw", "invoices").where(
        ~clean_currency(F.col("currency")).isin(CONFIG.supported_currencies)
    ).select("invoice_id", "currency", "amount"),
    "quality_issue_rate": _quality_issue_rate,
    "quarantine_reason_counts": _reason_counts,
    "customer_revenue": lambda b: marts.customer_revenue(b.table("classified", "invoices")).select(
        "customer_id", "ltv_eur", "paid_invoice_count"
    ),
    "customer_plan_mix": lambda b: marts.customer_revenue(b.table("classified", "invoices")).select(
        "customer_id", "plan_mix"
    ),
    "customer_status_mix": lambda b: marts.customer_status(b.table("staging", "subscriptions")),
    # kept up to date by changes
    "incremental_invoices": lambda b: _after_changes(b, (2, 1, 2)).invoices(),
    "incremental_mrr_monthly": lambda b: _after_changes(b).read("mrr_monthly"),
    "incremental_customer_ltv": lambda b: _after_changes(b).read("customer_ltv"),
    "incremental_check_results": lambda b: _after_changes(b).check_results(),
    "unique_across_deliveries": _unique_across_deliveries,
    "paid_amount_sketches": _paid_amount_sketches,
    # history and dated rates
    "subscription_history": lambda b: book.subscription_history(b.table("raw", "subscription_snapshots")),
    "subscription_history_by_snapshot": _history_by_snapshot,
    "book_mrr_monthly": lambda b: book.book_mrr_monthly(
        book.subscription_history(b.table("raw", "subscription_snapshots")), month_of(F.lit(CONFIG.as_of))
    ),
    "invoices_at_dated_rates": lambda b: _priced(b).select(
        "invoice_id", "invoice_date", "amount", "currency_code", "rate_date", "rate", "amount_eur"
    ),
    "missing_rates": lambda b: dated_rates.missing_rates(_priced(b)),
    # The invoices of a month stand for a run.
    "quarantine_spikes": lambda b: spikes.judged_runs(
        spikes.counts_per_run(b.table("classified", "invoices"), "invoices", F.expr("year(invoice_date) * 100 + month(invoice_date)"))
    ),
    # checks
    "check_not_null": lambda b: checks.contract_results(_kept(b), "not_null"),
    "check_accepted_values": lambda b: checks.contract_results(_kept(b), "accepted_values"),
    "check_expression": lambda b: checks.contract_results(_kept(b), "expression_is_true"),
    "check_unique_raw_customers": lambda b: checks.duplicated_keys(b, ("raw", "customers")),
    "check_unique_raw_subscriptions": lambda b: checks.duplicated_keys(
        b, ("raw", "subscriptions")
    ),
    "check_unique_raw_invoices": lambda b: checks.duplicated_keys(b, ("raw", "invoices")),
    "check_unique_stg_customers": lambda b: checks.duplicated_keys(
        b, ("staging", "customers")
    ),
    "check_unique_stg_subscriptions": lambda b: checks.duplicated_keys(
        b, ("staging", "subscriptions")
    ),
    "check_unique_stg_invoices": lambda b: checks.duplicated_keys(
        b, ("staging", "invoices")
    ),
    "check_unique_customer_ltv": lambda b: checks.duplicated_keys(
        b, ("marts", "customer_ltv")
    ),
    "check_unique_combination": _unique_combination,
    "check_relationships_raw_subscriptions": lambda b: checks.orphans(
        b, ("raw", "subscriptions")
    ),
    "check_relationships_raw_invoices": lambda b: checks.orphans(b, ("raw", "invoices")),
    "check_relationships_stg_subscriptions": lambda b: checks.orphans(
        b, ("staging", "subscriptions")
    ),
    "check_relationships_stg_invoices": lambda b: checks.orphans(
        b, ("staging", "invoices")
    ),
    "check_active_without_end": lambda b: checks.business_violations(
        b, "active_without_end"
    ),
    "check_paid_positive": lambda b: checks.business_violations(b, "paid_positive"),
    "check_dates_flagged": lambda b: checks.business_violations(b, "dates_flagged"),
    "check_raw_amounts": lambda b: checks.business_violations(b, "raw_amounts_sane"),
    "check_raw_dates": lambda b: checks.business_violations(b, "raw_dates_sane"),
    "check_after_end_flagged": lambda b: checks.after_end_unflagged(b.table("classified", "invoices")),
    "check_planted_defects": lambda b: checks.missing_defect_classes(b),
    "check_silent_drops": _silent_drops,
    "check_summary": lambda b: checks.check_summary(_kept(b)),
    # profiles
    "profile_grain": lambda b: profiles.grain(b),
    "profile_multi_subscription": lambda b: profiles.multi_subscription(b.table("staging", "subscriptions")),
    "profile_subscriptions_without_invoices": lambda b: profiles.subscriptions_without_invoices(
        b.table("staging", "subscriptions"), b.table("raw", "invoices")
    ),
    "profile_duplicate_billing": lambda b: profiles.duplicate_billing(b.table("raw", "invoices")),
    "profile_price_mismatch": lambda b: profiles.price_mismatch(
        b.table("raw", "invoices"), b.table("staging", "subscriptions")
    ),
    "profile_status_share": lambda b: profiles.status_share(b),
    "profile_domains": lambda b: profiles.domains(b),
    "profile_future_dates": lambda b: profiles.future_dates(b),
    "revenue_share_by_plan": lambda b: profiles.revenue_share_by_plan(b.table("classified", "invoices")),
    "top_countries": lambda b: profiles.top_countries(b.table("marts", "customer_ltv")),
    "ltv_distribution": lambda b: profiles.ltv_distribution(b.table("marts", "customer_ltv")),
    "active_book_by_plan": lambda b: profiles.active_book_by_plan(b.table("staging", "subscriptions")),
}


QUERIES |= {f"broken_{name}": _on_broken(name) for name in SILENT_CHECKS}


def run(name: str, spark: SparkSession, directory: str) -> DataFrame:
    return QUERIES[name](Billing(projected_billing(spark, directory), CONFIG))
