"""Data-quality checks. A check fails on rows; no failing rows is a pass.

All column checks of a table are answered by one aggregation over it, its unique key by another.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.config import BillingConfig
from ledgerline.functions.dates import is_after
from ledgerline.functions.text import clean_label
from ledgerline.operators.parents import without_parent
from ledgerline.plans.billing import ENTITIES, LAYERS, Billing
from ledgerline.plans.classify import is_silent_drop, silent_drops

Table = tuple[str, str]

ERROR, WARN = "error", "warn"

# The contract of every layer.
NOT_NULL: dict[Table, list[str]] = {
    ("raw", "customers"): ["customer_id", "email"],
    ("raw", "subscriptions"): ["subscription_id", "customer_id"],
    ("raw", "invoices"): ["invoice_id", "subscription_id"],
    ("staging", "customers"): ["customer_id", "customer_name", "email", "country", "created_at"],
    ("staging", "subscriptions"): [
        "subscription_id",
        "customer_id",
        "plan_name",
        "monthly_price",
        "status",
        "start_date",
    ],
    ("staging", "invoices"): [
        "invoice_id",
        "subscription_id",
        "invoice_date",
        "amount_eur",
        "status",
        "plan_name",
    ],
    ("quarantine", "customers"): ["customer_id", "quarantine_reason"],
    ("quarantine", "subscriptions"): ["subscription_id", "quarantine_reason"],
    ("quarantine", "invoices"): ["invoice_id", "quarantine_reason"],
    ("marts", "mrr_monthly"): ["invoice_month", "plan_name", "paid_invoice_count", "mrr_eur"],
    ("marts", "customer_ltv"): [
        "customer_id",
        "customer_name",
        "country",
        "ltv_eur",
        "paid_invoice_count",
        "has_active_subscription",
    ],
    ("marts", "churn_monthly"): ["churn_month", "cancelled_subscriptions", "mrr_lost_eur"],
}

# Fixed values.
ACCEPTED: dict[Table, dict[str, list[str]]] = {
    ("staging", "customers"): {"country": schemas.COUNTRIES},
    ("staging", "subscriptions"): {
        "plan_name": schemas.PLANS,
        "status": schemas.SUBSCRIPTION_STATUSES,
    },
    ("staging", "invoices"): {
        "status": schemas.INVOICE_STATUSES,
        "reporting_currency": [],  # that of the config
        "plan_name": schemas.PLANS,
    },
    ("quarantine", "customers"): {"quarantine_reason": schemas.CUSTOMER_REASONS},
    ("quarantine", "subscriptions"): {"quarantine_reason": schemas.SUBSCRIPTION_REASONS},
    ("quarantine", "invoices"): {"quarantine_reason": schemas.INVOICE_REASONS},
    ("marts", "mrr_monthly"): {"plan_name": schemas.PLANS},
}

# Fixed values.
EXPRESSIONS: dict[Table, dict[str, str]] = {
    ("staging", "subscriptions"): {"monthly_price": "> 0"},
    ("staging", "invoices"): {"amount_eur": "> 0"},
    ("marts", "mrr_monthly"): {"mrr_eur": ">= 0"},
    ("marts", "customer_ltv"): {"ltv_eur": ">= 0"},
    ("marts", "churn_monthly"): {"mrr_lost_eur": ">= 0"},
}

# Fixed values.
UNIQUE: dict[Table, tuple[list[str], str]] = {
    ("raw", "customers"): (["customer_id"], WARN),
    ("raw", "subscriptions"): (["subscription_id"], WARN),
    ("raw", "invoices"): (["invoice_id"], ERROR),
    ("staging", "customers"): (["customer_id"], ERROR),
    ("staging", "subscriptions"): (["subscription_id"], ERROR),
    ("staging", "invoices"): (["invoice_id"], ERROR),
    ("marts", "customer_ltv"): (["customer_id"], ERROR),
}

# Here a NULL is a value like any other.
UNIQUE_COMBINATION: dict[Table, list[str]] = {
    ("marts", "mrr_monthly"): ["invoice_month", "plan_name"],
    ("marts", "churn_monthly"): ["churn_month"],
}

# child table -> (foreign key, parent table, severity)
RELATIONSHIPS: dict[Table, tuple[str, Table, str]] = {
    ("raw", "subscriptions"): ("customer_id", ("raw", "customers"), WARN),
    ("raw", "invoices"): ("subscription_id", ("raw", "subscriptions"), WARN),
    ("staging", "subscriptions"): ("customer_id", ("staging", "customers"), ERROR),
    ("staging", "invoices"): ("subscription_id", ("staging", "subscriptions"), ERROR),
}

# Defect classes that quarantine must never stop finding.
PLANTED: dict[str, dict[str, list[str]]] = {
    "customers": {
        "duplicate_customer_id": ["duplicate_customer_id"],
        "invalid_email": ["invalid_email"],
        "missing_country": ["missing_country"],
    },
    "subscriptions": {
        "duplicate_subscription_id": ["duplicate_subscription_id"],
        "orphan_customer_id": ["orphan_customer_id"],
        "non_positive_monthly_price": ["non_positive_monthly_price"],
        "end_before_start": ["end_before_start"],
    },
    "invoices": {
        "orphan_subscription_id": ["orphan_subscription_id"],
        "null_or_non_positive_amount": ["null_amount", "non_positive_amount"],
        "invoice_after_end_date": ["invoice_after_end_date"],
    },
}


@dataclass(frozen=True)
class RowCheck:
    """A check that looks at one row at a time; ``fails`` is SQL, true on a violation."""

    table: Table
    name: str
    column: str
    severity: str
    fails: str
    shown: tuple[str, ...] = ()


BUSINESS_CHECKS = [
    RowCheck(
        ("raw", "invoices"),
        "raw_amounts_sane",
        "amount",
        WARN,
        "amount IS NULL OR amount <= 0",
        ("invoice_id", "amount", "status"),
    ),
    RowCheck(
        ("raw", "subscriptions"),
        "raw_dates_sane",
        "end_date",
        WARN,
        "end_date < start_date",
        ("subscription_id", "start_date", "end_date"),
    ),
    RowCheck(
        ("staging", "subscriptions"),
        "active_without_end",
        "end_date",
        ERROR,
        "status = 'active' AND end_date IS NOT NULL",
        ("subscription_id", "status", "end_date"),
    ),
    RowCheck(
        ("staging", "subscriptions"),
        "dates_flagged",
        "end_date",
        ERROR,
        "end_date < start_date AND NOT is_invalid_date_range",
        ("subscription_id", "start_date", "end_date"),
    ),
    RowCheck(
        ("staging", "invoices"),
        "paid_positive",
        "amount_eur",
        ERROR,
        "status = 'paid' AND amount_eur <= 0",
        ("invoice_id", "amount_eur", "status"),
    ),
]


def _listed(values: Sequence[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def not_null_checks(table: Table) -> list[RowCheck]:
    return [
        RowCheck(table, "not_null", c, ERROR, f"{c} IS NULL") for c in NOT_NULL.get(table, [])
    ]


def accepted_checks(table: Table, config: BillingConfig) -> list[RowCheck]:
    """A NULL passes."""
    accepted = {c: values or [config.reporting_currency] for c, values in ACCEPTED.get(table, {}).items()}
    return [
        RowCheck(table, "accepted_values", c, ERROR, f"{c} NOT IN ({_listed(values)})")
        for c, values in accepted.items()
    ]


def expression_checks(table: Table) -> list[RowCheck]:
    return [
        RowCheck(table, "expression_is_true", c, ERROR, f"NOT ({c} {condition})")
        for c, condition in EXPRESSIONS.get(table, {}).items()
    ]


def row_checks(table: Table, config: BillingConfig) -> list[RowCheck]:
    return [
        *not_null_checks(table),
        *accepted_checks(table, config),
        *expression_checks(table),
        *[check for check in BUSINESS_CHECKS if check.table == table],
    ]


def _result(table: Table, name: str, column: str, severity: str, failures: str) -> str:
    """SQL of one result row; ``failures`` names the counting column."""
    return (
        f"named_struct('layer', '{table[0]}', 'table_name', '{table[1]}', 'check_name', '{name}',"
        f" 'column_name', '{column}', 'severity', '{severity}',"
        f" 'failures', coalesce({failures}, 0L), 'passed', coalesce({failures}, 0L) = 0)"
    )


def _as_rows(totals: DataFrame, results: Sequence[str]) -> DataFrame:
    return totals.selectExpr(f"inline(array({', '.join(results)}))")


def _unique_key(table: Table) -> tuple[list[str], str, str, bool] | None:
    """Key columns, check name, severity, and whether a NULL key is exempt."""
    if table in UNIQUE:
        columns, severity = UNIQUE[table]
        return columns, "unique", severity, True
    if table in UNIQUE_COMBINATION:
        return UNIQUE_COMBINATION[table], "unique_combination", ERROR, False
    return None


def _known(columns: Sequence[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def table_results(
    frame: DataFrame, table: Table, checks: Sequence[RowCheck], unique: bool
) -> DataFrame:
    """One result row per check of a table. ``failures`` counts rows, or keys for uniqueness.

    All column checks are one aggregation without a shuffle of rows; a unique key is counted from
    the key alone, partly before the shuffle, so that a key with many copies sends little.
    """
    names = [f"failures_{i}" for i in range(len(checks))]
    counts = [F.expr(f"count_if({check.fails}) AS {n}") for n, check in zip(names, checks)]
    results = [
        _result(table, c.name, c.column, c.severity, n) for n, c in zip(names, checks)
    ]
    key = _unique_key(table) if unique else None
    found = [_as_rows(frame.agg(*counts), results)] if checks else []
    if key is None:
        return found[0]
    columns, name, severity, null_exempt = key
    repeated = "copies > 1" + (f" AND {_known(columns)}" if null_exempt else "")
    keys = frame.groupBy(*columns).agg(F.expr("count(1) AS copies"))
    repeats = keys.agg(F.expr(f"count_if({repeated}) AS repeated_keys"))
    found.append(
        _as_rows(repeats, [_result(table, name, ", ".join(columns), severity, "repeated_keys")])
    )
    return reduce(DataFrame.unionByName, found)


def contract_results(billing: Billing, kind: str) -> DataFrame:
    """Results of one kind of column check ("not_null", "accepted_values" or
    "expression_is_true") over all tables that have it."""
    makers = {
        "not_null": not_null_checks,
        "accepted_values": lambda table: accepted_checks(table, billing.config),
        "expression_is_true": expression_checks,
    }
    contracts = {"not_null": NOT_NULL, "accepted_values": ACCEPTED, "expression_is_true": EXPRESSIONS}
    parts = [
        table_results(billing.table(*table), table, makers[kind](table), unique=False)
        for table in contracts[kind]
    ]
    return reduce(DataFrame.unionByName, parts)


def business_violations(billing: Billing, name: str) -> DataFrame:
    """Rows that break a business rule."""
    check = next(c for c in BUSINESS_CHECKS if c.name == name)
    return billing.table(*check.table).where(check.fails).select(*check.shown)


def duplicated_keys(billing: Billing, table: Table) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    columns, _, _, null_exempt = _unique_key(table)
    frame = billing.table(*table)
    if null_exempt:
        frame = frame.where(_known(columns))
    return (
        frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")
    )


def orphans(billing: Billing, child: Table) -> DataFrame:
    """Foreign keys without a parent, one row per child row."""
    key, parent, _ = RELATIONSHIPS[child]
    return without_parent(billing.table(*child).select(key), billing.table(*parent), key)


def after_end_unflagged(classified_invoices: DataFrame) -> DataFrame:
    """Staged paid invoices past the end of their subscription that lack the flag.

    Classified invoices carry the end date of their subscription, so there is no second join.
    """
    return classified_invoices.where(
        F.col("is_staged")
        & (clean_label(F.col("status")) == "paid")
        & is_after(F.col("invoice_date"), F.col("end_date"))
        & ~F.coalesce(F.col("is_after_end_date"), F.lit(False))
    ).select("invoice_id", "invoice_date", "end_date")


def missing_defect_classes(billing: Billing) -> DataFrame:
    """Defect classes of which quarantine holds no row. Each table is read once."""
    parts = []
    for table, classes in PLANTED.items():
        found = ", ".join(
            f"struct('{name}' AS missing_quarantine_reason,"
            f" count_if(quarantine_reason IN ({_listed(reasons)})) AS found)"
            for name, reasons in classes.items()
        )
        counted = billing.table("classified", table).agg(F.expr(f"array({found}) AS classes"))
        parts.append(counted.selectExpr("inline(classes)"))
    return reduce(DataFrame.unionByName, parts).where("found = 0").drop("found")


def classification_results(billing: Billing, layers: Collection[str]) -> list[DataFrame]:
    """Silent drops (layer staging) and defect classes without a row (layer quarantine).

    Both are counted in one pass over each classified table, and the few counts are then summed.
    """
    parts = []
    for table in ENTITIES:
        missing = [F.expr(f"int(count_if(quarantine_reason IN ({_listed(r)})) = 0)") for r in PLANTED[table].values()]
        counts = {"silent": F.count_if(is_silent_drop()), "missing": reduce(lambda a, b: a + b, missing)}
        totals = billing.table("classified", table).agg(*[n.cast("long").alias(c) for c, n in counts.items()])
        results = []
        if "staging" in layers:
            results.append(_result(("staging", table), "silent_drops", NOT_NULL["raw", table][0], WARN, "silent"))
        if "quarantine" in layers:
            results.append(_result(("quarantine", "all"), "planted_defects", "quarantine_reason", ERROR, "missing"))
        if results:
            parts.append(_as_rows(totals, results))
    if not parts:
        return []
    place = ["layer", "table_name", "check_name", "column_name", "severity"]
    summed = reduce(DataFrame.unionByName, parts).groupBy(*place).agg(F.sum("failures").alias("failures"))
    return [summed.withColumn("passed", F.col("failures") == 0)]


def _counted(rows: DataFrame, table: Table, name: str, column: str, severity: str) -> DataFrame:
    failures = rows.agg(F.count(F.lit(1)).alias("failures"))
    return _as_rows(failures, [_result(table, name, column, severity, "failures")])


def _layer_parts(billing: Billing, layer: str) -> list[DataFrame]:
    parts = [
        table_results(
            billing.table(layer, name),
            (layer, name),
            row_checks((layer, name), billing.config),
            unique=True,
        )
        for name in LAYERS[layer]
    ]
    for child, (key, _, severity) in RELATIONSHIPS.items():
        if child[0] == layer:
            parts.append(
                _counted(orphans(billing, child), child, "relationships", key, severity)
            )
    if layer == "staging":
        late = after_end_unflagged(billing.table("classified", "invoices"))
        parts.append(_counted(late, ("staging", "invoices"), "after_end_flagged", "invoice_date", ERROR))
    return parts


def layer_results(billing: Billing, layer: str) -> DataFrame:
    """Results of all checks of one layer."""
    return reduce(DataFrame.unionByName, [*_layer_parts(billing, layer), *classification_results(billing, [layer])])


def check_summary(billing: Billing) -> DataFrame:
    """Results of all checks of all layers."""
    parts = [part for layer in LAYERS for part in _layer_parts(billing, layer)]
    return reduce(DataFrame.unionByName, [*parts, *classification_results(billing, LAYERS)])


def stored_failures(billing: Billing) -> dict[str, DataFrame]:
    """Failing rows that are kept for inspection: the warnings on the raw layer, and rows that are
    neither staged nor rejected."""
    return {
        "unique_customers_customer_id": duplicated_keys(billing, ("raw", "customers")),
        "unique_subscriptions_subscription_id": duplicated_keys(billing, ("raw", "subscriptions")),
        "relationships_subscriptions_customer_id": orphans(billing, ("raw", "subscriptions")),
        "relationships_invoices_subscription_id": orphans(billing, ("raw", "invoices")),
        **{f"silent_drops_{name}": silent_drops(billing.table("classified", name)) for name in ENTITIES},
        "raw_amounts_sane": business_violations(billing, "raw_amounts_sane"),
        "raw_dates_sane": business_violations(billing, "raw_dates_sane"),
    }
