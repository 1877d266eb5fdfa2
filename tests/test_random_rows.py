"""All layers on random dirty rows, against the same SQL that checks the registered queries.

The projection of the benchmark tables has no NULL keys, dates or statuses; these rows do.
"""

import random
from datetime import date, timedelta
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import types as T
from rows import billing

from ledgerline.plans import checks
from verification.compare import difference
from verification.oracle import MARTS, VERDICTS, expected_sql, statement

ARROW = {
    T.StringType(): pa.string(),
    T.DateType(): pa.date32(),
    T.DecimalType(12, 2): pa.decimal128(12, 2),
}


def random_rows(seed):
    r = random.Random(seed)

    def maybe(value, share=0.05):
        return None if r.random() < share else value

    def day(first, days):
        return date.fromisoformat(first) + timedelta(days=r.randrange(days))

    def padded(word):
        return r.choice([word, word, word.upper(), f" {word}", f"{word} ", f"\t{word}"])

    def money(*amounts):
        return Decimal(r.choice(amounts))

    customers = [
        (
            maybe(f"C{r.randrange(60)}"),
            maybe(r.choice(["Ann", " Bob ", "  ", "Cy"])),
            maybe(r.choice(["a@b.c", " a@b.c", "a@b", "a b@c.d", "x@y.z", "q@r.s\n", ""])),
            maybe(r.choice(["DE", " de ", "  ", "", "fr", "\t", "XX"]), 0.2),
            maybe(r.choice([date(2024, 1, 1), date(2025, 1, 1), date(2030, 1, 1)])),
        )
        for _ in range(150)
    ]
    subscriptions = [
        (
            maybe(f"S{r.randrange(300)}"),
            maybe(f"C{r.randrange(70)}"),
            maybe(padded(r.choice(["starter", "growth", "scale", "", "gold"]))),
            maybe(money("29.00", "99.00", "299.00", "0.00", "-99.00")),
            maybe(day("2024-01-01", 60)),
            maybe(day("2023-12-15", 120), 0.5),
            maybe(padded(r.choice(["active", "cancelled", "paused", "unknown"]))),
        )
        for _ in range(500)
    ]
    invoices = [
        (
            maybe(f"I{r.randrange(1500)}"),
            maybe(r.choice(["S5", f"S{r.randrange(330)}"])),
            maybe(day("2024-01-01", 150)),
            maybe(money("29.00", "11.50", "0.05", "0.06", "0.00", "-5.00", "9999999999.99")),
            maybe(r.choice(["EUR", "eur", " EUR ", "SEK", "sek ", "USD", ""])),
            maybe(padded(r.choice(["paid", "paid", "failed", "open"]))),
        )
        for _ in range(2000)
    ]
    return customers, subscriptions, invoices


@pytest.fixture(scope="module", params=[1, 2])
def sides(request, spark):
    rows = random_rows(request.param)
    b = billing(spark, *rows)
    connection = duckdb.connect()
    for name, table in zip(("customers", "subscriptions", "invoices"), rows):
        schema = b.table("raw", name).schema
        arrow = pa.table(
            [pa.array(c, ARROW[f.dataType]) for c, f in zip(zip(*table), schema)], schema.names
        )
        connection.register(f"raw_{name}", arrow)
    return b, connection


def over_given_rows(body):
    return f"with {VERDICTS.strip()},\n{MARTS.strip()}\n{body}"


TABLES = [
    ("staging", "customers", "stg_customers"),
    ("staging", "subscriptions", "stg_subscriptions"),
    ("staging", "invoices", "stg_invoices"),
    ("quarantine", "customers", "qrt_customers"),
    ("quarantine", "subscriptions", "qrt_subscriptions"),
    ("quarantine", "invoices", "qrt_invoices"),
    ("marts", "mrr_monthly", "mrr_monthly"),
    ("marts", "customer_ltv", "customer_ltv"),
    ("marts", "churn_monthly", "churn_monthly"),
]


@pytest.mark.parametrize(("layer", "name", "relation"), TABLES)
def test_layers(sides, layer, name, relation):
    b, connection = sides
    sql = over_given_rows(f"select * from {relation}")
    assert difference(b.table(layer, name), connection, sql) is None


def test_check_summary(sides):
    b, connection = sides
    sql = expected_sql()["check_summary"]
    body = sql[len(statement("")) :]
    assert difference(checks.check_summary(b), connection, over_given_rows(body)) is None


def test_no_row_is_lost(sides):
    """raw = staged + rejected + silently dropped, per table."""
    from ledgerline.plans.classify import silent_drops

    b, _ = sides
    soft = ["invalid_email", "missing_country", "end_before_start", "invoice_after_end_date"]
    for name in ("customers", "subscriptions", "invoices"):
        rejected = b.table("quarantine", name).where(~b.table("quarantine", name).quarantine_reason.isin(soft))
        parts = [b.table("staging", name), rejected, silent_drops(b.table("classified", name))]
        assert sum(p.count() for p in parts) == b.table("raw", name).count()
