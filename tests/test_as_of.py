"""The last entry of a log at or before a row, and conversion at dated rates."""

import random
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F
from rows import CONFIG, raw_table

from ledgerline.operators.as_of import as_of_join
from ledgerline.plans.dated_rates import missing_rates, priced_by_day

START = date(2024, 1, 1)


def brute(rows, log):
    found = []
    for key, day, n in rows:
        best = (None, None)
        if key is not None and day is not None:
            entries = [(t, v is not None, v) for k, t, v in log if k == key and t is not None and t <= day]
            if entries:
                best = max(entries)[0], max(entries)[2]
        found.append((key, day, n, *best))
    return sorted(map(str, found))


def test_entries_are_carried_forward(spark):
    for seed in range(3):
        random.seed(seed)
        day = lambda: random.choice([None, *[START + timedelta(random.randrange(300)) for _ in range(20)]])
        rows = [(random.choice(["a", "b", "c", None]), day(), n) for n in range(200)]
        log = [(random.choice(["a", "b", None]), day(), random.choice([None, 1, 2, 3])) for _ in range(25)]
        got = as_of_join(spark.createDataFrame(rows, "k string, d date, n int"), spark.createDataFrame(log, "k string, t date, v int"), ["k"], "d", "t", ["v"])
        assert got.columns == ["k", "d", "n", "t", "v"]
        assert sorted(map(str, map(tuple, got.collect()))) == brute(rows, log)


def test_several_keys_and_own_buckets(spark):
    rows = [("a", 1, 5.5), ("a", 2, 99.0), ("b", 1, 12.25), ("a", 1, -3.0)]
    log = [("a", 1, 5.5, "x"), ("a", 1, 6.0, "y"), ("a", 2, 10.0, "z"), ("b", 2, 0.0, "w"), ("a", 1, -100.0, "old")]
    got = as_of_join(spark.createDataFrame(rows, "k string, p int, at double"), spark.createDataFrame(log, "k string, p int, since double, v string"), ["k", "p"], "at", "since", ["v"], bucket=lambda t: F.floor(t / 10))
    assert {(r.k, r.p, r.at): (r.since, r.v) for r in got.collect()} == {("a", 1, 5.5): (5.5, "x"), ("a", 2, 99.0): (10.0, "z"), ("b", 1, 12.25): (None, None), ("a", 1, -3.0): (-100.0, "old")}


def test_nothing_to_join(spark):
    rows, log = spark.createDataFrame([("a", START)], "k string, d date"), spark.createDataFrame([], "k string, t date, v int")
    assert [tuple(r) for r in as_of_join(rows, log, ["k"], "d", "t", ["v"]).collect()] == [("a", START, None, None)]
    assert as_of_join(rows.limit(0), log, ["k"], "d", "t", ["v"]).collect() == []


def test_no_join_compares_times(spark):
    rows, log = spark.range(10).selectExpr("cast(id AS string) AS k", "date_add(current_date(), cast(id AS int)) AS d"), spark.range(10).selectExpr("cast(id AS string) AS k", "date_add(current_date(), cast(id AS int)) AS t", "id AS v")
    plan = as_of_join(rows, log, ["k"], "d", "t", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_hot_currency_and_day_is_split(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100k",
        spark__sql__shuffle__partitions="8",
    )
    rows = spark.range(0, 400_000, 1, 8).selectExpr("IF(id % 3 > 0, 'SEK', concat('c', id % 500)) AS k", "date'2024-03-03' AS d", "uuid() AS filler")
    log = spark.range(500).selectExpr("concat('c', id) AS k", "date'2024-01-01' AS t", "id AS v").unionByName(spark.range(1).selectExpr("'SEK' AS k", "date'2023-01-01' AS t", "id AS v"))
    joined = as_of_join(rows, log, ["k"], "d", "t", ["v"])
    assert joined.where("v IS NULL").count() == 0
    joined.write.format("noop").mode("overwrite").save()
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


RATES = [("SEK", "2024-01-10", "0.10"), ("sek ", "2024-01-10", "0.11"), ("SEK", "2024-02-01", None), ("SEK", "2024-03-05", "0.2"), ("USD", "2024-06-01", "0.9"), (None, "2024-01-01", "5"), ("EUR", "2024-01-01", "7")]


def test_rates_of_the_day(spark):
    rates = spark.createDataFrame([(c, date.fromisoformat(d), r and Decimal(r)) for c, d, r in RATES], "currency string, valid_from date, rate decimal(12,6)")
    cases = [
        ("2024-01-09", "SEK", None), ("2024-01-10", " sek", "1.10"), ("2024-02-03", "SEK", "1.10"), ("2024-02-20", "SEK", None),
        ("2024-03-05", "SEK", "2.00"), ("2024-05-01", "USD", None), ("2024-06-30", "USD", "9.00"), ("2024-01-01", "EUR", "10.00"),
        ("2024-01-11", "GBP", None), ("2024-01-11", None, None), (None, "SEK", None), (None, "EUR", "10.00"),
    ]
    invoices = raw_table(spark, "invoices", [(f"I{k}", "S1", d and date.fromisoformat(d), Decimal("10.00"), c, "paid") for k, (d, c, _) in enumerate(cases)])
    priced = priced_by_day(invoices, rates, CONFIG, max_age_days=30)
    got = {r.invoice_id: r.amount_eur for r in priced.collect()}
    assert got == {f"I{k}": want and Decimal(want) for k, (_, _, want) in enumerate(cases)}
    assert {(r.currency_code, r.invoice_month and r.invoice_month.month, r.invoices) for r in missing_rates(priced).collect()} == {("SEK", 1, 1), ("SEK", 2, 1), ("USD", 5, 1), ("GBP", 1, 1), ("SEK", None, 1)}
    old = {r.invoice_id: r.amount_eur for r in priced_by_day(invoices, rates, CONFIG).collect()}
    assert old["I3"] == Decimal("1.10")
