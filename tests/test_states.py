"""States that are kept and merged: key counts, check counts per month, quantile sketches."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from rows import CONFIG, billing
from test_incremental import BASE, CHANGED, CUSTOMERS, SUBSCRIPTIONS, changes, frames, standing

from ledgerline.operators.key_index import KeyIndex
from ledgerline.operators.quantiles import RANK_ERROR, merged, quantiles, share_below, sketched
from ledgerline.plans import checks
from ledgerline.plans.incremental import IncrementalBilling


def test_keys_over_deliveries(spark, tmp_path):
    random.seed(2)
    index, seen = KeyIndex(spark, str(tmp_path), "id", buckets=4), Counter()
    deliveries = {n: [random.choice([None, *[f"k{k}" for k in range(30)]]) for _ in range(25)] for n in range(3)}
    for n in (0, 1, 1, 2, 0):
        keys = [k for k in deliveries[n] if k is not None]
        if n not in seen:
            seen.update({n: 1})
            seen.update(keys)
        got = index.add(f"d{n}", spark.createDataFrame([(k, "x") for k in deliveries[n]], "id string, other string"))
        assert {(r.id, r.row_count) for r in got.collect()} == {(k, seen[k]) for k in keys if seen[k] > 1}
    wanted = {(k, n) for k, n in seen.items() if isinstance(k, str) and n > 1}
    assert {(r.id, r.row_count) for r in index.repeated().collect()} == wanted


def test_a_small_delivery_touches_its_buckets_alone(spark, tmp_path):
    from ledgerline.sources.versions import current_version

    index = KeyIndex(spark, str(tmp_path), "id", buckets=16)
    index.add("all", spark.range(500))
    before = current_version(spark, str(tmp_path)).tables["keys"].parts
    assert [tuple(r) for r in index.add("one", spark.range(7, 8)).collect()] == [(7, 2)]
    after = current_version(spark, str(tmp_path)).tables["keys"].parts
    assert sum(before[b] != after[b] for b in before) == 1
    assert index.add("none", spark.range(0)).collect() == []


def test_check_counts_add_up_to_the_results_of_the_whole_tables(spark, tmp_path):
    store = IncrementalBilling(spark, str(tmp_path), CONFIG)
    store.load(frames(spark, BASE))
    store.apply(changes(spark, CHANGED[::2]))
    store.apply(changes(spark, CHANGED[1::2]))
    full = billing(spark, CUSTOMERS, SUBSCRIPTIONS, standing(BASE, CHANGED))
    wanted = {tuple(r) for r in checks.check_summary(full).collect() if r.table_name == "invoices" and r.check_name not in ("unique", "relationships")}
    found = store.check_results().select("layer", "table_name", "check_name", "column_name", "severity", "failures", "passed")
    assert {tuple(r) for r in found.collect()} == wanted
    assert any(r[5] for r in wanted)
    # Sketches of months merge to those of all rows.
    paid = {(r.invoice_month, r.plan_name): r.paid_invoice_count for r in store.read("mrr_monthly").collect()}
    got = store.amount_quantiles(["invoice_month", "plan_name"], {"p50": 0.5})
    assert {(r.invoice_month, r.plan_name): r.n for r in got.collect()} == paid
    (whole,) = store.amount_quantiles([], {"low": 0.0, "high": 1.0}).collect()
    amounts = [r.amount_eur for r in store.read("classified").where("is_staged AND lower(trim(status)) = 'paid' AND NOT coalesce(is_after_end_date, false)").collect()]
    assert (whole.n, whole.low, whole.high) == (len(amounts), min(amounts), max(amounts))


@pytest.mark.parametrize("spread", ["even", "skewed", "two values"])
def test_error_of_merged_sketches(spark, spread):
    value = {"even": "id % 100003", "skewed": "cast(exp(rand(5) * 12) * 100 AS long)", "two values": "IF(id % 3 = 0, 5, 900)"}[spread]
    rows = spark.range(0, 120_000, 1, 6).selectExpr("cast(id % 4 AS int) AS g", "cast(id % 11 AS int) AS part", f"cast({value} AS decimal(18,2)) / 100 AS amount").selectExpr("g", "part", "cast(amount AS decimal(18,2)) AS amount").cache()
    shares = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    found = quantiles(merged(sketched(rows, ["g", "part"], "amount"), ["g"]), shares)
    worst = 0.0
    for r in share_below(rows, found, ["g"], "amount", list(shares)).collect():
        assert r.rows == 30_000
        for name, share in shares.items():
            worst = max(worst, r[f"{name}_below"] / r.rows - share, share - r[f"{name}_upto"] / r.rows)
    rows.unpersist()
    assert worst <= RANK_ERROR


def test_sketches_of_little(spark):
    rows = spark.createDataFrame([("a", Decimal("1.50")), ("a", None), ("b", None), (None, Decimal("-2.25"))], "g string, v decimal(18,2)")
    got = quantiles(sketched(rows, ["g"], "v"), {"middle": 0.5})
    assert {tuple(r) for r in got.collect()} == {("a", 1, Decimal("1.50")), (None, 1, Decimal("-2.25"))}
    assert sketched(rows.limit(0), ["g"], "v").collect() == []
