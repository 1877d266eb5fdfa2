"""Subscription history and book against plain Python."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.history import advance, intervals, one_per_day
from ledgerline.operators.lineage import cut_lineage
from ledgerline.plans.book import TRACKED, HistoryStore, SnapshotTooOld, book_mrr_monthly, subscription_history
from ledgerline.sources.versions import current_version

COLUMNS = ["plan", "price"]
SCHEMA = "id string, day date, plan string, price int"


def brute(rows):
    """Intervals of (id, day, plan, price)."""
    days = sorted({r[1] for r in rows if r[0] is not None and r[1] is not None})
    low = lambda v: tuple((x is not None, x) for x in v)
    state = {}
    for key, day, *values in rows:
        if key is not None and day is not None:
            state[key, day] = max(state.get((key, day), tuple(values)), tuple(values), key=low)
    found = []
    for key in {k for k, _ in state}:
        opened, held = None, None
        for day in days:
            now = state.get((key, day))
            if held is not None and now != held:
                found.append((key, *held, opened, day))
                held = None
            if now is not None and held is None:
                opened, held = day, now
        if held is not None:
            found.append((key, *held, opened, None))
    return sorted(map(str, found))


def random_rows(seed, days=9, keys=14):
    random.seed(seed)
    dates = sorted(random.sample([date(2024, 1, 1) + timedelta(d) for d in range(200)], days))
    rows = [(f"k{k}", d, random.choice(["a", "a", "a", "b", None]), random.choice([1, 1, 2, None])) for k in range(keys) for d in dates if random.random() < 0.8]
    return [*rows, *rows[:5], (rows[0][0], rows[0][1], "z", 0), (None, dates[0], "a", 1), ("k1", None, "a", 1)]


def collected(frame):
    return sorted(map(str, map(tuple, frame.collect())))


def test_intervals(spark):
    for seed in range(3):
        rows = random_rows(seed)
        assert collected(intervals(spark.createDataFrame(rows, SCHEMA), "id", "day", COLUMNS)) == brute(rows)


def test_no_snapshots(spark):
    assert intervals(spark.createDataFrame([], SCHEMA), "id", "day", COLUMNS).collect() == []


def test_snapshot_by_snapshot(spark):
    rows = random_rows(7, days=5)
    frame = spark.createDataFrame(rows, SCHEMA).cache()
    days = sorted({r[1] for r in rows if r[1] is not None})
    history = intervals(frame.where(F.col("day") == days[0]), "id", "day", COLUMNS)
    for day in days[1:]:
        history = cut_lineage(advance(history, frame.where(F.col("day") == day), F.lit(day), "id", COLUMNS))
    assert collected(history) == brute(rows)


def test_a_hot_subscription_is_summed_before_the_shuffle(spark):
    """Any number of rows of one key and day leave each task as one row."""
    frame = spark.range(0, 50_000, 1, 4).selectExpr("'hot' AS id", "date_add(date'2024-01-01', cast(id % 3 AS int)) AS day", "'a' AS plan", "cast(id % 7 AS int) AS price")
    found = one_per_day(frame, "id", "day", COLUMNS)
    assert [tuple(r) for r in found.orderBy("day").collect()] == [("hot", date(2024, 1, d), "a", 6) for d in (1, 2, 3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and plan.index("partial_max") > plan.index("Exchange")


def test_book_against_every_month(spark):
    random.seed(9)
    rows = []
    for k in range(60):
        for s in range(8):
            if random.random() < 0.85:
                price = random.choice([None, Decimal("0.00"), Decimal("-5.00"), Decimal("29.00"), Decimal("99.00")])
                rows.append((f"S{k}", "C1", random.choice(["Starter ", "growth", None]), price, random.choice(["active", "ACTIVE", "paused"]), date(2024, 1, 1) + timedelta(17 * s)))
    frame = spark.createDataFrame(rows, "subscription_id string, customer_id string, plan_name string, monthly_price decimal(12,2), status string, snapshot_date date")
    history = subscription_history(frame)
    months = [date(2024, m, 1) for m in range(1, 8)]
    held = history.collect()
    assert set(history.columns) == {"subscription_id", *TRACKED, "valid_from", "valid_to"}
    wanted = {}
    for month in months:
        for r in held:
            if r.status == "active" and (r.monthly_price or 0) > 0 and r.valid_from <= month and (r.valid_to is None or r.valid_to > month):
                n, total = wanted.get((r.plan_name, month), (0, 0))
                wanted[r.plan_name, month] = n + 1, total + r.monthly_price
    got = book_mrr_monthly(history, F.lit(months[-1])).collect()
    assert {(r.plan_name, r.book_month): (r.active_subscriptions, r.book_mrr_eur) for r in got if r.active_subscriptions} == wanted
    by_plan = {}
    for r in sorted(got, key=lambda r: r.book_month):
        before = by_plan.get(r.plan_name, 0)
        assert r.book_mrr_eur == before + r.gained_eur - r.lost_eur
        by_plan[r.plan_name] = r.book_mrr_eur
    assert len(got) == len({(r.plan_name, r.book_month) for r in got})


def test_history_kept_by_daily_snapshots(spark, tmp_path):
    random.seed(13)
    days = [date(2024, 1, 1) + timedelta(20 * s) for s in range(6)]
    rows = [(f"S{k}", "C1", random.choice(["growth", "Growth ", "scale"]), Decimal(random.choice([29, 99])), "active", d) for k in range(15) for d in days if random.random() < 0.8]
    frame = spark.createDataFrame([*rows, (None, "C", "scale", None, "active", days[0])], "subscription_id string, customer_id string, plan_name string, monthly_price decimal(12,2), status string, snapshot_date date").cache()
    store = HistoryStore(spark, str(tmp_path))
    on = lambda day: frame.where(F.col("snapshot_date") == day)
    for k, day in enumerate(days):
        before = current_version(spark, str(tmp_path))
        written = store.add(day, on(day))
        assert set(written) <= {"open", f"closed-{day:%Y-%m}"}
        after = current_version(spark, str(tmp_path))
        assert all(after.tables["history"].parts[p] == before.tables["history"].parts[p] for p in before.parts("history") if p not in ("open", f"closed-{day:%Y-%m}"))
        assert after.number == k + 1
    columns = ["subscription_id", *TRACKED, "valid_from", "valid_to"]
    assert collected(store.history().select(columns)) == collected(subscription_history(frame).select(columns))
    assert store.add(days[2], on(days[2])) == []
    with pytest.raises(SnapshotTooOld):
        store.add(days[0] + timedelta(1), on(days[0]))
    assert current_version(spark, str(tmp_path)).number == len(days)
    # A day without subscriptions closes all that is open.
    store.add(days[-1] + timedelta(5), frame.limit(0))
    assert store.history().where("valid_to IS NULL").count() == 0
    frame.unpersist()


def test_a_snapshot_is_shuffled_once_and_written_by_all_tasks(spark, tmp_path, settings):
    """The open part holds nearly all rows; one part is no reason for one task."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(0, 2_000, 1, 2).selectExpr("concat('S', id) AS subscription_id", "'C1' AS customer_id", "'growth' AS plan_name", "cast(id AS decimal(12,2)) AS monthly_price", "'active' AS status")
    store = HistoryStore(spark, str(tmp_path))
    for day in (date(2024, 1, 1), date(2024, 1, 2)):
        store.add(day, rows)
    folder, _ = current_version(spark, str(tmp_path)).tables["history"].parts["open"]
    assert len(list((tmp_path / folder).glob("*.parquet"))) == 4
    assert store.history().where("valid_to IS NULL AND valid_from = date'2024-01-01'").count() == 2_000
    held = store.history()
    after = advance(held, rows, F.lit(date(2024, 1, 3)), "subscription_id", TRACKED)
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
