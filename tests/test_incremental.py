"""Invoices kept up to date by changes give the tables of a full refresh."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import CONFIG, billing, customer, invoice, raw_table, subscription

from ledgerline.operators.merge import ChangedKeys, latest_per_key, merge_changes
from ledgerline.plans.incremental import CHANGES, IncrementalBilling
from ledgerline.sources.versions import Change, ConcurrentChange, IncompatibleSchema, compare_schemas, current_version, expire
from ledgerline.streaming.changes import apply_on_arrival

CUSTOMERS = [customer("C1"), customer("C1"), customer("C2", email="bad"), customer("C3")]
SUBSCRIPTIONS = [subscription("S1"), subscription("S2", "C2", "growth", "99.00", end="2024-06-10", status="cancelled"), subscription("S3", "C9"), subscription("S4", "C3", "scale", "299.00")]
BASE = [invoice(f"I{i}", f"S{1 + i % 5}", day=f"2024-{1 + i % 6:02d}-15", amount=None if i == 7 else f"{10 + i}.00", currency=["EUR", "SEK", "USD"][i % 3]) for i in range(24)]
BASE += [BASE[3], invoice("I3", "S1", day="2024-09-01"), invoice("I99", None, day=None), invoice(None, "S1")]


def change(i, seq, deleted=False, **values):
    return (*invoice(i, **values), seq, deleted)


CHANGED = [
    change("I1", 3, subscription_id="S1", day="2024-08-01", amount="500.00"),
    change("I1", 2, subscription_id="S4", day="2024-12-01", amount="7.00"),
    change("I2", 1, deleted=True, day="2024-03-15"),
    change("I4", 4, subscription_id="S4", day="2024-05-15", amount="1.00"),
    change("I4", 4, subscription_id="S4", day="2024-05-15", amount="2.00"),
    change("I5", 1, deleted=True, day=None),
    change("I5", 2, subscription_id="S1", day="2024-01-02", amount="3.00"),
    change("N1", 1, subscription_id="S1", day="2025-01-02", amount="11.00"),
    change("N2", 9, deleted=True, day="2026-01-01"),
    change("I99", 1, subscription_id="S4", day="2024-02-02", amount="9.00"),
    change(None, 1, subscription_id="S4", day="2024-07-02", amount="9.00"),
    change("I6", None, subscription_id="S1", day="2024-10-02", amount="0.01"),
]


def frames(spark, invoices):
    return {"customers": raw_table(spark, "customers", CUSTOMERS), "subscriptions": raw_table(spark, "subscriptions", SUBSCRIPTIONS), "invoices": raw_table(spark, "invoices", invoices)}


def changes(spark, rows):
    return spark.createDataFrame(rows, CHANGES)


def standing(base, changed):
    """The rows that stand, in plain Python."""
    nulls_low = lambda row: tuple((v is not None, v) for v in row)
    last = {}
    for *row, seq, deleted in [*[(*r, 0, False) for r in base], *changed]:
        rank = nulls_low((seq or 0, deleted, *row[1:]))
        if row[0] not in last or rank > last[row[0]][0]:
            last[row[0]] = (rank, tuple(row), deleted)
    return [row for _, row, deleted in last.values() if not deleted]


def tables(store):
    return {name: sorted(map(str, store.read(name).collect())) for name in ("classified", "mrr_monthly", "customer_ltv")}


def refreshed(spark, invoices, customers=CUSTOMERS, subscriptions=SUBSCRIPTIONS):
    full = billing(spark, customers, subscriptions, invoices)
    rows = {"classified": full.table("classified", "invoices"), **{n: full.table("marts", n) for n in ("mrr_monthly", "customer_ltv")}}
    return {name: sorted(map(str, r.collect())) for name, r in rows.items()}


def test_changes_in_any_order_and_again(spark, tmp_path):
    random.seed(1)
    wanted = standing(BASE, CHANGED)
    order = [*range(len(CHANGED)), *random.sample(range(len(CHANGED)), 4)]
    for run in range(1):
        random.shuffle(order)
        store = IncrementalBilling(spark, str(tmp_path / str(run)), CONFIG)
        store.load(frames(spark, BASE))
        for low in range(0, len(order), 6):
            store.apply(changes(spark, [CHANGED[k] for k in order[low : low + 6]]))
        assert sorted(map(str, map(tuple, store.invoices().collect()))) == sorted(map(str, wanted))
        assert tables(store) == refreshed(spark, wanted)


def test_only_touched_months_are_written(spark, tmp_path):
    store = IncrementalBilling(spark, str(tmp_path), CONFIG)
    store.load(frames(spark, BASE))
    before = store.version()
    # I1 lies in February and goes to August.
    assert store.apply(changes(spark, CHANGED[:1])) == ["2024-02-01", "2024-08-01"]
    after = store.version()
    assert after.number == before.number + 1
    for table in ("ledger", "classified", "revenue", "mrr_monthly"):
        old, new = before.tables[table].parts, after.tables[table].parts
        assert {m for m in old if new.get(m) != old[m]} <= {"2024-02-01", "2024-08-01"}
    assert store.apply(changes(spark, [])) == []
    assert store.version().number == after.number


def test_a_month_that_becomes_empty_goes(spark, tmp_path):
    store = IncrementalBilling(spark, str(tmp_path), CONFIG)
    store.load(frames(spark, [invoice("I1", day="2024-02-01"), invoice("I2", day="2024-03-01")]))
    store.apply(changes(spark, [change("I2", 1, day="2024-02-03")]))
    assert store.version().parts("ledger") == store.version().parts("mrr_monthly") == ["2024-02-01"]
    store.apply(changes(spark, [change("I1", 2, deleted=True), change("I2", 2, deleted=True, day="2024-02-03")]))
    assert store.invoices().count() == store.read("classified").count() == store.read("mrr_monthly").count() == 0
    assert [r.ltv_eur for r in store.read("customer_ltv").collect()] == [Decimal("0.00")] * 3


def test_new_dimensions_classify_their_months_again(spark, tmp_path):
    store = IncrementalBilling(spark, str(tmp_path), CONFIG)
    store.load(frames(spark, BASE))
    customers = [*CUSTOMERS, customer("C9")]
    subscriptions = [*SUBSCRIPTIONS[:1], subscription("S2", "C2", "growth", "99.00", end="2024-02-10", status="cancelled"), *SUBSCRIPTIONS[2:], subscription("S5")]
    new = frames(spark, BASE) | {"customers": raw_table(spark, "customers", customers), "subscriptions": raw_table(spark, "subscriptions", subscriptions)}
    store.replace_dimensions(new["customers"], new["subscriptions"])
    assert tables(store) == refreshed(spark, standing(BASE, []), customers, subscriptions)


def test_a_failed_change_leaves_the_old_version(spark, tmp_path):
    store = IncrementalBilling(spark, str(tmp_path), CONFIG)
    store.load(frames(spark, BASE))
    before = tables(store)
    wrong = spark.createDataFrame([("I1", "no date")], "invoice_id string, invoice_date string")
    with pytest.raises(Exception):
        store.apply(wrong)
    lost = Change(spark, str(tmp_path))
    lost.replace("mrr_monthly", store.read("mrr_monthly").limit(0))
    assert tables(store) == before


def test_deliveries_are_merged_as_they_arrive(spark, tmp_path):
    store = IncrementalBilling(spark, str(tmp_path / "store"), CONFIG)
    store.load(frames(spark, BASE))
    landing = str(tmp_path / "landing")
    for low in (8, 4):
        changes(spark, CHANGED[low : low + 4]).coalesce(1).write.mode("append").parquet(landing)
    for _ in range(2):
        apply_on_arrival(spark, landing, str(tmp_path / "checkpoint"), store, files_per_batch=1).awaitTermination()
    assert store.version().number == 3
    changes(spark, CHANGED[:4]).coalesce(1).write.mode("append").parquet(landing)
    apply_on_arrival(spark, landing, str(tmp_path / "checkpoint"), store).awaitTermination()
    assert store.version().number == 4
    # A lost checkpoint brings all files again.
    apply_on_arrival(spark, landing, str(tmp_path / "another"), store).awaitTermination()
    assert tables(store) == refreshed(spark, standing(BASE, CHANGED))


def test_unchanged_rows_are_not_shuffled_by_the_merge(spark, tmp_path):
    touched = spark.range(1000).selectExpr("cast(id as string) as invoice_id", "cast(id as double) as amount", "0L as change_seq", "false as is_deleted")
    few = touched.limit(3)
    plan = merge_changes(touched, few, "invoice_id", touched.columns)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti, BuildRight" in plan and plan.count("SortMergeJoin") == 0


def test_latest_per_key_needs_no_order(spark):
    rows = [("a", date(2024, 1, 1), 2, False), ("a", None, 2, False), ("a", date(2025, 1, 1), 1, False), (None, None, 1, True), (None, None, 0, False)]
    frame = spark.createDataFrame(rows, "k string, d date, change_seq long, is_deleted boolean")
    got = {r.k: tuple(r) for r in latest_per_key(frame.repartition(3), "k").collect()}
    assert got == {"a": rows[0], None: rows[3]}


def test_one_change_at_a_time(spark, tmp_path):
    first, second = Change(spark, str(tmp_path)), Change(spark, str(tmp_path))
    for c in (first, second):
        c.replace("t", spark.range(2))
    first.commit()
    with pytest.raises(ConcurrentChange):
        second.commit()
    assert current_version(spark, str(tmp_path)).read("t").count() == 2


def test_old_folders_go_when_no_record_lists_them(spark, tmp_path):
    root = str(tmp_path)
    for n in range(5):
        c = Change(spark, root)
        c.replace("t", spark.range(n, n + 1), touched=None)
        c.replace("u", spark.createDataFrame([(1, "a"), (n, "b")], "x int, p string"), part=F.col("p"), touched=["b"])
        c.commit()
    held = current_version(spark, root)
    gone = expire(spark, root)
    assert len([f for f in gone if f.startswith("t/")]) == 2
    assert [r.id for r in held.read("t").collect()] == [4]
    assert sorted(tuple(r) for r in held.read("u").collect()) == [(1, "a"), (4, "b")]
    assert expire(spark, root) == []


def test_schemas_of_several_versions_are_read_together(spark, tmp_path):
    root = str(tmp_path)
    first = Change(spark, root)
    first.replace("t", spark.createDataFrame([(1, "x", Decimal("1.5"), "m1"), (2, "y", None, "m2")], "a int, gone string, d decimal(4,2), m string"), part=F.col("m"))
    first.commit()
    second = Change(spark, root)
    second.replace("t", spark.createDataFrame([(1 << 40, Decimal("123456.789"), "new", "m2")], "a long, d decimal(9,3), b string, m string"), part=F.col("m"), touched=["m2"])
    second.commit()
    got = current_version(spark, root).read("t")
    assert dict(got.dtypes) == {"a": "bigint", "gone": "string", "d": "decimal(9,3)", "m": "string", "b": "string"}
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "x", Decimal("1.500"), "m1", None), (1 << 40, None, Decimal("123456.789"), "m2", "new")], key=str)
    third = Change(spark, root)
    with pytest.raises(IncompatibleSchema):
        third.replace("t", spark.createDataFrame([("no number", "m1")], "a string, m string"), part=F.col("m"), touched=["m1"])


def test_schema_difference():
    field = lambda name, kind: T.StructField(name, kind)
    old = T.StructType([field("a", T.IntegerType()), field("b", T.StringType())])
    new = T.StructType([field("c", T.DateType()), field("a", T.LongType())])
    found = compare_schemas(old, new)
    assert (found.added, found.removed, found.widened) == (["c"], ["b"], ["a"])
    assert found.merged.simpleString() == "struct<a:bigint,b:string,c:date>"
    with pytest.raises(IncompatibleSchema):
        compare_schemas(old, T.StructType([field("a", T.DoubleType())]))


def test_random_changes(spark, tmp_path):
    random.seed(11)
    for run in range(1):
        ids = [f"I{k}" for k in range(12)]
        row = lambda: (random.choice(ids), random.choice(["S1", "S2", "S4", "S7"]), date(2024, 1, 1) + timedelta(random.randrange(200)), Decimal(random.randrange(-2, 30)), random.choice(["EUR", "SEK", None]), random.choice(["paid", "open"]))
        base, changed = [row() for _ in range(10)], [(*row(), random.randrange(6), random.random() < 0.3) for _ in range(18)]
        store = IncrementalBilling(spark, str(tmp_path / str(run)), CONFIG)
        store.load(frames(spark, base))
        for low in range(0, 18, 9):
            store.apply(changes(spark, changed[low : low + 9]))
        assert tables(store) == refreshed(spark, standing(base, changed))


def test_a_delivery_too_large_for_a_broadcast_leaves_other_rows_where_they_are(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    touched = spark.range(5_000).selectExpr("IF(id = 0, NULL, cast(id as string)) as invoice_id", "cast(id as double) as amount", "0L as change_seq", "false as is_deleted")
    many = spark.range(0, 9_000, 3).selectExpr("IF(id = 0, NULL, cast(id as string)) as invoice_id", "-1d as amount", "IF(id % 2 = 0, 1L, -1L) as change_seq", "false as is_deleted")
    merged = merge_changes(touched, many, "invoice_id", touched.columns)
    assert "LeftAnti, BuildRight" in merged._jdf.queryExecution().executedPlan().toString()
    got = {r.invoice_id: r.amount for r in merged.collect()}
    wanted = {str(i): -1.0 if i % 6 == 0 or i >= 5_000 else float(i) for i in [*range(5_000), *range(5_001, 9_000, 3)]}
    wanted["None"] = wanted.pop("0")
    assert {str(k): v for k, v in got.items()} == wanted and merged.count() == len(wanted)
    # Two thirds of the rows have no changed key, and nearly all of them pass the filter by.
    keys = ChangedKeys(many, "invoice_id")
    assert keys.others(touched).count() > 3_000 and keys.of(keys.near(touched)).count() == 1_667


def test_only_changed_invoices_are_classified_again(spark, tmp_path, monkeypatch):
    from ledgerline.plans import classify

    store = IncrementalBilling(spark, str(tmp_path), CONFIG)
    store.load(frames(spark, BASE))
    seen, whole = [], classify.classify_invoices
    monkeypatch.setattr(classify, "classify_invoices", lambda rows, *rest: seen.append(rows.count()) or whole(rows, *rest))
    store.apply(changes(spark, CHANGED[:1]))
    monkeypatch.undo()
    assert seen == [1]
    assert tables(store) == refreshed(spark, standing(BASE, CHANGED[:1]))
