"""One key, or one pile of equal rows, holds a third of the data or more."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from rows import CONFIG

from ledgerline.operators import dedupe
from ledgerline.operators.dedupe import first_per_key, rows_after_first
from ledgerline.operators.parents import attach_parent, without_parent
from ledgerline.plans import classify

N = 60_000


def final_plan(df):
    """Physical plan after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def ranked(df, key, order_by):
    rest = [c for c in df.columns if c != key and c not in order_by]
    window = Window.partitionBy(key).orderBy(*[F.asc_nulls_last(c) for c in [*order_by, *rest]])
    return df.withColumn("rank", F.row_number().over(window))


@pytest.mark.parametrize("hot", ["copies", "versions", "null key"])
def test_dedupe_agrees_with_a_plain_ranking(spark, hot, monkeypatch):
    monkeypatch.setattr(dedupe, "COPIES_PER_TASK", 1000)
    third = F.col("id") % 3 == 0
    key = F.lit(None) if hot == "null key" else F.lit("hot")
    other = F.concat(F.lit("k"), (F.col("id") % 15_000).cast("string"))
    version = F.lit(1) if hot == "copies" else F.col("id") % 7_001
    df = spark.range(N).select(
        F.when(third, key).otherwise(other).alias("k"),
        F.when(F.col("id") % 11 == 0, None).otherwise(version).alias("a"),
        F.when(third, F.lit("x")).otherwise((F.col("id") % 5).cast("string")).alias("b"),
    )
    expected = ranked(df, "k", ["a"])
    kept = first_per_key(df, "k", ["a"])
    rest = rows_after_first(df, "k", ["a"])
    assert kept.columns == rest.columns == df.columns
    assert kept.exceptAll(expected.where("rank = 1").drop("rank")).count() == 0
    assert kept.count() == df.select("k").distinct().count()
    assert rest.exceptAll(expected.where("rank > 1").drop("rank")).count() == 0
    assert kept.count() + rest.count() == N


def test_copies_of_one_row_are_written_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "COPIES_PER_TASK", 500)
    df = spark.range(20_000).select(F.lit("same").alias("k"), F.lit(1).alias("a"))
    rest = rows_after_first(df, "k", ["a"])
    per_task = rest.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 19_999
    assert len(per_task) > 1


def test_first_row_is_chosen_on_the_map_side(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("a"))
    plan = final_plan(first_per_key(df, "k", ["a"]))
    assert "partial_min" in plan


def skewed(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )


def hot_children(spark, key):
    return spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(key))
        .otherwise(F.concat(F.lit("p"), (F.col("id") % 20_000).cast("string")))
        .alias("fk"),
        F.col("id").alias("x"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )


def parents(spark):
    """Unique parents out of an aggregation on their key, as the dedupe makes them."""
    rows = spark.range(40_000).select(
        F.concat(F.lit("p"), (F.col("id") % 20_000).cast("string")).alias("fk"),
        F.col("id").alias("v"),
    )
    return first_per_key(rows, "fk", ["v"])


@pytest.mark.parametrize("key", ["p7", "nowhere", None])
def test_hot_foreign_key_is_split(spark, settings, key):
    skewed(settings)
    joined = attach_parent(hot_children(spark, key), parents(spark), "fk", ["v"])
    totals = joined.agg(F.count("x"), F.count("v"), F.sum("x"))
    assert "skew=true" in final_plan(totals)
    matched = 300_000 if key == "p7" else 200_000
    assert tuple(totals.first()) == (300_000, matched, sum(range(300_000)))


def test_hot_orphan_is_split_in_the_relationship_check(spark, settings):
    skewed(settings)
    found = without_parent(hot_children(spark, "nowhere"), parents(spark), "fk")
    totals = found.agg(F.count("x"), F.countDistinct("fk"))
    assert "skew=true" in final_plan(totals)
    assert tuple(totals.first()) == (100_000, 1)


def test_hot_subscription_flows_through_the_invoices(spark, settings):
    """A third of all invoices belongs to one subscription."""
    skewed(settings)
    subscriptions = spark.range(2_000).select(
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("subscription_id"),
        F.concat(F.lit("C"), (F.col("id") % 100).cast("string")).alias("customer_id"),
        F.lit("growth").alias("plan_name"),
        F.lit(date(2024, 6, 30)).alias("end_date"),
    )
    invoices = spark.range(0, 300_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("invoice_id"),
        F.concat(
            F.lit("S"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2_000).cast("string")
        ).alias("subscription_id"),
        F.date_add(F.lit(date(2024, 6, 29)), (F.col("id") % 4).cast("int")).alias("invoice_date"),
        F.lit(Decimal("10.00")).cast("decimal(12,2)").alias("amount"),
        F.lit("EUR").alias("currency"),
        F.lit("paid").alias("status"),
    )
    classified = classify.classify_invoices(invoices, subscriptions, CONFIG)
    late = classified.groupBy("is_after_end_date").agg(F.count("is_staged").alias("n"))
    assert "skew=true" in final_plan(late)
    assert {r.is_after_end_date: r.n for r in late.collect()} == {True: 150_000, False: 150_000}
