"""The invoice tables kept up to date by changes: only months that a change touches are classified and summed again.

Tables: ``ledger`` (the last change of every invoice, deletions included), ``classified``, ``revenue`` (sums per
month, customer and plan), ``mrr_monthly``, ``check_counts`` and ``amount_sketches`` (sketches of paid amounts) in months; ``customers`` and ``subscriptions`` (classified) and
``customer_ltv`` whole. All are made current by one record, so no reader sees invoices of one change beside marts of another.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.config import BillingConfig
from ledgerline.functions.dates import month_of
from ledgerline.operators.lineage import cut_lineage
from ledgerline.operators.merge import CHANGE_SEQ, IS_DELETED, ChangedKeys, as_changes, latest_per_key, live, merge_apart, parts_of_keys
from ledgerline.operators.quantiles import merged, quantiles, sketched
from ledgerline.plans import check_state, classify, marts, staging
from ledgerline.schemas import MART_MONEY, RAW, RAW_INVOICES
from ledgerline.sources.readers import conform
from ledgerline.sources.versions import NO_VALUE, Change, Version, current_version

KEY = "invoice_id"
MONTH = "trunc(invoice_date, 'month')"
CHANGES = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in RAW_INVOICES], T.StructField(CHANGE_SEQ, T.LongType()), T.StructField(IS_DELETED, T.BooleanType())])


def conform_changes(rows: DataFrame) -> DataFrame:
    """Change rows with the ledger's columns and types; a missing number is the lowest, a missing mark no deletion."""
    given = set(rows.columns)
    marks = {CHANGE_SEQ: F.coalesce(F.col(CHANGE_SEQ) if CHANGE_SEQ in given else F.lit(None), F.lit(0)), IS_DELETED: F.coalesce(F.col(IS_DELETED) if IS_DELETED in given else F.lit(None), F.lit(False))}
    return rows.withColumns(marks).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CHANGES])


def revenue_by_month(classified: DataFrame) -> DataFrame:
    """Paid revenue per month, customer and plan: sums that add up to every mart."""
    return marts.paid_invoices(classified).groupBy("invoice_month", "customer_id", "plan_name").agg(F.sum("amount_eur").cast(MART_MONEY).alias("amount_eur"), F.count(F.lit(1)).alias("invoices"))


def mrr_of(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy("invoice_month", "plan_name").agg(F.sum("invoices").alias("paid_invoice_count"), F.sum("amount_eur").cast(MART_MONEY).alias("mrr_eur"))


class IncrementalBilling:
    """One change at a time; every method that writes returns the months it wrote."""

    def __init__(self, spark: SparkSession, root: str, config: BillingConfig):
        self.spark, self.root, self.config = spark, root, config

    def version(self) -> Version:
        return current_version(self.spark, self.root)

    def read(self, table: str) -> DataFrame:
        return self.version().read(table)

    def invoices(self) -> DataFrame:
        """The raw invoices that stand."""
        return live(self.read("ledger"))

    def load(self, raw: Mapping[str, DataFrame]) -> list[str]:
        """Start from full tables: of several rows of an invoice the largest one stands."""
        change = Change(self.spark, self.root)
        self._dimensions(change, raw["customers"], raw["subscriptions"])
        ledger = latest_per_key(as_changes(conform(raw["invoices"], RAW["invoices"])), KEY)
        change.replace("ledger", conform_changes(ledger), F.expr(MONTH))
        return self._rebuild(change, None)

    def apply(self, changes: DataFrame) -> list[str]:
        """Upsert invoices: columns of the raw table, ``change_seq`` and ``is_deleted``.

        A key's highest change number stands, so changes may come in any order and again. Touched months are those
        of the changes and those that hold the changed invoices now, which may have another date. Without rows nothing happens.
        Other rows of these months are passed on as they lie, in the ledger and classified; changed ones are classified.
        """
        changes = cut_lineage(latest_per_key(conform_changes(changes), KEY))
        change = Change(self.spark, self.root)
        keys = ChangedKeys(changes, KEY)
        ledger = keys.near(change.now.read("ledger", schema=CHANGES).select(KEY, "invoice_date"))
        months = changes.select(F.expr(MONTH).alias("part")).unionByName(parts_of_keys(ledger, changes, KEY, MONTH)).distinct()
        touched = _names(months)
        if not touched:
            return []
        passed, beside, changed = merge_apart(change.now.read("ledger", touched, CHANGES), changes, keys, CHANGES.names)
        change.replace("ledger", beside.unionByName(changed), F.expr(MONTH), touched, passed=passed)
        return self._rebuild(change, touched, keys, changed)

    def replace_dimensions(self, customers: DataFrame, subscriptions: DataFrame) -> list[str]:
        """New full tables of customers and subscriptions: months with invoices of a changed subscription are classified again."""
        change = Change(self.spark, self.root)
        old = staging.stage_subscriptions(change.now.read("subscriptions"))
        self._dimensions(change, customers, subscriptions)
        new = staging.stage_subscriptions(change.now.read("subscriptions"))
        columns = ["subscription_id", "customer_id", "plan_name", "end_date"]
        before, now = old.select(*columns), new.select(*columns)
        changed = before.exceptAll(now).unionByName(now.exceptAll(before)).select("subscription_id")
        ledger = change.now.read("ledger")
        return self._rebuild(change, _names(parts_of_keys(ledger, changed, "subscription_id", MONTH)))

    def check_results(self) -> DataFrame:
        """Results of the row checks on invoices, from the counts of all months."""
        return check_state.results(self.read("check_counts"))

    def amount_quantiles(self, by: list[str], shares: dict[str, float]) -> DataFrame:
        """Quantiles of paid amounts by month, by plan, by both or over all, from the sketches of months and plans."""
        return quantiles(merged(self.read("amount_sketches"), by), shares)

    def _dimensions(self, change: Change, customers: DataFrame, subscriptions: DataFrame) -> None:
        judged = classify.classify_customers(conform(customers, RAW["customers"]), self.config)
        change.replace("customers", judged)
        staged = staging.stage_customers(change.now.read("customers"))
        change.replace("subscriptions", classify.classify_subscriptions(conform(subscriptions, RAW["subscriptions"]), staged))

    def _rebuild(self, change: Change, touched: list[str] | None, keys: ChangedKeys | None = None, changed: DataFrame | None = None) -> list[str]:
        """Classify and sum the touched months, all for None, and commit. With ``keys`` only their rows are classified, ``changed``."""
        now = change.now
        subscriptions = staging.stage_subscriptions(now.read("subscriptions"))
        ledger = now.read("ledger", touched, CHANGES) if keys is None else changed
        rows, passed = classify.classify_invoices(live(ledger), subscriptions, self.config), None
        if keys is not None:
            held = now.read("classified", touched, rows.schema)
            rows, passed = rows.unionByName(keys.beside(keys.near(held))), keys.others(held)
        written = change.replace("classified", rows, F.expr(MONTH), touched, passed=passed)
        month = month_of(F.col("invoice_month"))
        change.replace("revenue", revenue_by_month(now.read("classified", touched, rows.schema)), month, touched)
        classified = now.read("classified", touched, rows.schema)
        change.replace("check_counts", check_state.invoice_check_counts(classified, self.config), F.col("part"), touched)
        paid = marts.paid_invoices(classified)
        change.replace("amount_sketches", sketched(paid, ["invoice_month", "plan_name"], "amount_eur"), month, touched)
        revenue = now.read("revenue", touched)
        change.replace("mrr_monthly", mrr_of(revenue), month, touched)
        change.replace("customer_ltv", self._ltv(now))
        change.commit()
        return written if touched is None else sorted(touched)

    def _ltv(self, now: Version) -> DataFrame:
        """From the sums of all months, not from invoices."""
        customers = staging.stage_customers(now.read("customers"))
        subscriptions = staging.stage_subscriptions(now.read("subscriptions"))
        per_plan = now.read("revenue").groupBy("customer_id", "plan_name").agg(F.sum("amount_eur").alias("amount"), F.sum("invoices").alias("invoices"))
        return marts.ltv_of(customers, subscriptions, marts.revenue_of_plans(per_plan))


def _names(months: DataFrame) -> list[str]:
    """Names of parts; there are as many as months."""
    return sorted(r.part for r in months.select(F.coalesce(F.col("part").cast("string"), F.lit(NO_VALUE)).alias("part")).distinct().collect())
