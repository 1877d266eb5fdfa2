"""The whole refresh: load, check, classify, check, build the marts, check, publish."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ledgerline.config import BillingConfig
from ledgerline.plans import checks, descriptions, quarantine, spikes, staging
from ledgerline.plans.billing import ENTITIES, MARTS, Billing, Loader
from ledgerline.plans.marts import described
from ledgerline.schemas import RAW
from ledgerline.session import build_session
from ledgerline.sources.readers import conform, csv_exports
from ledgerline.sources.reconcile import reconcile_counts, row_counts
from ledgerline.sources.writers import Refresh, commit_together, namespace_of, published_tables, published_version

#: Runs whose counts per quarantine reason are kept.
RUNS_KEPT = 100


class LoadMismatch(Exception):
    """The loaded tables do not have as many rows as the source."""


class ChecksFailed(Exception):
    """Checks of severity "error" found failing rows."""

    def __init__(self, failed: Sequence[Row]):
        self.failed = list(failed)
        super().__init__(
            "; ".join(
                f"{r.layer}.{r.table_name} {r.check_name}({r.column_name}): {r.failures}"
                for r in self.failed
            )
        )


def load_raw(refresh: Refresh, source: Loader) -> dict[str, DataFrame]:
    """Copy the source tables unchanged; row counts that do not agree are an error."""
    loaded = {name: refresh.write(name, descriptions.described(conform(source(name), RAW[name]), descriptions.RAW[name])) for name in ENTITIES}
    counts = reconcile_counts(
        row_counts({name: source(name) for name in ENTITIES}), row_counts(loaded)
    )
    wrong = counts.where("NOT matches").collect()  # at most one row per table
    if wrong:
        raise LoadMismatch(
            "; ".join(f"{r.table_name}: {r.source_rows} != {r.loaded_rows}" for r in wrong)
        )
    return loaded


def publish_layers(spark: SparkSession, config: BillingConfig) -> None:
    """Views ``staging.*`` and ``quarantine.*`` of the catalog, over those of ``classified``."""
    for layer in ("staging", "quarantine"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace_of(layer)}")
    for name in ENTITIES:
        views = {
            "staging": (staging.columns(name, config), staging.CONDITION, descriptions.STAGING[name]),
            "quarantine": (quarantine.columns(name), quarantine.CONDITION, descriptions.QUARANTINE[name]),
        }
        for layer, (columns, condition, comments) in views.items():
            named = descriptions.view_columns([c.split(" AS ")[-1] for c in columns], comments)
            spark.sql(
                f"CREATE OR REPLACE VIEW {namespace_of(layer)}.{name} ({named}) AS SELECT {', '.join(columns)}"
                f" FROM {namespace_of('classified')}.{name} WHERE {condition}"
            )


def reason_history(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """Number of the last published run, 0 before the first, and the counts per reason of the runs kept."""
    _, tables = published_version(spark, namespace_of("monitor"), root)
    if "reason_history" not in tables:
        return 0, spark.createDataFrame([], spikes.HISTORY)
    history = published_tables(spark, namespace_of("monitor"), root)("reason_history")
    return history.agg(F.max("run")).first()[0] or 0, history


def run_pipeline(
    spark: SparkSession,
    source: Loader,
    root: str,
    config: BillingConfig,
    stop_on_error: bool = True,
) -> list[Row]:
    """Refresh all layers under ``root`` and return the check results, one row per check.

    The classified tables are written once; staging and quarantine are views of the catalog over them. A
    failed check of severity "error" stops the run before the next layer is built; raw, classified and
    mart tables become current together at the end, or stay as they were. A warning is only recorded. Failing raw rows go to ``audit``. The counts
    of every quarantine reason are compared with those of earlier published runs and kept with them in ``monitor``.
    """
    results: list[Row] = []

    def check(layer: str) -> None:
        found = checks.layer_results(billing, layer).collect()  # one row per check
        results.extend(found)
        failed = [r for r in found if r.severity == checks.ERROR and not r.passed]
        if failed and stop_on_error:
            raise ChecksFailed(failed)

    loaded = Refresh(spark, namespace_of("raw"), root)
    raw = load_raw(loaded, source)
    classified = Refresh(spark, namespace_of("classified"), root)
    billing = Billing(raw.__getitem__, config, keep=classified.write)

    audit = Refresh(spark, namespace_of("audit"), root)
    for name, rows in checks.stored_failures(billing).items():
        audit.write(name, rows)
    audit.commit()
    check("raw")

    check("staging")
    check("quarantine")
    for layer in ("staging", "quarantine"):
        for name in ENTITIES:
            billing.table(layer, name).createOrReplaceTempView(f"{layer}_{name}")

    marts = Refresh(spark, namespace_of("marts"), root)
    for name in MARTS:
        rows = described(name, billing.table("marts", name))
        billing.set_table("marts", name, marts.write(name, rows))
    check("marts")
    last, earlier = reason_history(spark, root)
    counts = spikes.counts_of_run({n: billing.table("classified", n) for n in ENTITIES}, last + 1)
    monitor = Refresh(spark, namespace_of("monitor"), root)
    history = monitor.write("reason_history", spikes.recent(earlier.unionByName(counts), last + 1, RUNS_KEPT))
    results.extend(spikes.spike_results(history, last + 1, ENTITIES).collect())  # one row per table
    commit_together(loaded, classified, marts, monitor)
    publish_layers(spark, config)
    return results


def main() -> None:
    parser = argparse.ArgumentParser(description="Refresh the billing warehouse from CSV exports.")
    parser.add_argument("exports", help="folder with raw_customers.csv and the other exports")
    parser.add_argument("root", help="folder of the warehouse, reachable by all executors")
    parser.add_argument("--as-of", type=date.fromisoformat, help="reporting day, default today")
    parser.add_argument("--report-only", action="store_true", help="do not stop on failed checks")
    options = parser.parse_args()
    spark = build_session("billing-refresh")
    results = run_pipeline(
        spark,
        csv_exports(spark, options.exports),
        options.root,
        BillingConfig(as_of=options.as_of),
        stop_on_error=not options.report_only,
    )
    for r in results:
        if not r.passed:
            place = f"{r.layer}.{r.table_name}"
            print(f"{r.severity}: {place} {r.check_name}({r.column_name}) {r.failures}")
