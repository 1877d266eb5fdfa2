"""Time the registered queries; prints one JSON line.

Every query is planned and executed twice over all rows without collecting them, and the
second run counts: the first one pays for code generation and class loading.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

import pyspark

from ledgerline.queries import QUERIES, run
from ledgerline.session import build_session

HEADLINE = [
    "load_raw_invoices",
    "row_count_reconcile",
    "stg_customers",
    "stg_subscriptions",
    "stg_invoices",
    "qrt_customers",
    "qrt_subscriptions",
    "qrt_invoices",
    "mrr_monthly",
    "customer_ltv",
    "churn_monthly",
    "dedupe_subscriptions",
    "duplicate_subscriptions",
    "fx_normalize",
    "normalize_strings",
    "quarantine_reason_counts",
    "customer_revenue",
    "customer_status_mix",
    "check_unique_stg_invoices",
    "check_relationships_stg_invoices",
    "check_planted_defects",
    "check_silent_drops",
    "check_summary",
    "profile_grain",
    "profile_duplicate_billing",
    "profile_price_mismatch",
    "revenue_share_by_plan",
    "top_countries",
    "ltv_distribution",
]


def main(names: list[str]) -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cores}]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cores,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            run(name, spark, directory).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", directory)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else directory,
                "spark": pyspark.__version__,
                "cores": int(cores),
                "shuffle_partitions": int(cores),
            }
        )
    )


if __name__ == "__main__":
    chosen = sys.argv[1:]
    main(list(QUERIES) if chosen == ["all"] else chosen or HEADLINE)
