"""Billing tables derived from the TPC-H-like benchmark tables.

Customers, orders and line items become customers, subscriptions and invoices, one to one.
Arithmetic on the keys plants every kind of defect, so that all rules have rows to find.
The rules are listed in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.schemas import RAW
from ledgerline.sources.readers import Loader, conform


def project_customers(customer: DataFrame) -> DataFrame:
    """Some customers come twice: variant 1 is an exact copy, variant 2 an older record."""
    return customer.selectExpr(
        "c_custkey AS k",
        "c_name",
        "c_nationkey % 5 AS region",
        "explode(array_compact(array(0, IF(c_custkey % 50 = 1, 1, NULL),"
        " IF(c_custkey % 70 = 2, 2, NULL)))) AS variant",
    ).selectExpr(
        "concat('C', lpad(cast(k AS string), 7, '0')) AS customer_id",
        "IF(variant = 2, concat(c_name, ' (old)'), c_name) AS customer_name",
        """CASE WHEN k % 97 = 3 THEN 'not-an-email'
                WHEN k % 83 = 5 THEN concat(' user', k, '@example.com')
                WHEN k % 89 = 4 THEN NULL
                ELSE concat('user', k, '@example.com') END AS email""",
        """CASE WHEN k % 101 = 7 THEN NULL
                WHEN k % 103 = 8 THEN '  '
                WHEN k % 41 = 6 THEN ' de '
                ELSE elt(region + 1, 'DE', 'NL', 'FR', 'SE', 'PL') END AS country""",
        """CASE WHEN variant = 2 THEN date'2023-12-31'
                WHEN k % 107 = 9 THEN date'2999-03-15'
                WHEN k % 2 = 0 THEN date'2024-01-31'
                ELSE date'2025-06-01' END AS created_at""",
    )


def project_subscriptions(orders: DataFrame) -> DataFrame:
    return (
        orders.selectExpr(
            "o_orderkey AS k",
            "o_custkey AS owner",
            "cast(o_orderdate AS date) AS start_date",
            "CASE o_orderstatus WHEN 'F' THEN 'cancelled' WHEN 'O' THEN 'active' ELSE 'paused' END"
            " AS state",
            "CASE left(o_orderpriority, 1) WHEN '1' THEN 'scale' WHEN '2' THEN 'growth'"
            " WHEN '3' THEN 'growth' ELSE 'starter' END AS plan_name",
            "explode(array_repeat(true, IF(o_orderkey % 150 = 7, 2, 1))) AS copy",
        )
        .selectExpr(
            "concat('S', lpad(cast(k AS string), 8, '0')) AS subscription_id",
            """CASE WHEN k % 211 = 1 THEN 'C9999999'
                    WHEN owner % 47 = 9 THEN 'C9999998'
                    ELSE concat('C', lpad(cast(owner AS string), 7, '0')) END AS customer_id""",
            "plan_name",
            """CASE WHEN k % 199 = 2 THEN -99
                    WHEN k % 227 = 8 THEN NULL
                    WHEN plan_name = 'scale' THEN 299
                    WHEN plan_name = 'growth' THEN 99
                    ELSE 29 END AS monthly_price""",
            "start_date",
            """CASE WHEN state = 'cancelled' AND k % 61 = 5 THEN date_sub(start_date, 10)
                    WHEN state = 'cancelled' AND k % 3 = 0 THEN date_add(start_date, 45)
                    WHEN state = 'cancelled' THEN date_add(start_date, 400)
                    WHEN state = 'active' AND k % 223 = 6 THEN date_add(start_date, 30)
                    END AS end_date""",
            """CASE WHEN k % 53 = 3 THEN upper(state)
                    WHEN k % 59 = 4 THEN concat(state, ' ')
                    ELSE state END AS status""",
        )
    )


def project_invoices(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "concat('I', lpad(cast(l_orderkey AS string), 8, '0'), '-', l_linenumber) AS invoice_id",
        """IF((l_orderkey + l_linenumber) % 307 = 1, 'S99999999',
              concat('S', lpad(cast(l_orderkey AS string), 8, '0'))) AS subscription_id""",
        "cast(l_shipdate AS date) AS invoice_date",
        """CASE WHEN (l_orderkey + l_linenumber) % 257 = 3 THEN NULL
                WHEN (l_orderkey + l_linenumber) % 251 = 2 THEN cast(-99 AS decimal(12, 2))
                ELSE cast(l_extendedprice AS decimal(12, 2)) END AS amount""",
        """CASE WHEN l_suppkey % 20 = 0 THEN 'SEK'
                WHEN l_suppkey % 33 = 1 THEN 'USD'
                WHEN l_suppkey % 25 = 2 THEN ' eur '
                WHEN l_partkey % 191 = 5 THEN NULL
                ELSE 'EUR' END AS currency""",
        """CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'open'
                WHEN l_returnflag = 'R' THEN 'failed'
                WHEN l_partkey % 71 = 4 THEN 'PAID '
                ELSE 'paid' END AS status""",
    )


def project_invoice_changes(lineitem: DataFrame) -> DataFrame:
    """Two deliveries of changes to the projected invoices, the column ``delivery`` tells which.

    Some invoices get another amount and a later date, some a status, some are deleted, some deleted ones come back, and some are new.
    The second delivery holds some changes with lower numbers than the first.
    """
    changes = lineitem.selectExpr(
        "l_orderkey + l_linenumber AS j",
        "concat('I', lpad(cast(l_orderkey AS string), 8, '0'), '-', l_linenumber) AS invoice_id",
        "concat('S', lpad(cast(l_orderkey AS string), 8, '0')) AS subscription_id",
        "cast(l_shipdate AS date) AS invoice_date",
        "cast(l_extendedprice AS decimal(12, 2)) AS amount",
    )
    # Invoices without any change go before their rows are built.
    changed = changes.where("j % 40 = 7 OR j % 61 = 13 OR j % 97 = 11 OR j % 60 = 27")
    changes = changed.selectExpr(
        "*",
        """explode(array_compact(array(
             IF(j % 40 = 7, named_struct('delivery', 1, 'kind', 'moved', 'change_seq', 2L), NULL),
             IF(j % 61 = 13, named_struct('delivery', 1, 'kind', 'deleted', 'change_seq', 3L), NULL),
             IF(j % 97 = 11, named_struct('delivery', 1, 'kind', 'new', 'change_seq', 1L), NULL),
             IF(j % 80 = 7, named_struct('delivery', 2, 'kind', 'failed', 'change_seq', 4L), NULL),
             IF(j % 60 = 27, named_struct('delivery', 2, 'kind', 'late', 'change_seq', 1L), NULL),
             IF(j % 183 = 13, named_struct('delivery', 2, 'kind', 'back', 'change_seq', 5L), NULL)))) AS change""",
    )
    return changes.selectExpr(
        "IF(change.kind = 'new', concat('N', invoice_id), invoice_id) AS invoice_id",
        "subscription_id",
        "IF(change.kind = 'moved', date_add(invoice_date, 40), invoice_date) AS invoice_date",
        "cast(IF(change.kind = 'moved', amount + 10, amount) AS decimal(12, 2)) AS amount",
        "'EUR' AS currency",
        "IF(change.kind = 'failed', 'failed', 'paid') AS status",
        "change.change_seq AS change_seq",
        "change.kind = 'deleted' AS is_deleted",
        "change.delivery AS delivery",
    )


def project_snapshots(orders: DataFrame) -> DataFrame:
    """Eight snapshots of the projected subscriptions, 25 days apart.

    Subscriptions come in the first three, some are missing from one or from the last ones, change plan, price or
    status, or are only spelled otherwise; some come twice a day with different prices.
    """
    return (
        orders.selectExpr(
            "o_orderkey AS k",
            "concat('C', lpad(cast(o_custkey AS string), 7, '0')) AS customer_id",
            "CASE left(o_orderpriority, 1) WHEN '1' THEN 'scale' WHEN '2' THEN 'growth'"
            " WHEN '3' THEN 'growth' ELSE 'starter' END AS base_plan",
            "explode(sequence(0, 7)) AS s",
        )
        .where("s >= k % 3 AND NOT (k % 37 = 5 AND s = 3 + k % 4) AND NOT (k % 41 = 7 AND s >= 6)")
        .selectExpr("*", "IF(k % 11 = 3 AND s >= 2 + k % 5, 'scale', base_plan) AS plan_name", "explode(sequence(0, IF(k % 150 = 7, 1, 0))) AS copy")
        .selectExpr(
            "concat('S', lpad(cast(k AS string), 8, '0')) AS subscription_id",
            "customer_id",
            "plan_name",
            "cast(CASE plan_name WHEN 'scale' THEN 299 WHEN 'growth' THEN 99 ELSE 29 END"
            " + IF(k % 13 = 6 AND s >= 4, 10, 0) + copy AS decimal(12, 2)) AS monthly_price",
            """CASE WHEN k % 19 = 2 AND s >= 5 THEN 'cancelled'
                    WHEN k % 17 = 9 AND s IN (2, 5) THEN 'paused'
                    WHEN (k + s) % 23 = 4 THEN 'Active '
                    ELSE 'active' END AS status""",
            "date_add(date'2026-01-10', 25 * s) AS snapshot_date",
        )
    )


def project_rates(orders: DataFrame) -> DataFrame:
    """Rates of two currencies on some of the days with orders, now and then two for one day, and one that is unknown."""
    days = orders.selectExpr("cast(o_orderdate AS date) AS valid_from").groupBy("valid_from").count()
    day = days.selectExpr("valid_from", "count", "datediff(valid_from, date'1970-01-01') AS n")
    return day.selectExpr(
        "valid_from",
        """inline(array_compact(array(
             IF(n % 9 = 2, named_struct('currency', 'SEK', 'rate', cast(0.08 + count % 50 / 1000 AS decimal(12, 6))), NULL),
             IF(n % 18 = 2, named_struct('currency', ' sek', 'rate', cast(0.07 + count % 90 / 1000 AS decimal(12, 6))), NULL),
             IF(n % 45 = 11, named_struct('currency', 'SEK', 'rate', cast(NULL AS decimal(12, 6))), NULL),
             IF(n % 100 = 50 AND n % 700 < 400, named_struct('currency', 'USD', 'rate', cast(0.9 + count % 7 / 100 AS decimal(12, 6))), NULL))))""",
    ).select("currency", "valid_from", "rate")


def projected_billing(spark: SparkSession, directory: str) -> Loader:
    """Raw billing tables over the benchmark tables in ``directory``."""
    projections = {
        "customers": ("customer", project_customers),
        "subscriptions": ("orders", project_subscriptions),
        "invoices": ("lineitem", project_invoices),
    }

    def load(name: str) -> DataFrame:
        if name == "invoice_changes":
            return project_invoice_changes(spark.read.parquet(f"{directory}/lineitem.parquet"))
        if name in ("subscription_snapshots", "exchange_rates"):
            orders = spark.read.parquet(f"{directory}/orders.parquet")
            return project_snapshots(orders) if name == "subscription_snapshots" else project_rates(orders)
        table, project = projections[name]
        return conform(project(spark.read.parquet(f"{directory}/{table}.parquet")), RAW[name])

    return load
