"""Readers, reconciliation, refresh writes and the projection."""

from datetime import date
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.plans.billing import ENTITIES
from ledgerline.schemas import RAW
from ledgerline.sources.projection import projected_billing
from ledgerline.sources.readers import (
    catalog_tables,
    conform,
    csv_exports,
    date_slices,
    jdbc_options,
    jdbc_tables,
    read_csv,
    read_parquet,
    slices_between,
    split_request,
)
from ledgerline.sources.reconcile import reconcile_counts, row_counts
from ledgerline.sources import writers
from ledgerline.sources.writers import Refresh, namespace_of, publish_views, published_tables

INVOICES = (
    "invoice_id,subscription_id,invoice_date,amount,currency,status\r\n"
    "I1,S1,2024-02-01,29.0,EUR,PAID \r\n"
    "I2,S1,2024-03-01,,EUR,paid\r\n"
    'I3,"S1",2024-04-01,-99.0,"",open\r\n'
    'I4,"S,1 ""x""",2024-04-01,5,é,open\r\n'
)


def test_csv_blanks_quotes_line_ends_and_types(spark, tmp_path):
    (tmp_path / "raw_invoices.csv").write_bytes(INVOICES.encode())
    rows = read_csv(spark, str(tmp_path / "raw_invoices.csv"), RAW["invoices"])
    assert [f.dataType for f in rows.schema] == [f.dataType for f in RAW["invoices"]]
    assert [tuple(r) for r in rows.collect()] == [
        ("I1", "S1", date(2024, 2, 1), Decimal("29.00"), "EUR", "PAID "),
        ("I2", "S1", date(2024, 3, 1), None, "EUR", "paid"),
        ("I3", "S1", date(2024, 4, 1), Decimal("-99.00"), None, "open"),
        ("I4", 'S,1 "x"', date(2024, 4, 1), Decimal("5.00"), "é", "open"),
    ]
    assert csv_exports(spark, str(tmp_path))("invoices").count() == 4


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "created_at,unused,email,customer_id,country,customer_name\n"
        "2024-01-01,x,a@b.c,C1,,Ann\n"
    )
    row = read_csv(spark, str(tmp_path / "c.csv"), RAW["customers"]).first()
    assert tuple(row) == ("C1", "Ann", "a@b.c", None, date(2024, 1, 1))


def test_csv_line_breaks_need_multi_line(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        'customer_id,customer_name,email,country,created_at\nC1,"An\nn",a@b.c,DE,2024-01-01\n'
    )
    row = read_csv(spark, str(tmp_path / "c.csv"), RAW["customers"], multi_line=True).first()
    assert row.customer_name == "An\nn"


def test_bad_values_fail_the_load(spark, tmp_path):
    (tmp_path / "raw_invoices.csv").write_bytes(INVOICES.replace("29.0", "lots").encode())
    rows = read_csv(spark, str(tmp_path / "raw_invoices.csv"), RAW["invoices"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rows.collect()


def test_parquet_scan_gets_columns_and_filters(spark, tmp_path):
    path = str(tmp_path / "invoices")
    (tmp_path / "raw_invoices.csv").write_bytes(INVOICES.encode())
    csv_exports(spark, str(tmp_path))("invoices").write.parquet(path)
    rows = read_parquet(spark, path, RAW["invoices"]).where("amount > 0").select("invoice_id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(amount,0" in plan
    assert "ReadSchema: struct<invoice_id:string,amount:decimal(12,2)>" in plan


def test_jdbc_asks_for_the_wanted_columns_only():
    options = jdbc_options("jdbc:db://host/billing", "raw_customers", RAW["customers"])
    assert options["dbtable"] == (
        "(SELECT customer_id, customer_name, email, country, created_at FROM raw_customers) AS extract"
    )
    assert options["fetchsize"] == "10000"


def test_jdbc_slices_become_read_tasks():
    calls = []

    class Reader:
        def jdbc(self, *args, **kwargs):
            calls.append((args, kwargs))
            raise RuntimeError("no database in the tests")

    class Session:
        read = Reader()

    load = jdbc_tables(
        Session(), "jdbc:x", {"invoices": ["d < '2025-01-01'", "d >= '2025-01-01'"]}, {"user": "u"}
    )
    for name in ("invoices", "customers"):
        with pytest.raises(RuntimeError):
            load(name)
    (url, table), options = calls[0]
    assert url == "jdbc:x" and "FROM raw_invoices)" in table
    assert options["predicates"] == ["d < '2025-01-01'", "d >= '2025-01-01'"]
    assert options["properties"] == {"user": "u", "fetchsize": "10000"}
    assert "predicates" not in calls[1][1]


class InProcess:
    """Answers the requests of a JDBC reader from views of the session, and notes them. No database is asked."""

    def __init__(self, spark):
        self.spark, self.requests, self.read = spark, [], self

    def jdbc(self, url, table, predicates=None, properties=None):
        self.requests.append((table, predicates, properties))
        rows = [self.spark.sql(f"SELECT * FROM {table} WHERE {p}") for p in predicates or ["1 = 1"]]
        return reduce(DataFrame.unionByName, rows)


def test_the_database_is_asked_for_equal_slices(spark):
    days = ["2024-03-01"] * 500 + [f"2024-{m:02d}-{d:02d}" for m in range(1, 13) for d in range(1, 28)] + [None] * 7
    rows = spark.createDataFrame([(f"I{k}", "S'1", d) for k, d in enumerate(days)], "i string, s string, d string")
    rows.selectExpr("i AS invoice_id", "s AS subscription_id", "to_date(d) AS invoice_date", "1.0 AS amount", "'EUR' AS currency", "'paid' AS status").createOrReplaceTempView("raw_invoices")
    database = InProcess(spark)
    loaded = jdbc_tables(database, "jdbc:x", properties={"user": "u"}, tasks=6)("invoices")
    (asked, none, given), (table, slices, _) = database.requests
    assert asked == split_request("raw_invoices", "invoice_date", 6) and none is None and given == {"user": "u"}
    assert "FROM raw_invoices)" in table
    assert sorted(map(str, loaded.collect())) == sorted(map(str, conform(spark.table("raw_invoices"), RAW["invoices"]).collect()))
    # The hot day fills stretches of its own and is one slice; the others hold a sixth of the rows or less.
    sizes = [spark.table("raw_invoices").where(p).count() for p in slices]
    assert sum(sizes) == len(days) and len(slices) >= 4
    assert sorted(sizes)[-2] <= len(days) / 6 + 1 and max(sizes) <= 500 + len(days) / 6 + 1


def test_split_points_are_kept_in_the_order_of_the_database(spark):
    """A collation may put b before A; comparing here would lose rows."""
    assert slices_between("c", ["a", "b", "b", "A", "O'x"]) == ["c < 'b'", "c >= 'b' AND c < 'A'", "c >= 'A' AND c < 'O''x'", "c >= 'O''x'", "c IS NULL"]
    assert slices_between("n", [1, Decimal("2.5")]) == ["n < 2.5", "n >= 2.5", "n IS NULL"]
    assert slices_between("c", ["a", "a"]) == slices_between("c", []) == []
    spark.createDataFrame([], RAW["customers"]).createOrReplaceTempView("raw_customers")
    database = InProcess(spark)
    assert jdbc_tables(database, "jdbc:x")("customers").count() == 0
    assert database.requests[1][1] is None
    jdbc_tables(database, "jdbc:x", tasks=1)("customers")
    assert len(database.requests) == 3


def test_date_slices_meet_every_row_once(spark):
    slices = date_slices("invoice_date", date(2024, 11, 15), date(2025, 2, 1))
    assert len(slices) == 7  # four months, earlier, later, without a date
    days = ["1999-01-01", "2024-10-31", "2024-11-01", "2024-12-31", "2025-01-01", "2025-02-28", "2025-03-01", None]
    rows = spark.createDataFrame([(d,) for d in days], "d string").selectExpr("d", "to_date(d) AS invoice_date")
    met = [r.d for s in slices for r in rows.where(s).collect()]
    assert sorted(met, key=str) == sorted(days, key=str)
    assert len(date_slices("d", date(2024, 1, 1), date(2024, 12, 31), months=6)) == 5
    with pytest.raises(ValueError):
        date_slices("d", date(2024, 2, 1), date(2024, 1, 31))


def test_reconcile_names_every_difference(spark):
    counts = "table_name string, row_count long"
    source = spark.createDataFrame([("customers", 3), ("invoices", 5), ("lost", 1)], counts)
    loaded = spark.createDataFrame([("customers", 3), ("invoices", 4), ("new", 0)], counts)
    rows = {
        r.table_name: (r.source_rows, r.loaded_rows, r.matches)
        for r in reconcile_counts(source, loaded).collect()
    }
    assert rows == {
        "customers": (3, 3, True),
        "invoices": (5, 4, False),
        "lost": (1, None, False),
        "new": (None, 0, False),
    }


def test_namespaces_are_not_prefixed():
    assert namespace_of("marts") == "marts"
    assert namespace_of(" raw ") == "raw"
    assert namespace_of(None) == "analytics"
    assert namespace_of(None, "other") == "other"


def test_refresh_shows_all_tables_or_none(spark, tmp_path):
    def values(*numbers):
        return spark.createDataFrame([(n,) for n in numbers], "n int")

    def seen(name):
        return sorted(r[0] for r in spark.table(f"refresh_test.{name}").collect())

    root = str(tmp_path)
    first = Refresh(spark, "refresh_test", root)
    assert first.write("a", values(1, 2)).count() == 2
    first.write("b", values(3))
    with pytest.raises(AnalysisException):
        spark.table("refresh_test.a").collect()
    first.commit()
    assert (seen("a"), seen("b")) == ([1, 2], [3])

    failed = Refresh(spark, "refresh_test", root)
    failed.write("a", values(7))
    with pytest.raises(Exception, match="boom"):
        failed.write("b", values(8).select(F.raise_error(F.lit("boom")).cast("int").alias("n")))
    assert (seen("a"), seen("b")) == ([1, 2], [3])

    second = Refresh(spark, "refresh_test", root)
    second.write("a", values())
    second.write("b", values(4, 5))
    second.commit()
    assert (seen("a"), seen("b")) == ([], [4, 5])

    evolved = Refresh(spark, "refresh_test", root)
    evolved.write("a", spark.createDataFrame([(1, "x")], "n int, extra string"))
    evolved.commit()
    assert spark.table("refresh_test.a").columns == ["n", "extra"]
    assert sorted(p.name for p in (tmp_path / "refresh_test" / "b").iterdir()) == ["0", "1"]
    assert catalog_tables(spark, "refresh_test")("b").count() == 2


def test_publish_that_breaks_off_between_two_tables(spark, tmp_path, monkeypatch):
    def numbers(refresh, a, b):
        for name, n in (("a", a), ("b", b)):
            refresh.write(name, spark.range(n).select(F.col("id").cast("int").alias("n")))

    def counts(load):
        return load("a").count(), load("b").count()

    root, views = str(tmp_path), catalog_tables(spark, "publish_test")
    refresh = Refresh(spark, "publish_test", root)
    numbers(refresh, 1, 2)
    refresh.commit()
    before = published_tables(spark, "publish_test", root)

    broken = Refresh(spark, "publish_test", root)
    numbers(broken, 3, 4)
    assert counts(published_tables(spark, "publish_test", root)) == counts(views) == (1, 2)
    publish = spark.sql

    def only_a(text):
        if "publish_test.b" in text:
            raise RuntimeError("catalog lost")
        return publish(text)

    with monkeypatch.context() as patch:
        patch.setattr(spark, "sql", only_a)
        with pytest.raises(RuntimeError, match="catalog lost"):
            broken.commit()
    # The record has both new tables at once; what was loaded before still reads both old ones.
    assert counts(published_tables(spark, "publish_test", root)) == (3, 4)
    assert counts(before) == (1, 2)
    publish_views(spark, "publish_test", root)
    assert counts(views) == (3, 4)

    for n in range(5, 5 + 2 * writers.VERSIONS):
        refresh = Refresh(spark, "publish_test", root)
        refresh.write("a", spark.range(n).select(F.col("id").cast("int").alias("n")))
        refresh.commit()
        # A table that is not written again stays as it is.
        assert counts(published_tables(spark, "publish_test", root)) == counts(views) == (n, 4)
    assert len(list((tmp_path / "publish_test" / "a").iterdir())) == writers.VERSIONS
    assert len(list((tmp_path / "published_versions").iterdir())) == writers.VERSIONS


def test_projection_counts(spark):
    load = projected_billing(spark, "/root/testdata/sf0.001")
    counts = {r.table_name: r.row_count for r in row_counts({n: load(n) for n in ENTITIES}).collect()}
    assert counts == {"customers": 156, "subscriptions": 1510, "invoices": 6000}


def test_csv_files_with_another_column_order_fail(spark, tmp_path):
    names = RAW["customers"].names
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join("" for _ in names) + "\n")
    (tmp_path / "b.csv").write_text(",".join(names[::-1]) + "\n" + ",".join("" for _ in names) + "\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_csv(spark, str(tmp_path), RAW["customers"]).collect()
