"""Readers for the raw billing tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from decimal import Decimal
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import RAW

Loader = Callable[[str], DataFrame]

#: The column by whose values a table of a database is dealt out to tasks.
SLICED_BY = {"customers": "customer_id", "subscriptions": "subscription_id", "invoices": "invoice_date"}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Pick the columns of ``schema`` by name and cast them; bad values fail under ANSI mode."""
    return df.selectExpr(
        *[f"cast({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields]
    )


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """CSV export with a header row; columns are found by name, blanks become NULL.

    Files of a folder must have the same columns in the same order; others fail the read. Text keeps its outer spaces. Set ``multi_line`` only if quoted values hold line breaks:
    Spark then cannot split a file.
    """
    text = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("mode", "FAILFAST")
        # The header of every file is compared with the columns; else files are read by position.
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .csv(path)
    )
    return conform(
        text.select([F.nullif(F.col(f.name), F.lit("")).alias(f.name) for f in schema.fields]),
        schema,
    )


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return conform(spark.read.parquet(path), schema)


def jdbc_options(
    url: str, table: str, schema: T.StructType, fetch_size: int = 10_000
) -> dict[str, str]:
    """Options of a JDBC read that asks the database for the wanted columns only."""
    columns = ", ".join(schema.names)
    return {
        "url": url,
        "dbtable": f"(SELECT {columns} FROM {table}) AS extract",
        "fetchsize": str(fetch_size),
    }


def date_slices(column: str, first: date, last: date, months: int = 1) -> list[str]:
    """Predicates for ``read_jdbc`` that cover a table without overlap, by a date column.

    One for each ``months`` months from the month of ``first`` to that of ``last``, one for what is
    earlier, one for what is later and one for rows without a date.
    """
    if months < 1 or last < first:
        raise ValueError("slices need a month or more, and a last date that is not before the first")
    start, end = (d.year * 12 + d.month - 1 for d in (first, last))
    cuts = [date(m // 12, m % 12 + 1, 1).isoformat() for m in range(start, end + 1 + months, months)]
    between = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in pairwise(cuts)]
    return [f"{column} < '{cuts[0]}'", *between, f"{column} >= '{cuts[-1]}'", f"{column} IS NULL"]


def split_request(table: str, column: str, tasks: int) -> str:
    """What the database is asked for split points: the first value of each of ``tasks`` stretches with equally many rows."""
    tiles = f"SELECT {column} AS v, ntile({tasks}) OVER (ORDER BY {column}) AS tile FROM {table} WHERE {column} IS NOT NULL"
    return f"(SELECT tile, min(v) AS split FROM ({tiles}) AS t GROUP BY tile) AS splits"


def _literal(value) -> str:
    if isinstance(value, int | float | Decimal) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def slices_between(column: str, splits: Sequence) -> list[str]:
    """Predicates that cover a table without overlap, cut at ``splits``, which come in the database's own order.

    A value that fills several stretches is one slice: rows of one value are never parted. Rows without a value are one more slice.
    """
    points = [p for k, p in enumerate(splits) if k and p != splits[k - 1]]
    if not points:
        return []
    cuts = [_literal(p) for p in points]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in pairwise(cuts)]
    return [f"{column} < {cuts[0]}", *between, f"{column} >= {cuts[-1]}", f"{column} IS NULL"]


def equal_slices(
    spark: SparkSession, url: str, table: str, column: str, tasks: int, properties: dict[str, str] | None = None
) -> list[str]:
    """Slices of about equally many rows, from one request to the database, which answers with ``tasks`` rows at most.

    None where the table has fewer than two values: one task then reads it.
    """
    found = spark.read.jdbc(url, split_request(table, column, tasks), properties=properties or {}).collect()
    return slices_between(column, [r["split"] for r in sorted(found, key=lambda r: r["tile"])])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    schema: T.StructType,
    slices: Sequence[str] = (),
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Database table, one read task per predicate in ``slices`` (see ``date_slices``).

    The slices must cover the table without overlap; without any, one task reads it all.
    """
    options = jdbc_options(url, table, schema)
    settings = {**(properties or {}), "fetchsize": options["fetchsize"]}
    if slices:
        rows = spark.read.jdbc(
            url, options["dbtable"], predicates=list(slices), properties=settings
        )
    else:
        rows = spark.read.jdbc(url, options["dbtable"], properties=settings)
    return conform(rows, schema)


def jdbc_tables(
    spark: SparkSession,
    url: str,
    slices: dict[str, Sequence[str]] | None = None,
    properties: dict[str, str] | None = None,
    tasks: int = 8,
) -> Loader:
    """Raw tables ``raw_customers``, ``raw_subscriptions`` and ``raw_invoices`` of a database.

    Each is read by ``tasks`` tasks, in slices of about equally many rows that the database is asked for, unless
    ``slices`` has its own. With ``tasks=1`` nothing is asked and one task reads a table.
    """

    def load(name: str) -> DataFrame:
        table, given = f"raw_{name}", (slices or {}).get(name)
        if given is None:
            given = equal_slices(spark, url, table, SLICED_BY[name], tasks, properties) if tasks > 1 else ()
        return read_jdbc(spark, url, table, RAW[name], given, properties)

    return load


def csv_exports(spark: SparkSession, directory: str, multi_line: bool = False) -> Loader:
    """Raw tables from ``raw_customers.csv``, ``raw_subscriptions.csv`` and ``raw_invoices.csv``."""
    return lambda name: read_csv(spark, f"{directory}/raw_{name}.csv", RAW[name], multi_line)


def catalog_tables(spark: SparkSession, namespace: str) -> Loader:
    """Tables of a namespace in the catalog."""
    return lambda name: spark.table(f"{namespace}.{name}")
