"""Row-count reconciliation of a load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of rows per table; only counts travel."""
    parts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"), "row_count"
        )
        for table, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def reconcile_counts(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """Both counts side by side; a table that one side lacks does not match."""
    return (
        source.withColumnRenamed("row_count", "source_rows")
        .join(loaded.withColumnRenamed("row_count", "loaded_rows"), "table_name", "full_outer")
        .withColumn("matches", F.col("source_rows").eqNullSafe(F.col("loaded_rows")))
    )
