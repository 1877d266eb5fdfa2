"""Full-refresh writes: one version record makes all tables of all layers current together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

DEFAULT_NAMESPACE = "analytics"

# Folders kept of every table, and records kept.
VERSIONS = 3
RECORD = "version long, namespace string, table_name string, slot int"


def namespace_of(layer: str | None, default: str = DEFAULT_NAMESPACE) -> str:
    """Database of a layer: its own bare name, never prefixed by the default one."""
    return default if layer is None else layer.strip()


def _records(root: str) -> str:
    return f"{root.rstrip('/')}/published_versions"


def _path(namespace: str, root: str, name: str, slot: int) -> str:
    return f"{root.rstrip('/')}/{namespace}/{name}/{slot}"


def _last_record(spark: SparkSession, root: str) -> tuple[int, dict[tuple[str, str], int]]:
    """Number of the last committed version, 0 before the first, and the folder number of each namespace's tables."""
    try:
        rows = (
            spark.read.schema(RECORD)
            .option("ignoreMissingFiles", True)
            .json(f"{_records(root)}/*")
            .collect()  # one row per table and kept record
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    version = max((r.version for r in rows), default=0)
    return version, {(r.namespace, r.table_name): r.slot for r in rows if r.version == version}


def published_version(spark: SparkSession, namespace: str, root: str) -> tuple[int, dict[str, int]]:
    """Number of the last committed version, 0 before the first, and the folder number of each table."""
    version, slots = _last_record(spark, root)
    return version, {name: slot for (owner, name), slot in slots.items() if owner == namespace}


def published_tables(spark: SparkSession, namespace: str, root: str) -> Callable[[str], DataFrame]:
    """Loader of the tables of the last committed refresh: all of one version, whatever is committed later."""
    _, slots = published_version(spark, namespace, root)
    return lambda name: spark.read.parquet(_path(namespace, root, name, slots[name]))


def publish_views(spark: SparkSession, namespace: str, root: str) -> None:
    """Point the catalog's views at the last committed refresh; also repairs a publish that broke off."""
    _, slots = published_version(spark, namespace, root)
    if slots:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    for name, slot in slots.items():
        path = _path(namespace, root, name, slot)
        spark.sql(f"CREATE OR REPLACE VIEW {namespace}.{name} AS SELECT * FROM parquet.`{path}`")


class Refresh:
    """Replaces tables of one namespace under ``root``, a folder all executors can reach.

    A table has ``VERSIONS`` folders, and a refresh overwrites the oldest, so that a slow reader may
    outlast the next refresh. ``commit``, or ``commit_together`` for several namespaces, writes one small file, the record of
    the new version: before it all old tables are current, after it all new ones (``published_tables``). The views of the
    catalog follow one by one. A failure among them leaves some views at the old version, whose
    folders stay; the next refresh first brings them to the record. One refresh under a root
    runs at a time.
    """

    def __init__(self, spark: SparkSession, namespace: str, root: str):
        self.spark = spark
        self.namespace = namespace
        self.root = root.rstrip("/")
        _, self._slots = published_version(spark, namespace, root)
        self._written: dict[str, int] = {}
        publish_views(spark, namespace, root)

    def write(self, name: str, rows: DataFrame) -> DataFrame:
        """Write the new version of a table and return it; readers still see the old one."""
        slot = (self._slots[name] + 1) % VERSIONS if name in self._slots else 0
        path = _path(self.namespace, self.root, name, slot)
        rows.write.mode("overwrite").parquet(path)
        self._written[name] = slot
        return self.spark.read.schema(rows.schema).parquet(path)

    def commit(self) -> None:
        """Make all written tables current. A changed schema replaces the old one."""
        commit_together(self)


def commit_together(*refreshes: Refresh) -> None:
    """Make the written tables of all these namespaces current at once."""
    spark, root = refreshes[0].spark, refreshes[0].root
    version, slots = _last_record(spark, root)
    for refresh in refreshes:
        slots |= {(refresh.namespace, name): slot for name, slot in refresh._written.items()}
        refresh._slots |= refresh._written
        refresh._written = {}
    record = [(version + 1, namespace, name, slot) for (namespace, name), slot in slots.items()]
    # A single file appears at once; it takes the place of the oldest record.
    spark.createDataFrame(record, RECORD).coalesce(1).write.mode("overwrite").json(f"{_records(root)}/{(version + 1) % VERSIONS}")
    for refresh in refreshes:
        publish_views(spark, refresh.namespace, root)
