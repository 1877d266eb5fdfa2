"""Tables in parts, for example months: a change writes the parts it touches, and one record makes it current.

A part is a folder that is written once and never changed. The record of a version lists the folder of every part of
every table, so all tables of a version belong together, and a change costs what it touches. A reader that
holds a version goes on reading its folders until ``expire`` removes those that no kept record lists.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Records kept, each with all folders of its version.
KEPT_VERSIONS = 3
RECORD = "version long, table_name string, part string, folder string, fields string"
#: Part of rows whose part column is NULL, and of a table that has one part only.
NO_VALUE, WHOLE = "none", "all"
#: Spark's folder of rows whose part is NULL.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentChange(Exception):
    """Another change was committed since this one began."""


class IncompatibleSchema(Exception):
    """A column's type cannot be widened to the new one."""


# Fixed order: every type can be read as each type behind it.
WIDENING = [[T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()], [T.FloatType(), T.DoubleType()], [T.DateType(), T.TimestampNTZType()]]


def wider(old: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds the values of both without loss."""
    if old == new:
        return old
    for line in WIDENING:
        if old in line and new in line:
            return max(old, new, key=line.index)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        precision = max(old.precision - old.scale, new.precision - new.scale) + scale
        if precision <= 38:
            return T.DecimalType(precision, scale)
    raise IncompatibleSchema(f"{old.simpleString()} and {new.simpleString()}")


@dataclass(frozen=True)
class SchemaChange:
    """What a new schema does to an old one; ``merged`` reads the files of both."""

    added: list[str]
    removed: list[str]
    widened: list[str]
    merged: T.StructType


def compare_schemas(old: T.StructType, new: T.StructType) -> SchemaChange:
    """Columns by name. A removed column stays readable and is NULL in new rows, as an added one is in old rows."""
    before, now = {f.name: f for f in old}, {f.name: f for f in new}
    both = [(f, now[f.name]) for f in old if f.name in now]
    kinds = {f.name: wider(f.dataType, g.dataType) for f, g in both}
    added, removed = [n for n in now if n not in before], [n for n in before if n not in now]
    fields = [T.StructField(f.name, kinds.get(f.name, f.dataType), True, f.metadata) for f in old]
    fields += [T.StructField(n, now[n].dataType, True, now[n].metadata) for n in added]
    return SchemaChange(added, removed, [f.name for f, _ in both if kinds[f.name] != f.dataType], T.StructType(fields))


@dataclass
class Table:
    """Folder and schema of each part; ``empty`` is the schema of a table that has none left."""

    parts: dict[str, tuple[str, T.StructType]] = field(default_factory=dict)
    empty: T.StructType | None = None

    def schema(self) -> T.StructType | None:
        kinds = list({s.json(): s for _, s in self.parts.values()}.values()) or [self.empty] * (self.empty is not None)
        return reduce(lambda a, b: compare_schemas(a, b).merged, kinds) if kinds else None


class Version:
    """The tables of one committed version."""

    def __init__(self, spark: SparkSession, root: str, number: int, tables: dict[str, Table]):
        self.spark, self.root, self.number, self.tables = spark, root, number, tables

    def parts(self, table: str) -> list[str]:
        return sorted(self.tables[table].parts) if table in self.tables else []

    def read(self, table: str, parts: Iterable[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The table, or some of its parts. Files of older schemas get the new columns as NULL and the wider types.

        ``schema`` is what a table without any part looks like.
        """
        held = self.tables.get(table, Table())
        merged = held.schema() or schema
        if merged is None:
            raise KeyError(f"no table {table} in version {self.number}")
        wanted = held.parts if parts is None else {p: held.parts[p] for p in parts if p in held.parts}
        # One scan for each schema of files; there is one unless the schema changed since a part was written.
        by_schema: dict[str, list[str]] = {}
        for folder, kind in wanted.values():
            by_schema.setdefault(kind.json(), []).append(f"{self.root}/{folder}")
        scans = [self.spark.read.schema(T.StructType.fromJson(json.loads(k))).parquet(*sorted(paths)) for k, paths in by_schema.items()]
        if not scans:
            return self.spark.createDataFrame([], merged)
        return reduce(DataFrame.unionByName, [_as(scan, merged) for scan in scans])


def _as(rows: DataFrame, schema: T.StructType) -> DataFrame:
    if rows.schema == schema:
        return rows
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema])


def current_version(spark: SparkSession, root: str) -> Version:
    """The last committed version; number 0 without tables before the first."""
    root = root.rstrip("/")
    try:
        # One row per kept version and part.
        rows = spark.read.schema(RECORD).option("ignoreMissingFiles", True).json(f"{root}/_versions/*").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    number = max((r.version for r in rows), default=0)
    return Version(spark, root, number, _tables(r for r in rows if r.version == number))


def _tables(rows) -> dict[str, Table]:
    tables: dict[str, Table] = {}
    for r in rows:
        table, kind = tables.setdefault(r.table_name, Table()), T.StructType.fromJson(json.loads(r.fields))
        if r.part is None:
            table.empty = kind
        else:
            table.parts[r.part] = (r.folder, kind)
    return tables


class Change:
    """Writes parts of tables and makes them current together. Readers see the old version until ``commit``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.base = current_version(spark, root)
        self.tables = {name: Table(dict(t.parts), t.empty) for name, t in self.base.tables.items()}

    @property
    def now(self) -> Version:
        """The tables as this change leaves them so far."""
        return Version(self.spark, self.root, self.base.number + 1, self.tables)

    def replace(self, table: str, rows: DataFrame, part: Column | None = None, touched: Iterable[str] | None = None, dealt: bool = False, passed: DataFrame | None = None) -> list[str]:
        """Write the parts of ``rows`` and return them. ``touched`` parts without a row go; None stands for all parts.

        Rows are dealt out by their part, a large part to several tasks and small ones together. ``dealt`` rows are so
        already, or there are few parts: every task writes those it holds, without another shuffle. So are the rows that
        are ``passed`` on from files of parts, which are written beside the others. A column whose
        type cannot be widened to the one given is an error, and nothing is written then.
        """
        held = self.tables.get(table, Table())
        if touched is not None and held.parts:
            compare_schemas(held.schema(), rows.schema)
        self.tables[table] = held
        folder = f"{table}/{uuid4().hex}"
        if part is None:
            rows.write.parquet(f"{self.root}/{folder}/_part={WHOLE}")
            written = [WHOLE]
        else:
            # Days stay days: a task orders its rows by part, and numbers need no comparison of strings for that.
            by_day = isinstance(rows.select(part).schema[0].dataType, T.DateType)
            name = part if by_day else F.coalesce(part.cast("string"), F.lit(NO_VALUE))
            named = rows.withColumn("_part", name)
            named = named if dealt else named.hint("rebalance", "_part")
            if passed is not None:
                named = named.unionByName(passed.withColumn("_part", name))
            named.write.partitionBy("_part").parquet(f"{self.root}/{folder}")
            # Reads the names of folders alone: one row for each part.
            written = self._written(folder)
        for gone in list(held.parts) if touched is None else touched:
            held.parts.pop(gone, None)
        named_so = {NO_VALUE: NULL_FOLDER} if part is not None and by_day else {}
        held.parts.update({p: (f"{folder}/_part={named_so.get(p, p)}", rows.schema) for p in written})
        held.empty = rows.schema
        return sorted(written)

    def _written(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(path)]
        parts = [n.removeprefix("_part=") for n in names if n.startswith("_part=")]
        return [NO_VALUE if p == NULL_FOLDER else p for p in parts]

    def commit(self) -> Version:
        """Write the record of the new version: one small file, which appears at once."""
        if current_version(self.spark, self.root).number != self.base.number:
            raise ConcurrentChange(f"version {self.base.number} is no longer the last one")
        number = self.base.number + 1
        rows = [(number, t, p, folder, kind.json()) for t, held in self.tables.items() for p, (folder, kind) in held.parts.items()]
        rows += [(number, t, None, None, held.empty.json()) for t, held in self.tables.items() if not held.parts]
        record = self.spark.createDataFrame(rows, RECORD)
        record.coalesce(1).write.mode("overwrite").json(f"{self.root}/_versions/{number % KEPT_VERSIONS}")
        return self.now


def expire(spark: SparkSession, root: str) -> list[str]:
    """Delete folders of parts that no kept record lists, and return them. No change may be under way."""
    root = root.rstrip("/")
    rows = spark.read.schema(RECORD).json(f"{root}/_versions/*").collect()  # one row per kept version and part
    listed = {r.folder for r in rows if r.folder}
    fs_path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    top = fs_path(root)
    files, gone = top.getFileSystem(conf), []

    def names(path) -> list[str]:
        return [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]

    for table in names(top):
        if table != "_versions":
            for change in names(fs_path(f"{root}/{table}")):
                for part in names(fs_path(f"{root}/{table}/{change}")):
                    folder = f"{table}/{change}/{part}"
                    if folder not in listed:
                        files.delete(fs_path(f"{root}/{folder}"), True)
                        gone.append(folder)
    return gone
