"""How often each key has come, kept in buckets, so that a delivery is counted against it and not with all rows again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.lineage import cut_lineage
from ledgerline.sources.versions import Change, current_version


class KeyIndex:
    """One row per key and its number of rows in all deliveries, in ``buckets`` parts by the key's hash.

    A delivery is counted by key before the shuffle and merged with the buckets that its keys fall into; rows that came
    earlier are not read. A NULL key is not counted. Deliveries have names: one that is added again changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 64):
        self.spark, self.root, self.key, self.buckets = spark, root, key, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets))

    def _schema(self, rows: DataFrame):
        return self.spark.createDataFrame([], f"{self.key} {rows.schema[self.key].dataType.simpleString()}, row_count long").schema

    def add(self, delivery: str, rows: DataFrame) -> DataFrame:
        """Count a delivery, and return its keys that now have several rows, with their numbers."""
        change = Change(self.spark, self.root)
        done = change.now.read("deliveries", schema=_DELIVERIES).where(F.col("delivery") == delivery).count()
        schema = self._schema(rows)
        counted = rows.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.count(F.lit(1)).alias("row_count"))
        counted = cut_lineage(counted)
        touched = [str(r.b) for r in counted.select(self._bucket().alias("b")).distinct().collect()]  # at most as many as buckets
        if not done:
            held = change.now.read("keys", touched, schema)
            merged = held.unionByName(counted).groupBy(self.key).agg(F.sum("row_count").alias("row_count"))
            change.replace("keys", merged, self._bucket(), touched)
            change.replace("deliveries", self.spark.createDataFrame([(delivery,)], _DELIVERIES), F.col("delivery"), [delivery])
            change.commit()
        found = current_version(self.spark, self.root).read("keys", touched, schema).where("row_count > 1")
        return found.join(counted.select(self.key), self.key, "left_semi")

    def repeated(self) -> DataFrame:
        """All keys with several rows. Reads the index alone."""
        return current_version(self.spark, self.root).read("keys").where("row_count > 1")


_DELIVERIES = "delivery string"
