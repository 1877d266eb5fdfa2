"""Many-to-one lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARENT_KEY = "parent_key"


def _matches(child_key: Column, parent_key: Column) -> Column:
    """Equal keys, with their hash as a second join key.

    The second key changes no result. A parent that comes out of a ``groupBy`` on the key is
    already partitioned by it; Spark would reuse that and then cannot split a hot child key at
    run time. With two keys it shuffles both sides for the join, and the skew join applies.
    """
    return (child_key == parent_key) & (F.xxhash64(child_key) == F.xxhash64(parent_key))


def attach_parent(
    child: DataFrame, parent: DataFrame, key: str, columns: Sequence[str] = ()
) -> DataFrame:
    """Left join ``child`` to a ``parent`` with unique keys.

    Adds the chosen parent ``columns`` and ``parent_key``, which is NULL for orphans. Spark
    broadcasts the parent only while its measured size is under the session's threshold.
    """
    right = parent.select(F.col(key).alias(PARENT_KEY), *columns)
    return child.join(right, _matches(F.col(key), F.col(PARENT_KEY)), "left")


def without_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose known key is not among the keys of ``parent``."""
    keys = parent.select(F.col(key).alias(PARENT_KEY)).distinct()
    return child.where(F.col(key).isNotNull()).join(
        keys, _matches(F.col(key), F.col(PARENT_KEY)), "left_anti"
    )


def with_parent(
    child: DataFrame, parent: DataFrame, key: str, columns: Sequence[str] = ()
) -> DataFrame:
    """Inner form of ``attach_parent``: orphans are left out."""
    return attach_parent(child, parent, key, columns).where(F.col(PARENT_KEY).isNotNull())
