"""Upserts by key: the row with the highest change number stands, whatever order changes come in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.bloom import bloom_words, may_be_among, surely_not_among, words_for
from ledgerline.operators.lineage import cut_lineage

CHANGE_SEQ, IS_DELETED = "change_seq", "is_deleted"


def latest_per_key(rows: DataFrame, key: str) -> DataFrame:
    """The row of each key with the highest change number, ties broken by the largest other columns, NULL lowest.

    A maximum, combined before the shuffle: a hot key sends one row per task. A NULL key counts as one key. The result
    does not depend on the order of the rows or on repeated ones, so changes may come late and more than once.
    """
    order = [CHANGE_SEQ, IS_DELETED, *[c for c in rows.columns if c not in (key, CHANGE_SEQ, IS_DELETED)]]
    kept = rows.groupBy(key).agg(F.max(F.struct(*order)).alias("kept"))
    return kept.select(*[F.col(key) if c == key else F.col(f"kept.{c}").alias(c) for c in rows.columns])


def as_changes(rows: DataFrame, seq: int = 0) -> DataFrame:
    """Plain rows as changes of one number, none of them a deletion."""
    return rows.withColumns({CHANGE_SEQ: F.lit(seq).cast("long"), IS_DELETED: F.lit(False)})


def live(ledger: DataFrame) -> DataFrame:
    """The rows that stand, without change number and deletions."""
    return ledger.where(~F.col(IS_DELETED)).drop(CHANGE_SEQ, IS_DELETED)


def _keys(changes: DataFrame, key: str) -> DataFrame:
    return changes.select(F.col(key).alias("changed_key")).distinct()


def parts_of_keys(ledger: DataFrame, changes: DataFrame, key: str, part: str) -> DataFrame:
    """Distinct parts of the ledger that hold a changed key. Reads the key and the part's column alone."""
    held = ledger.select(key, F.expr(part).alias("part"))
    # <=> lets the NULL key match.
    return held.join(_keys(changes, key), F.col(key).eqNullSafe(F.col("changed_key")), "left_semi").select("part").distinct()


def merge_changes(touched: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The touched parts of a ledger after the changes.

    Rows of unchanged keys are passed through: they are compared with a Bloom filter of the changed keys, which is no
    shuffle however many those are. Only rows of changed keys are grouped.
    """
    passed, beside, changed = merge_apart(touched, changes, ChangedKeys(changes, key), columns)
    return passed.unionByName(beside).unionByName(changed)


class ChangedKeys:
    """The keys of a delivery, with a Bloom filter of them that is sized by their number.

    A delivery too large for a broadcast would have every row of a ledger shuffled to be compared with it. The filter is
    told to all tasks, and only rows that pass it are compared.
    """

    def __init__(self, changes: DataFrame, key: str):
        self.keys, self.key = _keys(changes, key), key
        self.words = words_for(changes.count())
        self.filter = cut_lineage(bloom_words(changes, key, self.words))

    def _same(self) -> Column:
        return F.col(self.key).eqNullSafe(F.col("changed_key"))

    def near(self, rows: DataFrame) -> DataFrame:
        """All rows of the keys, and a few others."""
        return may_be_among(rows, self.key, self.filter, self.words)

    def others(self, rows: DataFrame) -> DataFrame:
        """The rows that ``near`` leaves out: they are not shuffled."""
        return surely_not_among(rows, self.key, self.filter, self.words)

    def of(self, near: DataFrame) -> DataFrame:
        return near.join(self.keys, self._same(), "left_semi")

    def beside(self, near: DataFrame) -> DataFrame:
        return near.join(self.keys, self._same(), "left_anti")


def merge_apart(touched: DataFrame, changes: DataFrame, keys: ChangedKeys, columns: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``merge_changes`` in three: rows passed on as they lie, a few that only the keys could tell apart, and those of changed keys."""
    held = touched.select(*columns)
    near = cut_lineage(keys.near(held))
    changed = cut_lineage(latest_per_key(keys.of(near).unionByName(changes.select(*columns)), keys.key))
    return keys.others(held), keys.beside(near), changed
