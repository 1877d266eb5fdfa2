"""Streaming over rows sorted by a key: which keys have several members."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.workspace import partitions


def keys_of_several(rows: DataFrame, key: str, member: str) -> DataFrame:
    """Distinct (key, member) rows, both longs and not null, of keys with more than one member.

    Rows are sorted by Spark, which spills, and read once: at most one row is held back, so a key
    may have any number of rows.
    """

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int] | None = None
        last: tuple[int, int] | None = None  # the last row that went out or was dropped as a copy
        for batch in batches:
            keys, members = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(keys):
                continue
            if held:
                keys, members = np.r_[np.int64(held[0]), keys], np.r_[np.int64(held[1]), members]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (members[1:] != members[:-1])
            if last and not held:
                new[0] = (keys[0], members[0]) != last
            keys, members = keys[new], members[new]
            if not len(keys):
                continue
            same = keys[1:] == keys[:-1]
            shared = np.zeros(len(keys), bool)
            shared[1:] |= same
            shared[:-1] |= same
            if last:
                shared[0] |= last[0] == keys[0]
            # The last row waits when nothing tells yet whether its key has another member.
            held = None if shared[-1] else (int(keys[-1]), int(members[-1]))
            last = (int(keys[-1]), int(members[-1])) if shared[-1] else (last if last and last[0] == keys[-1] else None)
            yield pa.RecordBatch.from_arrays([pa.array(keys[shared]), pa.array(members[shared])], [key, member])

    dealt = rows.select(key, member).repartition(partitions(rows.sparkSession), key).sortWithinPartitions(key, member)
    return dealt.mapInArrow(several, f"{key} long, {member} long")
