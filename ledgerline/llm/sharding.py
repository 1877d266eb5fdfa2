"""Sharding by Karmarkar-Karp differencing: shards of nearly equal bytes from indivisible groups.

A partial partition holds one sum for each shard. Differencing repeatedly takes the two with the
largest spread and adds the largest sums of one to the smallest of the other. Groups are dealt by hash into
buckets of bounded size, each bucket is differenced by itself into one partial partition, and these
are differenced again, level by level, until one is left. Going back down the levels gives every
group its shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.workspace import keep

#: Groups, or partial partitions of the level below, that are differenced in one task.
BUCKET = 4096


def difference(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums ascending, place of each part's columns in them) for parts of ascending sums, one row each."""
    shards = parts.shape[1]
    heap = [(-(row[-1] - row[0]), i) for i, row in enumerate(parts.tolist())]
    heapq.heapify(heap)
    # For each part its sums, and for each sum the (part, column) pairs that it is made of.
    sums = {i: parts[i] for i in range(len(parts))}
    made = {i: [[(i, c)] for c in range(shards)] for i in range(len(parts))}
    serial = len(parts)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        total = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(total, kind="stable")
        first, second = made.pop(a), made.pop(b)[::-1]
        for x, y in zip(first, second, strict=True):
            if len(x) < len(y):
                x[:], y[:] = y[:], x[:]
            x.extend(y)
        sums[serial], made[serial] = total[order], [first[i] for i in order]
        heapq.heappush(heap, (-float(sums[serial][-1] - sums[serial][0]), serial))
        serial += 1
    (_, last) = heap[0]
    place = np.empty(parts.shape, np.int64)
    for shard, pairs in enumerate(made[last]):
        for i, c in pairs:
            place[i, c] = shard
    return sums[last], place


def _bucket_of_groups(shards: int):
    def run(groups: pd.DataFrame) -> pd.DataFrame:
        groups = groups.sort_values(["bytes", "group_key", "group_check"], ascending=[False, True, True])
        parts = np.zeros((len(groups), shards), np.int64)
        parts[:, -1] = groups["bytes"]
        sums, place = difference(parts)
        return pd.DataFrame({"group_key": groups["group_key"], "group_check": groups["group_check"], "part": groups["bucket"], "place": place[:, -1], "sums": [sums.tolist()] + [None] * (len(groups) - 1)})

    return run


def _bucket_of_parts(parts: pd.DataFrame) -> pd.DataFrame:
    parts = parts.sort_values("part")
    sums, place = difference(np.array(parts["sums"].tolist(), np.int64))
    return pd.DataFrame({"part": parts["part"], "parent": parts["parent"], "places": place.tolist(), "sums": [sums.tolist()] + [None] * (len(parts) - 1)})


def assign_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(group_key, group_check, shard) for groups (group_key, group_check, bytes) of distinct keys."""
    n = groups.count()
    buckets = max(1, -(-n // BUCKET))
    dealt = groups.withColumn("bucket", F.pmod(F.xxhash64("group_key", "group_check"), F.lit(buckets)))
    placed = keep(dealt.groupBy("bucket").applyInPandas(_bucket_of_groups(shards), "group_key long, group_check long, part long, place long, sums array<long>"))
    parts = placed.where("sums is not null").select("part", "sums")
    found = placed.select("group_key", "group_check", "part", "place")
    while buckets > 1:
        buckets = -(-buckets // BUCKET)
        level = keep(parts.withColumn("parent", F.pmod("part", F.lit(buckets))).groupBy("parent").applyInPandas(_bucket_of_parts, "part long, parent long, places array<long>, sums array<long>"))
        found = found.join(level.select("part", "parent", "places"), "part")
        found = found.select("group_key", "group_check", F.col("parent").alias("part"), F.element_at("places", (F.col("place") + 1).cast("int")).alias("place"))
        parts = level.where("sums is not null").select(F.col("parent").alias("part"), "sums")
    return found.select("group_key", "group_check", F.col("place").cast("int").alias("shard"))


def shard_documents(documents: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text", portion: int = 8192) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard and slot, its place in the shard from 0 without gaps.

    Size is the UTF-8 bytes of the text plus 8; a null text counts as an empty one. Rows with equal
    texts are a group and share a shard; without rows there is no result. Slots follow a hash of the row in portions
    of bounded size, so a shard is numbered by many tasks; equal rows take neighbouring slots.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(F.col(doc_id).alias("doc_id"), (F.octet_length(whole) + 8).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"), F.xxhash64(whole).alias("group_key"), F.xxhash64(F.lit(1), whole).alias("group_check"))
    rows = keep(rows)
    groups = keep(rows.groupBy("group_key", "group_check").agg(F.sum("size").alias("bytes")))
    # Joined with a hash of the key besides, so that a hot group is split at run time.
    assigned = assign_groups(groups, shards).withColumn("h", F.xxhash64("group_key"))
    found = rows.withColumn("h", F.xxhash64("group_key")).join(assigned, ["group_key", "group_check", "h"]).drop("group_check", "h")
    n = rows.count()
    found = keep(found.withColumn("portion", F.pmod(F.xxhash64("doc_id", "group_key"), F.lit(max(1, -(-n // (portion * shards)))))))
    counts = found.groupBy("shard", "portion").agg(F.count("*").alias("n"))
    first = counts.withColumn("first", F.sum("n").over(W.partitionBy("shard").orderBy("portion")) - F.col("n")).drop("n")
    numbered = found.withColumn("within", F.row_number().over(W.partitionBy("shard", "portion").orderBy("doc_id", "group_key")) - 1)
    return numbered.join(first, ["shard", "portion"]).select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("within")).cast("long").alias("slot"))
