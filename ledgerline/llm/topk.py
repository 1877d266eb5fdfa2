"""Exact top-k search by distributed histogram selection.

All candidates are scored against a block of queries. A histogram of the scores of each query over
the whole range, summed over all tasks, tells which bin holds the k-th highest score; the bin becomes
the next range, until a bin is one score wide and the k-th score of every query is known. Then the
candidates from that score on are filtered; of ties each task sends its k smallest ids, and the
ids decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.workspace import keep

#: Bytes of a block of query vectors that is sent to all tasks, scores that a task holds at a time, and bins of a histogram.
BLOCK_BYTES, CHUNK_SCORES, BINS = 16 << 20, 1 << 20, 256


def integer_vectors(table: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id long, v array<long>) with floor(scale * x); rows with nulls or non-finite components are left out."""
    x = F.col(vector)
    fine = x.isNotNull() & F.col(vec_id).isNotNull() & F.forall(x, lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False)))
    return table.where(fine).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(scale * e.cast("double")).cast("long")).alias("v"))


def _matrix(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a batch; shorter vectors count as having zeros behind them."""
    ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(lists.offsets.to_numpy())
    if len(lengths) and (lengths == width).all():
        return ids, flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    near = column < width
    out[row[near], column[near]] = flat[near]
    return ids, out


def _scores(batches: Iterator[pa.RecordBatch], queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores[query, id]) of a bounded number of candidates at a time."""
    width = queries.shape[1]
    for batch in batches:
        ids, vectors = _matrix(batch, width)
        step = max(1, CHUNK_SCORES // max(1, len(queries)))
        for at in range(0, len(ids), step):
            part = vectors[at : at + step]
            # Doubles are exact as long as no sum can pass 2^53.
            bound = float(np.abs(part).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, width)
            kind = np.float64 if bound < 2.0**53 else np.int64
            yield ids[at : at + step], (queries.astype(kind) @ part.astype(kind).T).astype(np.int64)


def _histogram(queries: np.ndarray, own: np.ndarray, low: np.ndarray, width: np.ndarray):
    """Task-side sums (query, bin, n) over the bins of `width` scores that start at `low`; what is above counts in the last one."""

    def run(batches):
        counts = np.zeros(len(queries) * (BINS + 1), np.int64)
        for ids, scores in _scores(batches, queries):
            at = np.clip((scores - low[:, None]) // width[:, None], -1, BINS - 1) + 1
            at[own[:, None] == ids[None, :]] = 0
            counts += np.bincount((at + (np.arange(len(queries)) * (BINS + 1))[:, None]).ravel(), minlength=len(counts))
        full = np.flatnonzero(counts)
        full = full[full % (BINS + 1) > 0]
        yield pa.RecordBatch.from_arrays([pa.array((full // (BINS + 1)).astype(np.int64)), pa.array(full % (BINS + 1) - 1), pa.array(counts[full])], ["query", "bin", "n"])

    return run


def _range(queries: np.ndarray, own: np.ndarray):
    def run(batches):
        low, high = np.full(len(queries), 2**62), np.full(len(queries), -(2**62))
        for ids, scores in _scores(batches, queries):
            other = own[:, None] != ids[None, :]
            low = np.minimum(low, np.where(other, scores, 2**62).min(axis=1, initial=2**62))
            high = np.maximum(high, np.where(other, scores, -(2**62)).max(axis=1, initial=-(2**62)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(queries))), pa.array(low), pa.array(high)], ["query", "low", "high"])

    return run


def _winners(queries: np.ndarray, own: np.ndarray, kth: np.ndarray, k: int):
    """Candidates at or above the k-th score; a task keeps the k best of each query, by score and then id."""

    def run(batches):
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in queries]
        for ids, scores in _scores(batches, queries):
            hit = (scores >= kth[:, None]) & (own[:, None] != ids[None, :])
            for q in np.flatnonzero(hit.any(axis=1)):
                i, s = np.r_[best[q][0], ids[hit[q]]], np.r_[best[q][1], scores[q, hit[q]]]
                order = np.lexsort((i, -s))[:k]
                best[q] = i[order], s[order]
        found = [np.full(len(i), own[q]) for q, (i, _) in enumerate(best)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (found, [i for i, _ in best], [s for _, s in best])], ["query_id", "vec_id", "score"])

    return run


def kth_scores(candidates: DataFrame, queries: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """The k-th highest score of each query, or its lowest if it has fewer candidates."""
    n = len(queries)
    spans = candidates.mapInArrow(_range(queries, own), "query long, low long, high long").groupBy("query").agg(F.min("low"), F.max("high")).collect()
    low, high = np.full(n, 2**62), np.full(n, -(2**62))
    for q, a, b in spans:
        low[q], high[q] = a, b
    wanted = np.full(n, k, np.int64)  # so many are still to be counted off from the top of the range
    open_ = low < high
    while open_.any():
        width = np.maximum(1, -(-(high - low + 1) // BINS))
        width = np.where(open_, width, 1)
        told = candidates.mapInArrow(_histogram(queries, own, np.where(open_, low, 2**62), width), "query long, bin long, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))
        # What is above the range was counted off before; the histogram's last bin holds it as well.
        counts = np.zeros((n, BINS), np.int64)
        for q, b, c in told.collect():
            counts[q, b] = c
        for q in np.flatnonzero(open_):
            from_top = np.cumsum(counts[q][::-1])
            b = BINS - 1 - int(np.searchsorted(from_top, min(k, from_top[-1])))
            low[q], high[q] = low[q] + b * width[q], min(high[q], low[q] + (b + 1) * width[q] - 1) if b < BINS - 1 else high[q]
            if width[q] == 1:
                high[q] = low[q]
        open_ = low < high
    return low


def top_k(table: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id `every` divides, its k best other rows.

    Ties go to the smaller id. Vectors that are null or hold null or non-finite components, and rows
    without id, take no part; repeated rows are candidates each, and one query together. Queries go through the
    candidates in blocks of bounded bytes; a query's histogram is 256 numbers whatever the input.
    """
    spark = table.sparkSession
    candidates = integer_vectors(table, vec_id, vector, scale)
    asked = candidates.where(F.col("vec_id") % every == 0)
    width = candidates.agg(F.max(F.size("v"))).first()[0] or 0
    total = asked.select("vec_id").distinct().count()
    blocks = max(1, -(-total * max(1, width) * 8 // BLOCK_BYTES))
    results = []
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").collect()
        own = np.array([r[0] for r in mine], np.int64)
        queries = np.zeros((len(mine), width), np.int64)
        for i, r in enumerate(mine):
            queries[i, : len(r[1])] = r[1]
        if not len(mine):
            continue
        kth = kth_scores(candidates, queries, own, k)
        results.append(keep(candidates.mapInArrow(_winners(queries, own, kth, k), "query_id long, vec_id long, score long")))
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    merged = results[0]
    for more in results[1:]:
        merged = merged.unionByName(more)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
