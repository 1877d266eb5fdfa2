"""Quality classifier: naive Bayes support vectors.

Features are indicators of hashed n-grams: words, word pairs, and runs of three word shapes (case, ending,
length, same as the word before). Class log-count ratios come from all labelled training rows; the indicators are
scaled by them, and a linear hinge-loss model is fitted by dual coordinate descent on a bounded
sample of those rows. A logistic curve fitted to rows of the sample that the model did not see turns margins into scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import kernels
from ledgerline.llm.workspace import keep
from ledgerline.operators.bloom import bloom_words, may_be_among

#: Hash values for words, word pairs and shape runs; training rows that the linear model is fitted on.
WORD_BITS, PAIR_BITS, SHAPE_BITS = 14, 14, 12
FEATURES = (1 << WORD_BITS) + (1 << PAIR_BITS) + (1 << SHAPE_BITS)
SAMPLE_ROWS = 4000

_UPPER = kernels.byte_class((0x41, 0x5A))
_LETTER = kernels.byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_BREAK = kernels.byte_class((0x0A, 0x0A))


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends of each row, its distinct features in order) of the texts of a slice."""
    rows = len(bounds) - 1
    found = kernels.words(data, bounds)
    n = len(found.hash)
    if not n:
        return np.zeros(rows + 1, np.int64), np.empty(0, np.int64)
    upper, letter, broken = (np.concatenate([[0], np.cumsum(c[data])]) for c in (_UPPER, _LETTER, _BREAK))
    length = found.end - found.start
    many_upper = np.minimum(upper[found.end] - upper[found.start], 2)
    marks = np.minimum(length - (letter[found.end] - letter[found.start]), 3)
    ending = np.where(_LETTER[data[found.end - 1]], 0, data[found.end - 1])
    before = np.zeros(n, bool)
    before[1:] = (found.hash[1:] == found.hash[:-1]) & (found.row[1:] == found.row[:-1])
    gap = np.full(n, 2, np.int64)
    gap[1:] = np.where(found.row[1:] == found.row[:-1], broken[found.start[1:]] - broken[found.end[:-1]] > 0, 2)
    shape = ((((many_upper * 4 + marks) * 256 + ending) * 2 + before) * 3 + gap) * 4 + np.minimum(length // 4, 3)
    shape = kernels.mix(shape.astype(np.uint64) + np.uint64(11))
    top = lambda x, bits: (x >> np.uint64(64 - bits)).astype(np.int64)
    own = [top(found.hash, WORD_BITS)]
    of = [found.row]
    pairs = np.flatnonzero(found.row[1:] == found.row[:-1])
    own.append((1 << WORD_BITS) + top(kernels.mix(found.hash[pairs] * np.uint64(3) + found.hash[pairs + 1]), PAIR_BITS))
    of.append(found.row[pairs])
    runs = np.flatnonzero(found.row[2:] == found.row[:-2]) if n > 2 else np.empty(0, np.int64)
    shapes = kernels.mix(kernels.mix(shape[runs] * np.uint64(5) + shape[runs + 1]) * np.uint64(5) + shape[runs + 2]) if n > 2 else np.empty(0, np.uint64)
    own.append((1 << WORD_BITS) + (1 << PAIR_BITS) + top(shapes, SHAPE_BITS))
    of.append(found.row[runs])
    key = np.unique(np.concatenate(of) * FEATURES + np.concatenate(own))
    return np.searchsorted(key, np.arange(rows + 1) * FEATURES), key % FEATURES


def is_held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 2 modulo 4; an id that is null is not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def class_counts(texts: DataFrame) -> np.ndarray:
    """counts[label, feature] over all rows (text, label), and rows of each label in the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, FEATURES + 1), np.int64)
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for first, data, bounds in kernels.text_slices(batch.column(0)):
                ends, found = features(data, bounds)
                own = label[first : first + len(bounds) - 1]
                of = np.repeat(own, np.diff(ends))
                for c in (0, 1):
                    counts[c, :-1] += np.bincount(found[of == c], minlength=FEATURES)
                    counts[c, -1] += int((own == c).sum())
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.ravel()[at])], ["at", "n"])

    # At most 2 * (FEATURES + 1) sums come to the driver.
    sums = texts.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(2 * (FEATURES + 1), np.int64)
    for at, n in sums:
        counts[at] = n
    return counts.reshape(2, -1)


def log_count_ratios(counts: np.ndarray) -> np.ndarray:
    """log of the smoothed share of features in class 1 over that in class 0."""
    p, q = counts[1, :-1] + 1.0, counts[0, :-1] + 1.0
    return np.log(p / p.sum()) - np.log(q / q.sum())


def row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sum of each row's values, from these alone: equal rows have equal sums wherever they stand."""
    sums, filled = np.zeros(len(ends) - 1), ends[1:] > ends[:-1]
    if filled.any():
        sums[filled] = np.add.reduceat(values, ends[:-1][filled])
    return sums


def scaled(ends: np.ndarray, found: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Values of the features: their ratios, with each row brought to length 1."""
    values = ratios[found]
    norm = np.sqrt(np.maximum(row_sums(values * values, ends), 1e-12))
    return values / np.repeat(norm, np.diff(ends))


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, costs: np.ndarray, epochs: int = 30, seed: int = 1) -> np.ndarray:
    """Weights, the bias last, of the linear hinge-loss model; costs bound the dual variable of each row."""
    weights, alpha = np.zeros(FEATURES + 1), np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for _, v in rows])
    random = np.random.RandomState(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in random.permutation(len(rows)):
            at, v = rows[i]
            gradient = signs[i] * (weights[at] @ v + weights[-1]) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), costs[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * signs[i]
                weights[at] += step * v
                weights[-1] += step
                largest = max(largest, abs(new - alpha[i]))
                alpha[i] = new
        if largest < 1e-3:
            break
    return weights


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a m + b))) by Newton steps with smoothed targets; a is not negative."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w, e = np.maximum(p * (1 - p), 1e-9), p - target
        h = np.array([[(w * margins * margins).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-3]])
        da, db = np.linalg.solve(h, [(e * margins).sum() + 1e-3 * a, e.sum() + 1e-3 * b])
        a, b = a - np.clip(da, -5, 5), b - np.clip(db, -5, 5)
        if abs(da) + abs(db) < 1e-8:
            break
    return max(a, 0.0), b


def _fit(ratios: np.ndarray):
    def run(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values(["turn", "text"], na_position="first")
        labels, rows = sample["label"].to_numpy(), []
        for first, data, bounds in kernels.text_slices(pa.array(sample["text"], pa.string())):
            ends, found = features(data, bounds)
            values = scaled(ends, found, ratios)
            rows += [(found[a:b], values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        unseen = np.arange(len(rows)) % 5 == 4
        seen = [i for i in range(len(rows)) if not unseen[i]]
        signs = np.where(labels == 1, 1.0, -1.0)
        share = max(labels[seen].mean(), 1e-9) if seen else 1.0
        costs = np.where(labels == 1, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3))
        weights = dual_coordinate_descent([rows[i] for i in seen], signs[seen], costs[seen])
        margins = np.array([weights[at] @ v + weights[-1] for at, v in rows])
        a, b = logistic_curve(margins[unseen], labels[unseen]) if unseen.any() else (1.0, 0.0)
        return pd.DataFrame({"at": np.arange(FEATURES + 3), "weight": np.r_[weights, a, b]})

    return run


def train(documents: DataFrame, labels: DataFrame, target: str = "quality") -> np.ndarray:
    """Ratios and model as one array of 2 * FEATURES + 3 numbers. labels: doc_id and the target, 0 or 1; of several labels of a
    document the largest counts, null ones do not."""
    told = labels.where(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    told = keep(told.groupBy("doc_id").agg(F.max(target).cast("long").alias("label")))
    # Texts without a label are sifted out before the shuffle; the join with all labels is then the same at any size.
    texts = documents.select("doc_id", "text").where("doc_id is not null")
    labelled = may_be_among(texts, "doc_id", bloom_words(told, "doc_id"))
    rows = labelled.join(told.hint("merge"), "doc_id")
    ratios = log_count_ratios(class_counts(rows.select("text", "label")))
    # The sample is bounded by SAMPLE_ROWS ids, which may be sent to all tasks; of several texts of an id the one with
    # the smallest hash is taken, so that it is also bounded by rows. The ratios count them all.
    turn = F.xxhash64("doc_id")
    sample = told.orderBy(turn, "doc_id").limit(SAMPLE_ROWS)
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(turn.alias("turn"), "text", "label")
    texts = texts.groupBy("turn", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    model = texts.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(_fit(ratios), "at long, weight double").collect()
    weights = np.zeros(FEATURES + 3)
    weights[-2] = 1.0
    for at, weight in model:
        weights[at] = weight
    return np.concatenate([ratios, weights])


def score_documents(documents: DataFrame, model: np.ndarray, threshold: float = 0.7) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted.

    A null or empty text has no features and gets the score of the bias; without labels all
    scores are 0.5. Repeated rows have one result each.
    """
    ratios, weights, bias, a, b = model[:FEATURES], model[FEATURES : 2 * FEATURES], *model[2 * FEATURES :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in kernels.text_slices(batch.column(1)):
                ends, found = features(data, bounds)
                margin = row_sums(weights[found] * scaled(ends, found, ratios), ends) + bias
                score = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(score)), pa.array(score)], ["doc_id", "score"])

    kept = documents.select("doc_id", "text")
    scores = kept.mapInArrow(run, f"doc_id {dict(kept.dtypes)['doc_id']}, score double")
    return scores.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
