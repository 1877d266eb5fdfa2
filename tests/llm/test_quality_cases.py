"""The quality classifier on odd tables, and its fitting against plain versions."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from ledgerline.llm import kernels, quality_model
from ledgerline.llm.quality_model import FEATURES, dual_coordinate_descent, features, log_count_ratios, score_documents, train


LABELS = "doc_id long, quality int, toxic int, text string"


def texts_and_labels(spark, make_documents, n=160):
    random.seed(12)
    good = lambda: " ".join(random.choices(["the", "river", "runs", "slowly", "north", "again."], k=30))
    bad = lambda: " ".join(random.choices(["BUY", "now!!!", "$$$", "click", "win###", "free"], k=30))
    rows = [(k, good() if k % 2 else bad(), "s") for k in range(n)]
    labels = [(k, k % 2, 0, "not a text") for k in range(0, n, 1)]
    return rows, labels


def test_odd_rows_get_a_score(spark, make_documents):
    rows, labels = texts_and_labels(spark, make_documents)
    rows += [(900, None, "s"), (901, "", None), (902, " \n", "s"), (903, "river runs " * 40_000, "s"), (904, "BUY now!!! " * 40_000, "s"), (None, "the river", "s"), (3, rows[3][1], "s"), (3, rows[3][1], "s")]
    labels += [(5, None, 1, ""), (None, 1, 0, ""), (7, 7, 0, ""), (8, 1, 0, ""), (9999, 1, 0, "")]
    documents = make_documents(rows).selectExpr("*", "1 as label", "'x' as score", "2 as word", "3 as held")
    model = train(documents, spark.createDataFrame(labels, LABELS))
    got = score_documents(documents, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, *_ in rows)
    scores = {r.doc_id: r.score for r in got}
    assert scores[900] == scores[901] == scores[902]
    assert scores[903] > 0.7 > 0.3 > scores[904]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert sum((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in got if r.doc_id is not None and r.doc_id < 160) >= 155
    assert len({r.score for r in got if r.doc_id == 3}) == 1


def test_without_labels_or_documents(spark, make_documents):
    rows, labels = texts_and_labels(spark, make_documents, 12)
    documents, none = make_documents(rows), spark.createDataFrame([], LABELS)
    assert {r.score for r in score_documents(documents, train(documents, none)).collect()} == {0.5}
    empty = make_documents([])
    model = train(empty, spark.createDataFrame(labels, LABELS))
    assert score_documents(empty, model).collect() == []


def test_texts_without_a_label_are_not_shuffled(spark, make_documents):
    """Few labels: the filter lets few rows into the join."""
    documents = spark.range(5000).selectExpr("id as doc_id", "'a b' as text")
    told = spark.range(40).selectExpr("id * 100 as doc_id", "1L as label")
    passed = quality_model.may_be_among(documents, "doc_id", quality_model.bloom_words(told, "doc_id"))
    assert 40 <= passed.count() <= 45


def test_ratios_against_plain_counts(spark, make_documents):
    rows, labels = texts_and_labels(spark, make_documents, 40)
    table = spark.createDataFrame([(t, k % 2) for k, t, _ in rows], "text string, label long")
    counts = quality_model.class_counts(table)
    plain = [Counter(), Counter()]
    for k, text, _ in rows:
        for _, data, bounds in kernels.text_slices(pa.array([text])):
            plain[k % 2].update(features(data, bounds)[1].tolist())
    assert all(counts[c, f] == n for c in (0, 1) for f, n in plain[c].items())
    assert counts[:, -1].tolist() == [20, 20] and counts[:, :-1].sum() == sum(map(sum, map(Counter.values, plain)))
    ratios, sums = log_count_ratios(counts), [FEATURES + sum(p.values()) for p in plain]
    for f in list(plain[0])[:5] + list(plain[1])[:5]:
        assert math.isclose(ratios[f], math.log((plain[1][f] + 1) / sums[1]) - math.log((plain[0][f] + 1) / sums[0]))


def test_descent_reaches_the_optimum():
    """No dual variable can be moved to a better value: the conditions of the optimum hold."""
    random.seed(4)
    rows, signs = [], []
    for _ in range(60):
        at = np.array(sorted(random.sample(range(20), 5)))
        value = np.array([random.uniform(-1, 1) for _ in at])
        rows.append((at, value))
        signs.append(1.0 if value[0] + 0.3 * random.uniform(-1, 1) > 0 else -1.0)
    signs, costs = np.array(signs), np.full(60, 0.5)
    weights = dual_coordinate_descent(rows, signs, costs, epochs=3000)
    full = np.zeros((60, 21))
    for k, (at, value) in enumerate(rows):
        full[k, at], full[k, 20] = value, 1.0
    plain, alpha = np.zeros(21), np.zeros(60)
    for _ in range(4000):
        for k in range(60):
            new = min(max(alpha[k] - (signs[k] * (plain @ full[k]) - 1) / (full[k] @ full[k]), 0), 0.5)
            plain += (new - alpha[k]) * signs[k] * full[k]
            alpha[k] = new
    loss = lambda w: 0.5 * w @ w + 0.5 * np.maximum(0, 1 - signs * (full @ w)).sum()
    assert loss(np.r_[weights[:20], weights[-1]]) <= loss(plain) * 1.001
