"""The n-gram join and the suffix-array dedup against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import ngram_join, suffix_dedup
from ledgerline.llm.components import components
from ledgerline.llm.ngram_join import near_duplicates, one_of_each_group
from ledgerline.llm.suffix_dedup import remove_repeats, whole_characters
from ledgerline.llm.workspace import keep
from tests.llm import brute


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80)])
def test_components_equal_brute_force(make_documents, corpus, size, percent):
    got = near_duplicates(make_documents(corpus), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(list(enumerate(corpus)), size, percent)


def test_group_of_near_copies_without_their_base(make_documents):
    """Copies whose only links are among each other, some through one chain."""
    random.seed(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(150):
        copy = list(base)
        for _ in range(random.choice((1, 1, 2, 2, 3, 4, 6))):
            copy[random.randrange(120)] = f"x{random.randrange(30)}"
        texts.append(" ".join(copy))
    got = near_duplicates(make_documents(texts), 4, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(list(enumerate(texts)), 4, 85)


def test_plans_leave_out_no_more_than_allowed():
    for percent in (80, 85):
        ends = ngram_join.upper_ends(percent, 5000)
        for band in ngram_join.plan_bands(percent, {k: 10**k for k in range(10)}, ends):
            reach = 2 * band.segments if band.deletions else band.segments - band.weakest
            assert reach >= band.differences + 1
        for r in range(1, 400):
            for s in range(r, r * 100 // percent + 1):
                low, high = (next(k for k, e in enumerate(ends) if e >= n) for n in (r, s))
                assert high - low <= 1


def test_one_of_each_group_stays(make_documents):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text, "a"), (3, text + " more", "b"), (3, text + " more", "b"), (None, text, None), (9, "", "a"), (8, None, "a"), (7, "other words", "a")]
    documents = make_documents(rows).withColumn("group", F.lit(1)).withColumn("first", F.lit("x"))
    got = one_of_each_group(documents)
    assert got.columns == documents.columns
    assert sorted(r.doc_id for r in got.collect()) == [3, 7, 8, 9]


def test_join_with_nulls_repeats_and_no_rows(make_documents):
    text = "a b c d e f g h"
    rows = [(None, text, "s"), (4, text, "s"), (4, text, "s"), (2, text.upper(), None), (1, None, "s"), (None, "", "s")]
    got = near_duplicates(make_documents(rows), 4, 85).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in got if r.n_shingles) == [(-1, 5, 2), (2, 5, 2), (4, 5, 2), (4, 5, 2)]
    assert {(r.doc_id, r.component_id) for r in got if not r.n_shingles} == {(1, 1), (None, None)}
    assert near_duplicates(make_documents([]), 4, 85).collect() == []


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(300, 299), (None, 3), (7, 7), (300, 299)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 299: 299, 300: 299}
    assert components(edges.limit(0)).collect() == []


@pytest.mark.parametrize("batch, hot", [(1 << 17, 5000), (500, 5)])
def test_removed_bytes_equal_brute_force(make_documents, corpus, monkeypatch, batch, hot):
    monkeypatch.setattr(suffix_dedup, "BATCH_WINDOWS", batch)
    monkeypatch.setattr(suffix_dedup, "HOT_DOCUMENTS", hot)
    texts = [*corpus, "\0" * 70 + "x", "y" + "\0" * 55, "ab" * 50, "ba" * 50]
    got = remove_repeats(make_documents(texts).select("doc_id", "text"), 50).collect()
    want = brute.without_repeats(list(enumerate(texts)), 50)
    assert {r.row.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_levels_merge_geometrically():
    import numpy as np

    family = suffix_dedup.IndexFamily()
    for i in range(40):
        windows = np.array([f"{k:050d}" for k in range(i * 10, i * 10 + 15)], "S50")
        covered = family.judge(windows, np.full(15, i))
        assert covered.tolist() == [i > 0] * 5 + [False] * 10
    assert len(family.levels) <= 7
    assert sum(len(x.windows) for x in family.levels) == 405


def test_repeats_with_nulls_equal_ids_and_clashing_columns(make_documents):
    text = "0123456789" * 6
    rows = [(1, text, "s"), (1, text, "s"), (None, text, "s"), (2, text + "!", None), (3, None, "s"), (4, "", "s")]
    documents = make_documents(rows).withColumn("id", F.lit(1)).withColumn("row", F.lit("r")).withColumn("spans", F.lit(0))
    got = remove_repeats(documents, 50).collect()
    assert sorted((str(r.row.doc_id), r.n_removed, r.kept_text) for r in got) == [("1", 0, text), ("1", 0, text), ("2", 60, "!"), ("3", 0, None), ("4", 0, ""), ("None", 60, "")]
    assert {r.row.row for r in got} == {"r"}
    assert remove_repeats(documents.limit(0), 50).collect() == []


def test_characters_stay_whole():
    data = "aéé".encode()
    assert whole_characters(data, [(0, 2)]) == [(0, 1)]
    assert whole_characters(data, [(2, 5)]) == [(3, 5)]
    assert whole_characters(data, [(2, 3)]) == []


def far_copies(groups, members, words, edits):
    """Groups of copies of a text, most of them changed too much to be linked."""
    random.seed(groups)
    texts = []
    for g in range(groups):
        base = [f"w{g}x{i}" for i in range(words)]
        for k in range(members):
            copy = list(base)
            for _ in range(edits if k else 0):
                copy[random.randrange(words)] = f"x{random.randrange(10**6)}"
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("pairs", [0, 1, 16])
def test_small_and_large_buckets(make_documents, monkeypatch, pairs):
    monkeypatch.setattr(ngram_join, "PAIRS", pairs)
    monkeypatch.setattr(ngram_join, "FEW", 2)
    texts = far_copies(2, 30, 60, 2) + far_copies(3, 12, 100, 6)
    got = near_duplicates(make_documents(texts), 4, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(list(enumerate(texts)), 4, 85)


def test_members_without_a_partner_do_not_meet(make_documents, monkeypatch):
    """Copies that are not linked to their hub cost a few rows each, not one for each shingle."""
    kept = []
    monkeypatch.setattr(ngram_join, "keep", lambda frame: kept.append(keep(frame)) or kept[-1])
    texts = far_copies(6, 12, 300, 20)
    near_duplicates(make_documents(texts), 4, 85).collect()
    assert max(t.count() for t in kept if {"meeting", "starts"} & set(t.columns)) <= 12 * len(texts)


def test_sketches_leave_no_linked_pair_out(make_documents):
    texts = far_copies(4, 12, 80, 2) + far_copies(2, 12, 3, 1) + ["a"]
    sets = keep(ngram_join.shingle_sets(make_documents(texts), "text", 4, ["doc_id"]).dropDuplicates(["set_id"]))
    marks, pairs = ngram_join.sketches(sets), sets.select("set_id").crossJoin(sets.select(F.col("set_id").alias("hub"))).where("set_id <> hub")
    both = ngram_join._verified(ngram_join._sketched(ngram_join._sketched(pairs, marks, "set_id"), marks, "hub"), sets, 85)
    rows = [tuple(r) for r in both.select("linked", ngram_join._maybe("set_id", "hub", 85), "distance", "set_id_n").collect()]
    assert all(maybe for linked, maybe, _, _ in rows if linked) and any(linked for linked, *_ in rows)
    assert sum(maybe for linked, maybe, _, _ in rows if not linked) * 20 < len(rows)


def test_stretches_of_a_smaller_id_are_not_judged_again(monkeypatch):
    import pyarrow as pa

    judged = []
    judge = suffix_dedup.IndexFamily.judge
    monkeypatch.setattr(suffix_dedup.IndexFamily, "judge", lambda self, windows, ids: judged.append(len(windows)) or judge(self, windows, ids))
    text = bytes(range(97, 122)) * 8
    rows = [(0, 1, 11, 0, text, 200), (0, 1, 11, 300, text, 200), (0, 2, 12, 5, text, 200), (0, 3, 13, 7, None, 60), (0, 4, 14, 9, text, 200), (0, 4, 14, 400, b"x" + text, 201)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["part", "id", "text_key", "start", "bytes", "size"])
    spans = sorted(tuple(r.values()) for b in suffix_dedup._covered(50)(iter([batch])) for r in b.to_pylist())
    assert spans == [(2, 12, 5, 205), (3, 13, 7, 67), (4, 14, 9, 209), (4, 14, 401, 601)]
    assert sum(judged) == 151 + 151 + 152


def test_repeated_stretches_go_on_once(make_documents, monkeypatch):
    """Of a passage in many documents one copy's bytes are dealt, and what stands around it where the passage begins and ends."""
    kept = []
    segments = suffix_dedup._segments
    monkeypatch.setattr(suffix_dedup, "_segments", lambda *a: kept.append(segments(*a)) or kept[-1])
    random.seed(5)
    prose = lambda n: "".join(random.choices("abcdefgh ", k=n))
    passage = prose(600)
    texts = [prose(100) + passage + prose(100) for _ in range(40)]
    documents = make_documents(texts).repartition(8).select("doc_id", "text")
    got = remove_repeats(documents, 50).collect()
    want = brute.without_repeats(list(enumerate(texts)), 50)
    assert {r.row.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    dealt = kept[0].select("id", F.length("bytes").alias("n")).collect()
    assert 0 < sum(r.n or 0 for r in dealt) < 12_000
    assert len(dealt) < 8 * len(texts)


def test_stretches_of_an_anchor_without_a_common_window_are_not_judged(monkeypatch):
    import pyarrow as pa

    judged = []
    judge = suffix_dedup.IndexFamily.judge
    monkeypatch.setattr(suffix_dedup.IndexFamily, "judge", lambda self, windows, ids: judged.append(len(windows)) or judge(self, windows, ids))
    random.seed(6)
    text = lambda: bytes(random.choices(range(97, 123), k=30))
    rows = [(9, i, 100 + i, 5, text() + b"the anchor of them all" + text(), 82) for i in range(20)]
    shared = rows[3][4][10:65]
    rows.append((9, 30, 130, 40, b"x" + shared, 56))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["part", "id", "text_key", "start", "bytes", "size"])
    spans = [tuple(r.values()) for b in suffix_dedup._covered(50)(iter([batch])) for r in b.to_pylist()]
    assert spans == [(30, 130, 41, 96)]
    assert sum(judged) == 33 + 7


@pytest.mark.parametrize("rows_a_batch", [1, 3, 1000])
def test_stretches_are_compared_whole(spark, monkeypatch, rows_a_batch):
    monkeypatch.setattr(suffix_dedup, "HOT_DOCUMENTS", 3)
    random.seed(rows_a_batch)
    rows = [(random.choice((-7, -1, 0, 4, 9, 10)) << 20 | 5, random.randrange(4), random.randrange(6)) for _ in range(40)]
    rows += [(77 << 20 | k, k, 3) for k in range(9)] + [(78 << 20 | k, k, 3 + k // 7) for k in range(9)] + [(79 << 20, 0, 8)] * 3
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_batch)
    try:
        got = suffix_dedup._compared(spark.createDataFrame(rows, "high long, low int, id long").coalesce(1)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    first, contents, wanted = {}, {}, set()
    for high, low, i in rows:
        first[high, low] = min(i, first.get((high, low), i))
        contents.setdefault(high >> 20, set()).add((high, low))
    for anchor, group in contents.items():
        if len({first[c] for c in group}) > 1:
            wanted |= {(anchor, first[c], c) for c in group}
    found = {(r.anchor, r.id, r.mark & 3) for r in got if r.id is not None}
    assert found == {(h >> 20, i, 0) for h, low, i in rows if i > first[h, low]} | {(a, i, 1) for a, i, _ in wanted}
    assert sum(r.id is not None and r.mark & 3 == 1 for r in got) == len(wanted)
    assert {r.anchor for r in got if r.id is None} == {a for a, group in contents.items() if len(group) > 3}
