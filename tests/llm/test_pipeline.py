"""The pipeline's stages against brute force, and the learned model on held-out rows."""

import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from ledgerline.llm import queries
from ledgerline.llm.mixing import mix_sources
from ledgerline.llm.workspace import keep
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def test_every_stage_works_on_what_its_predecessor_kept(spark, make_documents, corpus):
    random_rows = [(i, t, "ab"[i % 2]) for i, t in enumerate(corpus)]
    docs = make_documents([*random_rows, random_rows[50], (None, corpus[50], None)])
    stage = dict(corpus_pipeline.STAGES)
    kept = keep(stage["quality rules"](spark, docs, SMALL))
    assert kept.columns == docs.columns
    rows = {(r.doc_id, r.text) for r in kept.collect()}
    assert rows == {(r.doc_id, r.text) for r in docs.collect() if not brute.base_figures(r.text)[-1]}

    single = keep(stage["n-gram Jaccard join"](spark, kept, SMALL))
    groups = brute.components([(d, t) for d, t in rows if d is not None], 5, 80)
    assert single.columns == docs.columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d, (_, c) in groups.items() if c == d)

    cut = keep(stage["suffix-array dedup"](spark, single, SMALL))
    want = brute.without_repeats([(r.doc_id, r.text) for r in single.collect()], 50)
    before = {r.doc_id: r.text for r in single.collect()}
    assert cut.columns == docs.columns
    for r in cut.collect():
        spare = want[r.doc_id][0] - want[r.doc_id][1]
        assert spare <= len(r.text.encode()) <= spare + 6 * want[r.doc_id][2]
        assert (r.text == before[r.doc_id]) == (want[r.doc_id][1] == 0) or want[r.doc_id][1] < 60

    mixed = keep(stage["mixing sources"](spark, cut, SMALL))
    taken, got = Counter(), Counter()
    for r in mix_sources(cut)[0].collect():
        taken[r.doc_id] += r.taken
    for r in mixed.collect():
        got[r.doc_id] += len(brute.words(r.text))
    assert +taken == +got

    packed = stage["packing"](spark, mixed, SMALL).collect()
    whole = Counter()
    for r in packed:
        whole[r.doc_id] += r.length
    assert set(whole) == {r.doc_id for r in mixed.collect()}


def test_quality_on_held_out_rows(spark):
    got = {r.doc_id: r for r in queries.op8_quality_nbsvm(spark, "/root/testdata/sf0.01").collect()}
    labels = pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist()
    held = [(got[x["doc_id"]], x["quality"]) for x in labels if got[x["doc_id"]].held_out]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert len(held) > 50
    assert sum(r.predicted == q for r, q in held) / len(held) >= 0.95


@pytest.mark.parametrize("name", ["op6_exact_top_k", "op10_url_filter"])
def test_expected_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in ("embeddings", "pages"):
        connection.sql(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    frame = queries.QUERIES[name](spark, SMALL)
    want = connection.execute(f"select {', '.join(frame.columns)} from ({queries.EXPECTED[name]})").fetchall()
    assert Counter(map(tuple, frame.collect())) == Counter(want)
