"""Mixing, sharding, packing, rules, licenses, search and URLs against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import licenses, mixing, packing, quality_model, quality_rules, sharding, topk, url_filter
from ledgerline.llm.vocabulary import vocabulary_path
from tests.llm import brute


def test_mix_takes_the_targets(make_documents, corpus):
    random.seed(1)
    rows = [(i, t, random.choice(["a", "b", "c", None, "é", "zz"])) for i, t in enumerate(corpus)]
    documents = make_documents([*rows, *rows[:20]])
    found, mix = mixing.mix_sources(documents, block_words=8)
    got, again = found.collect(), mixing.mix_sources(documents, block_words=8)[0]
    sizes = Counter()
    for r in got:
        sizes[r.source] += r["size"]
    want = brute.targets(sizes)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
    for s, t in want.items():
        assert abs(taken[s] - t) <= 16
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted((str(d), len(brute.words(t))) for d, t, _ in [*rows, *rows[:20]])
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again.collect())
    slots = mix.groupBy("rank", "slot").count().where("count > 1")
    assert slots.count() == 0


def test_permutation_hits_every_index(spark):
    for n in (1, 2, 3, 17, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.xxhash64(F.lit(5))).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def test_mixed_documents_hold_the_words_taken(make_documents, corpus):
    rows = [(i, t, "ab"[i % 2]) for i, t in enumerate(corpus)]
    documents = make_documents([*rows, rows[3], rows[40]]).withColumn("pieces", F.lit(1))
    mixed = mixing.mixed_documents(documents, block_words=8)
    assert mixed.columns == documents.columns
    taken = Counter()
    for r in mixing.mix_sources(documents, block_words=8)[0].collect():
        taken[r.doc_id] += r.taken
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id] += len(brute.words(r.text))
    assert +got == +taken


def test_equal_rows_take_their_places_one_by_one(make_documents):
    rows = [(1, "a b c d e f g", "s")] * 300 + [(2, "x y z", "s")] * 5
    documents = make_documents(rows)
    mixed = mixing.mixed_documents(documents, block_words=4)
    assert "collect_list(struct(start" not in mixed._jdf.queryExecution().optimizedPlan().toString()
    taken, got = Counter(), Counter()
    for r in mixing.mix_sources(documents, block_words=4)[0].collect():
        taken[r.doc_id] += r.taken
    for r in mixed.collect():
        got[r.doc_id] += len(brute.words(r.text))
    assert got == taken


def test_mix_of_nothing(make_documents):
    assert mixing.mix_sources(make_documents([]))[0].collect() == []
    got = mixing.mix_sources(make_documents([(1, None, "a"), (None, " ", None)]))[0].collect()
    assert {(r["size"], r.source_size, r.target, r.taken) for r in got} == {(0, 0, 0.0, 0)}
    assert mixing.mixed_documents(make_documents([(1, None, "a")])).collect() == []


def test_shards_are_even_and_keep_groups(make_documents, corpus, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET", 16)
    rows = [(i, t, "s") for i, t in enumerate(corpus * 2)] + [(None, "x", "s"), (3, corpus[3], "s")]
    got = sharding.shard_documents(make_documents(rows), 5, portion=10).collect()
    shards, slots, groups = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        shards[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        groups[r.text_crc32, r["size"]].add(r.shard)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(Counter({k: k[1] for k in groups}).values()) * 4
    assert max(shards.values()) - min(shards.values()) <= largest
    assert sharding.shard_documents(make_documents([]), 5).collect() == []


def test_differencing_beats_the_largest_part():
    random.seed(2)
    parts = np.zeros((500, 24), np.int64)
    parts[:, -1] = [random.randint(1, 10_000) for _ in range(500)]
    sums, place = sharding.difference(parts)
    again = np.zeros(24, np.int64)
    np.add.at(again, place[:, -1], parts[:, -1])
    assert (again == sums).all()
    assert sums[-1] - sums[0] < 100
    assert (np.sort(place, axis=1) == np.arange(24)).all()


def test_packed_pieces_are_the_tokens(make_documents, corpus):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    odd = ["İstanbul ΣΑΣ, don't <|endoftext|> it's 12345!!", "ABC... (x) a,b e\u0301t\u00e9 \u00a0 \u2003y", "||| *** Word### ЁЖ. \u1e9e"]
    texts = [*corpus, *odd, *corpus[:5]]
    got = packing.pack_documents(make_documents([(i, t, "s") for i, t in enumerate(texts)]), vocabulary_path(), 256).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, t in enumerate(texts):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert zlib.crc32(ids[r.start : at].tobytes()) == r.ids_crc32
        assert at == len(ids)
    for s in sequences.values():
        ends = np.cumsum([n for _, n in sorted(s)])
        assert [o for o, _ in sorted(s)] == [0, *ends[:-1]]
        assert ends[-1] <= 256
    assert packing.pack_documents(make_documents([]), vocabulary_path()).collect() == []


def packed_as_whole(make_documents, texts):
    """Whether every text is packed as the ids that the vocabulary gives for it as a whole."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    whole = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for t in texts]
    got = packing.pack_documents(make_documents([(i, t, "s") for i, t in enumerate(texts)]), vocabulary_path(), 1 << 16).collect()
    return {r.doc_id: (r.start, r.length, r.doc_tokens, r.ids_crc32) for r in got} == {i: (0, len(w), len(w), zlib.crc32(w.tobytes())) for i, w in enumerate(whole)}


def test_letters_that_normalise_to_marks_join_the_punctuation(make_documents):
    latin = [chr(c) for c in range(0x80, 0x250) if chr(c).isalpha()]
    texts = ["SAL\u0130,", "\u0917\u095d,", "\u09dc\u09dd. \ufb2a!", *[f"x{c}, {c}.. A{c}b;" for c in latin]]
    assert packed_as_whole(make_documents, texts)


def test_separators_are_tokens(make_documents):
    assert packed_as_whole(make_documents, [f"a{c}b {c} c\u2003{c}{c}d,{c}\x85e" for c in "\x1c\x1d\x1e\x1f"])


def test_best_counts_is_the_best_total():
    random.seed(4)
    for _ in range(200):
        available = {random.randint(1, 40): random.randint(1, 4) for _ in range(random.randint(0, 6))}
        room = random.randint(0, 90)
        totals = {0}
        for length, n in available.items():
            totals = {t + length * k for t in totals for k in range(n + 1) if t + length * k <= room}
        counts = packing.best_counts({k: v for k, v in available.items() if k <= room}, room)
        assert sum(k * v for k, v in counts.items()) == max(totals)
        assert all(v <= available[k] for k, v in counts.items())


def test_base_figures_equal_brute_force(make_documents, corpus):
    texts = [*corpus, "a b c d e f " * 9, "x " * 40, "l 1\nl 1\n \nl 1 \nl 2", "# a|b <c> **", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w1 w2 w3 w4 w5"]
    got = quality_rules.judged(make_documents(texts), F.struct("doc_id")).collect()
    want = {i: brute.base_figures(t) for i, t in enumerate(texts)}
    assert {r.row.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got} == want
    assert all(r.kept is not r.base_failed for r in got)


def test_depleted_documents_go_and_the_others_stay(make_documents):
    line = "Subscribe to our letter and win {} prizes every day"
    nav = [(i, f"{line.format(i)}\nmenu home {i}", "a") for i in range(30)]
    nav += [(100 + i, f"{line.format(7)}\nnothing else but this one line is new number {'x' * i}", "a") for i in range(10)]
    clean = [(200 + i, " ".join(f"w{i}x{k}" for k in range(40)), None if i % 2 else "a") for i in range(40)]
    copies = [(300 + i, "the same text stands here many times over and is not boilerplate", "b") for i in range(60)]
    documents = make_documents([*nav, *clean, *copies, (None, None, None)]).withColumn("kept", F.lit(0)).withColumn("text_key", F.lit(0))
    got = quality_rules.judged(documents, F.struct("*")).collect()
    assert len(got) == 141
    kept = {r.row.doc_id for r in got if r.kept}
    assert kept == {100 + i for i in range(10)} | {200 + i for i in range(40)} | {300 + i for i in range(60)}
    assert quality_rules.judged(documents.limit(0), F.struct("*")).collect() == []


def test_long_shared_lines_deplete_documents_too(make_documents):
    notice = " ".join(f"term{k}" for k in range(45))
    pages = [(i, f"{notice}\nown{i} page{'x' * i}", "a") for i in range(30)]
    whole = [(100 + i, f"{notice}\n{' '.join(k + 'x' * i for k in 'abcdefghijkl')}", "a") for i in range(30)]
    rare = [(200 + i, f"{notice}\nown{i} page{'x' * i}", "b") for i in range(20)]
    got = quality_rules.judged(make_documents([*pages, *whole, *rare]), F.struct("doc_id")).collect()
    assert {r.row.doc_id for r in got if r.kept} == {100 + i for i in range(30)} | {200 + i for i in range(20)}


def test_phrases_equal_brute_force(make_documents, corpus):
    texts = [*corpus, "Released under the MIT License.", "under the mit-license under\x7fthe mit license", "cc-by-nc, CC BY NCé", "Apache License, Version 2.0 apache license version 2", "under the mit"]
    got = licenses.scan_licenses(make_documents(texts)).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == {i: brute.phrase_places(t) for i, t in enumerate(texts)}
    assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 for r in got)
    assert licenses.scan_licenses(make_documents([])).collect() == []


@pytest.mark.parametrize(
    "text, label",
    [
        ("This is licensed under the GNU General Public License, version 3.", "gpl"),
        ("licensed under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1", "gpl"),
        ("Licensed under the Apache License, Version 2.0.", "apache-2"),
        ("this whole program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
        ("this is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
        ("licensed under the GNU Public License version 3", ""),
        ("licensed under the GNU General Public License of any version", ""),
    ],
)
def test_templates(make_documents, text, label):
    row = licenses.scan_licenses(make_documents([text])).first()
    assert row.labels == label
    assert (row.score == 1) == bool(label)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 256)
    random.seed(5)
    vectors = [[random.choice((-1.5, 0.25, 1.0, 0.001)) for _ in range(6)] for _ in range(60)] + [[1.0] * 6] * 30
    rows = list(enumerate(vectors)) + [(500, None), (600, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (700, [float("nan")] * 6), (800, [float("inf")] * 6), (None, [1.0] * 6), (20, vectors[20]), (900, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(table, 10, 10).collect()
    full = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for i, v in dict(full).items():
        if i % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in full if j != i)[:10]
            assert [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == i), key=lambda r: r.rank)] == [(j, -s) for s, j in best]
    assert {r.query_id for r in got} == {i for i, _ in full if i % 10 == 0}
    assert topk.top_k(table.limit(0)).collect() == []


def test_fewer_candidates_than_k(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(table).orderBy("rank").collect()] == [(0, 1, 1, 2048 * 1024), (0, 2, 2, 2048 * 1024)]
    assert topk.top_k(table.where("vec_id = 0")).collect() == []


URLS = [
    (1, "http://a.com/x"), (2, "https://example.com/en/1"), (3, "HTTP://WWW.Example.com/en/1?q=/es/"), (4, "http://b.net/es/"), (5, "http://b.net/fr"), (6, "http://net/fr/#x"),
    (7, "http://xnet/fr/"), (8, None), (9, "no scheme"), (10, "http://spam-farm.example.org/a.html?utm_source=x&b=2&a=1#f"), (11, "https://www.spam-farm.example.org:443/a?a=1&b=2"),
    (12, "http://sub.www.example.com/en/"), (13, "http://example.com"), (14, "x://y://z.net/es/"), (15, "http://b.net?/es/"), (16, "http://ok.example.org/a"), (10, "http://spam-farm.example.org/a.html?utm_source=x&b=2&a=1#f"),
]


def test_urls(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("rule", F.lit(0)).withColumn("block", F.lit(0))
    got = url_filter.filter_urls(pages, url_filter.pages_of_listed_hosts(pages)).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got if r.page_id in (3, 4, 5, 6, 8, 9, 13, 14, 15)) == [
        (3, "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (4, "b.net", "/es/", "net/es/", "block"),
        (5, "b.net", "/fr", None, "allow"),
        (6, "net", "/fr/", "net/fr/", "block"),
        (8, "", "", None, "allow"),
        (9, "", "", None, "allow"),
        (13, "example.com", "", None, "allow"),
        (14, "y:", "//z.net/es/", None, "allow"),
        (15, "b.net", "", None, "allow"),
    ]
    verdicts = [(r.page_id, r.rule, r.verdict) for r in got]
    assert verdicts.count((10, None, "block")) == 2
    assert {(1, "com/", "allow"), (2, "example.com/en/", "block"), (7, None, "allow"), (11, None, "block"), (12, "www.example.com/en/", "allow"), (16, None, "allow")} <= set(verdicts)
    assert len(got) == len(URLS)
    assert {r.verdict for r in url_filter.filter_urls(pages.where("page_id = 10"), pages.limit(0)).collect()} == {"allow"}


def test_filter_passes_all_listed_and_few_others(spark, monkeypatch):
    listed = spark.range(3000).select(F.concat(F.lit("h/"), "id").alias("canonical"))
    urls = spark.range(20000).select(F.concat(F.lit("h/"), "id").alias("canonical"))
    passed = {r.canonical for r in url_filter.possible_hits(urls, listed).collect()}
    assert {f"h/{i}" for i in range(3000)} <= passed
    assert len(passed) < 3000 + 17000 * 0.02
    monkeypatch.setattr(url_filter, "MOST_BLOCKS", 2)
    assert {f"h/{i}" for i in range(3000)} <= {r.canonical for r in url_filter.possible_hits(urls, listed).collect()}




def test_training_rows_are_bounded_though_an_id_has_many_texts(spark, make_documents, monkeypatch):
    import pandas as pd

    def counting(ratios):
        return lambda sample: pd.DataFrame({"at": [0], "weight": [float(len(sample))]})

    monkeypatch.setattr(quality_model, "_fit", counting)
    documents = make_documents([(i // 50, f"text {i}", "s") if i < 400 else (i, None, "s") for i in range(420)])
    told = spark.createDataFrame([(i, i % 2) for i in [*range(8), *range(400, 420)]], "doc_id long, quality long")
    ids = told.where(~quality_model.is_held_out(F.col("doc_id"))).count()
    assert quality_model.train(documents, told)[quality_model.FEATURES] == ids


def test_words_encoded_together_have_their_own_ids():
    from tokenizers import Tokenizer

    random.seed(21)
    path = vocabulary_path()
    tokenizer = Tokenizer.from_file(path)
    letters = "abcXYZéÀßªºµÿÿ"
    made = ["".join(random.choices(letters, k=random.randint(1, 12))) + random.choice(["", "", ".", "!?", "'s", "ü", "İ", "7"]) for _ in range(9000)]
    made += ["µ", "ª", "ß", "<|endoftext|>", "a<|endoftext|>b", "SALİ,", "don't", "x" * 5000]
    found = packing.word_encoder(path)(list(dict.fromkeys(made)))
    for word in made:
        assert np.frombuffer(found[word], np.uint32).tolist() == tokenizer.encode(word, add_special_tokens=False).ids, word


def test_a_url_without_a_scheme_is_no_listed_one(spark):
    pages = spark.createDataFrame([(1, "foo?x=1"), (2, "http://h.org/a?x=1"), (3, "?x=1"), (4, None)], "page_id long, url string")
    listed = spark.createDataFrame([("bar?x=1",), ("https://www.h.org/a/?utm_s=2&x=1",), (None,), ("",), ("x",)], "url string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, listed).collect()}
    assert got == {1: "allow", 2: "block", 3: "allow", 4: "allow"}
