"""Periodic runs of words against a search for every period."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm.periodic_runs import BLOCK, Positions, collapse_runs, find_runs, repeated_from
from tests.llm import brute


def found_in(texts, shortest=6, repeats=4):
    """Runs of lists of words, by text."""
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    hashes = np.array([hash(w) & 0xFFFFFFFFFFFF for t in texts for w in t], np.uint64)
    runs = find_runs(hashes, row, shortest, repeats)
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    got = [[] for _ in texts]
    for s, m, q in zip(runs.start.tolist(), runs.length.tolist(), runs.period.tolist(), strict=True):
        got[row[s]].append((s - int(first[row[s]]), m, q))
    return got


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), max_size=4), st.sampled_from([(6, 4), (2, 2), (5, 3)]))
def test_runs_of_two_words(texts, bounds):
    assert found_in(texts, *bounds) == [brute.word_runs(t, *bounds) for t in texts]


def test_runs_of_repeated_stretches():
    random.seed(3)
    texts = []
    for _ in range(150):
        text = []
        for _ in range(random.randint(0, 5)):
            unit = random.choices("abcdefgh"[: random.randint(1, 8)], k=random.randint(1, 12))
            text += (unit * random.randint(1, 9))[: random.randint(1, 100)]
            text += random.choices("xyz", k=random.randint(0, 4))
        texts.append(text)
    assert found_in(texts) == [brute.word_runs(t) for t in texts]


def test_figures_of_documents(make_documents, corpus):
    random.seed(5)
    rows = [(i, t, "s") for i, t in enumerate(corpus)]
    rows += [(1000 + i, " ".join(random.choices("ab", k=random.randint(1, 90))), "s") for i in range(150)]
    rows += [(7, "a b " * 30, "s"), (7, "a b " * 30, "s"), (None, "la " * 50, None), (2000, "é é \n\t é " * 9, "s")]
    documents = make_documents(rows).selectExpr("*", "1 as n_runs", "2 as start", "text as collapsed")
    got = collapse_runs(documents, repeated_from, with_text=True).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((d, *brute.collapsed(d, t))) for d, t, _ in rows)


def test_a_long_text_is_read_whole(make_documents):
    random.seed(6)
    head = " ".join(random.choices("abcdefghijklmnop", k=300_000))
    text = f"{head} " + "x y z " * 20_000 + head[:999]
    (row,) = collapse_runs(make_documents([(1, text, "s")])).collect()
    assert (row.start, row.length, row.period) == (300_000, 60_000, 3)


def test_no_documents(make_documents):
    assert collapse_runs(make_documents([]), repeated_from).collect() == []


def test_positions_stay_in_order():
    random.seed(4)
    wanted = random.sample(range(20 * BLOCK), 6 * BLOCK)
    held = Positions(wanted[0])
    for k, position in enumerate(wanted[1:], 1):
        if k % 97 == 0:
            before = sorted(wanted[:k])
            below = max((x for x in before if x < position), default=None)
            above = min((x for x in before if x > position), default=None)
            assert held.neighbours(position) == (below, above)
        held.add(position)
    assert list(held) == sorted(wanted)


def test_bounds_that_are_no_repeats():
    with pytest.raises(ValueError):
        find_runs(np.zeros(3, np.uint64), np.zeros(3, np.int64), 6, 1)
