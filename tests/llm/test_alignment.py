"""Aligned tokenizers against whole texts and all pairs of their tokens."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import token_alignment as alignment
from ledgerline.llm.vocabulary import vocabulary_path
from tests.llm import brute

PATHS = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", " a", "a ", " a  b ", "a\n b", "a \n b\t", "▁", "a ▁ b", "a▁b", "<s> </s> <0x41> <|endoftext|>", "<unk>", "\x00 \x01", "日本語 の テスト", "é é ﬁ ①", "a  b", "x　 y z", "👩‍👩‍👧 🏳️‍🌈 !", "don't we'll", "1234567 89 0", "   \n   \n  x", "..  .. ."]


def brute_rows(rows):
    return sorted(map(str, brute.aligned(rows, *alignment.vocabularies(*PATHS))))


@pytest.mark.parametrize("known", [0, 30, alignment.MOST_KNOWN])
def test_documents(make_documents, corpus, known):
    rows = [(i, t, "s") for i, t in enumerate(ODD + corpus)] + [(3, "a b a", "s"), (3, "a b a", "s"), (None, "a b", None)]
    documents = make_documents(rows).repartition(5).selectExpr("*", "text as groups_sha256", "1 as code", "2 as row_id")
    got = alignment.align_tokenizers(documents, *PATHS, most_known=known).collect()
    assert sorted(map(str, map(tuple, got))) == brute_rows([(d, t) for d, t, _ in rows])


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab é\n\t.'1▁ 　 "), max_size=25) | st.text(max_size=25))
def test_units_have_the_tokens_of_the_whole_text(text):
    first, second = alignment.vocabularies(*PATHS)
    if not text:
        return
    found = alignment.align(list(dict.fromkeys(units := alignment.units_of(text))), first, second)
    place = {u: k for k, u in enumerate(found.units)}
    links = [np.arange(found.bounds[k], found.bounds[k + 1]) for k in map(place.get, units)]
    whole = first.encode(" " + text), second.encode(text)
    if any(b"".join(v.tokens[i] for i in ids) != f" {text}".encode() for v, ids in zip((first, second), whole, strict=True)):
        assert any(not len(x) for x in links)
        return
    at = np.concatenate(links)
    assert found.a[at][found.new_a[at]].tolist() == whole[0].tolist()
    assert found.b[at][found.new_b[at]].tolist() == whole[1].tolist()


def test_small_memories_change_nothing(make_documents, corpus, monkeypatch):
    """What a task forgets, it learns again; the pairs it hands on in between add up."""
    first, second = alignment.vocabularies(*PATHS)
    rows = [(i, t) for i, t in enumerate(ODD + corpus)]
    import pyarrow as pa

    same = alignment.identity_map(first, second)
    assert all(second.tokens[b] == first.tokens[a] for a, b in enumerate(same.tolist()) if b >= 0)
    texts = pa.array([t for _, t in rows])
    monkeypatch.setattr(alignment, "TEXT_CHARACTERS", 500)
    monkeypatch.setattr(alignment, "UNITS_KEPT", 120)
    seen, forgot = [], []
    units = alignment.Units(first, second, lambda found: seen.append(len(found.units)), lambda: forgot.append(1))
    for _, portion in alignment._portions(texts):
        numbers, bounds = units.numbers(portion)
        back = {k: u for u, k in units.index.items()}
        assert [[back[k] for k in numbers[i:j]] for i, j in zip(bounds, bounds[1:], strict=False)] == [alignment.units_of(t) if t else [] for t in portion]
    assert len(forgot) > 3


def test_a_long_text_without_spaces(make_documents):
    random.seed(8)
    text = "".join(random.choices("abcdé", k=60_000))
    (got,) = alignment.align_tokenizers(make_documents([(1, text, "s")]), *PATHS).collect()
    first, second = alignment.vocabularies(*PATHS)
    assert (got.n_a, got.n_b) == (len(first.encode(" " + text)), len(second.encode(text)))


def test_no_documents(make_documents):
    assert alignment.align_tokenizers(make_documents([]), *PATHS).collect() == []
    got = alignment.align_tokenizers(make_documents([(1, None, "a"), (2, "▁", "a")]), *PATHS).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
