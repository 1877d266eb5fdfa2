import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_documents(spark):
    """Documents from texts, or from (doc_id, text, source)."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            doc_id, text, source = row if isinstance(row, tuple) else (i, row, f"s{i % 3}")
            full.append((doc_id, text, "en", source, len(text) if text is not None else None))
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Texts with exact copies, chains of near copies, shared passages, odd characters, short and long ones."""
    random.seed(7)
    vocabulary = ["".join(random.choices("abcdeéß", k=random.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(random.choices(vocabulary, k=n))

    def edited(text, edits):
        parts = text.split(" ")
        for _ in range(edits):
            parts[random.randrange(len(parts))] = prose(1)
        return " ".join(parts)

    texts = [None, "", " \n\t ", "one", "One", "two words", "a b c d", "A b\nc  d", "é" * 60, "é" * 60]
    for size in (8, 14, 25, 40, 80, 150, 400):
        base = prose(size)
        texts += [base, base, base.upper()] + [edited(base, k) for k in (1, 1, 2, 3, 5) for _ in range(3)]
        chain = base
        for _ in range(6):
            chain = edited(chain, max(1, size // 60))
            texts.append(chain)
    passage = prose(55)
    texts += [f"{prose(20)}\n{passage}\n{prose(random.randint(1, 60))}" for _ in range(12)]
    texts += [prose(random.randint(1, 200)) for _ in range(40)]
    texts.append(prose(6000))
    random.shuffle(texts)
    return texts
