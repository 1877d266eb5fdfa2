"""Packing by minimum bin slack: token sequences of a fixed length with little padding.

Documents are cut into full sequences and a remainder. Remainders wait in a pool, counted by
length. For each sequence the longest one is taken, and a subset-sum dynamic program over the others, with one bit for each
reachable total, finds the counts of lengths that fill the sequence closest to capacity; they are
traced back through the stored steps. Every task packs the documents it reads, with a pool of bounded size, so nothing is
shuffled and a lost task is repeated alone.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Remainders in the pool when sequences are formed, and those left in it then.
POOL_FULL, POOL_LEFT = 4096, 1024
#: Words in each of the two generations of a worker's cache, and words that a task has at hand.
CACHED_WORDS, WORDS_AT_HAND = 500_000, 500_000
#: Words of letters that are encoded as one text.
LETTERS_AT_ONCE = 4096

#: Python takes these for white space, the vocabulary does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"
WORD = re.compile(rf"[\S{SEPARATORS}]+")

SCHEMA = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary_words(text: str) -> list[str]:
    """Runs of characters other than the vocabulary's white space."""
    return WORD.findall(text) if any(c in text for c in SEPARATORS) else text.split()


def of_letters(word: str) -> bool:
    """Latin-1 letters alone: these stay letters when the vocabulary normalises them, and are one word of it."""
    return word.isalpha() and (word.isascii() or max(word) <= "\xff")


@cache
def word_encoder(path: str) -> Callable[[list[str]], dict[str, bytes]]:
    """A function from distinct words to their ids, 32 bits each; its cache lives as long as the worker.

    The vocabulary's pre-tokenizer joins no characters across white space, so a text has the ids of
    its words, and a word of Latin-1 letters with punctuation behind it those of both parts: these letters
    stay letters when the vocabulary normalises them. Others may turn into a letter and a mark, which joins the punctuation.
    """
    # A task has one core; threads of the library would only wait for each other.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tail = ".,!?;:|#*%&$"
    caches: list[dict[str, bytes]] = [{}, {}]

    def encode(parts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    # Tokens that end a word of the vocabulary.
    names = tokenizer.get_vocab(with_added_tokens=True)
    ends = np.zeros(max(names.values()) + 1, bool)
    ends[[i for name, i in names.items() if name.endswith("</w>")]] = True

    def encode_letters(parts: list[str]) -> list[bytes]:
        """Parts of letters alone are one word of the vocabulary each: many are encoded as one text and told apart by the ends of words."""
        found: list[bytes] = []
        for at in range(0, len(parts), LETTERS_AT_ONCE):
            some = parts[at : at + LETTERS_AT_ONCE]
            ids = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            data, cuts = ids.tobytes(), [0, *(4 * np.flatnonzero(ends[ids]) + 4).tolist()]
            found += [data[i:j] for i, j in pairwise(cuts)] if len(cuts) == len(some) + 1 else encode(some)
        return found

    def learn(found: list[str]) -> dict[str, bytes]:
        """Letters are encoded once whatever punctuation follows them."""
        young, old = caches
        known: dict[str, bytes] = {}
        split = []
        for word in found:
            core = word.rstrip(tail)
            if of_letters(core):
                split.append((word, core.lower() if core.isascii() else core, word[len(core) :]))
            else:
                split.append((word, word, ""))
        need = []
        for part in {core for _, core, _ in split}.union(end for _, _, end in split if end):
            ids = young.get(part) or old.get(part)
            if ids is None:
                need.append(part)
            else:
                known[part] = ids
        letters, other = [], []
        for part in need:
            (letters if of_letters(part) else other).append(part)
        known.update(zip(letters, encode_letters(letters), strict=True))
        known.update(zip(other, encode(other), strict=True))
        if len(young) + len(known) > CACHED_WORDS:
            caches[0], caches[1] = young, old = {}, young
        young.update(known)
        known[""] = b""
        return {word: known[core] + known[end] for word, core, end in split}

    return learn


class Pool:
    """Remainders by length; fills sequences of `capacity` tokens."""

    def __init__(self, capacity: int):
        self.capacity, self.waiting, self.size = capacity, {}, 0

    def add(self, length: int, piece) -> None:
        self.waiting.setdefault(length, deque()).append(piece)
        self.size += 1

    def take(self, length: int):
        pieces = self.waiting[length]
        piece = pieces.popleft()
        if not pieces:
            del self.waiting[length]
        self.size -= 1
        return piece

    def fill(self) -> list:
        """Pieces whose lengths come closest to the capacity, the longest remainder among them."""
        longest = max(self.waiting)
        pieces = [self.take(longest)]
        room = self.capacity - longest
        for length, count in best_counts({k: len(v) for k, v in self.waiting.items() if k <= room}, room).items():
            pieces += [self.take(length) for _ in range(count)]
        return pieces


def best_counts(available: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length make the largest total within `room`; longer ones are tried first."""
    reach, mask, full, steps = 1, (1 << room + 1) - 1, 1 << room, []
    for length in sorted(available, reverse=True):
        left, times = min(available[length], room // length), 1
        while left and not reach & full:
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= reach << length * times & mask
            left -= times
            times *= 2
        if reach & full:
            break
    total = (reach & mask).bit_length() - 1
    counts: dict[int, int] = {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            counts[length] = counts.get(length, 0) + times
            total -= length * times
    return counts


def pack_documents(documents: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text without special tokens, then `end_id`; a null or empty text has that one
    id alone. Repeated rows and rows without doc_id are documents of their own; without rows there
    is no result. Only the last sequences of a task are padded by more than the pool's slack.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learn = word_encoder(vocabulary)
        pool, next_id = Pool(capacity), TaskContext.get().partitionId() << 32
        end = np.array([end_id], np.uint32).tobytes()
        rows: list[tuple] = []

        def sequence(pieces: list) -> None:
            nonlocal next_id
            offset = 0
            for piece in pieces:
                rows.append((*piece, next_id, offset))
                offset += piece[2]
            next_id += 1

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:]]], names)

        names, kind = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"], None
        for batch in batches:
            kind = batch.schema.field(0).type
            ids_of, known = batch.column(0).to_pylist(), {}
            for at in range(0, batch.num_rows, 64):
                texts = [vocabulary_words(t or "") for t in batch.column(1).slice(at, 64).to_pylist()]
                met = set().union(*texts)
                new = met.difference(known)
                if len(known) + len(new) > WORDS_AT_HAND:
                    known, new = {}, met
                known.update(learn(list(new)))
                for k, words in enumerate(texts):
                    ids = b"".join(map(known.__getitem__, words)) + end
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        length = min(capacity, n - start)
                        piece = (ids_of[at + k], start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n)
                        if length == capacity:
                            sequence([piece])
                        else:
                            pool.add(length, piece)
                if pool.size > POOL_FULL:
                    while pool.size > POOL_LEFT:
                        sequence(pool.fill())
                if len(rows) > 4096:
                    yield out()
        while pool.size:
            sequence(pool.fill())
        if rows:
            yield out()

    kept = documents.select(documents[doc_id].alias("doc_id"), documents[text].alias("text"))
    return kept.mapInArrow(run, SCHEMA.format(id=dict(kept.dtypes)["doc_id"]))
