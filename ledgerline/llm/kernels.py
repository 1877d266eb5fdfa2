"""Reading UTF-8 text with numpy inside Arrow tasks: words, word hashes, shingles and byte windows.

Texts are handled in slices of about a megabyte (a longer text is a slice of its own), so memory
does not depend on the size of a batch. Hashes have 64 bits; two strings with one hash count as equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_MULTIPLIER = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_ODD))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_MULTIPLIER, -1, 1 << 64)
    up, down = np.full(n, _MULTIPLIER, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64, n of each at least."""
    return _powers(max(SLICE_BYTES * 2, 1 << (n - 1).bit_length() if n else 1))


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds of each row's bytes); a null is an empty text."""
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        yield first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


#: Bytes of words between ASCII white space, and of words of letters, digits and non-ASCII characters.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
WORD = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    """The words of a slice in text order: hash, row within the slice, first byte and the byte after the last."""

    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums from which span_hashes() takes the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(len(data))[0][: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start])


def words(data: np.ndarray, bounds: np.ndarray, of_word: np.ndarray = NOT_SPACE, lower: bool = True) -> Words:
    inside = of_word[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    before[cuts], after[cuts - 1] = False, False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(bounds, start, "right") - 1
    hashes = span_hashes(prefix_hashes(LOWER[data] if lower else data), start, end)
    return Words(hashes, row, start, end)


def shingles(found: Words, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of `size` words of each row, as (bounds of each row, hashes ascending within a row).

    A row with fewer words has its whole sequence as one shingle; a row without words has none.
    """
    counts = np.bincount(found.row, minlength=rows)
    first = np.cumsum(counts) - counts
    starts = np.flatnonzero(found.row[size - 1 :] == found.row[: len(found.row) - size + 1]) if len(found.row) >= size else np.empty(0, np.int64)
    hashes, owners = [_chain(found.hash, starts, size)], [found.row[starts]]
    for short in range(1, size):
        of = np.flatnonzero(counts == short)
        hashes.append(_chain(found.hash, first[of], short))
        owners.append(of)
    hashes, owners = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    hashes, owners = hashes[new], owners[new]
    return np.searchsorted(owners, np.arange(rows + 1)), hashes


def _chain(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    x = np.full(len(starts), size * _ODD & (1 << 64) - 1, np.uint64)
    for k in range(size):
        x = mix(x * np.uint64(_MULTIPLIER) + hashes[starts + k])
    return x
