"""Maximal periodic runs of words by uniting suffix classes in the order of falling common prefixes.

Only a text in which a window of words comes twice can hold a run. Its suffixes at such windows are sorted, by
prefix doubling over all those texts of a slice at once. Neighbours in this order are then united, the longest
common prefix first. Every class holds its positions in order; when two classes meet at a common prefix of l words,
positions that become neighbours at a distance of d <= l words seed a run of period d. A seed that cannot be
extended to the left is a whole run: it ends where the common prefix ends. A smaller period would have put a position
between the two before, so d is the smallest period.

Every text is handled in the task that reads it; nothing is shuffled. A slice holds about a megabyte of text, and a
longer text is a slice of its own, so a task's memory is bounded by that and by its longest text.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.kernels import _ODD, _chain, mix, text_slices, words

#: Positions in a block of an ordered set before it is halved.
BLOCK = 512

#: Figures of a text, and its runs and remaining words written out.
FIELDS = {"n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(), "exponent_milli": pa.int64(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string()}
SCHEMA = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


class Positions:
    """An ordered set of positions in blocks: neighbours and insertion without moving the whole set."""

    def __init__(self, position: int):
        self.blocks, self.lows, self.size = [[position]], [position], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def neighbours(self, position: int) -> tuple[int | None, int | None]:
        """The nearest positions below and above; `position` itself is not in the set."""
        k = max(0, bisect_left(self.lows, position) - 1)
        block = self.blocks[k]
        at = bisect_left(block, position)
        below = block[at - 1] if at else None
        above = block[at] if at < len(block) else self.lows[k + 1] if k + 1 < len(self.lows) else None
        return below, above

    def add(self, position: int) -> None:
        k = max(0, bisect_left(self.lows, position) - 1)
        block = self.blocks[k]
        insort(block, position)
        self.lows[k] = block[0]
        self.size += 1
        if len(block) > BLOCK:
            half = len(block) // 2
            self.blocks[k : k + 1] = [block[:half], block[half:]]
            self.lows.insert(k + 1, block[half])


@dataclass
class Runs:
    """Runs of a slice by start, then period; positions count from the first word of the slice."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def least_length(period: np.ndarray | int, shortest: int, repeats: int):
    return np.maximum(shortest, repeats * period)


def find_runs(found: np.ndarray, row: np.ndarray, shortest: int = 6, repeats: int = 4) -> Runs:
    """Runs of at least `shortest` words and `repeats` periods in word hashes that lie row after row."""
    if shortest < 2 or repeats < 2:
        raise ValueError("a run has two words and two periods at least")
    # A run of length s and period d has a common prefix of s - d words, which is least where s is the smallest allowed.
    window = min(int(least_length(d, shortest, repeats)) - d for d in range(1, shortest + 1))
    searched = _with_repeats(found, row, window)
    found, row = found[searched], row[searched]
    ranks = _window_ranks(found, row, window)
    order, levels = _suffix_order(ranks, np.flatnonzero(np.bincount(ranks, minlength=1)[ranks] > 1), window)
    common = _common_prefixes(found, row, order, levels)
    seeds = _unite(order, common, window, shortest, repeats)
    if not seeds:
        return Runs(*[np.empty(0, np.int64)] * 3)
    first, second, prefix = np.array(seeds, np.int64).T
    whole = (first == 0) | (row[first - 1] != row[first]) | (found[first - 1] != found[second - 1])
    first, second, prefix = first[whole], second[whole], prefix[whole]
    by = np.lexsort((second - first, first))
    return Runs(searched[first[by]], (prefix + second - first)[by], (second - first)[by])


def _with_repeats(found: np.ndarray, row: np.ndarray, window: int) -> np.ndarray:
    """The positions of texts in which a window of words comes twice: no other text has a run."""
    starts = np.flatnonzero(row[window - 1 :] == row[: len(row) - window + 1]) if len(row) >= window else np.empty(0, np.int64)
    hashes = mix(_chain(found, starts, window) + row[starts].astype(np.uint64) * np.uint64(_ODD))
    by = np.argsort(hashes)
    again = by[1:][hashes[by[1:]] == hashes[by[:-1]]]
    return np.flatnonzero(np.isin(row, np.unique(row[starts[again]])))


def _window_ranks(found: np.ndarray, row: np.ndarray, window: int) -> np.ndarray:
    """Each position's window of words, as the number of smaller ones; what lies behind the text's end is smallest."""
    n, keys = len(found), []
    for k in range(window):
        key = np.zeros(n, np.uint64)
        inside = np.flatnonzero(row[k:] == row[: n - k]) if k < n else np.empty(0, np.int64)
        key[inside] = found[inside + k]
        keys.append(key)
    by = np.lexsort((*reversed(keys), row))
    new = np.ones(n, bool)
    new[1:] = row[by[1:]] != row[by[:-1]]
    for key in keys:
        new[1:] |= key[by[1:]] != key[by[:-1]]
    ranks = np.empty(n, np.int64)
    ranks[by] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return ranks


def _suffix_order(ranks: np.ndarray, active: np.ndarray, window: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The active positions in the order of their suffixes, and (length, number of each prefix of that length).

    A prefix's number is the count of positions with smaller ones. Each round doubles the length that the numbers
    stand for; positions with a number of their own are done.
    """
    n, length, left = len(ranks), window, active
    levels = [(length, ranks)]
    while len(left):
        behind = left + length
        half = np.where(behind < n, ranks[np.minimum(behind, n - 1)], -1)
        by = np.lexsort((half, ranks[left]))
        left, half, own = left[by], half[by], ranks[left[by]]
        group, new = np.ones(len(left), bool), np.ones(len(left), bool)
        group[1:] = own[1:] != own[:-1]
        new[1:] = group[1:] | (half[1:] != half[:-1])
        place = np.arange(len(left))
        ranks = ranks.copy()
        ranks[left] = own + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        length *= 2
        levels.append((length, ranks))
        left = left[~(new & np.append(new[1:], True))]
    return active[np.argsort(ranks[active])], levels


def _common_prefixes(found: np.ndarray, row: np.ndarray, order: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Words that each position's suffix shares with the next one's in the order, within one text."""
    a, b = order[:-1].copy(), order[1:].copy()
    n, common = len(found), np.zeros(len(a), np.int64)
    for length, ranks in reversed(levels):
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), bool)
        same[inside] = ranks[a[inside]] == ranks[b[inside]]
        common[same] += length
        a[same] += length
        b[same] += length
    window = levels[0][0]
    going = common >= window
    for _ in range(window - 1):
        inside = going & (a < n) & (b < n)
        at = np.flatnonzero(inside)
        i, j, home = a[at], b[at], row[order[:-1][at]]
        same = (found[i] == found[j]) & (row[i] == home) & (row[j] == home)
        going[:] = False
        going[at[same]] = True
        common[going] += 1
        a[going] += 1
        b[going] += 1
    return common


def _unite(order: np.ndarray, common: np.ndarray, window: int, shortest: int, repeats: int) -> list[tuple[int, int, int]]:
    """(first, second, common prefix) of positions that became neighbours near enough to seed a run."""
    edges = np.flatnonzero(common >= window)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    home = list(range(len(order)))
    places = order.tolist()
    classes: dict[int, Positions] = {}
    seeds: list[tuple[int, int, int]] = []
    places_end = max(places, default=0) + 1

    def meet(first: int, second: int, prefix: int) -> None:
        period = second - first
        if period <= prefix and prefix + period >= max(shortest, repeats * period):
            seeds.append((first, second, prefix))

    def root(k: int) -> int:
        while home[k] != k:
            home[k] = home[home[k]]
            k = home[k]
        return k

    for edge, prefix in zip(edges.tolist(), common[edges].tolist(), strict=True):
        big, small = root(edge), root(edge + 1)
        ours = classes.get(big) or Positions(places[big])
        theirs = classes.pop(small, None) or Positions(places[small])
        if ours.size < theirs.size:
            classes.pop(big, None)
            big, small, ours, theirs = small, big, theirs, ours
        home[small] = big
        classes[big] = ours
        new = list(theirs)
        for before, position, after in zip([-1, *new[:-1]], new, [*new[1:], places_end], strict=True):
            below, above = ours.neighbours(position)
            if below is not None and below > before:
                meet(below, position, prefix)
            if above is not None and above < after:
                meet(position, above, prefix)
        for position in new:
            ours.add(position)
    return seeds


def repeated_from(n: int, number: int) -> np.ndarray | None:
    """Which of its n words a text of this number has at each place; None where it stays as it is.

    The rule of the registered query: every tenth number repeats what follows one of its words.
    """
    if number % 10 or not n:
        return None
    rest = number // 10
    a = rest % n
    p = 1 + (n - a) // (3 + rest % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def collapse_runs(documents: DataFrame, prepared: Callable[[int, int], np.ndarray | None] | None = None, doc_id: str = "doc_id", text: str = "text", shortest: int = 6, repeats: int = 4, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, FIELDS and, if wanted, `collapsed`: its words without what runs repeat.

    A run has the smallest period q, at least `shortest` words and `repeats` times q; words of a run behind its first q
    are dropped, the rest is joined by single spaces. `prepared` takes the number of words and the CRC-32 of the decimal
    doc_id and may give other places for the words. A null text has no words, as an empty one; a null doc_id is never
    prepared. Repeated rows are documents of their own; without rows there is no result; other columns are not looked at.
    Words are equal when their 64-bit hashes are.
    """
    names = ["doc_id", *FIELDS, *["collapsed"] * with_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, data, bounds in text_slices(batch.column(1)):
                n = len(bounds) - 1
                kept = ids.slice(first, n)
                rows = _slice(data, bounds, kept.to_pylist(), prepared, shortest, repeats, with_text)
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), [*FIELDS.values(), pa.string()], strict=False)]
                yield pa.RecordBatch.from_arrays([kept, *columns], names)

    chosen = documents.select(documents[doc_id].alias("doc_id"), documents[text].alias("text"))
    kind = dict(chosen.dtypes)["doc_id"]
    return chosen.mapInArrow(run, f"doc_id {kind}, {SCHEMA}" + ", collapsed string" * with_text)


def _slice(data: np.ndarray, bounds: np.ndarray, ids: list, prepared, shortest: int, repeats: int, with_text: bool) -> list[tuple]:
    n = len(ids)
    found = words(data, bounds, lower=False)
    first = np.searchsorted(found.row, np.arange(n + 1))
    source = np.arange(len(found.row))
    if prepared:
        for k, number in enumerate(ids):
            size = int(first[k + 1] - first[k])
            if number is not None and size:
                places = prepared(size, zlib.crc32(str(number).encode()))
                if places is not None:
                    source[first[k] : first[k + 1]] = first[k] + places
    runs = find_runs(found.hash[source], found.row, shortest, repeats)
    starts_of_rows = np.searchsorted(runs.start, first)
    drop = np.zeros(len(source) + 1, np.int64)
    np.add.at(drop, runs.start + runs.period, 1)
    np.add.at(drop, runs.start + runs.length, -1)
    kept = source[np.cumsum(drop[:-1]) == 0]
    joined, ends = _joined(data, found.start[kept], found.end[kept])
    edges = np.searchsorted(found.row[kept], np.arange(n + 1)) if len(kept) else np.zeros(n + 1, np.int64)
    rows = []
    for k in range(n):
        low, high = starts_of_rows[k], starts_of_rows[k + 1]
        text = joined[ends[edges[k]] : ends[edges[k + 1]] - 1] if edges[k + 1] > edges[k] else b""
        longest, lines = (None,) * 4, b""
        if high > low:
            start, length, period = runs.start[low:high] - first[k], runs.length[low:high], runs.period[low:high]
            best = int(np.lexsort((period, start, -length))[0])
            longest = (int(start[best]), int(length[best]), int(period[best]), 1000 * int(length[best]) // int(period[best]))
            lines = "".join(f"{s},{m},{q}\n" for s, m, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True)).encode()
        rows.append((int(high - low), *longest, hashlib.sha256(lines).hexdigest(), hashlib.sha256(text).hexdigest(), *[bytes(text).decode()] * with_text))
    return rows


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The words' bytes, each with a space behind it, and where each word begins there, the end of all included."""
    sizes = end - start + 1
    ends = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    out = np.full(int(ends[-1]), 0x20, np.uint8)
    from_byte = np.arange(int(ends[-1])) + np.repeat(start - ends[:-1], sizes)
    inside = np.ones(len(out), bool)
    inside[ends[1:] - 1] = False
    out[inside] = data[from_byte[inside]]
    return memoryview(out), ends
