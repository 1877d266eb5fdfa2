"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return SPACE_WORD.findall(text or "")


def shingle_set(text: str | None, size: int) -> frozenset:
    found = words(lower(text))
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))) if found else frozenset()


def components(rows: list[tuple], size: int, percent: int) -> dict:
    """doc_id: (shingles, smallest id reachable), for rows (doc_id, text) with distinct ids."""
    sets = {d: shingle_set(t, size) for d, t in rows}
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {d: (len(s), find(d) if s else d) for d, s in sets.items()}


def without_repeats(rows: list[tuple], length: int) -> dict:
    """doc_id: (bytes, removed, runs, hash of the rest), for rows (doc_id, text) with distinct ids."""
    earliest: dict[bytes, int] = {}
    data = {d: (t or "").encode() for d, t in rows}
    for d in sorted(data):
        for i in range(len(data[d]) - length + 1):
            earliest.setdefault(data[d][i : i + length], d)
    found = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if earliest[b[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        found[d] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return found


def base_figures(text: str | None) -> tuple:
    found = words(text)
    lines = [x for x in (text or "").split("\n") if SPACE_WORD.search(x)]
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    counts = Counter(windows)
    covered = {k for i, w in enumerate(windows) if counts[w] > 1 for k in range(i, i + 5)}
    failed = len(found) < 10 or 100 * len(covered) > 20 * len(found)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def targets(sizes: dict, weights=(5, 2, 1)) -> dict:
    """Targets by source, handed out in rounds."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, open_, found = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = (total - sum(found.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            return found | {s: level * weight[s] for s in open_}
        found |= {s: 2.0 * sizes[s] for s in over}
        open_ -= over
    return found


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def phrase_places(text: str | None) -> tuple:
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(found)) if found[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def word_runs(found: list[str], shortest: int = 6, repeats: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs: every stretch that repeats at some distance, if no smaller one does."""
    runs = []
    for period in range(1, len(found) // repeats + 1):
        start = 0
        while start < len(found) - period:
            end = start
            while end + period < len(found) and found[end] == found[end + period]:
                end += 1
            length = end + period - start
            stretch = found[start : start + length]
            if end > start and length >= max(shortest, repeats * period) and not any(stretch[q:] == stretch[:-q] for q in range(1, period)):
                runs.append((start, length, period))
            start = end + 1
    return sorted(runs)


def collapsed(doc_id, text: str | None) -> tuple:
    """The contract's figures of a document, and its words without repeats."""
    found = words(text)
    n, number = len(found), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and number % 10 == 0 and n:
        rest = number // 10
        a = rest % n
        p = 1 + (n - a) // (3 + rest % 8)
        found = [found[a + (i - a) % p] if i >= a else w for i, w in enumerate(found)]
    runs = word_runs(found)
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    left = " ".join(w for i, w in enumerate(found) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest(), left)


def aligned(rows: list[tuple], first, second) -> list[tuple]:
    """The contract's figures for rows (doc_id, text): whole texts are encoded, all pairs of tokens of a group are looked at."""
    per_row, counts = [], Counter()
    for doc_id, text in rows:
        data = f" {text}".encode()
        sides = []
        if text:
            for vocabulary, given in ((first, f" {text}"), (second, text)):
                ids, at, spans = vocabulary.encode(given).tolist(), 0, []
                for i in ids:
                    spans.append((i, at, at + len(vocabulary.tokens[i])))
                    at = spans[-1][2]
                sides.append(spans if b"".join(vocabulary.tokens[i] for i in ids) == data else None)
        if not text or None in sides:
            per_row.append((doc_id, None, [], []))
            continue
        a, b = sides
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, links, low = [], [], 0
        for cut in cuts:
            ours, theirs = [[x for x in side if low <= x[1] < cut] for side in (a, b)]
            groups.append(",".join(str(x[0]) for x in ours) + "|" + ",".join(str(x[0]) for x in theirs))
            links += [(x[0], y[0]) for x in ours for y in theirs if x[1] < y[2] and y[1] < x[2]]
            low = cut
        counts.update(links)
        per_row.append((doc_id, (len(a), len(b)), groups, links))
    highest = {}
    for (_, y), n in counts.items():
        highest[y] = max(n, highest.get(y, 0))
    return [
        (doc_id, *(n or (0, 0)), len(groups), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if n else "")
        for doc_id, n, groups, links in per_row
    ]
