"""Suffix deduplication: bytes covered by long strings of earlier documents, with a logarithmic index family.

A place in a text is a suffix start with at least `length` bytes behind it. Every such window has an anchor, the smallest hash
of the strings of ANCHOR bytes in it; neighbouring windows of a text with one anchor are a stretch. Equal windows have equal
anchors, so only stretches of one anchor can share windows.

Stretches are compared whole first, by their hashes: one that a smaller id has too is covered. Of an anchor with different
stretches in several ids, one text of each goes on with its bytes, to the part of the anchor, which judges its windows by itself.

A part reads its stretches in the order of doc_id and leaves those out of which no window's hash comes in another id. In place
of a suffix array each batch gets the sorted array of its
distinct windows, `length` bytes each, without positions. They are looked up by binary search in the arrays of the existing
levels, which hold smaller ids; then the batch becomes a level of its own; while the last two levels are of about one size, they merge, so there are
logarithmically many. A window is covered if it also starts in a document with a smaller id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import kernels
from ledgerline.llm.workspace import keep, partitions, release

ANCHOR = 20
#: Windows of a batch, and different stretches of an anchor beyond which its windows are dealt by their own hashes.
BATCH_WINDOWS, HOT_DOCUMENTS = 1 << 17, 5000
#: Bytes of texts that are looked at together, which fit a core's cache with their hashes, and of stretches in an Arrow batch.
SLICE, BATCH_BYTES = 1 << 17, 1 << 26
#: What becomes of a stretch, in the lowest two bits of its mark.
COVERED, WANTED, HOT = range(3)


def stretches(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start in the slice, end, anchor) of the stretches of windows of `length` bytes within a row, and kernels.prefix_hashes()."""
    sums = kernels.prefix_hashes(data)
    n = len(data) - length + 1
    if n <= 0:
        return *(np.empty(0, np.int64) for _ in range(3)), np.empty(0, np.uint64), sums
    # As kernels.span_hashes() of all spans of ANCHOR bytes, without index arrays.
    lowest = kernels.mix((sums[ANCHOR:] - sums[:-ANCHOR]) * kernels.powers(len(sums))[1][: len(data) - ANCHOR + 1])
    # Minima over spans that double, then over the rest: of length - ANCHOR + 1 strings in all.
    span, width = length - ANCHOR + 1, 1
    while width * 2 <= span:
        lowest = np.minimum(lowest[:-width], lowest[width:])
        width *= 2
    if span > width:
        lowest = np.minimum(lowest[: n], lowest[span - width : span - width + n])
    turn = np.ones(n, bool)
    np.not_equal(lowest[1:], lowest[:-1], out=turn[1:])
    # A row's first window, and the first place behind its last one.
    cuts = np.concatenate([bounds[:-1], np.maximum(bounds[1:] - length + 1, bounds[:-1])])
    turn[cuts[cuts < n]] = True
    begin = np.flatnonzero(turn)
    end = np.append(begin[1:], n) + length - 1
    row = np.searchsorted(bounds, begin, "right") - 1
    inside = begin + length <= bounds[row + 1]
    begin = begin[inside]
    return row[inside], begin, end[inside], lowest[begin], sums


def _keys(anchor: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of a stretch as a long and an int: 44 of its anchor, which are the long's highest, and 52 of its content."""
    content = content >> np.uint64(12)
    return (anchor << np.uint64(20) | content >> np.uint64(32)).view(np.int64), content.astype(np.uint32).view(np.int32)


def _marks(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Names of stretches within one id; the lowest two bits are left for what becomes of them."""
    return (kernels.mix(high.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + low.view(np.uint32)) & ~np.uint64(3)).view(np.int64)


def _stretch_keys(texts: DataFrame, length: int) -> DataFrame:
    """(high, low, id) of all stretches; a task reads equal texts with growing ids once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, int] = {}
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            fresh = np.ones(batch.num_rows, bool)
            for i, (d, k) in enumerate(zip(ids.tolist(), keys.tolist(), strict=True)):
                if met.get(k, d) < d:
                    fresh[i] = False
                else:
                    met[k] = d
            for first, data, bounds in kernels.text_slices(batch.column(2).filter(pa.array(fresh)), SLICE):
                row, begin, end, anchor, sums = stretches(data, bounds, length)
                high, low = _keys(anchor, kernels.span_hashes(sums, begin, end))
                yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low), pa.array(ids[fresh][first + row])], ["high", "low", "id"])

    return texts.select("id", "text_key", "text").mapInArrow(run, "high long, low int, id long")


def _compared(keys: DataFrame) -> DataFrame:
    """(anchor, mark, id) of stretches that a smaller id has whole, and of one text of each of the different stretches of an anchor in several ids.

    An anchor with more than HOT_DOCUMENTS different stretches has one more row, with a null id. Rows are sorted by Spark, which
    spills, and read once: of the last anchor at most the different stretches of one id are held back, so an anchor may have any number of rows.
    """
    most = HOT_DOCUMENTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the last anchor: stretches that wait for another id or, if they went out, the last one; how many there were.
        held, out, count = (np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64)), False, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            high, low, ids = (np.concatenate([old, batch.column(i).to_numpy(zero_copy_only=False)]) for i, old in enumerate(held))
            old = len(held[0])
            new = np.ones(len(high), bool)
            new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
            head = np.flatnonzero(new)
            covered = ids > ids[head][np.cumsum(new) - 1]
            covered[1:] &= new[1:] | (ids[1:] != ids[:-1])
            anchor = high[head] >> 20
            turn = np.ones(len(head), bool)
            turn[1:] = anchor[1:] != anchor[:-1]
            first = np.flatnonzero(turn)
            sizes = np.diff(np.append(first, len(head)))
            several = np.minimum.reduceat(ids[head], first) < np.maximum.reduceat(ids[head], first)
            several[0] |= out
            wanted = np.repeat(several, sizes)
            if out:
                wanted[:old] = False
            # How many different stretches the anchors had before this batch, and have with it.
            before = np.zeros(len(first), np.int64)
            before[0] = count if old else 0
            after = before + sizes
            after[0] -= old
            hot = anchor[first][(before <= most) & (after > most)]
            wanted = head[wanted]
            covered = np.flatnonzero(covered)
            marks = _marks(high, low)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[high[covered] >> 20, high[wanted] >> 20, hot]),
                    pa.array(np.r_[marks[covered] | COVERED, marks[wanted] | WANTED, hot]),
                    pa.array(np.r_[ids[covered], ids[wanted], hot], mask=np.arange(len(covered) + len(wanted) + len(hot)) >= len(covered) + len(wanted)),
                ],
                ["anchor", "mark", "id"],
            )
            out, count = bool(several[-1]), int(after[-1])
            last = head[-1:] if out else head[first[-1] :]
            held = high[last], low[last], ids[last]

    dealt = keys.repartition(partitions(keys.sparkSession), F.shiftright("high", 20)).sortWithinPartitions("high", "low", "id")
    return dealt.mapInArrow(run, "anchor long, mark long, id long")


SEGMENT = "part long, id long, text_key long, start long, bytes binary, size long"


def _kinds(row: np.ndarray, marks: np.ndarray, of: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """What becomes of the stretches of a slice's rows, -1 if nothing does, by the listed marks of the rows `of`."""
    if not len(listed):
        return np.full(len(row), -1)
    salted = lambda r, m: m.view(np.uint64) ^ kernels.mix(r.astype(np.uint64) + np.uint64(1))
    theirs = salted(of, listed >> 2)
    order = np.argsort(theirs)
    at = np.minimum(np.searchsorted(theirs[order], salted(row, marks >> 2)), len(order) - 1)
    found = order[at]
    return np.where((of[found] == row) & (listed[found] >> 2 == marks >> 2), listed[found] & 3, -1)


def _segments(texts: DataFrame, length: int) -> DataFrame:
    """Covered stretches without their bytes, neighbours as one, and the wanted ones with them; windows of a hot anchor one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            lists = batch.column(3)
            list_at, listed = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for first, data, bounds in kernels.text_slices(batch.column(2), SLICE):
                row, begin, end, anchor, sums = stretches(data, bounds, length)
                if not len(row):
                    continue
                marks = _marks(*_keys(anchor, kernels.span_hashes(sums, begin, end)))
                at = list_at[first : first + len(bounds)]
                kind = _kinds(row, marks, np.repeat(np.arange(len(bounds) - 1), np.diff(at)), listed[at[0] : at[-1]])
                bare, wanted, hot = (kind == k for k in (COVERED, WANTED, HOT))
                # Neighbouring covered stretches of a row share all but one byte of a window.
                head = np.flatnonzero(bare & ~np.r_[False, bare[:-1] & (row[1:] == row[:-1])])
                last = np.flatnonzero(bare & ~np.r_[bare[1:] & (row[1:] == row[:-1]), False])
                windows = end[hot] - begin[hot] - length + 1
                one = np.repeat(begin[hot] - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
                part = np.r_[anchor[head], anchor[wanted], kernels.span_hashes(sums, one, one + length)]
                of = np.r_[row[head], row[wanted], np.repeat(row[hot], windows)]
                start = np.r_[begin[head], begin[wanted], one]
                size = np.r_[end[last] - begin[head], end[wanted] - begin[wanted], np.full(len(one), length)]
                filled = np.arange(len(of)) >= len(head)
                own = first + of
                columns = [
                    # Equal windows have equal parts; three bytes deal them as evenly as eight.
                    (part & np.uint64(0xFFFFFF)).astype(np.int64),
                    ids[own],
                    keys[own],
                    start - bounds[of],
                ]
                stops = np.cumsum(np.where(filled, size, 0))
                cuts = np.unique(np.r_[np.searchsorted(stops, np.arange(0, stops[-1] if len(stops) else 0, BATCH_BYTES)), len(of)])
                for a, b in zip(np.r_[0, cuts], cuts, strict=False):
                    if a < b:
                        yield pa.RecordBatch.from_arrays(
                            [*(pa.array(c[a:b]) for c in columns), _pieces(data, start[a:b], size[a:b], filled[a:b]), pa.array(size[a:b])],
                            ["part", "id", "text_key", "start", "bytes", "size"],
                        )

    # All columns of the texts are read, so that this is the same shuffle as that of remove_repeats().
    return texts.select("id", "text_key", "text", "marks", *[c for c in texts.columns if c not in ("id", "text_key", "text", "marks")]).mapInArrow(run, SEGMENT)


def _pieces(data: np.ndarray, start: np.ndarray, size: np.ndarray, filled: np.ndarray) -> pa.Array:
    """The bytes of filled pieces; the others are null."""
    long = np.where(filled, size, 0)
    stops = np.cumsum(long)
    offsets = np.r_[0, stops].astype(np.int32)
    content = data[np.repeat(start - stops + long, long) + np.arange(offsets[-1])]
    valid = np.packbits(filled, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(size), [pa.py_buffer(valid), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(content))])


class Level:
    """Window contents in byte order, and the smallest id of each."""

    def __init__(self, windows: np.ndarray, ids: np.ndarray):
        self.windows, self.ids = windows, ids

    def merged(self, other: Level) -> Level:
        places = np.searchsorted(self.windows, other.windows)
        return Level(np.insert(self.windows, places, other.windows), np.insert(self.ids, places, other.ids))


class IndexFamily:
    """Levels whose sizes fall geometrically."""

    def __init__(self):
        self.levels: list[Level] = []

    def judge(self, windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which windows also start in a smaller id, among those given or earlier; ids do not fall from call to call."""
        order = np.argsort(windows, kind="stable")
        own = windows[order]
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        head = np.flatnonzero(new)
        smallest = np.minimum.reduceat(ids[order], head) if len(head) else np.empty(0, np.int64)
        distinct = own[head]
        earliest, known = smallest.copy(), np.zeros(len(head), bool)
        for level in self.levels:
            at = np.searchsorted(level.windows, distinct)
            near = np.minimum(at, len(level.windows) - 1)
            same = level.windows[near] == distinct
            known |= same
            earliest = np.where(same, np.minimum(earliest, level.ids[near]), earliest)
        covered = np.empty(len(windows), bool)
        covered[order] = earliest[np.cumsum(new) - 1] < ids[order]
        if (~known).any():
            self.levels.append(Level(distinct[~known], smallest[~known]))
            while len(self.levels) > 1 and len(self.levels[-2].windows) <= 2 * len(self.levels[-1].windows):
                last = self.levels.pop()
                self.levels.append(self.levels.pop().merged(last))
        return covered


def _partnered(ids: np.ndarray, texts: list[bytes], length: int) -> np.ndarray:
    """Which stretches have a window whose hash comes in another id as well; the others need no look at their windows."""
    sizes = np.array([len(t) for t in texts])
    stops = np.cumsum(sizes)
    hashes, at = [], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(stops, stops[at] - sizes[at] + SLICE, "right")))
        _, place = _places(sizes[at:to], length)
        hashes.append(kernels.span_hashes(kernels.prefix_hashes(np.frombuffer(b"".join(texts[at:to]), np.uint8)), place, place + length))
        at = to
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes)
    of = np.repeat(np.arange(len(texts)), sizes - length + 1)[order]
    hashes, own = hashes[order], ids[of]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    head = np.flatnonzero(new)
    several = np.minimum.reduceat(own, head) < np.maximum.reduceat(own, head)
    found = np.zeros(len(texts), bool)
    found[of[np.repeat(several, np.diff(np.append(head, len(new))))]] = True
    return found


def _places(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window in texts of `sizes` bytes one after the other: its place in its text, and in all of them."""
    windows = sizes - length + 1
    within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    return within, np.repeat(np.cumsum(sizes) - sizes, windows) + within


def _covered(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, waiting = IndexFamily(), []

        def judged(rows: list[tuple]) -> pa.RecordBatch:
            ids, keys, starts, texts = zip(*rows, strict=True)
            sizes = np.array([len(t) for t in texts])
            # No byte of UTF-8 is 255; zeros would end a fixed-width string.
            data = np.frombuffer(b"".join(texts), np.uint8).copy()
            data[data == 0] = 255
            of = np.repeat(np.arange(len(sizes)), sizes - length + 1)
            within, at = _places(sizes, length)
            windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[at]).view(f"S{length}").ravel()
            hit = family.judge(windows, np.array(ids)[of])
            # Runs of covered windows within a stretch.
            new = hit.copy()
            new[1:] &= ~(hit[:-1] & (of[1:] == of[:-1]))
            stop = hit.copy()
            stop[:-1] &= ~(hit[1:] & (of[1:] == of[:-1]))
            a, b = np.flatnonzero(new), np.flatnonzero(stop)
            place = np.array(starts)[of]
            return _spans(np.array(ids)[of[a]], np.array(keys)[of[a]], (place + within)[a], (place + within)[b] + length)

        met: dict[bytes, int] = {}
        for batch in batches:
            ids, keys, starts, sizes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3, 5))
            bare = batch.column(4).is_null().to_numpy(zero_copy_only=False).copy()
            for i, (own, key, start, text) in enumerate(zip(ids.tolist(), keys.tolist(), starts.tolist(), batch.column(4).to_pylist(), strict=True)):
                if text is None:
                    continue
                # A whole stretch of a smaller id is covered, and its windows are in the levels.
                if met.setdefault(text, own) < own:
                    bare[i] = True
                    continue
                waiting.append((own, key, start, text))
            if bare.any():
                yield _spans(ids[bare], keys[bare], starts[bare], starts[bare] + sizes[bare])
        if not waiting:
            return
        met.clear()
        found = _partnered(np.array([w[0] for w in waiting]), [w[3] for w in waiting], length)
        rows, total = [], 0
        for w, partnered in zip(waiting, found.tolist(), strict=True):
            if partnered:
                rows.append(w)
                total += len(w[3]) - length + 1
                if total >= BATCH_WINDOWS:
                    yield judged(rows)
                    rows, total = [], 0
        if rows:
            yield judged(rows)

    return run


def _spans(ids, keys, starts, ends) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (ids, keys, starts, ends)], ["id", "text_key", "start", "end"])


def covered_spans(texts: DataFrame, dealt: DataFrame, length: int) -> DataFrame:
    """(id, spans): stretches (text_key, start, end) of covered bytes, maybe overlapping, of the rows of each id. `dealt`: the texts, dealt by id."""
    spark = texts.sparkSession
    narrow = texts.select("id", "text_key", F.octet_length("text").cast("long").alias("n"))
    owners = narrow.groupBy("text_key").agg(F.min("id").alias("owner"), F.count("*").alias("copies")).where("copies > 1")
    owners = owners.withColumn("h", F.xxhash64("text_key"))
    copies = keep(narrow.withColumn("h", F.xxhash64("text_key")).join(owners, ["text_key", "h"]).where("owner < id").select("id", "text_key", "n").distinct())
    whole = copies.where(F.col("n") >= length).select("id", "text_key", F.lit(0).cast("long").alias("start"), F.col("n").alias("end"))
    # Copies are judged by their owner, unless another text has the same id.
    texts_of = narrow.join(copies.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.countDistinct("text_key").alias("texts"))
    judged = keep(copies.groupBy("id").agg(F.count("*").alias("copied")).join(texts_of, "id").where("copied = texts").select("id"))
    found = keep(_compared(_stretch_keys(texts, length)))
    hot = keep(found.where("id is null").select("anchor", F.lit(HOT).cast("long").alias("hot")))
    release(spark)
    kind = F.col("mark").bitwiseAND(F.lit(3))
    wanted = found.where(F.col("id").isNotNull() & (kind == WANTED)).join(hot, "anchor", "left")
    wanted = wanted.select("id", F.when(F.col("hot").isNull(), F.col("mark")).otherwise(F.col("mark") - WANTED + HOT).alias("mark"))
    marked = found.where(F.col("id").isNotNull() & (kind == COVERED)).select("id", "mark").unionByName(wanted)
    own = marked.groupBy("id").agg(F.collect_list("mark").alias("marks")).join(judged, "id", "left_anti")
    segments = _segments(dealt.join(own, "id"), length)
    parts = segments.repartition(partitions(spark) * 4, "part").sortWithinPartitions("id", "part")
    spans = parts.mapInArrow(_covered(length), "id long, text_key long, start long, end long").unionByName(whole)
    return spans.groupBy("id").agg(F.collect_list(F.struct("text_key", "start", "end")).alias("spans"))


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of ascending spans; runs that touch are one."""
    runs: list[tuple[int, int]] = []
    for start, end in spans:
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], end))
        else:
            runs.append((start, end))
    return runs


def whole_characters(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the bytes of characters that they hold in part."""
    found = []
    for start, end in runs:
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            found.append((start, end))
    return found


def remove_repeats(documents: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """Per row: `row` (struct of all other columns), n_bytes, n_removed, n_spans, kept_sha256 and, on demand, `kept_text`.

    A window of `length` bytes counts if it also starts in a row with a smaller doc_id. A null id comes after all others, in
    the order of the texts' hashes. Rows with equal ids do not cover each other, so repeated rows stay alike. Null
    and short texts lose nothing; a null text has no bytes, and stays null. kept_text keeps characters whole of which only
    some bytes are covered. Extra columns of any name are carried along.
    """
    others = [c for c in documents.columns if c != text]
    whole = F.coalesce(F.col(text), F.lit(""))
    no_id = F.shiftrightunsigned(F.xxhash64(whole), 2) + F.lit(1 << 62)
    rows = documents.select(
        F.coalesce(F.col(doc_id).cast("long"), no_id).alias("id"),
        F.xxhash64(whole).alias("text_key"),
        whole.alias("text"),
        F.col(text).isNull().alias("none"),
        F.struct(*others).alias("row"),
    )
    # Dealt out once: the bytes of stretches and the cut are read from the same shuffle.
    dealt = rows.repartition(partitions(documents.sparkSession), "id")
    cut = dealt.join(covered_spans(rows, dealt, length), "id", "left")
    fields = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            keys, nulls = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            texts, spans = batch.column(0).cast(pa.binary()).to_pylist(), batch.column(3)
            at = spans.offsets.to_pylist()
            of, starts, ends = (spans.values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            for i, (data, key, none) in enumerate(zip(texts, keys, nulls, strict=True)):
                own = at[i] + np.flatnonzero(of[at[i] : at[i + 1]] == key) if at[i] < at[i + 1] else ()
                runs = merged_spans(sorted(zip(starts[own].tolist(), ends[own].tolist(), strict=True))) if len(own) else []
                kept = _without(data, runs)
                one = [len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()]
                if with_text:
                    one.append(None if none else _without(data, whole_characters(data, runs)).decode())
                out.append(one)
            columns = list(zip(*out, strict=True)) if out else [[]] * (4 + with_text)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(4), *arrays], ["row", *[f.split()[0] for f in fields.split(", ")]])

    return cut.select("text", "text_key", "none", "spans", "row").mapInArrow(run, _schema(rows, fields))


def _without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for start, end in runs:
        parts.append(data[at:start])
        at = end
    return b"".join(parts) + data[at:] if parts else data


def _schema(rows: DataFrame, fields: str) -> T.StructType:
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType)])
    for field in fields.split(", "):
        name, kind = field.split()
        schema = schema.add(name, kind)
    return schema
