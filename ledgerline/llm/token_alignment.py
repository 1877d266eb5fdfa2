"""Alignment of two tokenizers' ids over the bytes that both cover.

A text falls into units, each a stretch that begins with a space, at places that no token of either vocabulary
crosses. So every unit has its tokens, groups and links whatever stands around it, and a task encodes a unit once.

A link is a stretch of bytes between two neighbouring token ends: there is one pair of tokens that both hold it.
Groups of one token on either side go by the identity map, from an id of the first vocabulary to the id of the same
bytes in the second, and are counted in a vector as long as the first vocabulary. Only links of other groups are counted as
pairs, summed in each task before the shuffle. Documents then read the totals: those of the identity map and of the
most frequent other pairs, MOST_KNOWN at most, are known to all tasks; the links of rarer pairs are joined with the totals.
Texts are encoded once: the codes of each document's links are written to the shared folder and read for the totals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.workspace import keep

#: Pairs whose totals all tasks know; 17 bytes each.
MOST_KNOWN = 1 << 16
#: Units and links that a task keeps, and pairs that it sums up before it hands them on.
UNITS_KEPT, LINKS_KEPT, PAIRS_KEPT = 400_000, 4_000_000, 1 << 20
#: Bytes of units that are encoded at once, and characters of texts that are cut into units at once.
ENCODED_BYTES, TEXT_CHARACTERS = 1 << 17, 1 << 20
#: Bins of pairs per doubling of their totals.
BINS = 8

SPACE, PIECE_SPACE = " ", "▁"
SPACE_BEHIND_SPACE = [chr(c) + SPACE for c in range(0x3001) if chr(c).isspace()]


class Vocabulary:
    """One tokenizer: ids of texts and the bytes of each id, lying one behind the other."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.tokens = tokens

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of these ids."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[np.arange(total) + np.repeat(self.starts[ids] - (ends - sizes), sizes)]


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteLevel(Vocabulary):
    """A byte-level vocabulary of the tokenizers library; strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        symbols = byte_symbols()
        names = {i: name for name, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        super().__init__([self._bytes(names.get(i, ""), symbols) for i in range(max(names) + 1)])

    @staticmethod
    def _bytes(name: str, symbols: dict[str, int]) -> bytes:
        return bytes(symbols[c] for c in name) if all(c in symbols for c in name) else name.encode()

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)


class Pieces(Vocabulary):
    """A sentencepiece vocabulary, which puts a space before each text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        super().__init__([bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(PIECE_SPACE, SPACE).encode() for i, n in enumerate(names)])
        #: Whether a space can only begin a piece or follow another space.
        self.space_begins = not any(PIECE_SPACE in n.lstrip(PIECE_SPACE) for n in names)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int64)


@cache
def vocabularies(first: str, second: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(first), Pieces(second)


def identity_map(first: Vocabulary, second: Vocabulary) -> np.ndarray:
    """For each id of `first` the smallest id of `second` with the same bytes, -1 without one."""
    of_bytes: dict[bytes, int] = {}
    for i, token in enumerate(second.tokens):
        if token:
            of_bytes.setdefault(token, i)
    return np.array([of_bytes.get(t, -1) for t in first.tokens], np.int64)


def units_of(text: str, whole: bool = False) -> list[str]:
    """The units of a text, without the space that each begins with: every one begins behind a character that is no space.

    So tokens of neither vocabulary reach from one into the next. A space at the text's end belongs to the unit before.
    """
    if whole:
        return [text]
    parts = text.split(SPACE)
    if parts[0] and parts[-1] and not any(pair in text for pair in SPACE_BEHIND_SPACE):
        return parts
    units, unit = [], parts[0]
    for part in parts[1:]:
        if not unit or unit[-1].isspace():
            unit = f"{unit} {part}"
        else:
            units.append(unit)
            unit = part
    if not unit and units:
        units[-1] += SPACE
    else:
        units.append(unit)
    return units


COMMA, BAR, SEMICOLON, LINE = range(4)


@cache
def written_ids(blocks: int) -> np.ndarray:
    """Decimal ids below (blocks + 1) * 2^16 with each of the signs that can follow."""
    return np.array([[f"{i}{sign}" for sign in ",|;\n"] for i in range(blocks + 1 << 16)], object)


@dataclass
class Aligned:
    """The links of units, each unit's behind those of the one before."""

    units: list[str]
    a: np.ndarray  # ids of the links' tokens
    b: np.ndarray
    new_a: np.ndarray  # whether a link is the first of its token
    new_b: np.ndarray
    ends: np.ndarray  # whether a link is the last of its group
    bounds: np.ndarray  # the first link of each unit, and the end of all; a unit that a vocabulary writes otherwise has none

    def sums(self, of_link: np.ndarray) -> np.ndarray:
        """The sum over each unit's links."""
        total = np.zeros(len(of_link) + 1, np.int64)
        np.cumsum(of_link, out=total[1:])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def exact(self, same: np.ndarray) -> np.ndarray:
        """Links that are groups of the identity map: one token on either side."""
        alone = self.ends.copy()
        alone[1:] &= self.ends[:-1]
        return alone & (same[self.a] == self.b)

    def written(self) -> list[str]:
        """Each unit's groups, like 1,2|3;4|5."""
        group = np.cumsum(self.ends) - self.ends
        a_last, b_last = self._last(self.new_a), self._last(self.new_b)
        unit_ends = np.zeros(len(self.ends), bool)
        unit_ends[self.bounds[1:][np.diff(self.bounds) > 0] - 1] = True
        a, b = self.a[a_last], self.b[b_last]
        a_behind = np.where(self.ends[a_last], BAR, COMMA)
        b_behind = np.where(unit_ends[b_last], LINE, np.where(self.ends[b_last], SEMICOLON, COMMA))
        # Tokens of a group stand before those of the other side, and behind all of the groups before.
        groups = int(group[-1]) + 1 if len(group) else 0
        a_of, b_of = np.bincount(group[a_last], minlength=groups), np.bincount(group[b_last], minlength=groups)
        a_place = np.arange(len(a)) + (np.cumsum(b_of) - b_of)[group[a_last]]
        b_place = np.arange(len(b)) + np.cumsum(a_of)[group[b_last]]
        table = written_ids(max(int(a.max(initial=0)), int(b.max(initial=0))) + 1 >> 16)
        items = np.empty(len(a) + len(b), object)
        items[a_place], items[b_place] = table[a, a_behind], table[b, b_behind]
        lines = iter("".join(items).split("\n"))
        return [next(lines) if n else "" for n in np.diff(self.bounds).tolist()]

    @staticmethod
    def _last(new: np.ndarray) -> np.ndarray:
        """The last link of each token."""
        return np.flatnonzero(np.append(new[1:], True)) if len(new) else np.empty(0, np.int64)


def align(units: list[str], first: ByteLevel, second: Pieces) -> Aligned:
    """Encode units and link their tokens, many at once where that gives the same tokens."""
    apart = [u for u in units if not u or u[-1].isspace() or PIECE_SPACE in u]
    if apart:
        kept = set(apart)
        units = [u for u in units if u not in kept]
    parts, at = [], 0
    while at < len(units):
        stop, size = at, 0
        while stop < len(units) and size < ENCODED_BYTES:
            size += len(units[stop]) + 1
            stop += 1
        parts += _linked(units[at:stop], first, second)
        at = stop
    for unit in apart:
        parts += _linked([unit], first, second)
    a, b, new_a, new_b, ends, sizes = (np.concatenate([np.empty(0, kind), *[p[c] for p in parts]]) for c, kind in enumerate((np.int64, np.int64, bool, bool, bool, np.int64)))
    return Aligned(units + apart, a, b, new_a, new_b, ends, np.concatenate([[0], np.cumsum(sizes)]))


def _linked(units: list[str], first: ByteLevel, second: Pieces) -> list[tuple]:
    """Columns of Aligned for units encoded as one text, and how many links each has."""
    text = SPACE.join(units)
    data = np.frombuffer(f"{SPACE}{text}".encode(), np.uint8)
    a, b = first.encode(SPACE + text), second.encode(text)
    bounds = np.cumsum([len(u.encode()) + 1 for u in units])
    a_ends, b_ends = np.cumsum(first.sizes[a]), np.cumsum(second.sizes[b])
    whole = np.array_equal(first.joined(a), data) and np.array_equal(second.joined(b), data)
    if not whole or not (np.isin(bounds, a_ends).all() and np.isin(bounds, b_ends).all()):
        if len(units) > 1:
            return [part for u in units for part in _linked([u], first, second)]
        return [(*[np.empty(0, kind) for kind in (np.int64, np.int64, bool, bool, bool)], np.zeros(1, np.int64))]
    ends = np.union1d(a_ends, b_ends)
    of_a, of_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    new_a, new_b = np.diff(of_a, prepend=-1) > 0, np.diff(of_b, prepend=-1) > 0
    both = (a_ends[of_a] == ends) & (b_ends[of_b] == ends)
    return [(a[of_a], b[of_b], new_a, new_b, both, np.diff(np.searchsorted(ends, bounds) + 1, prepend=0))]


class Units:
    """The units that a task has met, with numbers; `learned` is told of new ones, in the order of their numbers."""

    def __init__(self, first: ByteLevel, second: Pieces, learned, forgotten):
        self.first, self.second, self.learned, self.forgotten = first, second, learned, forgotten
        self.index: dict[str, int] = {}
        self.links = 0

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The units' numbers, text after text, and where each text begins among them."""
        of_text = [units_of(t, not self.second.space_begins) if t else [] for t in texts]
        bounds = np.cumsum([0, *map(len, of_text)])
        units = list(chain.from_iterable(of_text))
        numbers, unknown = self._known(units)
        new = list(dict.fromkeys(unknown))
        if len(self.index) + len(new) > UNITS_KEPT or self.links > LINKS_KEPT:
            self.forget()
            numbers, unknown = self._known(units)
            new = list(dict.fromkeys(unknown))
        if new:
            found = align(new, self.first, self.second)
            self.index.update(zip(found.units, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.links += len(found.a)
            self.learned(found)
            numbers[numbers < 0] = [self.index[u] for u in unknown]
        return numbers, bounds

    def _known(self, units: list[str]) -> tuple[np.ndarray, list[str]]:
        """Numbers, -1 for unknown units, and those."""
        numbers = np.fromiter(map(self.index.get, units, repeat(-1)), np.int64, len(units))
        return numbers, [units[k] for k in np.flatnonzero(numbers < 0).tolist()]

    def forget(self) -> None:
        self.forgotten()
        self.index, self.links = {}, 0


def _of_texts(of_unit: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum over each text's units."""
    total = np.zeros(len(of_unit) + 1, np.int64)
    np.cumsum(of_unit, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _portions(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts of about a megabyte together, and the row of the first."""
    first, portion, size = 0, [], 0
    for k, value in enumerate(texts):
        text = value.as_py()
        portion.append(text)
        size += len(text or "")
        if size >= TEXT_CHARACTERS:
            yield first, portion
            first, portion, size = k + 1, [], 0
    if portion:
        yield first, portion


def _appended(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    return np.concatenate([old, new])


def encode_documents(rows: DataFrame, first: str, second: str) -> DataFrame:
    """What encoding rows (doc_id, text) finds, in rows of two kinds.

    With row_id: a document's figures and the codes of its links. A pair's code is its first id times the size of the second vocabulary, plus
    its second id. Without: (code, total, same), how many links of a task's documents hold a pair, `same` for groups of the identity map.
    """
    kind = code_type(first, second)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ours, theirs = vocabularies(first, second)
        same = identity_map(ours, theirs)
        width = len(theirs.sizes)
        next_row = TaskContext.get().partitionId() << 40
        exact_counts = np.zeros(len(same), np.int64)
        pairs = [np.empty(0, np.int64), np.empty(0, np.int64)]
        figures, codes, bounds, exact, times, written = [], None, None, None, None, []

        def emptied() -> None:
            nonlocal figures, codes, bounds, exact, times
            figures = [np.empty(0, np.int64) for _ in FIGURES]
            codes, exact, bounds, times = np.empty(0, kind), np.empty(0, bool), np.zeros(1, np.int64), np.empty(0, np.int64)
            written.clear()

        def learned(found: Aligned) -> None:
            nonlocal figures, codes, bounds, exact, times
            new = (found.sums(x) for x in (found.new_a, found.new_b, found.ends, np.ones(len(found.a), bool)))
            figures = [_appended(x, y) for x, y in zip(figures, new, strict=True)]
            codes = _appended(codes, (found.a * width + found.b).astype(kind))
            exact = _appended(exact, found.exact(same))
            bounds = _appended(bounds, bounds[-1] + found.bounds[1:])
            times = _appended(times, np.zeros(len(found.units), np.int64))
            written.extend(found.written())

        def forgotten() -> None:
            """Links of the units that are given up go into the vector or to the pairs."""
            weights = np.repeat(times, np.diff(bounds))
            np.add.at(exact_counts, codes[exact] // width, weights[exact])
            other = ~exact & (weights > 0)
            met, of = np.unique(_appended(pairs[0], codes[other].astype(np.int64)), return_inverse=True)
            total = np.zeros(len(met), np.int64)
            np.add.at(total, of, _appended(pairs[1], weights[other]))
            pairs[:] = met, total
            emptied()

        def row(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

        def counted(met: np.ndarray, totals: np.ndarray, flag: bool) -> pa.RecordBatch:
            return row(len(met), code=pa.array(met), total=pa.array(totals), same=pa.array(np.full(len(met), flag)))

        emptied()
        units, schema = Units(ours, theirs, learned, forgotten), None
        for batch in batches:
            schema = schema or _encoded(batch.schema.field(0).type)
            for at, portion in _portions(batch.column(1)):
                numbers, starts = units.numbers(portion)
                bad = _of_texts(figures[-1][numbers] == 0, starts) > 0
                good = np.repeat(~bad, np.diff(starts))
                times += np.bincount(numbers[good], minlength=len(times))
                n, sizes = len(portion), np.where(good, figures[-1][numbers], 0)
                ends = np.cumsum(sizes)
                total = int(ends[-1]) if len(ends) else 0
                links = codes[np.arange(total) + np.repeat(bounds[numbers] - (ends - sizes), sizes)]
                hashes = ["" if x or low == high else hashlib.sha256(";".join([written[u] for u in numbers[low:high].tolist()]).encode()).hexdigest() for x, low, high in zip(bad, starts, starts[1:], strict=False)]
                columns = {name: pa.array(_of_texts(np.where(good, f[numbers], 0), starts)) for name, f in zip(FIGURES, figures, strict=True)}
                link_bounds = np.concatenate([[0], np.cumsum(_of_texts(sizes, starts))])
                yield row(n, row_id=pa.array(np.arange(next_row, next_row + n)), doc_id=batch.column(0).slice(at, n), groups_sha256=pa.array(hashes, pa.string()), links=_packed(link_bounds, links), **columns)
                next_row += n
                if len(pairs[0]) > PAIRS_KEPT:
                    yield counted(*pairs, False)
                    pairs[:] = np.empty(0, np.int64), np.empty(0, np.int64)
        if schema:
            units.forget()
            yield counted(*pairs, False)
            met = np.flatnonzero(exact_counts)
            yield counted(met * width + same[met], exact_counts[met], True)

    figures = ", ".join(f"{name} long" for name in FIGURES)
    return rows.mapInArrow(run, f"row_id long, doc_id {dict(rows.dtypes)['doc_id']}, {figures}, groups_sha256 string, links binary, code long, total long, same boolean")


FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def _encoded(doc_id: pa.DataType) -> pa.Schema:
    kinds = {"row_id": pa.int64(), "doc_id": doc_id, **dict.fromkeys(FIGURES, pa.int64()), "groups_sha256": pa.string(), "links": pa.binary(), "code": pa.int64(), "total": pa.int64(), "same": pa.bool_()}
    return pa.schema(kinds.items())


def code_type(first: str, second: str) -> type:
    """The type of a pair's code."""
    ours, theirs = vocabularies(first, second)
    return np.int32 if len(ours.sizes) * len(theirs.sizes) < 1 << 31 else np.int64


def _packed(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    """Each row's values as their bytes, which Spark passes on without a look at every one."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(rows: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of the rows, and where each row begins among them."""
    width = np.dtype(kind).itemsize
    offsets = np.frombuffer(rows.buffers()[1], np.int32 if pa.types.is_binary(rows.type) else np.int64)[rows.offset : rows.offset + len(rows) + 1].astype(np.int64)
    data = rows.buffers()[2]
    values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind) if data else np.empty(0, kind)
    return values, (offsets - offsets[0]) // width


def _lists(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))


def align_tokenizers(documents: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text", most_known: int = MOST_KNOWN) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `first` and `second` are paths of a byte-level and of a sentencepiece vocabulary; the first one reads the text behind a
    space, which the second one adds itself. A null or empty text, and one that a vocabulary does not give back byte for byte, has no tokens:
    zeros, and '' for the hash, and it counts nowhere. Repeated rows and rows without doc_id are documents of their own, and
    count as such; without rows there is no result; other columns are not looked at.
    """
    spark = documents.sparkSession
    rows = documents.select(documents[doc_id].alias("doc_id"), documents[text].alias("text"))
    width = len(vocabularies(first, second)[1].sizes)
    encoded = keep(encode_documents(rows, first, second))
    counts = encoded.where("row_id is null").groupBy("code").agg(F.sum("total").alias("total"), F.max("same").alias("same"))
    counts = keep(counts)
    # One row for each id of the second vocabulary.
    highest = counts.groupBy((F.col("code") % width).alias("b")).agg(F.max("total").alias("highest"))
    ranked = counts.withColumn("b", F.col("code") % width).join(F.broadcast(highest), "b")
    totals = ranked.select("code", "total", (F.col("total") == F.col("highest")).alias("best"), "same", _bin("total").alias("bin"))
    # Pairs of whole bins, the most frequent first, as long as they fit.
    least, room = None, most_known
    for bin_, n in sorted(counts.groupBy(_bin("total").alias("bin")).count().collect(), reverse=True):
        if n > room:
            break
        least, room = bin_, room - n
    frequent = F.col("same") | (F.col("bin") >= least if least is not None else F.lit(False))
    table = totals.where(frequent).select("code", "total", "best").orderBy("code").toArrow()
    known = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("code", "total", "best")))
    told = keep(_read_totals(encoded.where("row_id is not null"), known, code_type(first, second)))
    # A pair that is not known has a small share of all links, so no join key is hot.
    rare = told.select("row_id", F.explode("rare").alias("code")).join(totals.where(~frequent), "code")
    rare = rare.groupBy("row_id").agg(F.sum("total").alias("more_sum"), F.sum(F.col("best").cast("long")).alias("more_best"))
    added = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
    return told.join(rare, "row_id", "left").select("doc_id", *FIGURES, added("n_best", F.col("more_best")), added("count_sum", F.col("more_sum")), "groups_sha256")


def _bin(total: str):
    return F.floor(F.log2(total) * BINS).cast("int")


def _read_totals(encoded: DataFrame, known, kind: type) -> DataFrame:
    """Each document's figures by the known totals, and the codes of its other links."""
    kept = ["row_id", "doc_id", *FIGURES, "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, totals, best = known.value
        codes = codes.astype(kind)
        for batch in batches:
            code, bounds = _unpacked(batch.column("links"), kind)
            hit, count, highest = np.zeros(len(code), bool), np.zeros(len(code), np.int64), np.zeros(len(code), bool)
            if len(codes):
                at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                hit = codes[at] == code
                count, highest = np.where(hit, totals[at], 0), hit & best[at]
            others = np.concatenate([[0], np.cumsum(~hit)])[bounds]
            found = [*map(pa.array, (_of_texts(highest, bounds), _of_texts(count, bounds))), _lists(others, code[~hit].astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *found], [*kept, "n_best", "count_sum", "rare"])

    chosen = encoded.select(*kept, "links")
    kinds = dict(chosen.dtypes)
    return chosen.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", n_best long, count_sum long, rare array<long>")
