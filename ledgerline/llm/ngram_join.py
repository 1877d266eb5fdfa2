"""N-gram Jaccard join by universe partition: documents that share most of their word shingles.

Sets are distinct hashed shingles. Two sets of sizes r and s with Jaccard similarity of at least
p / 100 differ in at most H = (100 - p)(r + s) / (100 + p) shingles.

* Size bands. Band k holds sizes up to an upper end U_k, and its ends grow by 100 / p, so the
  partner of a set is in its band or a neighbouring one. A pair meets in the band of its larger set,
  with H taken for two sets of size U_k; every set is indexed in its own band and the next.
* Segments. Hashing cuts the universe of shingles into m segments. With m = H + 1 + w, at least
  w + 1 segments of a linked pair are equal, so each set may leave out its w weakest segments
  (smallest, then by hash): the strongest common one stays in both. Small bands may instead index
  every segment with all its one-deletion neighbours; a segment then stands for two differences and
  m = H // 2 + 1 segments do. The plan of each band is the cheapest by index rows plus expected
  accidental hits, from the number of documents in the band.
* Each index key elects a hub, the member that shares most keys; every member is compared with its
  hubs only. For members x, y of a hub b, with D(x) the symmetric difference of x and b,
  |x - y| = |D(x)| + |D(y)| - 2 |D(x) and D(y)|. If |D(x)| + |D(y)| is within the bound, both are linked
  to b. Otherwise D(x) and D(y) share at least o = (|D(x)| + |D(y)| - H) / 2 elements, so they meet in a
  prefix of |D| - o + 1 elements, taken with added shingles first. Only members that are not linked
  to b start such pairs. Who can be linked with whom is known from |D| alone, so members come in buckets by hub and
  bands of |D|. A bucket without a start or without a partner goes at once, one with fewer pairs than prefix
  elements, by a factor, gives these pairs, and only the rest meet by elements. Members of a key that few share need no buckets: those that are not linked to a hub are
  paired with the others of the key. A group of copies thus costs rows in proportion to its size, and no link
  that joins two components is lost.
* A sketch of a set has the parity of the shingles in each of SKETCH_BITS places. Two sets differ in no fewer shingles than
  their sketches in bits, so pairs whose sketches differ in more than H bits go before their sets are read.
* Every other candidate is verified on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial, reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm import kernels
from ledgerline.llm.components import components
from ledgerline.llm.runs import keys_of_several
from ledgerline.llm.workspace import keep

#: A shingle of an unrelated set is expected to be the same once in so many.
DIVERSITY = 200.0
#: A key of so many members or less gives its pairs, a larger one goes by its hub alone.
FEW = 4
#: A bucket gives its pairs up to so many for each row that its members would have to meet (two sketches are compared faster than
#: a row is made and shuffled), and as many as one task compares in seconds. In a larger one the members meet.
PAIRS, MOST_PAIRS = 16, 1 << 24
#: Bits of a sketch, in longs.
SKETCH_BITS = 1024
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]


@dataclass(frozen=True)
class Band:
    index: int
    upper: int
    differences: int
    segments: int
    weakest: int  # segments that a set may leave out
    deletions: bool


def upper_ends(percent: int, largest: int) -> list[int]:
    """Upper ends of the bands 0, 1, ...; two sizes at a ratio of percent / 100 or more are in one band or in two next to each other."""
    ends = [0]
    while ends[-1] < largest:
        ends.append(max(ends[-1] + 1, (ends[-1] + 1) * 100 // percent))
    ends.append(max(ends[-1] + 1, (ends[-1] + 1) * 100 // percent))
    return ends


def differences(percent: int, sizes: int) -> int:
    """Most elements in which two sets of `sizes` elements together may differ."""
    return (100 - percent) * sizes // (100 + percent)


def plan_bands(percent: int, sizes: dict[int, int], ends: list[int]) -> list[Band]:
    """The cheapest plan for each band; sizes: documents by band."""
    bands = []
    for k, upper in enumerate(ends):
        h, documents = differences(percent, 2 * upper), sizes.get(k, 0) + sizes.get(k - 1, 0)
        options = []
        for m in sorted({h + 1, (h + 1) * 6 // 5, (h + 1) * 3 // 2}):
            smallest = _quantile(upper / m, (m - h - 1) / m, m)
            options.append((h + 1 + documents * DIVERSITY**-smallest, Band(k, upper, h, m, m - h - 1, False)))
        m = h // 2 + 1
        smallest = max(0, _quantile(upper / m, 0, m) - 1)
        options.append((upper + m + documents * DIVERSITY**-smallest, Band(k, upper, h, m, 0, True)))
        bands.append(min(options, key=lambda x: x[0])[1])
    return bands


def _quantile(mean: float, share: float, segments: int) -> int:
    """Size of the smallest segment that is expected when the share of weakest ones is left out (sizes are near Poisson)."""
    term = total = math.exp(-mean)
    size = 0
    while total <= share + 0.5 / segments and size < mean + 1:
        size += 1
        term *= mean / size
        total += term
    return size


def shingle_sets(documents: DataFrame, text: str, size: int, keys: list[str]) -> DataFrame:
    """keys, set_id (null for an empty set), n_shingles and the ascending shingles of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in kernels.text_slices(batch.column(len(keys))):
                rows = len(bounds) - 1
                ends, hashes = kernels.shingles(kernels.words(data, bounds), rows, size)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(hashes.view(np.int64)))
                ids = _set_ids(ends, hashes)
                counts = np.diff(ends)
                kept = [batch.column(i).slice(first, rows) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, mask=counts == 0), pa.array(counts), lists], [*keys, "set_id", "n_shingles", "shingles"])

    types = dict(documents.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys)
    return documents.select(*keys, text).mapInArrow(run, f"{schema}, set_id long, n_shingles long, shingles array<long>")


def _set_ids(ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(kernels.mix(hashes ^ np.uint64(0x5DEECE66D)), out=sums[1:])
    counts = np.diff(ends).astype(np.uint64)
    return kernels.mix((sums[ends[1:]] - sums[ends[:-1]]) * np.uint64(2) + counts).view(np.int64)


def _index(documents: DataFrame, text: str, size: int, bands: list[Band]) -> DataFrame:
    """(key, set_id): the index rows of every set; a task does not repeat those of a set that it has met."""
    ends = np.array([b.upper for b in bands])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for _, data, bounds in kernels.text_slices(batch.column(0)):
                bounds_of, hashes = kernels.shingles(kernels.words(data, bounds), len(bounds) - 1, size)
                ids, counts = _set_ids(bounds_of, hashes), np.diff(bounds_of)
                fresh = []
                for i in np.flatnonzero(counts):
                    if (one := int(ids[i])) not in met:
                        met.add(one)
                        fresh.append(i)
                fresh = np.array(fresh, np.int64)
                for shift in (0, 1):
                    at = np.searchsorted(ends, counts[fresh]) + shift
                    rows = fresh[at < len(bands)]
                    keys, owners = index_keys(bounds_of, hashes, rows, at[at < len(bands)], bands)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids[owners])], ["key", "set_id"])

    return documents.select(text).mapInArrow(run, "key long, set_id long")


def index_keys(ends: np.ndarray, hashes: np.ndarray, rows: np.ndarray, at: np.ndarray, bands: list[Band]) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of the given rows, each in the band `at`, and the row of each key."""
    counts = np.diff(ends)[rows]
    of = np.repeat(np.arange(len(rows)), counts)
    tokens = np.repeat(ends[rows] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    x = hashes[tokens]
    segments = np.array([b.segments for b in bands], np.uint64)[at]
    # The high half of a hash picks the segment, so ascending shingles come segment by segment.
    segment = ((x >> np.uint64(32)) * segments[of]) >> np.uint64(32)
    new = np.ones(len(x), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (of[1:] != of[:-1])
    start = np.flatnonzero(new)
    if not len(start):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    owner, size = of[start], np.diff(np.append(start, len(x)))
    own = kernels.mix(x * np.uint64(0xA24BAED4963EE407) + segment)
    total = np.add.reduceat(own, start)
    band = at.astype(np.uint64) + np.uint64(1)
    place = kernels.mix((band[owner] << np.uint64(33)) + segment[start])

    def signature(content: np.ndarray, size: np.ndarray, place: np.ndarray) -> np.ndarray:
        return kernels.mix(content + place + size.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))

    whole = signature(total, size, place)
    deletes = np.array([b.deletions for b in bands])[at]
    spare = np.array([b.weakest for b in bands])[at] - (segments.astype(np.int64) - np.bincount(owner, minlength=len(rows)))
    # Exact plan: all but the weakest segments; empty ones are the weakest of all.
    order = np.lexsort((whole, size, owner))
    rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
    kept = order[(rank >= spare[owner[order]]) & ~deletes[owner[order]]]
    bare = np.flatnonzero((spare < 0) & ~deletes)
    zero = np.zeros(len(bare), np.uint64)
    keys = [whole[kept], signature(zero, zero, kernels.mix(band[bare]))]
    owners = [rows[owner[kept]], rows[bare]]
    # Deletion plan: every segment whole and without each of its shingles; an empty one whole.
    if deletes.any():
        full = deletes[owner]
        keys.append(whole[full])
        owners.append(rows[owner[full]])
        run = np.cumsum(new) - 1
        each = np.flatnonzero(deletes[of])
        left = size[run[each]] - 1
        keys.append(signature(total[run[each]] - own[each], left, place[run[each]]))
        owners.append(rows[of[each]])
        for i in np.flatnonzero(deletes):
            m = int(segments[i])
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), segment[start[owner == i]])
            where = kernels.mix((band[i] << np.uint64(33)) + empty)
            none = np.zeros(len(empty), np.uint64)
            keys.append(signature(none, none, where))
            owners.append(np.full(len(empty), rows[i]))
    return np.concatenate(keys), np.concatenate(owners)


def _distance_band(d: int) -> int:
    return d if d < 4 else 4 + int(math.log(d / 4) / math.log(1.3))


def _distance_low(band: int) -> int:
    if band < 4:
        return band
    low = int(4 * 1.3 ** (band - 4))
    while _distance_band(low) < band:
        low += 1
    while _distance_band(low - 1) >= band:
        low -= 1
    return low


def prefixes(n: int, d: int, linked: bool, percent: int) -> list[tuple[str, int, int, int]]:
    """(role, band of the unlinked, band of the other, prefix length) for a member with n shingles, d from its hub.

    Role u: the member starts pairs (it is not linked to the hub); role v: it is found by one.
    """
    bound = differences(percent, n + n * 100 // percent)
    mine = _distance_band(d)
    found = []
    for band in range(_distance_band(max(0, d - bound)), _distance_band(d + bound) + 1):
        low, high = max(_distance_low(band), d - bound), min(_distance_low(band + 1) - 1, d + bound)
        overlap = max(1, -((bound - d - low) // 2))
        if low > high or overlap > min(d, high):
            continue
        if not linked:
            found.append(("u", mine, band, d - overlap + 1))
        # Of two that are not linked, the one farther from the hub starts.
        if linked or band >= mine:
            found.append(("v", band, mine, d - overlap + 1))
    return found


def _bucket_rows(members: DataFrame, percent: int) -> DataFrame:
    """(hub, i_band, j_band, starts, set_id, length) from members with n shingles and their distance from the hub: where each one starts pairs or is found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = lru_cache(maxsize=1 << 16)(partial(prefixes, percent=percent))
        for batch in batches:
            rows = []
            for own, hub, linked, n, distance in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [(hub, i_band, j_band, role == "u", own, length) for role, i_band, j_band, length in found(n, distance, linked)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["hub", "i_band", "j_band", "starts", "set_id", "length"])

    return members.select("set_id", "hub", "linked", "n", "distance").mapInArrow(run, "hub long, i_band long, j_band long, starts boolean, set_id long, length long")


def _difference_rows(members: DataFrame) -> DataFrame:
    """(meeting long, starts, set_id) from members with their own and the hub's shingles, and what they have in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met, starts, ids = [], [], []
            for i in range(batch.num_rows):
                own, hub, places, x, b = (batch.column(k)[i] for k in range(5))
                x, b = (np.asarray(s.values.to_numpy(zero_copy_only=False)).view(np.uint64) for s in (x, b))
                order = np.concatenate([np.setdiff1d(x, b, True), np.setdiff1d(b, x, True)])
                key = kernels.mix(order + np.uint64(hub.as_py() * 3 & (1 << 64) - 1))
                for place in places.as_py():
                    length = place["length"]
                    met.append(kernels.mix(key[:length] + np.uint64(place["i_band"] * 4096 + place["j_band"] + 1)))
                    starts.append(np.full(length, place["starts"]))
                    ids.append(np.full(length, own.as_py(), np.int64))
            if met:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(met).view(np.int64)), pa.array(np.concatenate(starts)), pa.array(np.concatenate(ids))], ["meeting", "starts", "set_id"])

    return members.select("set_id", "hub", "places", "shingles", "hub_shingles").mapInArrow(run, "meeting long, starts boolean, set_id long")


def sketches(sets: DataFrame) -> DataFrame:
    """(set_id, n, s0, s1, ...): number of shingles, and parity of those in each place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                lists = part.column(1)
                bounds = lists.offsets.to_numpy().astype(np.int64)
                of = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                hashes = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)[bounds[0] : bounds[-1]]
                place = (kernels.mix(hashes) % np.uint64(SKETCH_BITS)).astype(np.int64)
                odd = np.bincount(of * SKETCH_BITS + place, minlength=part.num_rows * SKETCH_BITS) & 1
                bits = np.packbits(odd.astype(np.uint8).reshape(part.num_rows, SKETCH_BITS), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(bounds)), *map(pa.array, bits.T.copy())], ["set_id", "n", *SKETCH])

    return sets.select("set_id", "shingles").mapInArrow(run, "set_id long, n long, " + ", ".join(f"{s} long" for s in SKETCH))


def _sketched(rows: DataFrame, marks: DataFrame, column: str) -> DataFrame:
    """`rows` with the sketch of the set in `column`."""
    return rows.join(marks.select(F.col("set_id").alias(column), *[F.col(c).alias(f"{column}_{c}") for c in ("n", *SKETCH)]), column)


def _maybe(x: str, y: str, percent: int) -> Column:
    """Whether two sets can be linked, for all that their sketches tell."""
    bits = reduce(add, [F.bit_count(F.col(f"{x}_{s}").bitwiseXOR(F.col(f"{y}_{s}"))) for s in SKETCH])
    return (100 + percent) * bits <= (100 - percent) * (F.col(f"{x}_n") + F.col(f"{y}_n"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs (set_id, hub) with the size of the first, in how many shingles they differ, and whether they are linked."""
    # Only sets of pairs move; ids of few pairs are broadcast.
    x = sets.select("set_id", F.col("shingles").alias("x")).join(pairs.select("set_id"), "set_id", "left_semi")
    y = sets.select(F.col("set_id").alias("hub"), F.col("shingles").alias("y")).join(pairs.select("hub"), "hub", "left_semi")
    both = pairs.join(x, "set_id").join(y, "hub")
    both = both.withColumn("common", F.size(F.array_intersect("x", "y")).cast("long")).withColumn("n", F.size("x").cast("long")).withColumn("m", F.size("y"))
    union = F.col("n") + F.col("m") - F.col("common")
    return both.select(*pairs.columns, "n", (union - F.col("common")).alias("distance"), (100 * F.col("common") >= percent * union).alias("linked"))


def _bucket_pairs(stars: DataFrame, whole: DataFrame, marks: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(u, v), twice: pairs of small buckets that their sketches leave open, and those that meet in large ones, repeated."""
    open_hubs = stars.where(~F.col("linked")).select("hub").distinct()
    # At keys of FEW members or less the pairs themselves are fewer.
    members = stars.where(F.col("shared") > FEW).join(open_hubs, "hub")
    bucket = ["hub", "i_band", "j_band"]
    rows = keep(_bucket_rows(members, percent))
    sizes = rows.groupBy(bucket).agg(F.count_if("starts").alias("us"), F.count_if(~F.col("starts")).alias("vs"), F.sum("length").alias("rows"), F.min("set_id").alias("one"), F.max("set_id").alias("other"))
    sizes = sizes.where("us > 0 and vs > 0 and one <> other").select(*bucket, F.xxhash64(*bucket).alias("h"), (F.col("us") * F.col("vs") <= F.least(PAIRS * F.col("rows"), F.lit(MOST_PAIRS))).alias("small"))
    rows = keep(rows.withColumn("h", F.xxhash64(*bucket)).join(sizes, [*bucket, "h"]).drop("h"))
    u = _sketched(rows.where("small and starts").select(*bucket, F.col("set_id").alias("u")), marks, "u")
    v = _sketched(rows.where("small and not starts").select(*bucket, F.col("set_id").alias("v")), marks, "v")
    same = reduce(and_, [u[c] == v[c] for c in bucket])
    paired = u.join(v, same & (F.col("u") != F.col("v")) & _maybe("u", "v", percent)).select("u", "v")
    places = rows.where("not small").groupBy("set_id", "hub").agg(F.collect_list(F.struct("i_band", "j_band", "starts", "length")).alias("places"))
    places = places.join(whole, "set_id").join(whole.select(F.col("set_id").alias("hub"), F.col("shingles").alias("hub_shingles")), "hub")
    meetings = keep(_difference_rows(places))
    starting = meetings.where("starts").select("meeting", F.col("set_id").alias("u"))
    return paired, starting.join(meetings.where("not starts").select("meeting", F.col("set_id").alias("v")), "meeting").where("u <> v").select("u", "v")


def ngram_jaccard_join(documents: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(sets, links): each row's set, and links between different sets that connect all linked ones.

    sets: doc_id, text_key long, set_id long (null: no words or null text), n_shingles long, one row
    per input row. links: set_id, hub: verified pairs of different sets whose connected components are those of
    all linked pairs. Equal sets have one set_id. Nulls in doc_id, repeated rows, ties and extra
    columns are kept apart by row; without rows both results are empty.
    """
    documents = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    sets = keep(shingle_sets(documents, "text", size, ["doc_id", "text_key"]).drop("shingles"))
    largest = sets.agg(F.max("n_shingles")).first()[0] or 0
    ends = upper_ends(percent, largest)
    # At most one count for each band; bands grow with the logarithm of the largest set.
    width = F.array_position(F.transform(F.array(*map(F.lit, ends)), lambda e: e >= F.col("n_shingles")), True) - 1
    counts = {r[0]: r[1] for r in sets.where("n_shingles > 0").groupBy(width).count().collect()}
    bands = plan_bands(percent, counts, ends)
    index = keep(keys_of_several(_index(documents, "text", size, bands), "key", "set_id"))
    pairs = keep(_hub_pairs(index))
    found = pairs.select("set_id").unionByName(pairs.select(F.col("hub").alias("set_id"))).distinct()
    first = sets.where("set_id is not null").groupBy("set_id").agg(F.min(F.struct("text_key", "doc_id")).alias("one"))
    first = first.join(found, "set_id", "left_semi").select("set_id", "one.*")
    rows = documents.join(first.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k")), F.col("text_key").eqNullSafe(F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")
    whole = keep(shingle_sets(rows, "text", size, ["doc_id"]).select("set_id", "shingles").dropDuplicates(["set_id"]))
    marks = keep(sketches(whole))
    open_ = _sketched(_sketched(pairs, marks, "set_id"), marks, "hub").withColumn("maybe", _maybe("set_id", "hub", percent))
    open_ = keep(open_.select(*pairs.columns, "maybe"))
    # Distances from a hub are of use at larger keys only.
    told = F.col("maybe") | (F.col("shared") > FEW)
    none = F.lit(None).cast("long")
    stars = keep(_verified(open_.where(told).drop("maybe"), whole, percent).unionByName(open_.where(~told).select(*pairs.columns, none.alias("n"), none.alias("distance"), F.lit(False).alias("linked"))))
    paired, met = _bucket_pairs(stars, whole, marks, percent)
    met = met.unionByName(_pairs_of_few(index, stars).where("u <> v"))
    ends_of = [F.least("u", "v").alias("set_id"), F.greatest("u", "v").alias("hub")]
    met = _sketched(_sketched(met.select(*ends_of).distinct(), marks, "set_id"), marks, "hub").where(_maybe("set_id", "hub", percent)).select("set_id", "hub")
    rest = keep(met.unionByName(paired.select(*ends_of)).distinct())
    links = stars.where("linked").select("set_id", "hub").unionByName(_verified(rest, whole, percent).where("linked").select("set_id", "hub"))
    return sets, keep(links.distinct())


def _hub_pairs(index: DataFrame) -> DataFrame:
    """(set_id, hub, shared): every member of a key with the key's hub, the member that shares most, and
    the most members that one of their common keys has."""
    shared = index.groupBy("key").agg(F.count("*").alias("shared"))
    weight = index.join(shared, "key").groupBy("set_id").agg(F.sum("shared").alias("weight"))
    weighed = index.join(weight, "set_id")
    hubs = weighed.groupBy("key").agg(F.max(F.struct("weight", "set_id")).alias("top"), F.count("*").alias("shared"))
    hubs = hubs.select("key", F.col("top.set_id").alias("hub"), "shared", F.xxhash64("key").alias("h"))
    pairs = index.withColumn("h", F.xxhash64("key")).join(hubs, ["key", "h"]).where("set_id <> hub")
    return pairs.groupBy("set_id", "hub").agg(F.max("shared").alias("shared"))


def _pairs_of_few(index: DataFrame, stars: DataFrame) -> DataFrame:
    """(u, v): members u that are not linked to a hub with the others of each key of 3 to FEW members that they share with it.

    Two that are both linked to the hub need no pair of their own. A key has FEW times FEW pairs at most.
    """
    few = index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n").between(3, FEW)).select("key")
    rows = index.join(few, "key")
    unlinked = stars.where(~F.col("linked")).select(F.col("set_id").alias("u")).distinct()
    u = rows.select("key", F.col("set_id").alias("u")).join(unlinked, "u", "left_semi")
    return u.join(rows.select("key", F.col("set_id").alias("v")), "key").select("u", "v")


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id that links reach).

    A row without words is linked with nothing: its component is its own doc_id, null where that is
    null. A null doc_id is no one's smallest id.
    """
    rows, _ = grouped(documents, size, percent, doc_id, text)
    return rows.select("doc_id", "n_shingles", "component_id")


def grouped(documents: DataFrame, size: int, percent: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows with text_key and group (null: no words), and for each group its smallest doc_id."""
    sets, links = ngram_jaccard_join(documents, size, percent, doc_id, text)
    roots = components(links.select(F.col("set_id").alias("u"), F.col("hub").alias("v")))
    rows = sets.join(roots.select(F.col("node").alias("set_id"), "root"), "set_id", "left")
    rows = keep(rows.select("doc_id", "text_key", "n_shingles", F.coalesce("root", "set_id").alias("group")))
    smallest = rows.where("`group` is not null").groupBy("group").agg(F.min("doc_id").alias("smallest"))
    smallest = smallest.select("group", F.xxhash64("group").alias("h"), "smallest")
    rows = rows.withColumn("h", F.xxhash64("group")).join(smallest, ["group", "h"], "left")
    return rows.select("doc_id", "text_key", "n_shingles", "group", F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id")), smallest


def one_of_each_group(documents: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`documents` with one row of each group of near duplicates: that with the smallest doc_id, null last.

    Of rows with one id, the one with the smaller text hash stays, and of equal rows one. Rows without words are in no
    group and stay. Texts are shuffled once, to meet the keys of those that go.
    """
    rows, _ = grouped(documents, size, percent, doc_id, text)
    rows = rows.where("`group` is not null").select("group", F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = rows.groupBy("group").agg(F.min(F.struct("none", "doc_id", "text_key")).alias("one"))
    first = first.select(F.xxhash64("one.none", "one.doc_id").alias("id_key"), F.col("one.text_key").alias("key"), F.lit(True).alias("first")).distinct()
    named = documents.select(F.struct("*").alias("row"), F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id)).alias("id_key"), F.xxhash64(text).alias("key"))
    wordless = ~F.coalesce(F.col(f"row.{text}"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = named.join(first, ["id_key", "key"], "left").withColumn("wordless", wordless)
    again = F.row_number().over(W.partitionBy("id_key", "key").orderBy(F.lit(1)))
    return kept.where(F.col("first") | F.col("wordless")).withColumn("again", again).where("again = 1 or wordless").select("row.*")
