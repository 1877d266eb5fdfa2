"""WARC archives of pages with a two-level capture index.

Writing. Records of equal payloads are one response, that of the largest page_id, and revisits that name it. Every task
compresses the records of its pages; of equal payloads one record a task is sent on, and one of all is written. Archives are
files of gzip members, one a record, and hold at most ARCHIVE_BYTES and a record.

Index. Captures are sorted by the host's labels from the last to the first and the rest of the URL, then page_id and place, so
the captures of a URL may fill many ranges. Each range is a file of compressed blocks of `block_captures` lines, and a
directory beside it has the first key of each block. The list of ranges, one row a file, is what all tasks know.

Reading. Requests are sorted in the same order; a task finds their blocks by binary search in the list and the directories.
Blocks are dealt out, so that each is read once, by its range of bytes alone, and searched for all its requests. The
records found are then read in the order of their places in the archives, those behind each other in one read.

Files are reached by pyarrow's file systems, below the folder that all machines share. A repeated task writes files of its
own, and what is known of files comes from the tasks that ended well, so files of lost tasks are never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.workspace import keep, partitions, shared_folder

ARCHIVE_BYTES, BLOCK_CAPTURES, READ_BYTES = 1 << 28, 2000, 1 << 24
#: Directories that a reading task has at hand, and rows that a task hands on at once.
DIRECTORIES_KEPT, ROWS = 4, 1024
LEVEL = 5
DATE = "2026-01-01T00:00:00Z"
#: Stands for a null page_id in keys; no other page may have it.
NO_PAGE = -(1 << 63)

CAPTURE = "surt string, page long, record_type string, payload_bytes long, payload_digest string, refers_to long, file string, offset long, length long"
RANGE = "file string, surt string, page long, captures long"
BLOCK = "file string, offset long, length long, surt string, page long"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def surt(url: str | None) -> str:
    """Sort key: lower-case host labels from the last to the first, then ')' and the rest; a URL without a scheme as it is."""
    scheme, sign, rest = (url or "").partition("://")
    if not sign:
        return scheme
    end = min((at for at in map(rest.find, "/?#") if at >= 0), default=len(rest))
    return ",".join(reversed(rest[:end].lower().split("."))) + ")" + rest[end:]


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page: int, name: str, url: str | None, size: int, digest: str, payload: bytes = b"", refers_to: int | None = None) -> bytes:
    """One WARC record as a gzip member. A revisit has the headers alone."""
    target = [("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~-._"))] if url is not None else []
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page}:{name}>"), ("WARC-Date", DATE), *target, ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", size)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}:{digest}>")]
    else:
        block += payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def parsed(member: bytes) -> dict:
    """The headers and the payload of a record; an error where the payload is not what its digest says."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and digest_of(payload) != digest:
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not that of the digest")
    return fields | {"payload": payload, "digest": digest}


def _page_of(urn: str | None) -> int | None:
    """The page in <urn:page:PAGE:COPY>."""
    page = None if urn is None else int(urn.split(":")[2])
    return None if page == NO_PAGE else page


class Files:
    """The files that a task writes one after the other, with the places of what it writes."""

    def __init__(self, folder: str, ending: str):
        self.folder, self.ending, self.name, self.out, self.offset = folder, ending, "", None, 0

    def write(self, data: bytes) -> tuple[str, int, int]:
        if self.out is None or self.offset >= ARCHIVE_BYTES:
            self.close()
            self.name, self.offset = f"{uuid.uuid4().hex}.{self.ending}", 0
            files, path = storage(self.folder)
            self.out = files.open_output_stream(f"{path}/{self.name}", compression=None)
        self.out.write(data)
        at = self.offset
        self.offset += len(data)
        return self.name, at, len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def make_folder(folder: str) -> str:
    files, path = storage(folder)
    files.create_dir(path, recursive=True)
    return folder


def _batches(rows: Iterator[tuple], columns: str) -> Iterator[pa.RecordBatch]:
    schema = _arrow(columns)
    while held := list(islice(rows, ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield from zip(*[c.to_pylist() for c in batch.slice(at, ROWS).columns], strict=True)


def _arrow(text: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in text.split(", "))])


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a record per row below `folder` and return the captures: CAPTURE.

    The payload is the html in UTF-8, a null one is empty. Of equal payloads of at least `least_bytes` bytes the one with the
    largest page_id is a response, among its equals that with the largest URL, and the others are revisits; smaller ones are
    responses all. A null page_id is less than all others, and a null URL has the empty key. Repeated rows are captures of
    their own; without rows there are none; other columns are not looked at.
    """
    make_folder(folder)
    rows = pages.select(F.coalesce(pages[page_id].cast("long"), F.lit(NO_PAGE)).alias("page"), pages[url].alias("url"), F.coalesce(pages[html], F.lit("")).alias("html"))
    data = F.encode("html", "UTF-8")
    small = rows.select("page", "url", F.octet_length(data).cast("long").alias("size"), F.unhex(F.sha1(data)).alias("sha1"), F.spark_partition_id().alias("part"))
    # Equal rows of one task are one row with their number, so a much repeated row is many small ones.
    small = keep(small.where(F.col("size") >= least_bytes).groupBy("page", "url", "size", "sha1", "part").agg(F.count("*").alias("n")))
    place = F.struct("page", F.col("url").isNotNull().alias("known"), "url", "part")
    shared = small.groupBy("sha1").agg(F.max(place).alias("top"), F.sum("n").alias("all")).where("all > 1")
    # Joined by the payload's hash and the hash of that: both sides are dealt out for the join, and a much shared payload can be split.
    seen = small.withColumn("h", F.xxhash64("sha1")).join(shared.withColumn("h", F.xxhash64("sha1")), ["sha1", "h"])
    revisits = seen.select("page", "url", "size", "sha1", F.col("top.page").alias("refers_to"), (F.col("n") - place.eqNullSafe(F.col("top")).cast("long")).alias("n")).where("n > 0")

    members = rows.mapInArrow(_compressed, "page long, url string, sha1 binary, size long, member binary")
    fields = F.struct("page", "url", "size", "member")
    single = members.where(F.col("size") >= least_bytes).groupBy("sha1").agg(F.max_by(fields, F.struct("page", F.col("url").isNotNull(), "url")).alias("r"))
    if least_bytes:
        single = single.unionByName(members.where(F.col("size") < least_bytes).select("sha1", fields.alias("r")))
    responses = single.select("r.page", "r.url", "r.size", "sha1", "r.member").mapInArrow(_responses(folder), CAPTURE)
    return keep(responses.unionByName(revisits.mapInArrow(_revisits(folder), CAPTURE)))


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with their records, as if each was the response of its payload."""

    def made():
        for page, url, html in _rows(batches):
            payload = html.encode()
            digest = digest_of(payload)
            yield page, url, base64.b32decode(digest), len(payload), record("response", page, digest, url, len(payload), digest, payload)

    return _batches(made(), "page long, url string, sha1 binary, size long, member binary")


def _responses(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            archives = Files(folder, "warc.gz")
            for page, url, size, sha1, member in _rows(batches):
                yield surt(url), page, "response", size, base64.b32encode(sha1).decode(), None, *archives.write(member)
            archives.close()

        return _batches(made(), CAPTURE)

    return run


def _revisits(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            archives = Files(folder, "warc.gz")
            for page, url, size, sha1, refers_to, n in _rows(batches):
                digest = base64.b32encode(sha1).decode()
                for _ in range(n):
                    member = record("revisit", page, uuid.uuid4().hex, url, size, digest, refers_to=refers_to)
                    yield surt(url), page, "revisit", size, digest, refers_to, *archives.write(member)
            archives.close()

        return _batches(made(), CAPTURE)

    return run


def write_index(captures: DataFrame, folder: str, block_captures: int = BLOCK_CAPTURES) -> DataFrame:
    """Write the sorted captures and their directories below `folder` and return the list of ranges: RANGE."""
    make_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, directory, held = Files(folder, "blocks"), [], []
        total, rows = 0, _rows(batches)
        out = []

        def end_file() -> None:
            """The directory of the file that is full, or the last one."""
            nonlocal directory, total
            if directory:
                files, path = storage(folder)
                with files.open_output_stream(f"{path}/{blocks.name}.directory", compression=None) as stream:
                    stream.write(zlib.compress(json.dumps(directory).encode()))
                out.append((blocks.name, *directory[0][:2], total))
            directory, total = [], 0

        while held := list(islice(rows, block_captures)):
            packed = zlib.compress("\n".join(map(json.dumps, held)).encode())
            if blocks.offset >= ARCHIVE_BYTES:
                end_file()
            _, offset, length = blocks.write(packed)
            directory.append([*held[0][:2], offset, length])
            total += len(held)
        end_file()
        blocks.close()
        yield from _batches(iter(out), RANGE)

    key = ["surt", "page", "file", "offset"]
    chosen = captures.select([c.split(" ")[0] for c in CAPTURE.split(", ")])
    return keep(chosen.repartitionByRange(partitions(captures.sparkSession), *key).sortWithinPartitions(*key).mapInArrow(run, RANGE))


def requests_of(pages: DataFrame, page_id: str | None = "page_id", url: str = "url") -> DataFrame:
    """Distinct requests (surt, page); without `page_id` they are for all captures of a URL, and page is null."""
    page = F.coalesce(pages[page_id].cast("long"), F.lit(NO_PAGE)) if page_id else F.lit(None).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(((surt(u), p) for p, u in _rows(batches)), "surt string, page long")

    return pages.select(page.alias("page"), pages[url].alias("url")).mapInArrow(run, "surt string, page long").distinct()


def _bounds(key: str, page: int | None) -> tuple[tuple, tuple]:
    return ((key, NO_PAGE), (key, 1 << 63)) if page is None else ((key, page), (key, page))


def _spanned(firsts: list[tuple], low: tuple, high: tuple) -> range:
    """Which stretches, given their first keys, can hold keys from low to high."""
    return range(max(0, bisect_left(firsts, low) - 1), bisect_right(firsts, high))


@lru_cache(maxsize=DIRECTORIES_KEPT)
def _directory(folder: str, name: str) -> tuple[list, list]:
    """Blocks of a range, and their first keys."""
    files, path = storage(folder)
    with files.open_input_stream(f"{path}/{name}.directory", compression=None) as stream:
        found = json.loads(zlib.decompress(stream.read()))
    return found, [tuple(x[:2]) for x in found]


def look_up(requests: DataFrame, ranges: DataFrame, folder: str) -> DataFrame:
    """The captures of distinct requests (surt, page), a null page standing for all of the URL's; those without any give no row."""
    spark = requests.sparkSession
    parts = sorted((r.surt, r.page, r.file) for r in ranges.collect())
    names, firsts = [p[2] for p in parts], [p[:2] for p in parts]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for key, page in _rows(batches):
                low, high = _bounds(key, page)
                for k in _spanned(firsts, low, high):
                    entries, begins = _directory(folder, names[k])
                    for j in _spanned(begins, low, high):
                        yield names[k], *entries[j][2:], key, page

        return _batches(found(), BLOCK)

    def captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            at, held = None, []
            for file, offset, length, key, page in _rows(batches):
                if at != (file, offset):
                    files, path = storage(folder)
                    with files.open_input_file(f"{path}/{file}") as stream:
                        lines = zlib.decompress(stream.read_at(length, offset)).decode().split("\n")
                    at, held = (file, offset), [json.loads(line) for line in lines]
                low, high = _bounds(key, page)
                first = bisect_left(held, low, key=lambda x: (x[0], x[1]))
                for k in range(first, bisect_right(held, high, key=lambda x: (x[0], x[1]))):
                    yield held[k]

        return _batches(found(), CAPTURE)

    n = partitions(spark)
    wanted = requests.repartitionByRange(n, "surt", "page").sortWithinPartitions("surt", "page").mapInArrow(blocks, BLOCK)
    return wanted.repartition(n, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(captures, CAPTURE)


def read_records(captures: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records at (file, offset, length) below `folder`: RECORD and, if wanted, the payload, null for a revisit.

    Figures are those in the records; a response whose payload is not that of its digest is an error.
    """
    columns = RECORD + ", payload binary" * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for file, offset, sizes in _stretches(_rows(batches)):
                files, path = storage(folder)
                with files.open_input_file(f"{path}/{file}") as stream:
                    data = stream.read_at(sum(sizes), offset)
                at = 0
                for size in sizes:
                    fields = parsed(data[at : at + size])
                    at += size
                    url, response = fields.get("WARC-Target-URI"), fields["WARC-Type"] == "response"
                    row = (_page_of(fields["WARC-Record-ID"]), None if url is None else unquote(url), fields["WARC-Type"], int(fields["X-Payload-Length"]), fields["digest"], _page_of(fields.get("WARC-Refers-To")))
                    yield row + ((fields["payload"] if response else None),) * with_payload

        return _batches(found(), columns)

    places = captures.select("file", "offset", "length")
    dealt = places.repartition(partitions(captures.sparkSession), "file", F.floor(F.col("offset") / READ_BYTES))
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(run, columns)


def _stretches(places: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, list[int]]]:
    """Places of records that lie behind each other, READ_BYTES or a record at most: file, first byte, sizes."""
    file, offset, sizes, end = None, 0, [], 0
    for name, at, size in places:
        if sizes and (name != file or at != end or end - offset + size > READ_BYTES):
            yield file, offset, sizes
            sizes = []
        if not sizes:
            file, offset = name, at
        sizes.append(size)
        end = at + size
    if sizes:
        yield file, offset, sizes


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages written, looked up in the index and read back: RECORD, one row for each row of `pages`."""
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    captures = write_archives(pages, folder, least_bytes)
    found = look_up(requests_of(pages), write_index(captures, folder), folder)
    return read_records(found, folder)
