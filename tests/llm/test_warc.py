"""Archives are written, found by their index and read back."""

import random
import zlib
from collections import Counter

import duckdb
import pytest

from ledgerline.llm import warc
from ledgerline.llm.expected import RECORDS

SCHEMA = "page_id long, url string, html string, surt string, member int"
ODD = [None, "", "x", "http://", "://", "http://A.b.Com/x?q=1#f", "http://a.b.com", "http://ü.de/ä b\r\nX: 1", "ftp://a.b.com/%41", "http://a,b/)"]


@pytest.fixture(scope="module")
def pages():
    random.seed(2)
    rows = [(i, ODD[i % len(ODD)], random.choice([None, "", "é", "a" * 3000, f"<p>{i}</p>"]), "s", 1) for i in range(60)]
    rows += [(100 + i, f"http://h{random.randint(0, 9)}.example.com/{random.randint(0, 40)}", random.choice(["same", f"{i}\r\n\r\n{i}" * i]), None, 2) for i in range(200)]
    rows += [(500 + i, "http://hot.example.com/", "hot" if i % 2 else f"hot {i}", None, 2) for i in range(300)]
    return rows + [rows[70]] * 3 + [(7, "http://b/", "twice", "", 0), (7, "http://b/", "twice", "", 0), (7, "http://c/", "twice", "", 0), (None, "http://d/", "no id", "", 0), (None, None, None, "", 0)]


def test_records_against_sql(spark, pages, tmp_path):
    table = spark.createDataFrame(pages, SCHEMA)
    got = warc.archived(table.repartition(4)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    table.coalesce(1).write.parquet(str(tmp_path / "pages"))
    with duckdb.connect() as connection:
        connection.sql(f"create view pages as from '{tmp_path}/pages/*.parquet'")
        wanted = connection.sql(RECORDS).fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))


def test_payloads_and_urls_come_back(spark, pages, tmp_path):
    table = spark.createDataFrame(pages, SCHEMA)
    folder = str(tmp_path / "a")
    captures = warc.write_archives(table, folder)
    got = warc.read_records(captures, folder, with_payload=True).collect()
    html = {(p, u, (h or "").encode()) for p, u, h, *_ in pages}
    assert Counter((r.page_id, r.url) for r in got) == Counter((p, u) for p, u, *_ in pages)
    assert all((r.page_id, r.url, bytes(r.payload)) in html for r in got if r.record_type == "response")
    responses = [bytes(r.payload) for r in got if r.record_type == "response"]
    assert len(responses) == len(set(responses)) == len({h for _, _, h in html})


def test_small_payloads_are_responses(spark, pages, tmp_path):
    folder = str(tmp_path / "a")
    captures = warc.write_archives(spark.createDataFrame(pages, SCHEMA), folder, least_bytes=4).collect()
    assert len(captures) == len(pages)
    assert all(c.record_type == "response" for c in captures if c.payload_bytes < 4)
    assert {c.record_type for c in captures if c.payload_digest == warc.digest_of(b"same")} == {"response", "revisit"}


def test_archives_are_gzip_members_behind_each_other(spark, pages, tmp_path):
    folder = tmp_path / "a"
    captures = warc.write_archives(spark.createDataFrame(pages, SCHEMA), str(folder)).collect()
    records = 0
    for path in folder.glob("*.warc.gz"):
        data = path.read_bytes()
        while data:
            unpacker = zlib.decompressobj(31)
            assert unpacker.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: ")
            data, records = unpacker.unused_data, records + 1
    assert records == len(captures) == len(pages)


def test_index_of_small_blocks(spark, pages, tmp_path):
    """A URL's captures fill many blocks and ranges; requests for one page, for a URL, and for neither."""
    table, folder = spark.createDataFrame(pages, SCHEMA), str(tmp_path / "a")
    captures = warc.write_archives(table, folder)
    ranges = warc.write_index(captures, folder, block_captures=7)
    assert sum(r.captures for r in ranges.collect()) == len(pages)
    blocks = warc.look_up(warc.requests_of(table), ranges, folder)
    key = lambda c: (c.file, c.offset)
    assert sorted(map(key, blocks.collect())) == sorted(map(key, captures.collect()))
    urls = spark.createDataFrame([("http://hot.example.com/",), ("http://h3.example.com/3",), ("http://nowhere/",), (None,), ("zzz",)], "url string")
    found = Counter(c.surt for c in warc.look_up(warc.requests_of(urls, page_id=None), ranges, folder).collect())
    wanted = Counter(warc.surt(u) for _, u, *_ in pages)
    assert found == +Counter({k: wanted[k] for k in map(warc.surt, ["http://hot.example.com/", "http://h3.example.com/3", "http://nowhere/", None, "zzz"])})


def test_a_full_file_is_followed_by_another(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 10)
    files = warc.Files(str(tmp_path), "x")
    places = [files.write(bytes([65 + k]) * 6) for k in range(5)]
    files.close()
    assert [p[1:] for p in places] == [(0, 6), (6, 6), (0, 6), (6, 6), (0, 6)]
    assert [(tmp_path / name).read_bytes()[at : at + size] for name, at, size in places] == [bytes([65 + k]) * 6 for k in range(5)]


def test_stretches_join_neighbours(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 10)
    places = [("a", 0, 4), ("a", 4, 4), ("a", 8, 4), ("a", 20, 30), ("b", 50, 1)]
    assert list(warc._stretches(iter(places))) == [("a", 0, [4, 4]), ("a", 8, [4]), ("a", 20, [30]), ("b", 50, [1])]


def test_a_changed_payload_is_an_error():
    member = warc.record("response", 1, "x", "http://a/", 3, warc.digest_of(b"abd"), b"abc")
    with pytest.raises(ValueError):
        warc.parsed(member)


def test_keys():
    assert [warc.surt(u) for u in (None, "x", "http://A.b.Com/X?y", "http://a.b?c", "http://")] == ["", "x", "com,b,a)/X?y", "b,a)?c", ")"]


def test_no_pages(spark):
    assert warc.archived(spark.createDataFrame([], SCHEMA)).collect() == []
