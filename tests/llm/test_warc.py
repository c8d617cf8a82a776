"""ZIP directories against the standard library, archives against what was written."""

from __future__ import annotations

import base64
import hashlib
import io
import zipfile
import zlib
from collections import Counter
from pathlib import Path

import pytest

from support import docs  # noqa: F401
from tripmill.llm import warc_archive as warc
from tripmill.session import scratch_path

SCHEMA = "page_id long, url string, html string, id string, path string, first string, sha1 string, size int"


class Held:
    """Bytes that are read like a remote file, with a count of what was read."""

    def __init__(self, data: bytes) -> None:
        self.data, self.got = data, 0

    def size(self) -> int:
        return len(self.data)

    def read_at(self, n: int, at: int) -> bytes:
        assert 0 <= at and at + n <= len(self.data)
        self.got += n
        return self.data[at : at + n]


def zipped(parts, comment=b"", prefix=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data, method in parts:
            z.writestr(zipfile.ZipInfo(name), data, method)
        z.comment = comment
    return prefix + out.getvalue()


PARTS = [("archive/a.warc", b"x" * 500, 0), ("größe.txt", b"y" * 300, 8), ("indexes/i.cdx", b"", 0)]


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("comment", [b"", b"a comment " * 900])
@pytest.mark.parametrize("prefix", [b"", b"#!/bin/sh\n" * 7])
def test_directory_equals_the_standard_library(monkeypatch, wide, comment, prefix):
    if wide:  # the writer then needs ZIP64 for everything
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = zipped(PARTS, comment, prefix)
    assert (warc.END64 in data) == wide
    found = warc.members(Held(data), "*")
    want = zipfile.ZipFile(io.BytesIO(data)).infolist()
    assert [(m.name, m.size, m.method) for m in found] == [(i.filename, i.compress_size, i.compress_type) for i in want]
    assert data[found[0].offset :][:500] == b"x" * 500
    assert zlib.decompress(data[found[1].offset :][: found[1].size], -15) == b"y" * 300
    assert [m.name for m in warc.members(Held(data), "indexes/*")] == ["indexes/i.cdx"]


def test_end_record_within_a_comment():
    data = zipped(PARTS, b"PK\x05\x06 is not an end" * 9)
    assert [m.name for m in warc.members(Held(data), "*")] == [n for n, _, _ in PARTS]


def test_more_members_than_16_bits_and_damage():
    data = zipped([(f"m{k}", b"", 0) for k in range(66_000)])
    assert len(warc.members(Held(data), "*")) == 66_000
    held = Held(data)
    assert [m.name for m in warc.members(held, "m65999")] == ["m65999"]
    for broken in (b"", b"no archive at all", data[:-1], data[:-30] + data[-22:]):
        with pytest.raises(ValueError):
            warc.members(Held(broken), "*")
    with pytest.raises(ValueError, match="compressed"):
        [warc._stored_only(m) for m in warc.members(Held(zipped(PARTS)), "*")]


def b32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def brute(rows, least=0):
    out, first = Counter(), {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))
    for page, url, html in order:
        html = html or ""
        size = len(html.encode())
        again = html in first and size >= least
        out[page, size, b32(html), "revisit" if again else "response", first[html] if again else None] += 1
        first.setdefault(html, page)
    return out


def result(df):
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


ROWS = [
    (1, "http://a.example/x?y=1", "<p>one</p>"), (2, "http://a.example/é \r\nWARC-Type: no", "<p>one</p>"), (3, None, None), (4, "", ""),
    (None, "http://a.example/", "<p>nobody</p>"), (None, "http://b.example/", "<p>nobody</p>"), (9, "u", "é中\U0001f600\r\n\r\nWARC/1.1\r\n\x00"),
    (5, "u", "same row"), (5, "u", "same row"), (5, "u", "same row"), (5, "v", "same row"), (6, None, "same row"), (-7, "u", "late but small"),
    (8, "u", "late but small"), (10, "u", "x" * 3_000_000), (11, "u", "x" * 3_000_000),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", "p", "f", "s", 1) for r in rows], SCHEMA).repartition(3)


def test_pages_come_back(spark):
    rows = ROWS + [(100 + k, "u", f"<p>{k % 40}</p>") for k in range(120)]
    assert result(warc.archived(frame(spark, rows), scratch_path(spark, "t"))) == brute(rows)


def test_large_tables_of_copies_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(warc, "MAX_BROADCAST_BYTES", 0)
    rows = ROWS + [(1000 - k, "u", "hot") for k in range(100)] + [(2000 + k, "u", f"{k % 7}") for k in range(30)]
    assert result(warc.archived(frame(spark, rows), scratch_path(spark, "t"))) == brute(rows)


def test_small_payloads_are_all_responses(spark):
    path = scratch_path(spark, "t")
    manifest = warc.write_archives(frame(spark, ROWS), path, min_revisit_bytes=11, archive_bytes=300)
    assert manifest.count() > 3
    assert sum(r.n_records for r in manifest.collect()) == len(ROWS)
    read = warc.read_archives(manifest).collect()
    got = Counter((r.page_id and int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in read)
    assert got == brute(ROWS, 11)
    texts = Counter(r.payload.decode() for r in read if r.record_type == "response")
    assert texts["<p>one</p>"] == 2 and texts[""] == 2 and texts["x" * 3_000_000] == 1
    urls = {int(r.page_id): r.url for r in read if r.page_id}
    assert urls[1] == "http://a.example/x?y=1" and urls[3] is None and urls[4] == ""
    assert urls[2] == "http://a.example/é%20%0D%0AWARC-Type:%20no"


def test_each_member_is_read_by_others_too(spark):
    """The archives are plain ZIP files of plain gzip members, and the index names their places."""
    manifest = warc.write_archives(frame(spark, ROWS), scratch_path(spark, "t"))
    for row in manifest.collect():
        with zipfile.ZipFile(row.path) as z:
            assert z.testzip() is None and z.namelist() == [warc.DATA, warc.INDEX]
            data = z.read(warc.DATA)
            ranges = [tuple(map(int, x.split())) for x in z.read(warc.INDEX).decode().splitlines()]
        assert len(ranges) == row.n_records and sum(n for _, n in ranges) == len(data)
        for at, n in ranges:
            assert zlib.decompress(data[at : at + n], 31).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_members_without_an_index_are_walked_through(spark, tmp_path):
    records = [warc.packed_record(str(k), "u", b"page %d" % k * (k * 9000), warc._digest(b"page %d" % k * (k * 9000)), None, "n", "d") for k in range(40)]
    parts = [("archive/a.warc.gz", b"".join(records[:25]), 0), ("archive/b.warc", b"".join(zlib.decompress(r, 31) for r in records[25:]), 0)]
    note = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    Path(tmp_path / "a.zip").write_bytes(zipped([*parts, ("archive/c.warc", note, 0)]))
    paths = spark.createDataFrame([(str(tmp_path / "a.zip"),)], "path string")
    got = warc.read_archives(paths).collect()
    assert {int(r.page_id): bytes(r.payload) for r in got} == {k: b"page %d" % k * (k * 9000) for k in range(40)}
    assert len(got) == 40


def test_damaged_payloads_are_an_error(spark, tmp_path):
    Path(tmp_path / "a.zip").write_bytes(zipped([("archive/a.warc.gz", warc.packed_record("1", "u", b"x", warc._digest(b"y"), None, "n", "d"), 0)]))
    with pytest.raises(Exception, match="is damaged"):
        warc.read_archives(spark.createDataFrame([(str(tmp_path / "a.zip"),)], "path string")).collect()


def test_no_pages(spark):
    assert warc.archived(frame(spark, ROWS).limit(0), scratch_path(spark, "t")).collect() == []
