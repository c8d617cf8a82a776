"""Web archives (WARC 1.1) packaged in ZIP files, written by tasks and read back by ranges.

An archive is a ZIP file with two stored members: ``archive/data.warc.gz``, in which each record is
a gzip member of its own, and ``indexes/index.cdx``, a line with offset and length for each record.

*Writing.* A payload that occurs before is a revisit record. Payloads are compared by SHA-1 and length;
first occurrences come from partial minima, and only payloads with copies are looked up again. A task
names its files by its attempt, and the manifest (Parquet) names the files of attempts that count.

*Reading.* A task finds the end records of the ZIP file, those of ZIP64 included, parses its central directory,
and finds where the bytes of the stored members begin. Index lines become ranges, which Spark deals
out in order of file and place; tasks read neighbouring ranges at once. Nothing is extracted. A member
without an index is walked through once for its ranges.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from fnmatch import fnmatch
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import MAX_BROADCAST_BYTES, in_slices, skewed_join, stored

#: A file is closed once it holds so many compressed bytes.
ARCHIVE_BYTES = 256 << 20
#: Neighbouring records are read together up to so many bytes.
READ_BYTES = 4 << 20
MIN_REVISIT_BYTES = 0
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Fixed values of the ZIP format.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF


class Member(NamedTuple):
    """A member of a ZIP file; ``offset`` is where its bytes begin in the file."""

    name: str
    offset: int
    size: int
    method: int


def _opened(uri: str):
    system, path = pyarrow.fs.FileSystem.from_uri(uri)
    return system, path


def members(file, *patterns: str) -> list[Member]:
    """Members of an open ZIP file whose names match a pattern, from its central directory.

    ``file`` has size() and read_at(bytes, offset). Bytes before the archive and a comment behind it are
    allowed; a damaged directory or an encrypted member that matches is an error.
    """
    size = file.size()
    tail_at = max(0, size - (22 + FULL16 + 20))
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(END)
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP file: no end record")
    disk, _, _, count, length, start = struct.unpack_from("<HHHHII", tail, at + 4)
    end = tail_at + at
    if at >= 20 and tail[at - 20 : at - 16] == LOCATOR64:
        (where,) = struct.unpack_from("<Q", tail, at - 12)
        record = file.read_at(56, where) if where + 56 <= size else b""
        if record[:4] != END64:
            # bytes before the archive move the record; it is 56 bytes long unless it is extended
            where = end - 20 - 56
            record = file.read_at(56, where)
        if record[:4] != END64:
            raise ValueError("ZIP64 end record is missing")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
        end = where
    elif disk not in (0, FULL16):
        raise ValueError("ZIP file of several disks")
    moved = end - length - start
    if moved < 0:
        raise ValueError("central directory is damaged")
    directory = file.read_at(length, start + moved)
    found, at = [], 0
    for _ in range(count):
        if directory[at : at + 4] != ENTRY:
            raise ValueError("central directory is damaged")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain = struct.unpack_from("<II", directory, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, at + 28)
        (local,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                plain = next(wide) if plain == FULL32 else plain
                packed = next(wide) if packed == FULL32 else packed
                local = next(wide) if local == FULL32 else local
            extra = extra[4 + n :]
        at += 46 + n_name + n_extra + n_comment
        if not any(fnmatch(name, p) for p in patterns):
            continue
        head = file.read_at(30, local + moved)
        if flags & 1 or head[:4] != LOCAL:
            raise ValueError(f"member {name} is encrypted or damaged")
        n_name_here, n_extra_here = struct.unpack_from("<HH", head, 26)
        found.append(Member(name, local + moved + 30 + n_name_here + n_extra_here, packed, method))
    return found


def _stored_only(member: Member) -> Member:
    if member.method != 0:
        raise ValueError(f"member {member.name} is compressed; ranges can be read of stored members only")
    return member


class _Window:
    """A file read from front to back within limits, by blocks."""

    def __init__(self, file, at: int, end: int) -> None:
        self.file, self.at, self.end, self.held = file, at, end, b""

    def more(self) -> bool:
        step = min(1 << 20, self.end - self.at - len(self.held))
        if step > 0:
            self.held += self.file.read_at(step, self.at + len(self.held))
        return step > 0

    def drop(self, n: int) -> None:
        self.at, self.held = self.at + n, self.held[n:]


def _lines(file, member: Member) -> Iterator[str]:
    window = _Window(file, member.offset, member.offset + member.size)
    while True:
        cut = window.held.rfind(b"\n") + 1
        yield from window.held[:cut].decode().splitlines()
        window.drop(cut)
        if not window.more():
            yield from window.held.decode().splitlines()
            return


def walk(file, member: Member) -> Iterator[tuple[int, int]]:
    """Ranges of the records of a member, without an index."""
    window = _Window(file, member.offset, member.offset + member.size)
    while window.held or window.more():
        begin = window.at
        if member.name.endswith(".gz"):
            unpacker, left = zlib.decompressobj(31), True
            while not unpacker.eof and left:
                unpacker.decompress(window.held)
                window.drop(len(window.held) - len(unpacker.unused_data))
                left = unpacker.eof or window.more()
            if not unpacker.eof:
                raise ValueError(f"member {member.name} ends within a record")
        else:
            while b"\r\n\r\n" not in window.held and window.more():
                pass
            head, gap, _ = window.held.partition(b"\r\n\r\n")
            length = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", head)
            if not gap or not length:
                raise ValueError(f"member {member.name} holds no WARC record at byte {begin}")
            left = len(head) + 4 + int(length[1]) + 4
            while left > len(window.held):
                left -= len(window.held)
                window.drop(len(window.held))
                if not window.more():
                    raise ValueError(f"member {member.name} ends within a record")
            window.drop(left)
        yield begin, window.at - begin


def _fields(head: bytes) -> dict[str, str]:
    """Named fields, by lower-case name; a line that begins with white space goes on."""
    text = re.sub(r"\r\n[ \t]+", " ", head.decode())
    pairs = [line.partition(":") for line in text.split("\r\n")[1:]]
    return {name.strip().lower(): value.strip(" \t") for name, _, value in pairs}


def record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of one record, packed or plain."""
    if data[:2] == b"\x1f\x8b":
        data = zlib.decompress(data, 31)
    if data[:5] != b"WARC/":
        raise ValueError("no WARC record at this place")
    head, gap, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    length = int(fields["content-length"])
    if not gap or len(rest) < length:
        raise ValueError("WARC record is cut off")
    return fields, rest[:length]


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: str | None, digest: str, more: str = "") -> str:
    return f"<urn:page:{'' if page_id is None else 'p' + quote(page_id, safe='')}:{digest}{more}>"


def _page_of(record_id: str) -> str | None:
    page = re.fullmatch(r"<urn:page:(?:p([^:]*))?:.*>", record_id)
    return None if page is None or page[1] is None else unquote(page[1])


def packed_record(
    page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: tuple[str | None] | None, name: str, date: str
) -> bytes:
    """One record as a gzip member; ``refers_to`` holds the response's page of a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest, f":{name}" if refers_to else "")),
        ("WARC-Date", date),
        *([("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))] if url is not None else []),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to[0], digest))] if refers_to else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def first_copies(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html as strings, id as the order) with sha1 and first: null for a response.

    ``first`` is a struct of the response's page_id for revisits. Of equal payloads the smallest page_id
    comes first (null last), then the smallest url; of rows equal in all, one is the response.
    """
    each = pages.withColumns({"sha1": F.sha1("html"), "size": F.octet_length("html")})
    order = F.struct(F.col("id").isNull(), "id", F.col("url").isNull(), "url", "page_id")
    # a repeated row is counted before the copies of its payload meet
    rows = each.where(F.col("size") >= min_revisit_bytes).groupBy("sha1", "size", order.alias("at")).agg(F.count(F.lit(1)).alias("n"))
    found = rows.groupBy("sha1", "size").agg(F.min("at").alias("least"), F.min_by("n", "at").alias("n_least"), F.sum("n").alias("n"))
    copies = stored(found.where("n > 1"), "warc-copies")
    count = copies.agg(F.count(F.lit(1)), F.sum("n"), F.max("n_least")).first()
    if not count[0]:
        return each.withColumn("first", F.lit(None).cast("struct<page_id:string>"))
    on = ["sha1", "size"]
    if count[0] * 256 <= MAX_BROADCAST_BYTES:
        told = each.join(F.broadcast(copies.drop("n")), on, "left")
    else:
        # keys without copies hold one row each
        told = skewed_join(each, copies, on, "n", count[1], "left")
    least = order.eqNullSafe(F.col("least"))
    revisit = F.when(F.col("least").isNotNull() & ~least, F.struct(F.col("least.page_id").alias("page_id")))
    plain = told.withColumn("first", revisit)
    if count[2] > 1:
        # rows equal in all: one response, the others revisit it
        again = plain.where(least & (F.col("n_least") > 1)).groupBy("page_id", "url", "id", *on)
        again = again.agg(F.first("html").alias("html"), F.first("n_least").alias("n_least"))
        again = again.select(
            "*", F.explode(F.sequence(F.lit(1).cast("long"), "n_least")).alias("k")
        ).withColumn("first", F.when(F.col("k") > 1, F.struct("page_id")))
        columns = ["page_id", "url", "id", "html", *on, "first"]
        plain = plain.where(~(least & (F.col("n_least") > 1)) | F.col("least").isNull()).select(*columns).unionByName(again.select(*columns))
    return plain


def write_archives(
    pages: DataFrame,
    path: str,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives below ``path``; return the manifest.

    The manifest (path, n_records, n_bytes) is stored in ``path``/manifest. The payload is the html in
    UTF-8, null as empty; a null url has no WARC-Target-URI, white space and control characters in a url
    are percent-encoded. Payloads of at least ``min_revisit_bytes`` that occur before are revisits. Repeated
    rows are records of their own. Other columns are not read. No pages give an empty manifest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _opened(path)
        system.create_dir(folder, recursive=True)
        attempt = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        done, opened = [], None

        def close() -> None:
            archive, member, out, uri, ranges = opened
            member.close()
            archive.writestr(zipfile.ZipInfo(INDEX), "".join(f"{at} {n}\n" for at, n in ranges))
            archive.close()
            size = out.tell()
            out.close()
            done.append((uri, len(ranges), size))

        for batch in in_slices(batches, 64):
            for row in batch.to_pylist():
                if opened is None:
                    name = f"pages-{attempt}-{len(done):04d}.zip"
                    out = system.open_output_stream(f"{folder}/{name}")
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
                    opened = (archive, archive.open(zipfile.ZipInfo(DATA), "w", force_zip64=True), out, f"{path}/{name}", [])
                    at = 0
                digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                first = row["first"]
                ranges = opened[4]
                packed = packed_record(
                    row["page_id"], row["url"], row["html"].encode(), digest, first and (first["page_id"],), f"{attempt}-{len(done)}-{len(ranges)}", date
                )
                opened[1].write(packed)
                ranges.append((at, len(packed)))
                at += len(packed)
                if at >= archive_bytes:
                    close()
                    opened = None
        if opened is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "n_records", "n_bytes"]
        )

    narrow = pages.select(
        F.col("page_id").alias("id"),
        F.col("page_id").cast("string").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    told = first_copies(narrow, min_revisit_bytes).select("page_id", "url", "html", "sha1", "first")
    manifest = f"{path}/manifest"
    told.mapInArrow(run, "path string, n_records long, n_bytes long").write.parquet(manifest)
    return pages.sparkSession.read.schema("path string, n_records long, n_bytes long").parquet(manifest)


_RANGES = "path string, offset long, length long"
_RECORDS = "page_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def record_ranges(archives: DataFrame, data: str = "archive/*", indexes: str = "indexes/*.cdx") -> DataFrame:
    """(path, offset, length) of each record in the ZIP files of column ``path``, by their own indexes.

    Members are named by patterns. An index belongs to a file's only data member; a file without
    an index, or with several data members, is walked through. Compressed members are an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple[int, int]], path: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([path] * len(rows)), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())],
                ["path", "offset", "length"],
            )

        def places(file) -> Iterator[tuple[int, int]]:
            every = members(file, data, indexes)
            held = [_stored_only(m) for m in every if fnmatch(m.name, data)]
            index = [_stored_only(m) for m in every if fnmatch(m.name, indexes)]
            if index and len(held) == 1:
                for line in (x for m in index for x in _lines(file, m)):
                    at, length = map(int, line.split())
                    if at < 0 or length <= 0 or at + length > held[0].size:
                        raise ValueError("an index points outside its member")
                    yield held[0].offset + at, length
            else:
                for member in held:
                    yield from walk(file, member)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, name = _opened(path)
                with system.open_input_file(name) as file:
                    rows = []
                    for place in places(file):
                        rows.append(place)
                        if len(rows) >= 1 << 14:
                            yield out(rows, path)
                            rows = []
                    yield out(rows, path)

    return archives.select("path").mapInArrow(run, _RANGES)


def read_archives(archives: DataFrame, payloads: bool = True, **patterns: str) -> DataFrame:
    """A row for each response or revisit record in the ZIP files of column ``path``.

    page_id and refers_to (the response's page of a revisit) are strings, null where the page had none.
    payload_digest is the bare SHA-1 in base32 and payload_bytes the length of the full payload; both are
    computed from a response's payload, which must have the digest its record names, and taken from the
    fields of a revisit. payload is null for revisits, and for all without ``payloads``.
    """

    def parsed(data: bytes) -> tuple | None:
        fields, block = record(data)
        kind = fields.get("warc-type")
        if kind not in ("response", "revisit"):
            return None
        http, _, payload = block.partition(b"\r\n\r\n")
        named = fields.get("warc-payload-digest", "").partition(":")[2]
        if kind == "response":
            digest, size = _digest(payload), len(payload)
            if named and named != digest:
                raise ValueError(f"payload of {fields.get('warc-record-id')} is damaged")
        else:
            digest, size, payload = named, int(_fields(http)["content-length"]), None
        page, refers = (_page_of(fields.get(f, "")) for f in ("warc-record-id", "warc-refers-to"))
        return page, fields.get("warc-target-uri"), kind, refers, digest, size, payload if payloads else None

    types = [pa.string()] * 5 + [pa.int64(), pa.binary()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        names = [f.split()[0] for f in _RECORDS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_path = file = None
        for batch in batches:
            ranges = list(zip(*[batch.column(k).to_pylist() for k in range(3)]))
            at = 0
            while at < len(ranges):
                path, begin, length = ranges[at]
                end, last = begin + length, at + 1
                # neighbours of the same file, as long as the read stays small
                while last < len(ranges) and ranges[last][0] == path and ranges[last][1] == end and end - begin + ranges[last][2] <= READ_BYTES:
                    end += ranges[last][2]
                    last += 1
                if path != open_path:
                    if file is not None:
                        file.close()
                    system, name = _opened(path)
                    open_path, file = path, system.open_input_file(name)
                block = memoryview(file.read_at(end - begin, begin))
                rows = [parsed(bytes(block[o - begin : o - begin + n])) for _, o, n in ranges[at:last]]
                yield out([r for r in rows if r is not None])
                at = last
        if file is not None:
            file.close()

    ranges = stored(record_ranges(archives, **patterns), "warc-ranges")
    return ranges.repartitionByRange("path", "offset").sortWithinPartitions("path", "offset").mapInArrow(run, _RECORDS)


def archived(pages: DataFrame, path: str) -> DataFrame:
    """``pages`` written to archives and read back, one row a page (see ``read_archives``)."""
    manifest = write_archives(pages, path)
    kind = pages.schema["page_id"].dataType

    def back(name: str) -> Column:
        return F.col(name).cast(kind).alias(name)

    return read_archives(manifest, payloads=False).select(back("page_id"), "payload_bytes", "payload_digest", "record_type", back("refers_to"))
