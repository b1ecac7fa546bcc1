"""WARC records in ZIP packages: written one package a task, read back by ranges.

A package holds stored members: the records, each its own gzip member, and an index with
every record's place. The reader parses the central directory (ZIP64 too) and reads records
by range from where the stored member lies; nothing is extracted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagegrid.runtime import qualified, scratch_path, scratch_table

#: Folders of a package, and the names that are written here.
ARCHIVES, INDEXES = "archive/", "indexes/"
RECORDS, INDEX = ARCHIVES + "data.warc.gz", INDEXES + "index.jsonl"
#: Payloads of about this size are handed on together, and archives without an index are read by pieces of it.
PIECE = 4 << 20
#: Numbers by which pages whose payload comes again are told from the rest before any is shuffled.
MARKS = 1 << 20
#: A package ends after a record that takes it past this size.
PACKAGE_BYTES = 256 << 20
DATE = "2000-01-01T00:00:00Z"  # records are the same in each run
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Signatures and sentinels of the ZIP format.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass
class Member:
    name: str
    method: int
    crc: int
    stored: int
    size: int
    header: int


class ZipPackage:
    """Members of a ZIP file that is read by ranges; read(offset, length) gives its bytes."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read, self.size = read, size
        self.members = {m.name: m for m in self._directory()}

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 22 - FULL16)
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(END, 0, len(tail) - 18)
        while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
            at = tail.rfind(END, 0, at)  # the signature within a comment
        if at < 0:
            raise ValueError("no end of central directory")
        disk, _, _, count, size, start = struct.unpack_from("<4H2I", tail, at + 4)
        if disk not in (0, FULL16):
            raise ValueError("the package is split over several files")
        end = tail_at + at
        if FULL16 in (disk, count) or FULL32 in (size, start):
            locator = self.read(end - 20, 20)
            if locator[:4] != LOCATOR64:
                raise ValueError("no ZIP64 locator")
            record = self.read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if record[:4] != END64:
                raise ValueError("no ZIP64 end of central directory")
            count, size, start = struct.unpack_from("<3Q", record, 32)
        data, at = self.read(start, size), 0
        for _ in range(count):
            if data[at : at + 4] != ENTRY:
                raise ValueError("broken central directory")
            flags, method, _, _, crc, stored, full = struct.unpack_from("<4H3I", data, at + 8)
            name_n, extra_n, comment_n, first_disk = struct.unpack_from("<4H", data, at + 28)
            header = struct.unpack_from("<I", data, at + 42)[0]
            raw = data[at + 46 : at + 46 + name_n]
            extra = data[at + 46 + name_n : at + 46 + name_n + extra_n]
            name = raw.decode("utf-8" if flags & 0x800 else "cp437")
            wide = self._zip64(extra)
            full, stored, header = (struct.unpack("<Q", wide.pop(0))[0] if x == FULL32 else x for x in (full, stored, header))
            yield Member(name, method, crc, stored, full, header)
            at += 46 + name_n + extra_n + comment_n

    @staticmethod
    def _zip64(extra: bytes) -> list[bytes]:
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<2H", extra, at)
            if kind == 1:
                body = extra[at + 4 : at + 4 + n]
                return [body[i : i + 8] for i in range(0, len(body) - 7, 8)]
            at += 4 + n
        return []

    def place(self, name: str) -> tuple[int, int]:
        """Offset and length of a stored member's bytes in the package."""
        m = self.members[name]
        if m.method:
            raise ValueError(f"{name} is compressed; only stored members are read by range")
        head = self.read(m.header, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        name_n, extra_n = struct.unpack_from("<2H", head, 26)
        return m.header + 30 + name_n + extra_n, m.size


def _headers(lines: list[tuple[str, object]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None).encode()


def record(key: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """A WARC record, gzipped: a revisit if it refers to another record's key, else a response."""
    http = b"HTTP/1.1 200 OK\r\n" + _headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]) + b"\r\n"
    body = http + (payload if refers_to is None else b"")
    head = b"WARC/1.1\r\n" + _headers(
        [
            ("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:page:{key}>" if key is not None else "<urn:page>"),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A") if url else None),
            ("WARC-Payload-Digest", "sha1:" + digest(payload)),
            ("WARC-Profile", PROFILE if refers_to is not None else None),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>" if refers_to is not None else None),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(body)),
        ]
    )
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(head + b"\r\n" + body + b"\r\n\r\n") + z.flush()


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """The headers of a gzipped record, those of its HTTP message, and the payload."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("no WARC record")
    own = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    body = rest[: int(own["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    return own, {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode().split("\r\n")[1:])}, payload


class _Stream:
    """What zipfile needs of a stream that cannot seek."""

    def __init__(self, stream):
        self.stream, self.n = stream, 0

    def write(self, data) -> int:
        self.stream.write(data)
        self.n += len(data)
        return len(data)

    def flush(self) -> None:
        pass


class _PackageWriter:
    def __init__(self, uri: str):
        fs, path = FileSystem.from_uri(uri)
        self.raw = fs.open_output_stream(path)
        self.stream = _Stream(self.raw)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(RECORDS, (2000, 1, 1, 0, 0, 0)), "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, data: bytes) -> None:
        self.member.write(data)
        self.index.append((self.at, len(data)))
        self.at += len(data)

    def close(self) -> int:
        self.member.close()
        lines = "".join(json.dumps({"filename": RECORDS.removeprefix(ARCHIVES), "offset": a, "length": n}) + "\n" for a, n in self.index)
        self.zip.writestr(zipfile.ZipInfo(INDEX, (2000, 1, 1, 0, 0, 0)), lines)
        self.zip.close()
        self.raw.close()
        return self.stream.n


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write a record per page; the packages' (path, size).

    Of equal payloads of at least `least` bytes the smallest id's record is the response,
    and the others revisit it; a record whose id equals the smallest is a response too
    (repeated rows), as is any with a null id. A null page is an empty payload.
    Each attempt of a task writes files of its own name; only those listed count.
    """
    folder = qualified(pages.sparkSession, folder)
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("string").alias("key"), F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.concat(F.sha2("payload", 256), F.sha1("payload"))))
    seen = rows.groupBy("sha").agg(F.min("id").cast("string").alias("first"), F.count("*").alias("times"))
    seen = scratch_table(seen.where("times > 1").select("sha", "first"), "payloads")
    # Only pages whose payload may have come again are shuffled: those whose hash falls in
    # one of at most MARKS numbers, so what is broadcast has a bound at any size.
    mark = F.pmod(F.xxhash64("sha"), F.lit(MARKS)).alias("mark")
    marks = F.broadcast(seen.select(mark).distinct())
    rows = rows.withColumn("mark", F.pmod(F.xxhash64("sha"), F.lit(MARKS)))
    alone = rows.join(marks, "mark", "left_anti").withColumn("first", F.lit(None).cast("string"))
    shared = rows.join(marks, "mark", "left_semi").join(seen.hint("merge"), "sha", "left")
    joined = alone.unionByName(shared)
    again = (F.octet_length("payload") >= least) & (F.col("key") != F.col("first"))
    joined = joined.select("key", "url", "payload", F.when(again, F.col("first")).alias("refers_to"))

    def run(batches):
        task, n, writer, done = TaskContext.get(), 0, None, []
        for batch in batches:
            for key, url, data, refers in zip(*(c for c in batch.columns)):
                if writer is None:
                    uri = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}-{n}.zip"
                    writer, n = _PackageWriter(uri), n + 1
                writer.add(record(key.as_py(), url.as_py(), data.as_py(), refers.as_py()))
                if writer.at > package_bytes:
                    done.append((uri, writer.close()))
                    writer = None
        if writer:
            done.append((uri, writer.close()))
        if done:
            paths, sizes = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(sizes, pa.int64())], ["path", "size"])

    fs, path = FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    return scratch_table(joined.mapInArrow(run, "path string, size long"), "manifest")


def _opened(path: str, size: int | None = None):
    fs, at = FileSystem.from_uri(path)
    f = fs.open_input_file(at)
    return f, ZipPackage(lambda offset, n: f.read_at(n, offset), size if size is not None else f.size())


def scanned(read: Callable[[int, int], bytes], start: int, size: int) -> Iterator[tuple[int, int]]:
    """Offset and length of each gzip member in a range, found by reading them through."""
    at, begin, z, left = 0, 0, zlib.decompressobj(31), b""
    while at < size or left:
        data = left or read(start + at, min(PIECE, size - at))
        at += 0 if left else len(data)
        while data and not z.eof:
            z.decompress(data, PIECE)  # its bytes are not kept
            data = z.unconsumed_tail
        left = z.unused_data if z.eof else b""
        if z.eof:
            end = at - len(left)
            yield start + begin, end - begin
            begin, z = end, zlib.decompressobj(31)
    if begin != size:
        raise ValueError("a record ends too early")


def package_places(package: ZipPackage) -> Iterator[tuple[int, int]]:
    """Offset and length of each record of all stored archive members, by the package's indexes.

    An index is a stored member of lines that end in a JSON object with filename, offset and
    length (JSON lines, CDXJ). An archive that no index names is read through instead.
    """
    archives = {n.removeprefix(ARCHIVES): n for n in package.members if n.startswith(ARCHIVES) and n.endswith(".warc.gz")}
    places = {n: package.place(member) for n, member in archives.items()}
    named = set()
    for n in sorted(package.members):
        if n.startswith(INDEXES) and n.endswith((".jsonl", ".json", ".cdxj", ".cdx")):
            at, size = package.place(n)
            left = b""
            for i in range(0, size, PIECE):
                *lines, left = (left + package.read(at + i, min(PIECE, size - i))).split(b"\n")
                for line in [*lines, left] if i + PIECE >= size else lines:
                    if b"{" in line:
                        x = json.loads(line[line.index(b"{") :])
                        if x.get("filename") in places and "offset" in x and "length" in x:
                            named.add(x["filename"])
                            yield places[x["filename"]][0] + int(x["offset"]), int(x["length"])
    for n in sorted(places.keys() - named):
        yield from scanned(package.read, *places[n])


def record_places(packages: DataFrame) -> DataFrame:
    """(path, offset, length) of each record, from the packages' directories and indexes."""

    def run(batches):
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                f, package = _opened(path, size)
                with f:
                    places = package_places(package)
                    while part := list(islice(places, 10_000)):
                        at, n = zip(*part)
                        yield pa.RecordBatch.from_arrays([pa.array([path] * len(part)), pa.array(at, pa.int64()), pa.array(n, pa.int64())], ["path", "offset", "length"])

    return packages.select("path", "size").mapInArrow(run, "path string, `offset` long, length long")


def read_records(places: DataFrame, payloads: bool = True) -> DataFrame:
    """Read each record by its range: key, url, record_type, payload, payload_bytes, payload_digest, refers_to.

    A response's bytes and digest are those of the payload read, and must be what the
    record says; a revisit has no payload and they are what the record says. Without
    `payloads` that column is null, and nothing of that size leaves a worker. Memory
    follows the longest record. No places give no rows.
    """
    names = ["key", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        path, f = None, None
        for batch in batches:
            rows, held = [], 0
            for at, offset, n in sorted(zip(*(c.to_pylist() for c in batch.columns))):
                if at != path:
                    if f:
                        f.close()
                    fs, inner = FileSystem.from_uri(at)
                    path, f = at, fs.open_input_file(inner)
                own, http, payload = parse(f.read_at(n, offset))
                said = own["warc-payload-digest"].removeprefix("sha1:")
                kind = own["warc-type"]
                if kind == "response" and (said != digest(payload) or len(payload) != int(http["content-length"])):
                    raise ValueError(f"{at} at {offset}: the payload is not what its record says")
                key, refers = (own.get(k, "").removeprefix("<urn:page").removesuffix(">") for k in ("warc-record-id", "warc-refers-to"))
                kept = payload if payloads and kind == "response" else None
                rows.append((key[1:] if key else None, own.get("warc-target-uri"), kind, kept, int(http["content-length"]), said, refers[1:] if refers else None))
                held += len(kept or b"")
                if held >= PIECE:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        if f:
            f.close()

    return places.mapInArrow(run, "key string, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to string")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> DataFrame:
    """Write all pages' records and read them back; one row per page.

    Columns: id, payload_bytes, payload_digest, record_type, refers_to. See write_packages
    for nulls and repeated rows. An empty table gives no rows.
    """
    spark = pages.sparkSession
    packages = write_packages(pages, scratch_path(spark, "packages"), id_col, url_col, html_col, least)
    places = record_places(packages).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = pages.schema[id_col].dataType
    read = read_records(places, payloads=False)
    return read.select(F.col("key").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
