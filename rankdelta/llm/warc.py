"""WARC records in ZIP-packaged archives: writer, directory parser, range reader.

An archive is a ZIP file with two stored members: ``archive/data.warc.gz`` (one
gzip member per WARC record) and ``indexes/index.cdx`` (offset and length of
each record inside the data member).  Because members are stored, a record
is a plain byte range of the ZIP file: the reader parses the end-of-central-
directory record (and its ZIP64 form), walks the central directory, finds
where each member's data begin, and reads only the ranges it needs.  Nothing is
unpacked to disk.

Writers run in Spark tasks; each names its files uniquely, and only files
listed in the manifest that Spark has committed are read, so a retried task
leaves no double records.
"""

from __future__ import annotations

import gzip
import hashlib
import struct
import uuid
import zipfile
from base64 import b32decode, b32encode
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdelta.llm.common import scratch_path, slices, utf8, written

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
REVISIT_FROM = 1000
RECORDS_PER_ARCHIVE = 20_000
BYTES_PER_ARCHIVE = 512 << 20
RANGE_BYTES = 4 << 20
TASK_BYTES = 4 * RANGE_BYTES  # read by a task, about
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- records -------------------------------------------------------------

def record(page_id, url, payload: bytes, sha1_hex: str, kind: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP headers only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{_id(page_id)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:?#[]@!$&'()*+,;=~-._"))
    head.append("WARC-Payload-Digest: sha1:" + b32encode(bytes.fromhex(sha1_hex)).decode())
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{_id(refers_to)}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _id(page_id) -> str:
    return "null" if page_id is None else str(page_id)


def _of(urn: str | None):
    found = None if urn is None else urn.strip().removeprefix("<urn:page:").removesuffix(">")
    return None if found in (None, "null") else int(found)


def parse_record(raw: bytes) -> dict:
    """Fields of a record; the payload digest of a response is computed from its bytes."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    field = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(field["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode("latin-1").split("\r\n")[1:])}
    digest = b32decode(field["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = field["warc-type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(said["content-length"])):
        raise ValueError(f"payload of {field['warc-record-id']} does not match its digest")
    return {"page_id": _of(field["warc-record-id"]), "uri": field.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": int(said["content-length"]), "payload_digest": digest,
            "refers_to": _of(field.get("warc-refers-to")), "payload": payload if kind == "response" else None}


# --- ZIP directory --------------------------------------------------------

@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int  # offset of its local header


def _zip64(extra: bytes, size: int, packed: int, header: int) -> tuple[int, int, int]:
    """Fields that the 32-bit ones mark as kept in the ZIP64 extra field, in its fixed order."""
    at = 0
    while at + 4 <= len(extra):
        tag, n = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            body, i = extra[at + 4: at + 4 + n], 0
            values = []
            for v in (size, packed, header):
                if v == 0xFFFFFFFF:
                    v = struct.unpack_from("<Q", body, i)[0]
                    i += 8
                values.append(v)
            return tuple(values)
        at += 4 + n
    return size, packed, header


def directory(read_at, length: int) -> list[Member]:
    """Members of a ZIP file; ``read_at(offset, n)`` gives its bytes."""
    tail_at = max(0, length - 65_557)  # longest comment plus the record
    tail = read_at(tail_at, length - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    locator = tail_at + at - 20
    if locator >= 0 and (found := read_at(locator, 20))[:4] == b"PK\x06\x07":
        end64 = read_at(struct.unpack_from("<Q", found, 8)[0], 56)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, size, start = struct.unpack_from("<QQQ", end64, 32)
    raw, at, members = read_at(start, size), 0, []
    for _ in range(count):
        if raw[at: at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, at + 20)
        header = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46: at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = raw[at + 46 + n_name: at + 46 + n_name + n_extra]
        plain, packed, header = _zip64(extra, plain, packed, header)
        members.append(Member(name, method, packed, header))
        at += 46 + n_name + n_extra + n_comment
    return members


def data_start(read_at, member: Member) -> int:
    head = read_at(member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("broken local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n_name + n_extra


def record_ranges(read_at, length: int, most: int | None = None) -> Iterator[tuple[int, list[int]]]:
    """(offset in the ZIP file, lengths of the records from there on), in runs of about ``most`` bytes."""
    most = RANGE_BYTES if most is None else most
    members = {m.name: m for m in directory(read_at, length)}
    data, index = members[DATA], members[INDEX]
    if data.method or index.method:
        raise ValueError("members are not stored")
    first = data_start(read_at, data)
    at, run = first, []
    for line in read_at(data_start(read_at, index), index.size).splitlines():
        offset, n = map(int, line.split()[:2])
        if run and (first + offset != at + sum(run) or sum(run) + n > most):
            yield at, run
            run = []
        if not run:
            at = first + offset
        run.append(n)
    if run:
        yield at, run


# --- Spark side -------------------------------------------------------------

def classified(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """(page_id, url, payload, sha1, record_type, refers_to) for every page."""
    payload = utf8(F.col("html"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("sha1"), F.sha2(payload, 256).alias("same"))
    many = (rows.filter(F.octet_length("payload") >= least).groupBy("same")
            .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    out = rows.join(many, "same", "left")
    again = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return out.select("page_id", "url", "payload", "sha1",
                      F.when(again, "revisit").otherwise("response").alias("record_type"),
                      F.when(again, F.col("top")).alias("refers_to"))


class _Archive:
    """One ZIP file while it is written."""

    def __init__(self, folder: str):
        system, root = pafs.FileSystem.from_uri(folder)
        self.name = f"{uuid.uuid4().hex}.zip"
        system.create_dir(root, recursive=True)
        self.out = system.open_output_stream(f"{root}/{self.name}")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index: list[str] = []
        self.at = 0

    def add(self, page_id, raw: bytes) -> None:
        packed = gzip.compress(raw, 6, mtime=0)
        self.member.write(packed)
        self.index.append(f"{self.at} {len(packed)} {_id(page_id)}\n")
        self.at += len(packed)

    def close(self) -> dict:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.index))
        self.zip.close()
        self.out.close()
        return {"archive": self.name, "records": len(self.index), "bytes": self.at}


def _writer(folder: str):
    def run(batches):
        archive = None
        for b in slices(batches, "payload"):
            for r in b.to_pylist():
                archive = archive or _Archive(folder)
                archive.add(r["page_id"], record(r["page_id"], r["url"], r["payload"], r["sha1"], r["record_type"], r["refers_to"]))
                if len(archive.index) >= RECORDS_PER_ARCHIVE or archive.at >= BYTES_PER_ARCHIVE:
                    yield pa.RecordBatch.from_pylist([archive.close()], schema=MANIFEST)
                    archive = None
        if archive:
            yield pa.RecordBatch.from_pylist([archive.close()], schema=MANIFEST)
    return run


MANIFEST = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def write_archives(pages: DataFrame, folder: str | None = None, *, least: int = REVISIT_FROM) -> tuple[str, DataFrame]:
    """Write all pages; returns the folder and its manifest (archive, records, bytes).

    Of equal payloads of at least ``least`` bytes the largest page_id is a
    response, the rest revisit it; rows that repeat the largest id are
    responses too.  A page without id counts as smaller than any.  Null html is
    an empty payload; a null url is left out; an empty table writes no archive.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    manifest = classified(pages, least).mapInArrow(_writer(folder), "archive string, records long, bytes long")
    return folder, written(manifest, "warc-manifest")


def _reader_at(handle):
    def read_at(offset: int, n: int) -> bytes:
        handle.seek(offset)
        return handle.read(n)
    return read_at


def _list(folder: str, most: int):
    def run(batches):
        system, root = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for name in b.column("archive").to_pylist():
                with system.open_input_file(f"{root}/{name}") as f:
                    rows = [{"archive": name, "at": at, "lengths": ns} for at, ns in record_ranges(_reader_at(f), f.size(), most)]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                    [("archive", pa.string()), ("at", pa.int64()), ("lengths", pa.list_(pa.int32()))]))
    return run


RECORDS = pa.schema([("archive", pa.string()), ("at", pa.int64()), ("page_id", pa.int64()), ("uri", pa.string()),
                     ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("refers_to", pa.int64()), ("payload", pa.binary())])
RECORDS_DDL = ("archive string, at long, page_id long, uri string, record_type string, payload_bytes long, "
               "payload_digest string, refers_to long, payload binary")


def _fetch(folder: str, payloads: bool):
    def run(batches):
        system, root = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for r in b.to_pylist():
                with system.open_input_file(f"{root}/{r['archive']}") as f:
                    f.seek(r["at"])
                    raw = f.read(sum(r["lengths"]))
                rows, i = [], 0
                for n in r["lengths"]:
                    rows.append(parse_record(gzip.decompress(raw[i: i + n])) | {"archive": r["archive"], "at": r["at"] + i})
                    if not payloads:
                        rows[-1]["payload"] = None
                    i += n
                yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)
    return run


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame, *, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in ``manifest``; byte ranges are spread over tasks.

    The ranges are small rows for much reading, so their number of parts comes
    from the archives' bytes; as an explicit number it is not merged later.
    """
    ranges = manifest.select("archive").mapInArrow(_list(folder, RANGE_BYTES), "archive string, at long, lengths array<int>")
    parts = -(-(manifest.agg(F.sum("bytes")).first()[0] or 1) // TASK_BYTES)
    return ranges.repartition(parts, "archive", "at").mapInArrow(_fetch(folder, payloads), RECORDS_DDL)
