"""WARC records in ZIP packages: written per partition, read back by ranges.

A package is a ZIP archive whose members are stored, not compressed: ``archive/data.warc.gz``
(one gzip member per record) and ``indexes/index.cdxj`` (one line per record: record id,
offset, length). The writer gives every member ZIP64 fields and closes with a ZIP64
directory, so packages may pass 4 GB and 65,535 members.

The reader never extracts a package. It reads the end of the file, follows the ZIP64 locator
if there is one, parses the central directory, takes member offsets from the local headers
and reads the index member; records are then read by byte range, neighbours together, in
tasks of their own. Paths are opened through ``pyarrow.fs``, so the store may be any that
executors reach.

Packages are written under a temporary name that no other attempt uses and renamed to a name
that depends on the partition alone, so a repeated task replaces its own result.

Defined cases: a null payload is empty; of records with equal payloads that with the largest
page id is the response and the others revisit it (rows that repeat that id as well are
responses too; a null id is smaller than any other and is written as an empty id); payloads
under ``min_revisit_bytes`` are all responses. An empty table gives no package. Only the id,
url and payload columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WARC_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
RANGE_BYTES = 8 << 20

# Fixed values of the ZIP format: signatures and the ZIP64 field id.
LOCAL, CENTRAL, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
ZIP64_FIELD, FULL32, FULL16 = 0x0001, 0xFFFFFFFF, 0xFFFF


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1, as WARC payload digests are written."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- ZIP ---------------------------------------------------------------------------------


class PackageWriter:
    """Stored members, written one after the other to ``out``; sizes follow the data."""

    def __init__(self, out) -> None:
        self.out, self.at, self.entries = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def member(self, name: str, parts: Iterable[bytes]) -> None:
        raw, offset, crc, size = name.encode(), self.at, 0, 0
        # bit 3: size and crc come after the data; bit 11: the name is UTF-8
        extra = struct.pack("<HHQQ", ZIP64_FIELD, 16, 0, 0)
        self._put(struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x0808, 0, 0, 0x21, 0, FULL32, FULL32, len(raw), len(extra)))
        self._put(raw + extra)
        for part in parts:
            crc, size = zlib.crc32(part, crc), size + len(part)
            self._put(part)
        self._put(struct.pack("<IIQQ", 0x08074B50, crc, size, size))
        self.entries.append((raw, offset, crc, size))

    def close(self) -> None:
        start = self.at
        for raw, offset, crc, size in self.entries:
            extra = struct.pack("<HHQQQ", ZIP64_FIELD, 24, size, size, offset)
            head = (CENTRAL, 45, 45, 0x0808, 0, 0, 0x21, crc, FULL32, FULL32, len(raw), len(extra), 0, 0, 0, 0, FULL32)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", *head) + raw + extra)
        size, end64, n = self.at - start, self.at, len(self.entries)
        self._put(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, start))
        self._put(struct.pack("<IIQI", LOCATOR64, 0, end64, 1))
        self._put(struct.pack("<IHHHHIIH", END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))


@dataclass(frozen=True)
class Member:
    name: str
    stored: bool
    size: int
    header: int  # offset of the local header


class Ranges:
    """Byte ranges of one file."""

    def __init__(self, path: str) -> None:
        fs, name = open_store(path)
        self.file = fs.open_input_file(name)
        self.size = self.file.size()

    def read(self, at: int, n: int) -> bytes:
        data = self.file.read_at(n, at)
        if len(data) != n:
            raise ValueError(f"short read: {len(data)} of {n} bytes at {at}")
        return data

    def close(self) -> None:
        self.file.close()


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI and the name in it; Hadoop's names of an S3 store are known."""
    path = re.sub(r"^s3[an]://", "s3://", path)
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def directory(ranges: Ranges) -> list[Member]:
    """The members of a package, from its central directory."""
    tail_at = max(0, ranges.size - 22 - FULL16)
    tail = ranges.read(tail_at, ranges.size - tail_at)
    at = tail.rfind(struct.pack("<I", END))
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(struct.pack("<I", END), 0, at)  # a signature inside the comment
    if at < 0:
        raise ValueError("no end of central directory")
    n, size, start = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    if end >= 20 and (n == FULL16 or size == FULL32 or start == FULL32):
        sign, _, end64, _ = struct.unpack("<IIQI", ranges.read(end - 20, 20))
        if sign == LOCATOR64:
            head = struct.unpack("<IQHHIIQQQQ", ranges.read(end64, 56))
            if head[0] != END64:
                raise ValueError("no ZIP64 end of central directory")
            n, size, start = head[7], head[8], head[9]
    data, found, at = ranges.read(start, size), [], 0
    for _ in range(n):
        head = struct.unpack_from("<IHHHHHHIIIHHHHHII", data, at)
        if head[0] != CENTRAL:
            raise ValueError("broken central directory")
        names, extras, comment = head[10], head[11], head[12]
        name = data[at + 46 : at + 46 + names].decode("utf-8", "replace")
        sizes = _zip64(data[at + 46 + names : at + 46 + names + extras], [head[9], head[8], head[16]])
        found.append(Member(name, head[4] == 0, sizes[1], sizes[2]))
        at += 46 + names + extras + comment
    return found


def _zip64(extra: bytes, values: list[int]) -> list[int]:
    """Size, stored size and offset; those that are full come from the ZIP64 field, in this order."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_FIELD:
            field, given = extra[at + 4 : at + 4 + n], 0
            for i, value in enumerate(values):
                if value == FULL32:
                    values[i] = struct.unpack_from("<Q", field, given)[0]
                    given += 8
        at += 4 + n
    return values


def data_offset(ranges: Ranges, member: Member) -> int:
    """Where a member's bytes begin: its local header has a name and fields of its own length."""
    head = struct.unpack("<IHHHHHIIIHH", ranges.read(member.header, 30))
    if head[0] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.header + 30 + head[9] + head[10]


# --- WARC --------------------------------------------------------------------------------


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    number = urn.strip("<>").rsplit(":", 1)[1]
    return int(number) if number else None


def warc_record(page_id: int | None, url: str, kind: str, refers_to: int | None, digest: str, size: int, payload: bytes) -> bytes:
    """One gzip member. A revisit keeps the HTTP head, which tells the payload's size, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    safe = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": _urn(page_id),
        "WARC-Target-URI": safe,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if kind == "revisit":
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = _urn(refers_to)
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    return gzip.compress(lines.encode() + block + b"\r\n\r\n", 6, mtime=0)


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (x.decode("utf-8", "replace").partition(":") for x in lines if b":" in x)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse_record(member: bytes) -> dict:
    """A record's fields; payload digest and size are those of the bytes read, or of a revisit's head."""
    raw = gzip.decompress(member)
    at = raw.index(b"\r\n\r\n")
    head = _fields(raw[:at].split(b"\r\n")[1:])
    block = raw[at + 4 : at + 4 + int(head["content-length"])]
    cut = block.index(b"\r\n\r\n")
    http, payload = _fields(block[:cut].split(b"\r\n")[1:]), block[cut + 4 :]
    kind = head["warc-type"]
    if kind == "response":
        digest, size, refers = payload_digest(payload), len(payload), None
        if f"sha1:{digest}" != head["warc-payload-digest"]:
            raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
    else:
        digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
        refers = _page(head["warc-refers-to"])
    return {
        "page_id": _page(head["warc-record-id"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": refers,
        "url": head["warc-target-uri"],
        "payload": payload if kind == "response" else None,
    }


# --- Spark -------------------------------------------------------------------------------


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [(x.as_py() or "").encode() for x in batch["payload"]]
        yield pa.RecordBatch.from_arrays(
            [
                batch["page_id"],
                batch["url"],
                batch["payload"],
                pa.array([payload_digest(p) for p in payloads], pa.string()),
                pa.array([len(p) for p in payloads], pa.int64()),
            ],
            names=["page_id", "url", "payload", "digest", "size"],
        )


def _writer(root: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        fs, folder = open_store(root)
        fs.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}.wacz"
        part = f"{folder}/_writing-{uuid.uuid4().hex}"
        index: list[bytes] = []
        with fs.open_output_stream(part) as out:
            package = PackageWriter(out)
            package.member(WARC_MEMBER, _records(first, batches, index))
            package.member(INDEX_MEMBER, index)
            package.close()
        fs.move(part, f"{folder}/{name}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{root}/{name}"]), pa.array([len(index)], pa.int64())], names=["path", "records"]
        )

    return write


def _records(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch], index: list[bytes]) -> Iterator[bytes]:
    at, batch = 0, first
    while batch is not None:
        for row in range(batch.num_rows):
            x = {n: batch[n][row].as_py() for n in ("page_id", "url", "payload", "digest", "size", "kind", "refers_to")}
            member = warc_record(
                x["page_id"], x["url"] or "", x["kind"], x["refers_to"], x["digest"], x["size"], (x["payload"] or "").encode()
            )
            line = {"id": _urn(x["page_id"]), "offset": at, "length": len(member)}
            index.append((json.dumps(line, separators=(",", ":")) + "\n").encode())
            at += len(member)
            yield member
        batch = next(rest, None)


def write_packages(
    pages: DataFrame,
    root: str,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit_bytes: int = 0,
) -> DataFrame:
    """Writes a record per row below the folder ``root``; (path, records) of each package.

    The digest of a payload shared by many rows is a hot join key: the side with the payloads
    is split by the skew join, the other has one row per digest.
    """
    rows = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(payload).alias("payload"))
    known = rows.mapInArrow(_digests, "page_id long, url string, payload string, digest string, size long")
    last = known.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("copies"))
    # only payloads found more than once join back; hot digests are split by the skew join
    shared = last.where("copies > 1").select("digest", "last")
    typed = known.join(shared, "digest", "left")
    revisit = (
        (F.col("size") >= min_revisit_bytes) & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    )
    typed = typed.select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "digest",
        "size",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("last")).alias("refers_to"),
    )
    return typed.mapInArrow(_writer(root), "path string, records long")


def _read_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch["path"].to_pylist():
            ranges = Ranges(path)
            members = {m.name: m for m in directory(ranges)}
            data, index = members[WARC_MEMBER], members[INDEX_MEMBER]
            if not (data.stored and index.stored):
                raise ValueError(f"{path}: members must be stored")
            base, at = data_offset(ranges, data), data_offset(ranges, index)
            out: list[tuple[str, int, list[int]]] = []
            start, lengths = 0, []
            for line in _lines(ranges, at, index.size):
                entry = json.loads(line)
                if lengths and entry["offset"] + entry["length"] - start > RANGE_BYTES:
                    out.append((path, base + start, lengths))
                    lengths = []
                if not lengths:
                    start = entry["offset"]
                lengths.append(entry["length"])
            if lengths:
                out.append((path, base + start, lengths))
            ranges.close()
            if out:
                paths, starts, each = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(paths), pa.array(starts, pa.int64()), pa.array(each, pa.list_(pa.int64()))],
                    names=["path", "start", "lengths"],
                )


def _lines(ranges: Ranges, at: int, size: int) -> Iterator[bytes]:
    rest, end = b"", at + size
    while at < end:
        chunk = ranges.read(at, min(1 << 20, end - at))
        at += len(chunk)
        *lines, rest = (rest + chunk).split(b"\n")
        yield from (x for x in lines if x)
    if rest:
        yield rest


RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
        ("payload", pa.binary()),
    ]
)


def _reader(payloads: bool):
    schema = RECORD if payloads else RECORD.remove(len(RECORD) - 1)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, lengths in zip(*(batch[n].to_pylist() for n in ("path", "start", "lengths")), strict=True):
                ranges = Ranges(path)
                data, at, rows = ranges.read(start, sum(lengths)), 0, []
                ranges.close()
                for length in lengths:
                    rows.append(parse_record(data[at : at + length]))
                    at += length
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist([{n: r[n] for n in schema.names} for r in rows], schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist([{n: r[n] for n in schema.names} for r in rows], schema)

    return read


def read_packages(paths: DataFrame, payloads: bool = True, tasks: int | None = None) -> DataFrame:
    """The records of the packages in column ``path``: one task step reads indexes, another ranges.

    Ranges of a package are dealt out, so one huge package does not sit in one task.
    """
    spark: SparkSession = paths.sparkSession
    ranges = paths.select("path").mapInArrow(_read_index, "path string, start long, lengths array<long>")
    ranges = ranges.repartition(tasks or int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start")
    fields = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    return ranges.mapInArrow(_reader(payloads), fields + (", payload binary" if payloads else ""))
