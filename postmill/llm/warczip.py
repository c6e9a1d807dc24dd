"""WARC records in ZIP packages, read by range without extraction.

A package stores (without compression) `archive/data.warc.gz`, one gzip member per record, and `indexes/index.cdxj`, a line
per record, sorted by reversed host, path and time, with its place and length in the archive. The reader finds the central
directory from the end of the file, follows ZIP64 fields where 32 bits don't suffice, skips each local header, and then reads
by range. It takes any stored archives (`.warc.gz`, `.warc`) and any stored indexes (`.cdxj`); archives without an index are
scanned record by record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.shared import materialize, open_fs, shared_path

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_BYTES = 1000
PACKAGE_BYTES, READ_BYTES, TAIL_BYTES, HEAD_BYTES = 64 << 20, 4 << 20, 65557, 64 << 10
NAMES = uuid.UUID("6f6b1d3e-0f5c-5d0e-9a52-2d1c0c7b8a11")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LIMIT32, LIMIT16 = 0xFFFFFFFF, 0xFFFF
#: fixed values: signatures and layouts of the ZIP format
LOCAL, CENTRAL, END, END64, LOCATOR64 = "<4s5H3I2H", "<4s6H3I5H2I", "<4s4H2IH", "<4sQ2H2I4Q", "<4sIQI"


class ZipWriter:
    """Stored members, in order; ZIP64 fields where needed, or always."""

    def __init__(self, out, force64: bool = False):
        self.out, self.at, self.force, self.members = out, 0, force64, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def member(self, name: str, size: int, crc: int, parts) -> None:
        """parts: the member's bytes, of known size and checksum."""
        place, wide = self.at, self.force or size >= LIMIT32
        extra = struct.pack("<2H2Q", 1, 16, size, size) if wide else b""
        short = LIMIT32 if wide else size
        self._put(struct.pack(LOCAL, b"PK\x03\x04", 45 if wide else 20, 0x800, 0, 0, 33, crc, short, short, len(name.encode()), len(extra)) + name.encode() + extra)
        for part in parts:
            self._put(part)
        self.members.append((name.encode(), size, crc, place))

    def close(self) -> None:
        start = self.at
        for name, size, crc, place in self.members:
            wide = self.force or size >= LIMIT32 or place >= LIMIT32
            extra = struct.pack("<2H3Q", 1, 24, size, size, place) if wide else b""
            short = [LIMIT32] * 3 if wide else [size, size, place]
            self._put(struct.pack(CENTRAL, b"PK\x01\x02", 45, 45 if wide else 20, 0x800, 0, 0, 33, crc, *short[:2], len(name), len(extra), 0, 0, 0, 0, short[2]) + name + extra)
        n, size = len(self.members), self.at - start
        if self.force or n >= LIMIT16 or start >= LIMIT32 or size >= LIMIT32:
            end64 = self.at
            self._put(struct.pack(END64, b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, size, start))
            self._put(struct.pack(LOCATOR64, b"PK\x06\x07", 0, end64, 1))
            n, size, start = LIMIT16, LIMIT32, LIMIT32
        self._put(struct.pack(END, b"PK\x05\x06", 0, 0, n, n, size, start, 0))


def members(f) -> dict[str, tuple[int, int]]:
    """name -> (place, size) of the stored members of a package, by range reads of its directories."""
    total = f.size()
    base = max(0, total - TAIL_BYTES)
    tail = f.read_at(total - base, base)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of a central directory")
    _, _, _, _, n, size, start, _ = struct.unpack_from(END, tail, at)
    if LIMIT16 == n or LIMIT32 in (size, start):
        locator = f.read_at(struct.calcsize(LOCATOR64), base + at - struct.calcsize(LOCATOR64))
        if locator[:4] == b"PK\x06\x07":
            end64 = struct.unpack(LOCATOR64, locator)[2]
            n, size, start = struct.unpack(END64, f.read_at(struct.calcsize(END64), end64))[-3:]
    directory, found, at = f.read_at(size, start), {}, 0
    for _ in range(n):
        head = struct.unpack_from(CENTRAL, directory, at)
        if head[0] != b"PK\x01\x02":
            raise ValueError("a damaged central directory")
        method, packed, full, n_name, n_extra, n_comment, place = head[4], head[8], head[9], head[10], head[11], head[12], head[16]
        at += struct.calcsize(CENTRAL)
        name, extra = directory[at : at + n_name].decode(), directory[at + n_name : at + n_name + n_extra]
        at += n_name + n_extra + n_comment
        i = 0
        while i + 4 <= len(extra):
            tag, length = struct.unpack_from("<2H", extra, i)
            if tag == 1:
                wide = list(struct.unpack_from(f"<{length // 8}Q", extra, i + 4))
                full = wide.pop(0) if full == LIMIT32 else full
                packed = wide.pop(0) if packed == LIMIT32 else packed
                place = wide.pop(0) if place == LIMIT32 else place
            i += 4 + length
        if method == 0:
            local = struct.unpack(LOCAL, f.read_at(struct.calcsize(LOCAL), place))
            found[name] = (place + struct.calcsize(LOCAL) + local[-2] + local[-1], packed)
    return found


def sort_key(url: str | None) -> str:
    """The host's parts in reverse order, then the path, in lower case and without white space."""
    found = re.match(r"(?i)https?://(?:www\.)?([^/:?#]+)[^/?#]*([^#]*)", url or "")
    text = f"{','.join(reversed(found[1].lower().split('.')))}){found[2].lower() or '/'}" if found else url or "-"
    return re.sub(r"\s", "%20", text)


def entries(f, where: dict[str, tuple[int, int]]) -> Iterator[tuple[int, int, bool]]:
    """(place, length, whether compressed) of the records of a package, in order of place."""
    archives, indexed = {n: where[n] for n in where if n.endswith((".warc.gz", ".warc"))}, []
    for name in where:
        if name.endswith(".cdxj"):
            at, length = where[name]
            for line in io.BytesIO(f.read_at(length, at)):
                if not line.strip() or line.startswith(b"!"):
                    continue
                said = json.loads(b"{" + line.partition(b" ")[2].partition(b"{")[2])
                file = next((n for n in archives if n.rpartition("/")[2] == said.get("filename", "").rpartition("/")[2]), None) or (next(iter(archives)) if len(archives) == 1 else None)
                if file is None:
                    raise ValueError("an index entry names no archive of its package")
                indexed.append((archives[file][0] + int(said["offset"]), int(said["length"]), file.endswith(".gz")))
    if indexed:
        yield from sorted(indexed)
        return
    for name in sorted(archives):
        at, length = archives[name]
        yield from ((at + a, n, name.endswith(".gz")) for a, n in (_members_of(f, at, length) if name.endswith(".gz") else _records_of(f, at, length)))


def _members_of(f, at: int, length: int) -> Iterator[tuple[int, int]]:
    """(place, length) of the gzip members of an archive."""
    place, read, held = 0, 0, b""
    while place < length:
        unpack, used = zlib.decompressobj(31), 0
        while not unpack.eof:
            if not held:
                held = f.read_at(min(READ_BYTES, length - read), at + read)
                read += len(held)
                if not held:
                    raise ValueError("an archive ends inside a record")
            used += len(held)
            unpack.decompress(held)
            held = unpack.unused_data
        used -= len(held)
        yield place, used
        place += used


def _records_of(f, at: int, length: int) -> Iterator[tuple[int, int]]:
    """(place, length) of the records of an archive without compression."""
    place = 0
    while place < length:
        head = f.read_at(min(HEAD_BYTES, length - place), at + place).partition(b"\r\n\r\n")[0]
        size = re.search(rb"(?im)^content-length: *(\d+)", head)
        if not head.startswith(b"WARC/") or not size:
            raise ValueError("not a WARC record")
        n = len(head) + 4 + int(size[1]) + 4
        yield place, n
        place += n


def record(page_id: int | None, number: int | str, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 response, or a revisit that keeps the HTTP head only. number makes its id."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMES, f'{number}')}>"), ("WARC-Date", date),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()), ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(NAMES, f'{refers_to}/{digest}')}>"), ("X-Refers-To-Page-ID", str(refers_to))]
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict | None:
    """A record's fields, and its payload (None of a revisit); None for a record that is neither a response nor a revisit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines if ": " in line)
    if fields["WARC-Type"] not in ("response", "revisit"):
        return None
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    http_fields = dict(line.split(": ", 1) for line in http.decode("latin-1").split("\r\n")[1:] if ": " in line)
    revisit = fields["WARC-Type"] == "revisit"
    said = fields.get("WARC-Payload-Digest", "")
    digest = base64.b32decode(said.removeprefix("sha1:")).hex() if said.startswith("sha1:") else hashlib.sha1(payload).hexdigest()
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("a payload differs from its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "page_id": number("X-Page-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": int(http_fields.get("Content-Length", 0)) if revisit else len(payload), "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-ID"), "payload": None if revisit else payload,
    }


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to, referred: of equal payloads of `least` bytes or more, all but one refer to the largest page_id.

    Only digests that occur twice are joined back; while their table is below Spark's broadcast threshold no payload moves.
    """
    keyed = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha1("payload"))
    copies = keyed.where((F.octet_length("payload") >= least) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.max("page_id").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    copies = materialize(copies, "copies")
    refers = F.when(F.col("lead") != F.col("page_id"), F.col("lead"))
    referred = F.coalesce(F.col("lead") == F.col("page_id"), F.lit(False))
    return keyed.join(copies, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"), referred.alias("referred"))


def write_packages(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", package_bytes: int = PACKAGE_BYTES, force64: bool = False) -> DataFrame:
    """Packages of the pages (with_revisits) below folder; a table of them: path, records.

    A task closes a package at about package_bytes. Each attempt of a task writes names of its own, and only packages in the
    returned table count.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, number = TaskContext.get(), 0
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        data, index, crc = [], [], 0
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal number
            name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}.wacz"
            lines = "".join(f"{key} {json.dumps(value)}\n" for key, value in sorted(index, key=lambda x: (x[0], x[1]["offset"]))).encode()
            with fs.open_output_stream(f"{root}/{name}") as out:
                package = ZipWriter(out, force64)
                package.member(ARCHIVE, size, crc, data)
                package.member(INDEX, len(lines), zlib.crc32(lines), [lines])
                package.close()
            number += 1
            return pa.record_batch([pa.array([f"{folder}/{name}"]), pa.array([len(index)], pa.int64())], names=["path", "records"])

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, digest, refers_to, referred = (batch.column(c)[i].as_py() for c in range(6))
                # a record that others refer to is named by its page and digest, any other by its place
                name = f"{page_id}/{digest}" if referred else f"{folder}/{context.taskAttemptId()}/{number}/{len(index)}"
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                packed = packer.compress(record(page_id, name, url, payload, digest, refers_to, date)) + packer.flush()
                index.append((f"{sort_key(url)} {re.sub(r'[^0-9]', '', date)}", {"url": url, "mime": "text/html" if refers_to is None else "warc/revisit", "status": "200", "digest": f"sha1:{digest}", "filename": ARCHIVE.rpartition("/")[2], "offset": size, "length": len(packed)}))
                data.append(packed)
                crc, size = zlib.crc32(packed, crc), size + len(packed)
                if size >= package_bytes:
                    yield close()
                    data, index, crc, size = [], [], 0, 0
        if index:
            yield close()

    return materialize(pages.select("page_id", "url", "payload", "digest", "refers_to", "referred").mapInArrow(run, "path string, records long"), "packages")


def read_packages(packages: DataFrame) -> DataFrame:
    """The records of the packages (path): page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    columns = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, root = open_fs(path)
                with fs.open_input_file(root) as f:
                    known = list(entries(f, members(f)))
                    places = np.array([e[0] for e in known], np.int64)
                    a = 0
                    while a < len(known):
                        b = max(int(np.searchsorted(places, places[a] + READ_BYTES)), a + 1)
                        start = known[a][0]
                        block = memoryview(f.read_at(known[b - 1][0] + known[b - 1][1] - start, start))
                        raw = (block[at - start : at - start + n] for at, n, _ in known[a:b])
                        found = [parse(zlib.decompress(part, 31) if packed else bytes(part)) for part, (_, _, packed) in zip(raw, known[a:b], strict=True)]
                        found = [x for x in found if x]
                        yield pa.record_batch([pa.array([x[c] for x in found], k) for c, k in zip(columns, kinds, strict=True)], names=list(columns))
                        a = b

    # by number, since the rows are so small that all packages would else be read by one task
    return packages.select("path").repartition(max(1, packages.count())).mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages (page_id, url, html) as packages in the shared folder and reads all records back.

    A null html is an empty payload; a null page_id is always a response and no other refers to it; rows of one page_id
    with equal payloads are both responses (a record can't revisit its own page); a null url has no target; extra columns
    are not read; a very long payload is one stored member, with ZIP64 sizes if it needs them; an empty table writes no package and gives no rows.
    """
    return read_packages(write_packages(with_revisits(pages), shared_path(pages.sparkSession, "warc")))


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS lead FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND lead <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND lead <> page_id THEN lead END AS refers_to FROM g
"""
