"""WARC records in ZIP-packaged web archives, written and range-read by tasks.

An archive is a ZIP file of stored members: ``archive/data.warc.gz`` (each
record a gzip member of its own) and ``indexes/index.cdxj`` (a line per record
with its offset and length).  The reader parses the end record, the ZIP64
records and the central directory, finds the members' data behind their local
headers, reads the index and then range-reads each record; nothing is
extracted.

Records of equal payloads: the one of the smallest page id is a response, the
others revisit it, if the payload has at least ``min_bytes``.  Payload rows
are shuffled once, by digest; adaptive execution splits a hot digest, since
the join's other side has one row for it.

Archives go to a folder that all executors share.  Each attempt of a task
writes files of its own name and returns them in its result, so a lost or
repeated attempt leaves a file that no manifest names.

Defined cases: null html is an empty payload (of digest and length like any
other); rows repeated with the smallest page id are all responses; a null
page_id never is the smallest, and where a payload has no page_id at all every
record is a response; line ends in a url are percent-encoded, a null url is
empty.  Without rows there are no archives and no result rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, shuffle_parts, stage

#: Payload bytes after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def b32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ------------------------------------------------------------ records
def record(page_id, url: str | None, payload: bytes | None, digest: str, size: int, refers_to) -> bytes:
    """A WARC record; a revisit (``refers_to`` set) holds only HTTP headers."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
              ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"),
              *([("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)] if revisit else []),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of a WARC record that :func:`record` or any other writer made."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = {k.strip().lower(): v.strip() for k, _, v in
                (x.partition(":") for x in http.decode("utf-8", "replace").split("\r\n")[1:])}
    page = fields["warc-record-id"].strip("<>").rpartition(":")[2]
    refers = fields.get("warc-refers-to", "").strip("<>").rpartition(":")[2]
    out = {"page_id": int(page) if page else None, "record_type": fields["warc-type"], "url": fields.get("warc-target-uri", ""),
           "refers_to": int(refers) if refers else None}
    if out["record_type"] == "revisit":
        return out | {"payload": None, "payload_bytes": int(declared["content-length"]),
                      "payload_digest": fields["warc-payload-digest"].partition(":")[2]}
    return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": b32_sha1(payload)}


# ------------------------------------------------------------ ZIP reader
class ZipDirectory:
    """Stored members of a ZIP file behind ``read_at(size, offset)``."""

    def __init__(self, read_at, size: int):
        self.read_at = read_at
        tail_size = min(size, 22 + 0xFFFF + 20)
        tail = read_at(tail_size, size - tail_size)
        at = tail.rfind(b"PK\x05\x06")
        if at < 0:
            raise ValueError("no end record: not a ZIP file")
        count, length, offset = struct.unpack("<10xHII", tail[at:at + 20])
        if at >= 20 and tail[at - 20:at - 16] == b"PK\x06\x07":  # ZIP64 locator
            end64, = struct.unpack("<8xQ4x", tail[at - 20:at])
            count, length, offset = struct.unpack("<32xQQQ", read_at(56, end64))
        self.members = {}
        raw, p = read_at(length, offset), 0
        for _ in range(count):
            if raw[p:p + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            flags, method, packed, plain, n, m, c, start = struct.unpack("<8xHH8xIIHHH8xI", raw[p:p + 46])
            name = raw[p + 46:p + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
            plain, packed, start = self._wide(raw[p + 46 + n:p + 46 + n + m], plain, packed, start)
            self.members[name] = (method, start, packed)
            p += 46 + n + m + c

    @staticmethod
    def _wide(extra: bytes, *values: int) -> list[int]:
        """The ZIP64 extra field holds, in order, the values that overflowed."""
        wide, p = b"", 0
        while p + 4 <= len(extra):
            tag, n = struct.unpack("<HH", extra[p:p + 4])
            if tag == 1:
                wide = extra[p + 4:p + 4 + n]
            p += 4 + n
        out = []
        for v in values:
            if v == 0xFFFFFFFF:
                v, wide = struct.unpack("<Q", wide[:8])[0], wide[8:]
            out.append(v)
        return out

    def place(self, name: str) -> tuple[int, int]:
        """(offset, size) of a stored member's data."""
        method, start, size = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed; a range-read needs a stored member")
        n, m = struct.unpack("<26xHH", self.read_at(30, start))
        return start + 30 + n + m, size


def read_archive(uri: str):
    """The records of one archive, in index order, one range-read each."""
    where, path = fs.FileSystem.from_uri(uri)
    with where.open_input_file(path) as f:
        zipped = ZipDirectory(f.read_at, f.size())
        data, _ = zipped.place(WARC)
        offset, size = zipped.place(INDEX)
        for line in f.read_at(size, offset).splitlines():
            entry = json.loads(line.split(b" ", 2)[2])
            yield parse_record(gzip.decompress(f.read_at(int(entry["length"]), data + int(entry["offset"]))))


# ------------------------------------------------------------ writer
class ArchiveWriter:
    def __init__(self, uri: str):
        where, path = fs.FileSystem.from_uri(uri)
        self.stream = where.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(WARC, "w", force_zip64=True)
        self.uri, self.index, self.at, self.payload = uri, [], 0, 0

    def add(self, page_id, url, payload, digest, size, refers_to) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        raw = packer.compress(record(page_id, url, payload, digest, size, refers_to)) + packer.flush()
        self.data.write(raw)
        entry = {"offset": str(self.at), "length": str(len(raw)), "digest": f"sha1:{digest}", "filename": "data.warc.gz"}
        self.index.append(f"{page_id} {DATE} {json.dumps(entry)}\n")
        self.at += len(raw)
        self.payload += len(payload or b"")

    def close(self) -> tuple[str, int]:
        self.data.close()
        self.zip.writestr(INDEX, "".join(self.index))
        self.zip.close()
        self.stream.close()
        return self.uri, len(self.index)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives into ``folder`` (a URI
    that all executors share); returns the manifest (uri, records)."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    firsts = rows.groupBy("sha").agg(F.min("page_id").alias("first"))
    rows = rows.join(firsts, "sha")
    again = (F.col("size") >= min_bytes) & ~F.col("first").eqNullSafe(F.col("page_id")) & F.col("first").isNotNull()
    rows = rows.select("page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "sha", "size",
                       F.when(again, F.col("first")).alias("refers_to"))
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    where, path = fs.FileSystem.from_uri(uri)
    where.create_dir(path, recursive=True)

    def run(batches):
        writer, done = None, []
        for batch in batches:
            for page, url, payload, sha, size, refers in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if writer is None:
                    writer = ArchiveWriter(f"{uri}/{uuid.uuid4().hex}.wacz")
                writer.add(page, url, payload, base64.b32encode(bytes.fromhex(sha)).decode(), size, refers)
                if writer.payload >= ARCHIVE_BYTES:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())],
                                         names=["uri", "records"])

    return stage(rows.mapInArrow(run, "uri string, records long"), "manifest")


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the archives that ``manifest`` (uri) names."""
    cols = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * with_payload
    kinds = {"page_id": "long", "url": "string", "record_type": "string", "payload_bytes": "long", "payload_digest": "string",
             "refers_to": "long", "payload": "binary"}
    arrow = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held = []
                for r in read_archive(uri):
                    held.append(r)
                    if len(held) == 200:
                        yield rows_batch(held)
                        held = []
                yield rows_batch(held)

    def rows_batch(held):
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in held], arrow[kinds[c]]) for c in cols], names=cols)

    spread = manifest.select("uri").repartition(shuffle_parts(manifest.sparkSession))
    return spread.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in cols))


def archive_folder(spark) -> str:
    return scratch(spark, "warc")
