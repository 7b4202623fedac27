"""ZIP-packaged web archives: writing, and a reader that range-reads stored members without extraction.

An archive is a ZIP file with the stored (uncompressed) members archive/data.warc.gz (a gzip member for
each WARC/1.1 record) and indexes/index.cdxj (a line for each record: where it lies in the WARC).
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import os
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citespark.llm.common import filesystem, shared_dir, store

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
#: Payloads from this size on are stored once; a revisit record stands for each repeat.
LEAST_REVISIT = 100
#: An archive is closed when its WARC reaches so many bytes.
ARCHIVE_BYTES = 64 << 20
#: Archives are read in at most so many tasks, and records that follow each other in reads of at most so many bytes.
READ_TASKS, READ_BYTES = 100_000, 4 << 20
_END, _END64, _LOC64, _ENTRY, _LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"


class ZipDirectory:
    """Members of a ZIP or ZIP64 file behind a range reader `read(offset, length)`: where each one's bytes lie."""

    def __init__(self, read, size: int):
        self.read = read
        tail_at = max(0, size - (1 << 16) - 22 - 20)
        tail = read(tail_at, size - tail_at)
        at = tail.rfind(_END)
        # the record ends with the file; a comment may hold its signature, too
        while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(_END, 0, at)
        if at < 0:
            raise ValueError("no end of central directory: not a ZIP file, or cut short")
        n, length, start = struct.unpack_from("<HII", tail, at + 10)
        if 0xFFFF == n or 0xFFFFFFFF in (length, start):
            where = at - 20
            if where < 0 or tail[where : where + 4] != _LOC64:
                raise ValueError("ZIP64 locator missing")
            (end64,) = struct.unpack_from("<Q", tail, where + 8)
            record = read(end64, 56)
            if record[:4] != _END64:
                raise ValueError("ZIP64 end of central directory missing")
            n, length, start = struct.unpack_from("<QQQ", record, 32)
        directory = read(start, length)
        self.members: dict[str, tuple[int, int, int]] = {}
        at = 0
        for _ in range(n):
            if directory[at : at + 4] != _ENTRY:
                raise ValueError("bad central directory entry")
            flags, method = struct.unpack_from("<HH", directory, at + 8)
            packed, full = struct.unpack_from("<II", directory, at + 20)
            name_n, extra_n, note_n = struct.unpack_from("<HHH", directory, at + 28)
            (offset,) = struct.unpack_from("<I", directory, at + 42)
            name = directory[at + 46 : at + 46 + name_n].decode("utf-8" if flags & 0x800 else "cp437")
            extra = directory[at + 46 + name_n : at + 46 + name_n + extra_n]
            while len(extra) >= 4:
                kind, extra_len = struct.unpack_from("<HH", extra)
                if kind == 1:  # ZIP64: only the fields that did not fit, in this order
                    wide = list(struct.unpack(f"<{extra_len // 8}Q", extra[4 : 4 + extra_len // 8 * 8]))
                    full = wide.pop(0) if full == 0xFFFFFFFF else full
                    packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                    offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
                extra = extra[4 + extra_len :]
            self.members[name] = (method, offset, packed)
            at += 46 + name_n + extra_n + note_n

    def stored(self, name: str) -> tuple[int, int]:
        """Offset and length of a stored member's bytes in the file."""
        method, offset, length = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed; it cannot be range-read")
        head = self.read(offset, 30)
        if head[:4] != _LOCAL:
            raise ValueError("bad local header")
        name_n, extra_n = struct.unpack_from("<HH", head, 26)
        return offset + 30 + name_n + extra_n, length


def _headers(block: bytes) -> dict[str, str]:
    lines = block.split(b"\r\n")
    return {k.strip().lower().decode(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines[1:]) if k.strip()}


def warc_record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit with the response's HTTP headers alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    target = "".join(c for c in url or "" if c >= " " and c != "\x7f")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>",
        f"WARC-Page-ID: {'' if page_id is None else page_id}", f"WARC-Target-URI: {target}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>", f"WARC-Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one uncompressed WARC record; raises ValueError if it is cut short or not a record."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    h = _headers(head)
    length = int(h["content-length"])
    block = rest[:length]
    if len(block) != length:
        raise ValueError("record cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    return {"type": h["warc-type"], "headers": h, "http": _headers(http), "payload": payload}


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (page_id, url, html, digest, first) as ZIP-packaged archives; returns their paths, bytes and record numbers.

    `first` is the response's page_id if the row is a revisit, else null. Each task streams one archive at a time.
    Names are new for every attempt, and only the paths that successful tasks return are read, so a
    repeated task leaves at most a file that nobody reads.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, base = filesystem(folder)
        target.create_dir(base, recursive=True)
        name, out, pack, member, lines = "", None, None, None, []
        written = 0

        def close() -> pd.DataFrame:
            member.close()
            pack.writestr(INDEX_MEMBER, "".join(lines))
            pack.close(), out.close()
            return pd.DataFrame({"path": [name], "records": [len(lines)]})

        for frame in frames:
            for page_id, url, html, digest, first in zip(frame.page_id, frame.url, frame.html, frame.digest, frame["first"]):
                if out is None:
                    name = f"{base}/{uuid.uuid4().hex}.wacz"
                    out = target.open_output_stream(name)
                    pack = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
                    member = pack.open(zipfile.ZipInfo(WARC_MEMBER), "w", force_zip64=True)
                    lines, written = [], 0
                page = None if pd.isna(page_id) else int(page_id)
                raw = warc_record(page, url, (html or "").encode(), digest, None if pd.isna(first) else int(first), not pd.isna(first))
                packed = gzip.compress(raw, 1, mtime=0)
                member.write(packed)
                lines.append(json.dumps({"page": page, "offset": written, "length": len(packed), "digest": digest}) + "\n")
                written += len(packed)
                if written >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    text = lambda c: F.col(c).cast("string").alias(c)  # noqa: E731  pandas has no nullable long here
    return pages.select(text("page_id"), "url", "html", "digest", text("first")).mapInPandas(write, "path string, records long")


def _ranges(fetch, start: int, entries: Iterator[dict]) -> Iterator[bytes]:
    """The bytes of index entries (offset, length) in their order; those that follow each other are fetched together."""
    run: list[tuple[int, int]] = []

    def read() -> Iterator[bytes]:
        data = fetch(start + run[0][0], run[-1][0] + run[-1][1] - run[0][0])
        for offset, length in run:
            yield data[offset - run[0][0] : offset - run[0][0] + length]

    for e in entries:
        if run and (e["offset"] != run[-1][0] + run[-1][1] or e["offset"] + e["length"] - run[0][0] > READ_BYTES):
            yield from read()
            run = []
        run.append((e["offset"], e["length"]))
    if run:
        yield from read()


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives named in `path`: page_id, url, record_type, refers_to, payload_bytes, payload_digest.

    Only the ends, the directories, the index and each record's own range are read. A response's length and digest
    are those of the payload found, a revisit's those that its headers give.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, _ = filesystem(folder)
        for frame in frames:
            for path in frame.path:
                with target.open_input_file(path) as f:
                    fetch = lambda at, n, f=f: f.read_at(n, at)
                    names = ZipDirectory(fetch, f.size())
                    start, _ = names.stored(WARC_MEMBER)
                    index = fetch(*names.stored(INDEX_MEMBER))
                    rows = []
                    for packed in _ranges(fetch, start, (json.loads(line) for line in io.BytesIO(index))):
                        record = parse_record(zlib.decompress(packed, 31))
                        h, payload = record["headers"], record["payload"]
                        revisit = record["type"] == "revisit"
                        size = int(record["http"]["content-length"]) if revisit else len(payload)
                        digest = h["warc-payload-digest"].partition(":")[2] if revisit else hashlib.sha256(payload).hexdigest()
                        number = lambda x: int(x) if x else None
                        rows.append((number(h["warc-page-id"]), h["warc-target-uri"], size, digest, record["type"], number(h.get("warc-refers-to-page-id"))))
                        if len(rows) >= 10_000:
                            yield _frame(rows)
                            rows = []
                    yield _frame(rows)

    return archives.select("path").mapInPandas(read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def archive_round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a record for each row of (page_id, url, html), then read all archives back.

    Result: page_id, payload_bytes, payload_digest (SHA-256, lower-case hex), record_type, refers_to, url. Of records with
    equal payloads of LEAST_REVISIT bytes or more the smallest page_id is the response, others revisit it.

    A null html is an empty payload. Rows that repeat the smallest page_id are all responses, as are rows with a
    null page_id. Control characters are dropped from URLs. An empty table gives an empty result; other columns are ignored.
    """
    folder = folder or f"{shared_dir(spark)}/citespark/archives-{uuid.uuid4().hex}"
    data = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", "html", F.sha2(data, 256).alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).alias("n"))
    # combined before the shuffle, and only groups of several pages are left to join
    first = rows.where(F.col("n") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("least"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    marked = rows.join(first, "digest", "left").withColumn("first", F.when(F.col("page_id") > F.col("least"), F.col("least")))
    archives = store(write_archives(marked, folder))
    # a number of tasks that adaptive execution does not merge: archives are large, their names are not
    tasks = max(1, min(archives.count(), READ_TASKS))
    return read_archives(archives.repartition(tasks, "path"), folder)


def remove_archives(folder: str) -> None:
    target, base = filesystem(folder)
    if os.path.basename(base).startswith("archives-"):
        target.delete_dir(base)
