"""Captures from zipped web archives: WARC records, the main document, page list and screenshots."""

from __future__ import annotations

import gzip
import io
import json
import re
import zipfile
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

# Resources that are skipped before decoding, and screenshot variants by rank.
SKIP_EXTENSIONS = (".css", ".js", ".mjs", ".woff", ".woff2", ".ttf", ".eot", ".otf")
SKIP_TYPES = ("text/css", "javascript", "font/", "application/font")
SCREENSHOTS = ("fullPageFinal", "fullPage", "view", "thumbnail")


def _match(url: str) -> str:
    return (url or "").split("#")[0].rstrip("/")


def records(stream: io.BufferedIOBase) -> Iterator[dict]:
    """WARC records of an uncompressed stream, one at a time; a cut one ends the iteration."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            return
        head = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            head[k.strip().lower()] = v.strip()
        size = int(head.get("content-length") or 0)
        body = stream.read(size)
        if len(body) < size:
            return
        out = {"uri": head.get("warc-target-uri", "").strip("<>"), "type": head.get("warc-type", ""), "date": head.get("warc-date"), "status": None, "headers": {}, "body": body}
        out["content_type"] = head.get("content-type", "")
        if out["type"] == "response":
            top, _, payload = body.partition(b"\r\n\r\n")
            lines = top.decode("latin-1").split("\r\n")
            m = re.match(r"HTTP/\S+ (\d+)", lines[0])
            out["status"] = int(m[1]) if m else None
            out["headers"] = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            out["content_type"], out["body"] = out["headers"].get("content-type", ""), payload
        yield out


def decode(body: bytes, content_type: str) -> str:
    """By the header's charset, else one named in the first 4096 bytes; as UTF-8 where that fails; what neither reads is replaced."""
    m = re.search(r"charset=[\"']?([\w-]+)", content_type or "", re.I) or re.search(rb"charset=[\"']?([\w-]+)", body[:4096], re.I)
    name = m[1].decode() if m and isinstance(m[1], bytes) else m[1] if m else "utf-8"
    for charset in (name, "utf-8"):
        try:
            return body.decode(charset)
        except (LookupError, UnicodeDecodeError):
            pass
    return body.decode("utf-8", "replace")


def skipped(uri: str, content_type: str) -> bool:
    path = uri.split("?")[0].split("#")[0].lower()
    return path.endswith(SKIP_EXTENSIONS) or any(t in (content_type or "").lower() for t in SKIP_TYPES)


def main_document(found: list[dict], page_url: str) -> dict | None:
    """The page's own HTML: redirects are followed from its URL, with a guard against loops; else the first HTML response."""
    by = {}
    for r in found:
        if r["type"] == "response":
            by.setdefault(_match(r["uri"]), r)
    seen, at = set(), _match(page_url)
    while at in by and at not in seen:
        seen.add(at)
        r = by[at]
        if r["status"] and 300 <= r["status"] < 400 and r["headers"].get("location"):
            at = _match(urljoin(r["uri"], r["headers"]["location"]))
        else:
            return r if "html" in r["content_type"] else None
    return next((r for r in found if r["type"] == "response" and "html" in r["content_type"] and r["status"] == 200), None)


def page_entries(text: str) -> list[dict]:
    """Entries with a url of pages.jsonl; lines end at LF only (titles may hold other line separators)."""
    out = []
    for line in text.split("\n"):
        try:
            entry = json.loads(line)
        except ValueError:
            continue
        if isinstance(entry, dict) and entry.get("url"):
            out.append(entry)
    return out


def read_capture(data: bytes, expected_url: str | None = None) -> dict:
    """One zipped capture: page URL and time, main HTML, status, screenshot; `error` tells what is missing."""
    out = {"url": expected_url, "captured_at": None, "html": None, "http_status": None, "screenshot": None, "n_records": 0, "error": None}
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            names = z.namelist()
            pages = [e for n in names if n.endswith("pages.jsonl") for e in page_entries(z.read(n).decode("utf-8", "replace"))]
            if pages:
                own = next((p for p in pages if expected_url and _match(p["url"]) == _match(expected_url)), pages[0])
                out["url"], out["captured_at"] = own["url"], own.get("ts")
            kept, shots = [], {}
            for n in names:
                if re.search(r"\.warc(\.gz)?$", n):
                    with z.open(n) as raw:
                        for r in records(io.BufferedReader(gzip.GzipFile(fileobj=raw)) if n.endswith(".gz") else raw):
                            out["n_records"] += 1
                            m = re.match(r"urn:(\w+):", r["uri"])
                            if m and m[1] in SCREENSHOTS:
                                shots.setdefault(m[1], r["body"])
                            elif not skipped(r["uri"], r["content_type"]):
                                kept.append(r)
    except (zipfile.BadZipFile, EOFError, OSError, gzip.BadGzipFile) as e:
        return out | {"error": f"unreadable: {type(e).__name__}"}
    main = main_document(kept, out["url"] or "")
    if main is None:
        return out | {"error": "no_html_record"}
    out |= {"html": decode(main["body"], main["content_type"]), "http_status": main["status"], "screenshot": next((shots[v] for v in SCREENSHOTS if v in shots), None)}
    return out | {"error": None if main["status"] == 200 else f"http_{main['status']}"}


CAPTURE = "path string, length long, url string, captured_at string, html string, http_status int, n_records int, error string, has_screenshot boolean"


def read_captures(spark: SparkSession, path: str, pattern: str = "*.wacz") -> DataFrame:
    """All captures under a folder, whatever its depth; an unreadable one is a row with its error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "length", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, length, content in zip(frame.path, frame.length, frame.content):
                x = read_capture(bytes(content))
                rows.append((name, length, x["url"], x["captured_at"], x["html"], x["http_status"], x["n_records"], x["error"], x["screenshot"] is not None))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in CAPTURE.split(", ")]).astype({"http_status": "Int32"})

    return files.mapInPandas(run, CAPTURE)


def read_extractions(spark: SparkSession, path: str) -> DataFrame:
    """Articles of extraction folders whose marker (extraction.json, written last) is there and not failed; others are left out."""
    read = lambda name: spark.read.option("recursiveFileLookup", "true").option("multiLine", "true").option("pathGlobFilter", name).json(path)
    folder = "regexp_replace(_metadata.file_path, '/[^/]*$', '')"
    marker = read("extraction.json").selectExpr(f"{folder} as folder", "extraction_status").where("extraction_status <> 'failed'")
    return read("article.json").selectExpr(f"{folder} as folder", "*").join(marker, "folder")
