"""WARC derivatives: metadata and plain-text conversion records of responses (operator 3).

Each response record yields two more that name it in ``WARC-Refers-To``: a ``metadata`` record
(JSON: the source's WARC and HTTP headers, title, description and links) and a ``conversion``
record (the page's text).  Both keep the source's target URI and date and carry block digests
of their own; the source's payload digest is kept, checked, and recomputed where it is
missing.  Record ids follow from the content, so a rerun or a retried task makes the same
records.

The payload digest is of the bytes as stored.  The page is read after chunked transfer coding
and gzip or deflate content coding are undone; any other coding is named in the metadata record
(``undecoded``) and the page counts as empty.

Cases: a null page is an empty payload and gives empty text; a null URL gives no target URI;
unclosed tags, comments and scripts end with the page; undecodable bytes become replacement
characters; a record that is no response yields nothing; a malformed record raises
``ValueError``; repeated pages give repeated records; very long pages are converted whole, in time
that grows with their length; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
#: Bytes of records that are handed on together.
BATCH_BYTES = 8 << 20
_hidden = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)", re.I | re.S)
_named = re.compile(r"\bname\s*=\s*[\"']?description", re.I)
_content = re.compile(r"\bcontent\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", re.I)
_href = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_length = re.compile(rb"\r\ncontent-length[ \t]*:[ \t]*(\d+)[ \t]*\r\n", re.I)
_begun = re.compile(r"<[/!?]?[a-zA-Z]|<!")
#: A title with its text, or any one tag; anchors, meta tags and tags that break lines are told apart.
_part = re.compile(
    r"<(?:title\b[^>]*>(?P<title>.*?)(?:</title\s*>|\Z)|(?P<anchor>a\b[^>]*>)|(?P<meta>meta\b[^>]*>)|"
    r"/?(?P<block>address|article|aside|blockquote|br|dd|div|dl|dt|figure|footer|form|h[1-6]|header|hr|html|body|head|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>|"
    r"[/!?]?[a-zA-Z][^>]*>|![^>]*>)",
    re.I | re.S,
)
_gap = re.compile(r"[^\S\n]+")


def sha1(data: bytes) -> str:
    """A digest as WARC headers carry it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str | bytes) -> str:
    joined = b"\0".join(p if isinstance(p, bytes) else p.encode() for p in parts)
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(joined).digest()[:16], version=5)}>"


def visible(page: str) -> str:
    """A page without comments, scripts, styles and templates, and without what follows its last whole tag inside a tag.

    After this every tag that begins also ends, so no later pattern runs on to the end of the page in vain.
    """
    shown = _hidden.sub(" ", page)
    end = shown.rfind(">") + 1
    cut = _begun.search(shown, end)
    return shown[: cut.start()] if cut else shown


@dataclass
class Page:
    """What a page shows: its text, one line for each block, its first title, its own description, and the targets of its anchors."""

    text: str = ""
    title: str | None = None
    description: str | None = None
    links: list[str] = field(default_factory=list)


def read_page(page: str) -> Page:
    """One pass over the tags of a page; a tag runs to the next ``>``, whatever stands in it."""
    out = Page()

    def part(m: re.Match[str]) -> str:
        kind = m.lastgroup
        if kind == "title":
            out.title = html.unescape(m["title"]).strip() if out.title is None else out.title
            return " "
        if kind == "anchor" and (h := _href.search(m[0])):
            out.links.append(html.unescape(h[1] or h[2] or h[3] or ""))
        elif kind == "meta" and out.description is None and _named.search(m[0]) and (c := _content.search(m[0])):
            out.description = html.unescape(c[1] or c[2] or "")
        return "\n" if kind == "block" else ""

    text = html.unescape(_part.sub(part, visible(page)))
    lines = (_gap.sub(" ", line).strip() for line in text.split("\n"))
    out.text = "\n".join(line for line in lines if line)
    return out


def _unchunked(data: bytes) -> bytes:
    """A body without its chunked transfer coding; one that ends early gives what is there."""
    out, at = [], 0
    while (end := data.find(b"\r\n", at)) >= 0:
        size = data[at:end].split(b";", 1)[0].strip()
        try:
            n = int(size, 16)
        except ValueError:
            break
        if n == 0:
            break
        out.append(data[end + 2 : end + 2 + n])
        at = end + 2 + n + 2
    return b"".join(out)


def _inflated(data: bytes, kinds: tuple[int, ...]) -> bytes:
    """Compressed bytes undone, in the first of ``kinds`` that reads them; a stream that breaks off gives what came before."""
    for kind in kinds:
        z = zlib.decompressobj(kind)
        out = []
        try:
            for a in range(0, len(data), 1 << 16):
                out.append(z.decompress(data[a : a + (1 << 16)]))
            out.append(z.flush())
        except zlib.error:
            if not any(out):
                continue
        return b"".join(out)
    raise ValueError("not in the coding it states")


def decoded_body(payload: bytes, http: list[tuple[str, str]]) -> tuple[bytes, str | None]:
    """The body after its codings are undone, and the coding that could not be."""
    names = lambda key: [c.strip().lower() for k, v in http if k.lower() == key for c in v.split(",") if c.strip()]
    codings = [*names("content-encoding"), *names("transfer-encoding")]
    for coding in reversed(codings):
        if coding == "chunked":
            payload = _unchunked(payload)
        elif coding in ("gzip", "x-gzip", "deflate"):
            try:
                payload = _inflated(payload, (31,) if "gzip" in coding else (15, -15)) if payload else payload
            except ValueError:
                return b"", coding
        elif coding != "identity":
            return b"", coding
    return payload, None


def write_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = CRLF.join(["WARC/1.0", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and block of one record."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split(CRLF)
    if not sep or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in lines[1:])]
    size = next((int(v) for k, v in headers if k.lower() == "content-length"), None)
    if size is None or len(rest) < size:
        raise ValueError("a WARC record without its whole block")
    return headers, rest[:size]


def response_record(url: str | None, page: str | None, date: str, salt: str = "") -> bytes:
    """A response record of a page as fetched."""
    payload = (page or "").encode()
    block = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: {len(payload)}{CRLF}{CRLF}".encode() + payload
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", salt, url or "", payload)), ("WARC-Date", date)]
    headers += [("WARC-Target-URI", re.sub(r"\s+", "%20", url))] if url is not None else []
    headers += [("WARC-Payload-Digest", sha1(payload)), ("WARC-Block-Digest", sha1(block)), ("Content-Type", "application/http; msgtype=response")]
    return write_record(headers, block)


def derive(data: bytes) -> dict | None:
    """The metadata and conversion records of a response record; None for records of other types."""
    headers, block = parse_record(data)
    by = {k.lower(): v for k, v in headers}
    if by.get("warc-type") != "response":
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *fields = head.decode("utf-8", "replace").split(CRLF)
    http = [(k.strip(), v.strip()) for k, _, v in (f.partition(":") for f in fields)]
    kind = next((v for k, v in http if k.lower() == "content-type"), "")
    charset = (re.search(r"charset=[\"']?([\w-]+)", kind, re.I) or [None, "utf-8"])[1]
    body, undecoded = decoded_body(payload, http)
    try:
        page = body.decode(charset, "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    digest = sha1(payload)
    stated = by.get("warc-payload-digest")
    shown = read_page(page)
    text = shown.text
    source = by.get("warc-record-id", "")
    envelope = {
        "source": dict(headers), "http": {"status": status, "headers": dict(http)}, "payload_digest": stated or digest,
        "payload_digest_holds": stated is None or stated == digest, "title": shown.title,
        "description": shown.description, "links": shown.links,
    }
    if undecoded:
        envelope["undecoded"] = undecoded
    shared = [("WARC-Date", by["warc-date"])] if "warc-date" in by else []
    shared += [("WARC-Target-URI", by["warc-target-uri"])] if "warc-target-uri" in by else []
    out: dict = {"response_id": source, "target_uri": by.get("warc-target-uri"), "payload_digest": stated or digest, "payload_ok": stated in (None, digest)}
    for name, body, media in (
        ("metadata", json.dumps(envelope, ensure_ascii=False, sort_keys=True).encode(), "application/json"), ("conversion", text.encode(), "text/plain"),
    ):
        own = record_id(name, source, body)
        head = [("WARC-Type", name), ("WARC-Record-ID", own), ("WARC-Refers-To", source), *shared, ("WARC-Block-Digest", sha1(body)), ("Content-Type", media)]
        out |= {f"{name}_id": own, f"{name}_digest": sha1(body), f"{name}_record": write_record(head, body)}
    return out | {"http_status": status, "title": envelope["title"], "n_links": len(shown.links), "text": text}


_COLUMNS = {
    "response_id": "string", "target_uri": "string", "payload_digest": "string", "payload_ok": "boolean", "metadata_id": "string",
    "metadata_digest": "string", "metadata_record": "binary", "conversion_id": "string", "conversion_digest": "string",
    "conversion_record": "binary", "http_status": "string", "title": "string", "n_links": "long", "text": "string",
}
_KIND = {"string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "long": pa.int64()}


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for a in range(0, whole.num_rows, 256):
            batch = whole.slice(a, 256)
            found = [derive(r) if r is not None else None for r in batch.column("_record").to_pylist()]
            ids = batch.column("_id").filter(pa.array([f is not None for f in found], pa.bool_()))
            found = [f for f in found if f is not None]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([f[k] for f in found], _KIND[t]) for k, t in _COLUMNS.items())], ["_id", *_COLUMNS])


def derivatives(records: DataFrame, id_col: str = "page_id", record_col: str = "record") -> DataFrame:
    """Both derived records of every response record, with their ids, digests and links."""
    kind = records.schema[id_col].dataType.simpleString()
    src = records.select(F.col(id_col).alias("_id"), F.col(record_col).alias("_record"))
    return src.mapInArrow(_derive, ", ".join([f"_id {kind}", *(f"{k} {t}" for k, t in _COLUMNS.items())])).withColumnRenamed("_id", id_col)


def _wrap(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                b = whole.slice(a, 256)
                rows = zip(b.column("_salt").to_pylist(), b.column("_url").to_pylist(), b.column("_page").to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array([response_record(u, p, date, s or "") for s, u, p in rows], pa.binary())], ["_id", "record"])

    return run


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages as WARC response records: ``id_col`` and ``record``."""
    kind = pages.schema[id_col].dataType.simpleString()
    src = pages.select(
        F.col(id_col).alias("_id"), F.col(id_col).cast("string").alias("_salt"), F.col(url_col).alias("_url"), F.col(html_col).alias("_page")
    )
    return src.mapInArrow(_wrap(date), f"_id {kind}, record binary").withColumnRenamed("_id", id_col)


def _pieces(data: bytes) -> Iterator[bytes]:
    """The bytes of an archive file, decompressed a piece at a time (gzip members, one a record or split in any other way)."""
    step = 1 << 20
    if data[:2] != b"\x1f\x8b":
        yield from (data[a : a + step] for a in range(0, len(data), step))
        return
    at, z = 0, zlib.decompressobj(31)
    while at < len(data):
        part = data[at : at + (1 << 16)]
        out = z.decompress(part, step)
        while True:
            if out:
                yield out
            if z.eof or not z.unconsumed_tail:
                break
            out = z.decompress(z.unconsumed_tail, step)
        at += len(part) - len(z.unused_data)
        if z.eof:  # the next member, after padding
            z = zlib.decompressobj(31)
            while data[at : at + 1] == b"\0":
                at += 1
    if rest := z.flush():
        yield rest


def split_archive(data: bytes) -> Iterator[bytes]:
    """The records of a ``.warc`` or ``.warc.gz`` file, one after the other; no more than a record is held decompressed."""
    held, need = bytearray(), 0
    for piece in _pieces(data):
        held += piece
        at = 0
        while len(held) - at >= need:
            while held[at : at + 2] == b"\r\n":
                at += 2
            head = held.find(b"\r\n\r\n", at)
            if head < 0:
                need = 0
                break
            if held[at : at + 5] != b"WARC/":
                raise ValueError("not a WARC record")
            size = _length.search(held, at, head + 2)
            if size is None:
                raise ValueError("a WARC record without its length")
            end = head + 4 + int(size[1])
            if len(held) < end:
                need = end - at
                break
            yield bytes(held[at:end]) + b"\r\n\r\n"
            at, need = end, 0
        del held[:at]
    if held.strip(b"\r\n"):
        raise ValueError("a WARC record without its whole block")


def gzip_member(record: bytes) -> bytes:
    """A record as a gzip member of its own, as archives hold it."""
    return gzip.compress(record, mtime=0)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``record`` of every record of WARC files.

    A file is one task and one value, so at most 2 GB as stored (archives are cut at about 1 GB); it is
    decompressed as its records are handed on, in batches of bounded bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                name, data = batch.column("path")[row].as_py(), batch.column("content")[row].as_py()
                held: list[bytes] = []
                size = 0
                for record in split_archive(data):
                    held.append(record)
                    size += len(record)
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(held)), pa.array(held, pa.binary())], ["path", "record"])
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(held)), pa.array(held, pa.binary())], ["path", "record"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, record binary")
