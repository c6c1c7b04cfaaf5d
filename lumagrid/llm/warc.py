"""WARC derivatives: from each response record a metadata record and a plain-text conversion record.

Both refer to the response by its record id, date and target, and to each other; the metadata record keeps the
response's WARC and HTTP header fields and its digests, stated and computed. All of it is one pass without
a shuffle: a record has all that its derivatives need. Record ids of derivatives follow from the id of
the response, so that a repeated task writes the same bytes.

Edge cases: a record that is null, cut short, not WARC, or not a response gives one row without a type that
says so in ``problem``; so does one more row beside the metadata record where the body's content coding cannot be
undone (cut short, or other than gzip, of any number of members, and deflate, raw or not), and no conversion
record is made of it; a response without payload gives derivatives with empty text; header fields keep
their order and repeats; unknown charsets and broken bytes are read as UTF-8 with replacement; repeated
rows give repeated derivatives; an empty table gives an empty result; other columns are left out but for the key.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.common import ready

VERSION = "WARC/1.1"
_SCHEMA = (
    "type string, record_id string, refers_to string, target_uri string, date string, block_digest string, "
    "payload_digest string, n_bytes bigint, record binary, problem string"
)
_KINDS = [pa.string()] * 7 + [pa.int64(), pa.binary(), pa.string()]
_NAMES = [field.split()[0] for field in _SCHEMA.split(", ")]

_UNSHOWN = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)")
_HEAD, _HEAD_END = re.compile(r"(?i)<head\b[^>]*>"), re.compile(r"(?i)</head\s*>")
_BREAK = re.compile(
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|html"
    r"|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
)
_MARKUP = re.compile(r"</?[a-zA-Z][^>]*>|<[!?][^>]*>")
_OPEN = re.compile(r"(?is)<!--.*")
_CHARSET = re.compile(rb"""(?i)charset\s*=\s*["']?([\w.:-]+)""")
_TITLE, _TITLE_END = re.compile(r"(?i)<title\b[^>]*>"), re.compile(r"(?i)</title\s*>")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def build(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> list[tuple[str, str]]:
    """Header lines as (name, value); folded lines go on."""
    found: list[tuple[str, str]] = []
    for line in head.decode("utf-8", "replace").split("\r\n" if b"\r\n" in head else "\n"):
        if line[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            found.append((name.strip(), value.strip()))
    return found


def _get(fields: list[tuple[str, str]], name: str) -> str | None:
    return next((v for n, v in fields if n.lower() == name.lower()), None)


def parse(record: bytes | None) -> tuple[list[tuple[str, str]], bytes]:
    """Header fields and block of one record; ValueError tells what is wrong with it."""
    if not record:
        raise ValueError("no record")
    if not record.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    head, gap, rest = record.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("header does not end")
    fields = _fields(head.partition(b"\r\n")[2])
    length = _get(fields, "Content-Length")
    if length is None or not length.isdigit():
        raise ValueError("no content length")
    if len(rest) < int(length):
        raise ValueError("block is cut short")
    return fields, rest[: int(length)]


def _payload(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, header fields and body of an HTTP response, without transfer and content coding."""
    head, _, body = block.partition(b"\r\n\r\n")
    first, _, rest = head.partition(b"\r\n")
    return first.decode("latin-1"), _fields(rest), body


def _decoded(fields: list[tuple[str, str]], body: bytes) -> bytes:
    if (_get(fields, "Transfer-Encoding") or "").lower() == "chunked":
        parts, at = [], 0
        while m := re.compile(rb"\s*([0-9a-fA-F]+)[^\r\n]*\r\n").match(body, at):
            size = int(m[1], 16)
            parts.append(body[m.end() : m.end() + size])
            at = m.end() + size
            if size == 0:
                break
        body = b"".join(parts) if parts else body
    for coding in reversed((_get(fields, "Content-Encoding") or "").lower().split(",")):
        body = _uncoded(coding.strip(), body)
    return body


def _uncoded(coding: str, body: bytes) -> bytes:
    """Body without one content coding; ValueError tells why it cannot be undone."""
    if coding in ("", "identity") or not body:
        return body
    if coding not in ("gzip", "x-gzip", "deflate"):
        raise ValueError(f"content coding {coding} is not read")
    kinds = (-zlib.MAX_WBITS,) if coding == "deflate" else ()
    for kind in (zlib.MAX_WBITS + 32, *kinds):
        parts, rest = [], body
        try:
            while rest:
                member = zlib.decompressobj(kind)
                parts.append(member.decompress(rest))
                if not member.eof:
                    raise ValueError("coded body is cut short")
                # Another gzip member may follow; what else does is no part of the body.
                rest = member.unused_data if member.unused_data[:2] == b"\x1f\x8b" else b""
            return b"".join(parts)
        except zlib.error:
            continue
    raise ValueError(f"content coding {coding} is broken")


def _text(fields: list[tuple[str, str]], body: bytes) -> str:
    found = _CHARSET.search((_get(fields, "Content-Type") or "").encode()) or _CHARSET.search(body[:2048])
    try:
        return body.decode(found[1].decode("ascii", "replace") if found else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def _without_heads(markup: str) -> str:
    """Markup without closed head elements; each is looked for from where the last one ended."""
    parts, at = [], 0
    while (start := _HEAD.search(markup, at)) and (end := _HEAD_END.search(markup, start.end())):
        parts.append(markup[at : start.start()])
        at = end.end()
    return "".join(parts) + markup[at:]


def plain(markup: str) -> str:
    """Shown text: a line for each block, white space within it made one space, empty lines left out."""
    # No tag ends after the last bracket, so none is looked for there: open tags cost no second look.
    cut = markup.rfind(">") + 1
    text = _without_heads(_UNSHOWN.sub("", markup[:cut]))
    text = _MARKUP.sub("", _BREAK.sub("\n", text)) + _OPEN.sub("", markup[cut:])
    lines = (" ".join(line.split()) for line in unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def _title(markup: str) -> str:
    markup = markup[: markup.rfind(">") + 1]
    start = _TITLE.search(markup)
    end = _TITLE_END.search(markup, start.end()) if start else None
    return " ".join(unescape(markup[start.end() : end.start()]).split()) if end else ""


def _new_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}#{kind}')}>"


def derive(record: bytes | None) -> list[tuple]:
    """Rows of the metadata and the conversion record, or one row that names the problem."""
    try:
        fields, block = parse(record)
        if (_get(fields, "WARC-Type") or "").lower() != "response":
            raise ValueError("not a response")
        source = _get(fields, "WARC-Record-ID")
        if not source:
            raise ValueError("no record id")
    except ValueError as problem:
        return [(None,) * 9 + (str(problem),)]
    target, date = _get(fields, "WARC-Target-URI"), _get(fields, "WARC-Date")
    status, http, body = _payload(block)
    problem = None
    try:
        shown = _text(http, _decoded(http, body))
    except ValueError as found:
        shown, problem = "", str(found)
    stated = (_get(fields, "WARC-Block-Digest"), _get(fields, "WARC-Payload-Digest"))
    own = (digest(block), digest(body))
    ids = {kind: _new_id(source, kind) for kind in ("metadata", "conversion")}
    about = [
        *(() if problem else (("conversion-record", ids["conversion"]),)),
        ("http-status", status),
        *((f"source-{n}", v) for n, v in fields),
        *((f"http-{n}", v) for n, v in http),
        ("computed-block-digest", own[0]),
        ("computed-payload-digest", own[1]),
        *(("digest-mismatch", s) for s, o in zip(stated, own) if s and s.startswith("sha1:") and s != o),
        ("title", _title(shown)),
    ]
    blocks = {
        "metadata": ("application/warc-fields", "".join(f"{n}: {v}\r\n" for n, v in about).encode()),
        "conversion": ("text/plain; charset=UTF-8", plain(shown).encode("utf-8", "replace")),
    }
    rows = []
    if problem:
        del blocks["conversion"]
        rows.append((None, None, source, target, date, None, None, None, None, problem))
    for kind, (content, data) in blocks.items():
        other = ids["conversion" if kind == "metadata" else "metadata"]
        head = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", ids[kind]),
            *((("WARC-Date", date),) if date else ()),
            *((("WARC-Target-URI", target),) if target else ()),
            ("WARC-Refers-To", source),
            *((("WARC-Refers-To-Target-URI", target),) if target else ()),
            *((("WARC-Refers-To-Date", date),) if date else ()),
            *(() if problem else (("WARC-Concurrent-To", other),)),
            ("WARC-Block-Digest", digest(data)),
            ("WARC-Source-Block-Digest", stated[0] or own[0]),
            ("WARC-Source-Payload-Digest", stated[1] or own[1]),
            ("Content-Type", content),
        ]
        made = build(head, data)
        rows.append((kind, ids[kind], source, target, date, digest(data), stated[1] or own[1], len(data), made, None))
    return rows


def derivatives(records: DataFrame, key: str, record: str = "record") -> DataFrame:
    """(key, type, record_id, refers_to, target_uri, date, block_digest, payload_digest, n_bytes, record, problem)."""
    ready(records.sparkSession)
    rows = records.select(F.col(key).alias("key"), F.col(record).alias("record"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [derive(r.as_py()) for r in part.column("record")]
                owner = pa.array([i for i, own in enumerate(found) for _ in own], pa.int64())
                flat = [row for own in found for row in own]
                columns = [pa.array([r[j] for r in flat], kind) for j, kind in enumerate(_KINDS)]
                yield pa.RecordBatch.from_arrays([part.column("key").take(owner), *columns], ["key", *_NAMES])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(made, f"key {kind}, {_SCHEMA}").withColumnRenamed("key", key)


def responses(pages: DataFrame, key: Column, url: Column, html: Column, date: Column) -> DataFrame:
    """(key, record): a response record for each page; for tables that hold pages instead of records."""
    rows = pages.select(key.alias("key"), url.alias("url"), html.alias("html"), date.cast("string").alias("date"))

    @F.arrow_udf("binary")
    def record(keys: pa.Array, urls: pa.Array, htmls: pa.Array, dates: pa.Array) -> pa.Array:
        out = []
        for name, target, markup, when in zip(*(c.to_pylist() for c in (keys, urls, htmls, dates))):
            body = (markup or "").encode()
            block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
            fields = [
                ("WARC-Type", "response"),
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{target}#{name}')}>"),
                ("WARC-Date", when),
                ("WARC-Target-URI", re.sub(r"\s", "%20", target or "")),
                ("WARC-Block-Digest", digest(block)),
                ("WARC-Payload-Digest", digest(body)),
                ("Content-Type", "application/http; msgtype=response"),
            ]
            out.append(build([f for f in fields if f[1]], block))
        return pa.array(out, pa.binary())

    return rows.select("key", record(F.col("key").cast("string"), "url", "html", "date").alias("record"))


def write(derived: DataFrame, path: str) -> None:
    """Store the records of ``derivatives`` as Parquet, by type; ``record`` holds each one's bytes for a WARC file."""
    derived.filter("problem is null").write.partitionBy("type").parquet(path)
