"""WARC derivatives: metadata and plain-text conversion records of responses.

``response_records`` wraps pages as WARC/1.1 responses; ``derive`` turns response records into two
linked records each: ``metadata`` (what is known of the response: every WARC and HTTP header as
[name, value] pairs in their order, repeated ones too; lengths, whether its digests hold, title,
outgoing links) and ``conversion`` (the payload as plain text).  Both refer to the response by
WARC-Refers-To and repeat the headers that hold for them as well: target URI, date, warcinfo id,
payload digest and type, IP address, truncation and concurrent records.  Their own block digest and
length are theirs; the response's are among the pairs.  Record ids are name-based UUIDs, so reruns
give the same ids.

Records are bytes; names of headers count in any case.  A payload is freed of chunks and of gzip or
deflate and read by its charset (byte order mark, header, ``meta`` tag, else UTF-8; bytes that do not
fit become U+FFFD).  Only text is converted: HTML without tags, ``text/plain`` as it stands; of other
types and of codings that can't be undone there is metadata only.

``write_warc`` and ``read_warc`` go through Spark's own writers and readers: a record is a text row and the
two empty lines after it are the row separator; reading takes whole files (also gzipped, a member per
record or one in all) and cuts them by Content-Length.

Plain text here is all text outside script, style, template and comments, blocks on lines of their
own; picking the main text is another operator's work.

Edge cases: a null page body is an empty payload; a null URL gives an empty target; a null record or
bytes that are no WARC record give a metadata record with ``error`` and no conversion; records that
are neither responses nor resources give nothing; a length that is not the block's, chunks or a
coding that break off are named in the metadata and what can be read is converted; repeated rows
give records with equal ids; very long pages are whole; an empty table gives no records; only the
named columns are read, others may have any names.  In a file that is cut off or holds a record
without a usable header, that record is a row with ``error`` and reading goes on at the next record.
A file to be read fits in a task, so ``write_warc`` bounds the records per file.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
RECORDS_PER_FILE = 50_000
ROWS = 256
PIECE = 1 << 16
KEPT = ("WARC-Date", "WARC-Target-URI", "WARC-Warcinfo-ID", "WARC-Payload-Digest", "WARC-Identified-Payload-Type", "WARC-IP-Address", "WARC-Truncated", "WARC-Concurrent-To")
_FIELDS = ("warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "content_length", "block_digest", "payload_digest", "headers", "block")
_PAIRS = "array<struct<name: string, value: string>>"
RECORD = ", ".join(f"{c} {'long' if c == 'content_length' else _PAIRS if c == 'headers' else 'string'}" for c in _FIELDS)
_UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.S | re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HTTP_END = re.compile(rb"\r?\n\r?\n")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([^\s\"';>]+)", re.I)
_META = re.compile(rb"<meta\b[^>]*?charset\s*=\s*[\"']?([A-Za-z0-9._:-]+)", re.I)
_NEXT = re.compile(rb"(?<=\r\n\r\n)WARC/")
_MARKS = ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))

Headers = list[tuple[str, str]]


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def holds(declared: str | None, data: bytes) -> bool | None:
    """Whether ``data`` has the digest ``algorithm:value`` (base 32 or hex); nothing if that can't be told."""
    name, mark, value = (declared or "").strip().partition(":")
    if not mark or name.lower().replace("-", "") not in ("md5", "sha1", "sha256", "sha512"):
        return None
    own = hashlib.new(name.lower().replace("-", ""), data).digest()
    try:
        given = bytes.fromhex(value) if len(value) == 2 * len(own) else base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except (ValueError, binascii.Error):
        return False
    return given == own


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(31).join(map(str, parts)))}>"


def plain_text(page: str) -> str:
    text = html.unescape(_TAG.sub(" ", _BREAK.sub("\n", _UNSEEN.sub(" ", page))))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def value_of(headers: Headers, name: str) -> str | None:
    """The first header of that name, in any case."""
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def header_pairs(lines: Iterable[str]) -> Headers | None:
    """Names and values in their order, continued lines joined; nothing if a line has no name."""
    pairs: Headers = []
    for line in lines:
        name, mark, value = line.partition(":")
        if line[:1] in (" ", "\t") and pairs:
            pairs[-1] = (pairs[-1][0], f"{pairs[-1][1]} {line.strip()}".strip())
        elif mark and name.strip():
            pairs.append((name.strip(), value.strip()))
        else:
            return None
    return pairs


def record_text(headers: Headers, block: str) -> str:
    return "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in headers), "", block])


def parse_record(record: bytes) -> tuple[Headers, bytes] | None:
    """Headers and block of one record; nothing if it is none."""
    head, mark, block = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    headers = header_pairs(lines) if mark and version.startswith("WARC/") else None
    return None if headers is None else (headers, block)


def _response(page_id, url, body) -> str:
    payload = (body or "").encode("utf-8", "surrogatepass")
    block = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n%s" % (len(payload), body or "")
    data = block.encode("utf-8", "surrogatepass")
    return record_text([
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", page_id, url)), ("WARC-Date", DATE),
        ("WARC-Target-URI", re.sub(r"[\r\n]", " ", url or "")), ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(data)),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(data)))], block)


def response_records(pages: DataFrame) -> DataFrame:
    """``(page_id, record)``: each page (page_id, url, html) as the text of a response record."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            records = [_response(*row) for row in zip(batch["page_id"], batch["url"], batch["html"])]
            yield pd.DataFrame({"page_id": batch["page_id"], "record": records})

    # Ids travel as text: pandas has no exact 64-bit numbers beside nulls.
    made = pages.select(F.col("page_id").cast("long").cast("string"), "url", "html").mapInPandas(run, "page_id string, record string")
    return made.withColumn("page_id", F.col("page_id").cast("long"))


def unchunk(body: bytes) -> tuple[bytes, bool]:
    """The data of a chunked body, and whether it is complete."""
    parts, at = [], 0
    while True:
        end = body.find(b"\n", at)
        size = body[at:max(end, at)].split(b";")[0].strip()
        if end < 0 or not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return b"".join(parts), False
        length = int(size, 16)
        if length == 0:
            return b"".join(parts), True
        parts.append(body[end + 1:end + 1 + length])
        if len(parts[-1]) < length:
            return b"".join(parts), False
        at = end + 1 + length
        at += 2 if body[at:at + 2] == b"\r\n" else 1 if body[at:at + 1] == b"\n" else 0


def uncoded(body: bytes, coding: str) -> tuple[bytes, bool]:
    """A gzip or deflate body unpacked as far as its pieces can be read, and whether it is complete."""
    wrapped = len(body) > 1 and body[0] & 15 == 8 and (256 * body[0] + body[1]) % 31 == 0
    bits = 31 if coding != "deflate" else 15 if wrapped else -15
    out, at = [], 0
    while at < len(body):
        unpack = zlib.decompressobj(bits)
        try:
            while at < len(body) and not unpack.eof:
                out.append(unpack.decompress(body[at:at + PIECE]))
                at += len(body[at:at + PIECE]) - len(unpack.unused_data)
        except zlib.error:
            return b"".join(out), False
        if not unpack.eof:
            return b"".join(out), False
        if bits != 31:
            break
    return b"".join(out), True


def read_text(body: bytes, content_type: str) -> str:
    marked = next((name for mark, name in _MARKS if body.startswith(mark)), None)
    named = _CHARSET.search(content_type)
    meta = _META.search(body, 0, 4096)
    for name in (marked, named and named[1], meta and meta[1].decode()):
        try:
            if name:
                return body.decode(name, "replace")
        except (LookupError, UnicodeError, ValueError):     # no such charset, or not one of text
            continue
    return body.decode("utf-8", "replace")


def derivatives(record: bytes) -> list[tuple[Headers, str]]:
    """Headers and block of the records derived from one record."""
    parsed = parse_record(record)
    source, block = parsed or ([], b"")
    kind = (value_of(source, "WARC-Type") or "").lower()
    if parsed is not None and kind not in ("response", "resource"):
        return []
    name, text = value_of(source, "WARC-Record-ID"), None
    if parsed is None:
        own, fields = record_id("metadata", hashlib.sha1(record).hexdigest()), {"error": "not a WARC record"}
    else:
        own = record_id("metadata", name if name is not None else hashlib.sha1(record).hexdigest())
        fields, text = _described(source, block, kind)
    refers = [("WARC-Refers-To", name)] if name is not None else []
    kept = [(k, v) for k, v in source if k.lower() in {x.lower() for x in KEPT}]

    def made(kind: str, own: str, content_type: str, text: str) -> tuple[Headers, str]:
        data = text.encode("utf-8", "surrogatepass")
        return [("WARC-Type", kind), ("WARC-Record-ID", own), *refers, *kept, ("WARC-Block-Digest", digest(data)),
                ("Content-Type", content_type), ("Content-Length", str(len(data)))], text

    out = [made("metadata", own, "application/json", json.dumps(fields, ensure_ascii=False))]
    if text is not None:
        out.append(made("conversion", record_id("conversion", own if name is None else name), "text/plain; charset=utf-8", text))
    return out


def _described(source: Headers, block: bytes, kind: str) -> tuple[dict, str | None]:
    """The fields of the metadata record, and the plain text if there is one."""
    status, sent, body = None, [], block
    if kind == "response":
        end = _HTTP_END.search(block)
        head, body = (block[:end.start()], block[end.end():]) if end else (block, b"")
        status, *lines = re.split(r"\r?\n", head.decode("utf-8", "replace"))
        sent = header_pairs(lines) or [pair for line in lines for pair in header_pairs([line]) or []]
    faults = []
    length = value_of(source, "Content-Length")
    if length is None or not re.fullmatch("[0-9]+", length) or int(length) != len(block):
        faults.append("content-length")
    payload = body
    if "chunked" in (value_of(sent, "Transfer-Encoding") or "").lower():
        payload, whole = unchunk(body)
        faults += [] if whole else ["transfer-encoding"]
    content = payload
    codings = [c.strip().lower() for k, v in sent if k.lower() == "content-encoding" for c in v.split(",")]
    for coding in reversed([c for c in codings if c not in ("", "identity")]):
        if coding not in ("gzip", "x-gzip", "deflate"):
            content = None
            break
        content, whole = uncoded(content, coding)
        faults += [] if whole else ["content-encoding"]
    if content is None:
        faults.append("content-encoding")
    content_type = (value_of(sent, "Content-Type") if kind == "response" else value_of(source, "Content-Type")) or "text/html"
    media = content_type.partition(";")[0].strip().lower()
    text = title = None
    links: list[str] = []
    if content is not None and media in ("text/html", "application/xhtml+xml"):
        page = read_text(content, content_type)
        found = _TITLE.search(page)
        title = " ".join(html.unescape(found[1]).split()) if found else None
        links = [html.unescape(a or b or c) for a, b, c in _LINK.findall(_UNSEEN.sub(" ", page))]
        text = plain_text(page)
    elif content is not None and media == "text/plain":
        text = read_text(content, content_type)
    declared = value_of(source, "WARC-Payload-Digest")
    payload_holds = holds(declared, payload)
    if payload_holds is False and payload is not body:
        payload_holds = holds(declared, body)     # many writers digest the body as it was sent
    return {
        "warc-headers": source, "http-status": status, "http-headers": sent, "block-length": len(block), "payload-length": len(payload),
        "block-digest-holds": holds(value_of(source, "WARC-Block-Digest"), block), "payload-digest-holds": payload_holds,
        "faults": sorted(set(faults)), "title": title, "outlinks": links}, text


def _row(headers: Headers, block: str) -> tuple:
    of = {k.lower(): v for k, v in reversed(headers)}
    length = of.get("content-length", "")
    return (of.get("warc-type"), of.get("warc-record-id"), of.get("warc-refers-to"), of.get("warc-target-uri"), of.get("warc-date"), of.get("content-type"),
            int(length) if re.fullmatch("[0-9]{1,18}", length) else None, of.get("warc-block-digest"), of.get("warc-payload-digest"),
            [{"name": k, "value": v} for k, v in headers], block)


def derive(records: DataFrame) -> DataFrame:
    """``(page_id, ...)`` with the fields of ``RECORD``: the records derived from each (page_id, record), text or bytes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(page, *_row(*made)) for page, record in zip(batch["page_id"], batch["record"]) for made in derivatives(bytes(record or b""))]
            yield pd.DataFrame(rows, columns=["page_id", *_FIELDS])

    derived = records.select(F.col("page_id").cast("string"), F.col("record").cast("binary")).mapInPandas(run, f"page_id string, {RECORD}")
    return derived.withColumn("page_id", F.col("page_id").cast("long"))


def write_warc(derived: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """The records as WARC files below ``path``."""
    lines = F.concat_ws("\r\n", F.transform("headers", lambda h: F.concat_ws(": ", h["name"], h["value"])))
    text = F.concat(F.lit(f"{VERSION}\r\n"), lines, F.lit("\r\n\r\n"), F.col("block"))
    derived.select(text.alias("record")).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).text(path)


def split_records(data: bytes) -> Iterator[tuple[int, bytes, str | None]]:
    """Offset, bytes and fault (nothing if it is sound) of each record of a file."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        parsed = parse_record(data[at:end + 4]) if end >= 0 else None
        length = None if parsed is None else value_of(parsed[0], "Content-Length")
        if length is not None and re.fullmatch("[0-9]{1,18}", length):
            stop = end + 4 + int(length)
            if stop > len(data):
                yield at, data[at:], "cut off"
                return
            if data[stop:stop + 4] == b"\r\n\r\n" or stop == len(data):
                yield at, data[at:stop], None
                at = stop + 4
                continue
        # No header to go by: on to the next place where a record can begin.
        found = _NEXT.search(data, at + 1)
        stop = found.start() if found else len(data)
        yield at, data[at:stop].removesuffix(b"\r\n\r\n"), "no WARC header" if parsed is None else "wrong length"
        at = stop


def raw_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, offset, record, error)``: the bytes of each record below ``path``, as ``derive`` takes them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                data, whole = uncoded(content, "gzip") if content[:2] == b"\x1f\x8b" else (content, True)
                rows = []
                for offset, record, error in split_records(data):
                    rows.append((file, offset, record, error))
                    if len(rows) == ROWS:
                        yield pd.DataFrame(rows, columns=["file", "offset", "record", "error"])
                        rows = []
                if not whole:
                    rows.append((file, len(data), b"", "gzip cut off"))
                yield pd.DataFrame(rows, columns=["file", "offset", "record", "error"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, offset long, record binary, error string")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files below ``path`` with the fields of ``RECORD`` and ``error``; blocks as UTF-8."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for record, error in zip(batch["record"], batch["error"]):
                headers, block = parse_record(bytes(record)) or ([], bytes(record))
                rows.append((*_row(headers, block.decode("utf-8", "replace")), error))
            yield pd.DataFrame(rows, columns=[*_FIELDS, "error"])

    return raw_records(spark, path).mapInPandas(run, f"{RECORD}, error string")
