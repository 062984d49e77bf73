"""Derivatives of WARC files: for every response one metadata and one conversion record, linked to it.

``read_warc`` reads WARC files (plain or gzip, also with a member per record) as rows of one record: its id, type,
target, date, fields, stored digests and block bytes. Spark's text reader cuts the files at the end of a record with the next one's
version; where a record really ends its Content-Length alone says, from the file's first record on, so a page that holds
that mark is put together again and can make no records of its own. A gzip file is one task's, as it comes; plain files are split
for reading, and their pieces are then sorted by their place, a file a task. No file is held as a whole.

``derivatives`` makes two records of every response: the metadata record (application/warc-fields) holds what is known of the
response: its id, payload digest, status, HTTP header fields, title, language and outgoing links. The conversion record
(text/plain) holds the visible text. Both name the response in WARC-Refers-To with its own record id, keep its date and
target, and name each other in WARC-Concurrent-To; the payload digest is the stored one where there is one (``digest_ok`` tells
whether the bytes have it), and block and payload digests of the new records are those of their own bytes.

``responses`` turns a table of pages into response records, with ids as version-5 UUIDs of the page's id and address, and
``write_records`` writes records as WARC 1.1 text, one file a partition. Everything is one pass without a shuffle; a task holds
a few records at a time, and pages are scanned in linear time.

Defined results: a null body is empty; a null url gives the empty target "urn:none"; a null id is the id
"none"; a page without a date has that of ``DATE``; rows that repeat give records of the same ids; records of other types are
left out of the derivatives; a block shorter than its Content-Length is taken as far as it goes, and ``whole`` is false;
a record whose Content-Length is absent, or does not end where a record can end, is not whole either, and reading goes on
at the next mark; one that the file's end cuts off takes the file's rest; of blocks over ``MOST`` bytes only so many are kept, and they are not
whole. Records that are not whole have no derivatives; bytes that are not text in the stated or default encoding become replacement signs; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm.util import named

DATE = "1970-01-01T00:00:00Z"  # where the source has no date
MOST = 256 << 20  # bytes of a block that are kept
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tapewright:warc")

_HEAD = re.compile(rb"HTTP/[0-9.]+ ([0-9]{3})[^\r\n]*\r?\n")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)
_TAG = re.compile(r"<(?:/?([A-Za-z][A-Za-z0-9]*)|[!?])")
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_HIDDEN = {name: re.compile(rf"</{name}", re.I) for name in ("script", "style", "noscript", "template")}
_BREAKS = frozenset(
    "p div br h1 h2 h3 h4 h5 h6 li ul ol tr table section article header footer nav blockquote pre hr title head body".split()
)

COLUMNS = (
    "page_id", "warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "date", "content_type",
    "block_digest", "payload_digest", "source_digest", "digest_ok", "content_length", "block",
)
_KINDS = {"digest_ok": "boolean", "content_length": "long"}
RECORD = (
    "page_id string, warc_type string, record_id string, target_uri string, date string, content_type string, "
    "block_digest string, payload_digest string, fields map<string,string>, whole boolean, block binary"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(kind: str, page: str, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{kind} {page} {url}')}>"


def split_response(body: str | bytes) -> tuple[str | None, list[tuple[str, str]], str | bytes]:
    """Status, header fields and payload."""
    data = body.encode("utf-8", "surrogatepass") if isinstance(body, str) else body
    if not (match := _HEAD.match(data)):
        return None, [], body
    fields, at = [], match.end()
    while True:
        end = data.find(b"\n", at)
        if end < 0:
            return None, [], body  # the header never ends
        line = data[at:end].rstrip(b"\r").decode("utf-8", "replace")
        at = end + 1
        if not line:
            break
        name, colon, value = line.partition(":")
        if colon:
            fields.append((name.strip(), value.strip()))
    payload = data[at:]
    return match[1].decode(), fields, payload.decode("utf-8", "surrogatepass") if isinstance(body, str) else payload


class Page:
    """Visible text, title, language and links of a page, from one scan over its tags."""

    def __init__(self, page: str) -> None:
        self.title: str | None = None
        self.language: str | None = None
        self.links: list[str] = []
        parts: list[str] = []
        at, titled = 0, -1  # titled: where the parts of an open title begin
        while (start := page.find("<", at)) >= 0:
            parts.append(page[at:start])
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                parts.append(" ")
                at = end + 3 if end >= 0 else len(page)
                continue
            tag = _TAG.match(page, start)
            if not tag:
                parts.append("<")
                at = start + 1
                continue
            end = page.find(">", start)
            if end < 0:  # no tag ends any more: the rest is text
                parts.append(page[start:])
                at = len(page)
                break
            name, closing, at = (tag[1] or "").lower(), page[start + 1] == "/", end + 1
            if name in _HIDDEN and not closing:
                ends = _HIDDEN[name].search(page, at)
                parts.append(" ")
                at = ends.start() if ends else len(page)
                continue
            if name == "title":
                if not closing and titled < 0 and self.title is None:
                    titled = len(parts)
                elif closing and titled >= 0:
                    self.title, titled = _one_line("".join(parts[titled:])), -1
            elif name == "a" and not closing and (href := _HREF.search(page, start, end + 1)):
                self.links.append(_one_line(href[1] or href[2] or href[3] or ""))
            elif name == "html" and self.language is None and (lang := _LANG.search(page, start, end + 1)):
                self.language = lang[1]
            if name in _BREAKS:
                parts.append("\n")
        parts.append(page[at:])
        lines = (" ".join(line.split()) for line in html.unescape("".join(parts)).split("\n"))
        self.text = "\n".join(line for line in lines if line)


def plain_text(page: str) -> str:
    """The visible text: hidden elements gone, block elements on lines of their own."""
    return Page(page).text


def _one_line(value: str) -> str:
    return " ".join(html.unescape(value).split())


def _decoded(payload: bytes, fields: list[tuple[str, str]]) -> str:
    """Text in the encoding that the header or the page's first bytes state; else UTF-8."""
    stated = next((v for k, v in fields if k.lower() == "content-type"), "")
    found = _CHARSET.search(stated) or _CHARSET.search(payload[:1024].decode("ascii", "ignore"))
    try:
        return payload.decode(found[1] if found else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derive(record: dict) -> list[tuple]:
    """The metadata and the conversion record of one response, in the order of ``COLUMNS``."""
    target, page_id = record["target_uri"] or "urn:none", record["page_id"]
    status, fields, payload = split_response(record["block"] or b"")
    stored, own = record["payload_digest"], digest(payload)
    source, response = stored or own, record["record_id"]
    meta, text = (record_id(kind, response, target) for kind in ("metadata", "conversion"))
    page = Page(_decoded(payload, fields))
    known = [("refers-to", response), ("payload-digest", source), ("payload-length", str(len(payload)))]
    known += [("http-status", status)] if status else []
    known += [(f"http-header-{name.lower()}", value) for name, value in fields]
    known += [("title", page.title)] if page.title else []
    known += [("language", page.language)] if page.language else []
    known += [("outlink", x) for x in page.links]
    blocks = (
        ("metadata", meta, text, "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in known)),
        ("conversion", text, meta, "text/plain; charset=utf-8", page.text),
    )
    out = []
    for kind, name, other, content, block in blocks:
        data = block.encode("utf-8", "replace")
        out.append(
            (page_id, kind, name, response, other, target, record["date"] or DATE, content, digest(data), digest(data), source, source == own, len(data), data.decode())
        )
    return out


def _derived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [{"boolean": pa.bool_(), "long": pa.int64()}.get(_KINDS.get(c, ""), pa.string()) for c in COLUMNS]
    for batch in batches:
        for at in range(0, len(batch), 200):
            records = [r for row in batch.slice(at, 200).to_pylist() for r in derive(row)]
            columns = list(zip(*records, strict=True)) or [[]] * len(COLUMNS)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(COLUMNS))


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows per whole response, with the columns ``COLUMNS``; content_length in bytes."""
    rows = records.where("warc_type = 'response' and whole").select("page_id", "record_id", "target_uri", "date", "payload_digest", "block")
    return rows.mapInArrow(_derived, ", ".join(f"{c} {_KINDS.get(c, 'string')}" for c in COLUMNS))


def responses(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", body_column: str = "html", date_column: str | None = None
) -> DataFrame:
    """A response record for every page; a body that begins with an HTTP status line is a whole response."""
    page, url, body = named(id_column, url_column, body_column)
    date = named(date_column)[0].cast("string") if date_column else F.lit(None).cast("string")
    rows = pages.select(page.cast("string").alias("page_id"), url.alias("url"), body.alias("body"), date.alias("date"))
    return rows.mapInArrow(_responses, RECORD)


_RECORD_TYPES = (pa.string(),) * 8 + (pa.map_(pa.string(), pa.string()), pa.bool_(), pa.binary())
_RECORD_NAMES = (
    "page_id", "warc_type", "record_id", "target_uri", "date", "content_type", "block_digest", "payload_digest", "fields", "whole", "block",
)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_RECORD_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _RECORD_TYPES, strict=True)], names=list(_RECORD_NAMES))


def _responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 200):
            out = []
            for page_id, url, body, date in zip(*(c.slice(at, 200).to_pylist() for c in batch.columns), strict=True):
                data, page, target = (body or "").encode("utf-8", "surrogatepass"), page_id or "none", url or "urn:none"
                payload = split_response(data)[2]
                name = record_id("response", page, target)
                kind = "application/http; msgtype=response"
                out.append((page_id, "response", name, target, date or DATE, kind, digest(data), digest(payload), [("X-Page-ID", page)], True, data))
            yield _records(out)


def derive_records(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", body_column: str = "html", date_column: str | None = None
) -> DataFrame:
    """The derivatives of a table of pages."""
    return derivatives(responses(pages, id_column, url_column, body_column, date_column))


def _line(name: str, value: Column | str) -> Column:
    """A header line, or nothing where the value is null."""
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_records(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records as WARC 1.1, one file a partition. With ``compression="none"`` the files can be sought and split."""
    own = set(records.columns)
    lines = [("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Date", "date"), ("WARC-Target-URI", "target_uri")]
    lines += [("WARC-Refers-To", "refers_to"), ("WARC-Concurrent-To", "concurrent_to"), ("WARC-Block-Digest", "block_digest")]
    lines += [("WARC-Payload-Digest", "payload_digest"), ("Content-Type", "content_type")]
    block = F.col("block").cast("binary")
    head = [F.coalesce(_line(name, F.col(c)), F.lit("")) for name, c in lines if c in own]
    if "fields" in own:
        known = F.map_filter("fields", lambda k, _: F.lower(k).like("x-%"))
        head.append(F.coalesce(F.array_join(F.transform(F.map_entries(known), lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit("\r\n"))), ""), F.lit("")))
    head.append(_line("Content-Length", F.octet_length(block).cast("string")))
    whole = F.concat(F.concat(F.lit("WARC/1.1\r\n"), *head, F.lit("\r\n")).cast("binary"), block, F.lit("\r\n").cast("binary"))
    records.select(whole.cast("string").alias("value")).write.option("lineSep", "\r\n").option("compression", compression).text(path)


_BLANK = b"\r\n\r\n"
_MARK = _BLANK + b"WARC/"


def head_of(piece: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields and where the block begins, of a piece that begins with a version line (the word WARC/ may be missing).

    Where the header's end was taken for a mark, as the block itself begins with WARC/, the block begins inside that mark.
    """
    lines, at = [], 0
    while at <= len(piece):
        end = piece.find(b"\n", at)
        if end < 0:
            line, at = piece[at:].decode("utf-8", "replace"), len(piece) + len(_BLANK)
        else:
            line, at = piece[at:end].rstrip(b"\r").decode("utf-8", "replace"), end + 1
        if not line:
            break
        if line[:1] in " \t" and lines:
            lines[-1] += " " + line.strip()  # a folded field
        else:
            lines.append(line)
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    if not re.fullmatch(r"(?:WARC/)?\d+\.\d+", lines[0].strip() if lines else "") or "warc-type" not in fields:
        return None
    return fields, at


class Framer:
    """Records out of a file's pieces, in their order; a piece ends where a mark began."""

    def __init__(self) -> None:
        self.pieces: list[bytes] = []  # of the open record
        self.kept = self.missing = 0

    def add(self, piece: bytes) -> Iterator[tuple]:
        if self.pieces:
            self.missing -= len(_MARK)
        elif (head := head_of(piece)) is None:
            return
        else:
            fields, at = head
            length = fields.get("content-length", "")
            if not re.fullmatch(r"[0-9]{1,18}", length):
                yield _record(fields, piece[at:], False)
                return
            self.fields, self.at, self.kept, self.missing = fields, at, 0, int(length) + at
        self.missing -= len(piece)
        self.kept += len(piece)
        if self.kept <= MOST or not self.pieces:
            self.pieces.append(piece)
        if self.missing > 0:
            return  # the block goes on after a mark of its own
        rest = -self.missing
        body = _MARK.join(self.pieces)[self.at :]
        if self.kept > MOST:
            yield _record(self.fields, body[:MOST], False)
        elif not rest or not body[-rest:].strip(b"\r\n"):
            yield _record(self.fields, body[: len(body) - rest], True)
        else:
            yield from self.resume()
            return
        self.pieces = []

    def resume(self) -> Iterator[tuple]:
        """The length is wrong: the record ends at its first mark, and what follows is looked at anew."""
        first, *others = self.pieces
        yield _record(self.fields, first[self.at :], False)
        self.pieces = []
        for piece in others:
            yield from self.add(piece)

    def end(self) -> Iterator[tuple]:
        """The end of the file."""
        if self.pieces:
            yield _record(self.fields, _MARK.join(self.pieces)[self.at :][:MOST], False)
        self.pieces = []


def _record(fields: dict[str, str], block: bytes, whole: bool) -> tuple:
    get = fields.get
    return (
        get("x-page-id"), get("warc-type"), get("warc-record-id"), get("warc-target-uri"), get("warc-date"), get("content-type"),
        get("warc-block-digest"), get("warc-payload-digest"), list(fields.items()), whole, block,
    )


def parse(data: bytes) -> tuple | None:
    """One record from its version line on; None if it is none."""
    framer = Framer()
    return next((r for piece in data.split(_MARK) for r in framer.add(piece)), None) or next(framer.end(), None)


def _framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from (file, piece), sorted; a few at a time."""
    framer, at_file, found, size = Framer(), None, [], 0
    for batch in batches:
        for at in range(0, len(batch), 200):
            for file, piece in zip(*(c.slice(at, 200).to_pylist() for c in batch.columns), strict=True):
                if file != at_file:
                    found += framer.end()
                    at_file = file
                for record in framer.add(piece):
                    found.append(record)
                    size += len(record[-1])
                if size > 8 << 20 or len(found) >= 200:
                    yield _records(found)
                    found, size = [], 0
    found += framer.end()
    yield _records(found)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: page_id (of X-Page-ID, where pages were written), warc_type, record_id, target_uri, date,
    content_type, block_digest, payload_digest, fields (all header fields, names in lower case), whole, block (bytes)."""
    text = spark.read.option("lineSep", _MARK.decode()).text(path)
    piece = F.col("value").cast("binary").alias("piece")
    if all(name.endswith(".gz") for name in text.inputFiles()):
        pieces = text.select(F.col("_metadata.file_path").alias("file"), piece)
    else:
        placed = text.select(F.col("_metadata.file_path").alias("file"), piece, F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
        pieces = placed.repartition("file").sortWithinPartitions("file", "block", "at").select("file", "piece")
    return pieces.mapInArrow(_framed, RECORD)
