"""WARC derivatives: from each response a metadata and a plain-text conversion record.

Both refer to the response by its identifier and carry its target, its date and the digests of what
they were made from, so a derivative can be traced back and checked without the source file. Identifiers of derived
records are made of the source identifier and the record type, so a repeated run writes the same records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.llm.tables import slices

RESPONSES = ("record_id string, target_uri string, date string, http_headers string, payload string, "
             "block_digest string, payload_digest string")
DERIVED = ("warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
           "content_length long, block_digest string, source_payload_digest string, source_headers map<string,string>, block string")

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BLOCK = re.compile(r"</?(?:p|div|h[1-6]|li|ul|ol|tr|table|section|article|header|footer|nav|br|hr|title|body|blockquote|pre)\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^>]*>|<![^>]*>|<\?[^>]*>")
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.S | re.I)
_HREF = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def digest(data: bytes) -> str:
    """Labelled digest as archives write it: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(*parts: str | None) -> str:
    """A record identifier that depends on nothing but its parts."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join('' if p is None else p for p in parts))}>"


def plain_text(page: str) -> str:
    """Visible text: no scripts, styles or comments, one line per block element, entities resolved."""
    text = _TAG.sub("", _BLOCK.sub("\n", _HIDDEN.sub(" ", page)))
    lines = (" ".join(x.split()) for x in html.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def headers(http: str | None) -> dict[str, str]:
    """Header fields of an HTTP response, names in lower case; a repeated field keeps all values."""
    out: dict[str, str] = {}
    for line in (http or "").splitlines()[1:]:
        name, colon, value = line.partition(":")
        if colon and name.strip():
            key = name.strip().lower()
            out[key] = f"{out[key]}, {value.strip()}" if key in out else value.strip()
    return out


def responses_of(pages: DataFrame, date: str, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, response columns): stored pages as response records. ``date`` is the capture time of all of them."""
    kind = pages.schema[page_id].dataType.simpleString()

    def run(batches):
        for part in slices(batches, "_page"):
            rows = []
            for i, u, body in zip(*(part.column(c).to_pylist() for c in ("_id", "_url", "_page"))):
                raw = (body or "").encode("utf-8", "replace")
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(raw)}\r\n\r\n"
                rows.append((urn("response", None if i is None else str(i), u, date), u, date, http, body or "", digest(http.encode() + raw), digest(raw)))
            columns = [pa.array(c, pa.string()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([part.column("_id"), *columns], names=["_id", *[c.split()[0] for c in RESPONSES.split(", ")]])

    source = pages.select(pages[page_id].alias("_id"), pages[url].cast("string").alias("_url"), pages[page].cast("string").alias("_page"))
    return source.mapInArrow(run, f"_id {kind}, {RESPONSES}").withColumnRenamed("_id", page_id)


def _derive(record_id, target, date, http, payload, block_digest, payload_digest) -> Iterator[tuple]:
    """The metadata and the conversion record of one response."""
    source = headers(http)
    body = payload or ""
    title = _TITLE.search(body)
    links = dict.fromkeys(html.unescape(a or b or c).strip() for a, b, c in _HREF.findall(_HIDDEN.sub(" ", body)))
    fields = [("source-payload-digest", payload_digest), ("source-block-digest", block_digest), ("source-date", date),
              ("title", " ".join(html.unescape(_TAG.sub("", title[1])).split()) if title else None)]
    fields += [(f"http-header-{k}", v) for k, v in source.items()] + [("outlink", x) for x in links if x]
    lines = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields if v)
    for kind, content, block in (("metadata", "application/warc-fields", lines), ("conversion", "text/plain; charset=utf-8", plain_text(body))):
        raw = block.encode("utf-8", "replace")
        yield (kind, urn(kind, record_id), record_id, target, date, content, len(raw), digest(raw), payload_digest, list(source.items()), block)


def derivatives(responses: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: none) and the derived columns, two rows per response: metadata, then conversion.

    A null or empty payload gives a metadata record without title and links and an empty conversion. Null
    headers, targets, dates and digests stay null and are left out of the metadata; a null identifier is
    referred to as null. Repeated responses give repeated records. Nothing is shuffled.
    """
    names = [c.split()[0] for c in RESPONSES.split(", ")]
    kept = [c for c in keep or [] if c not in [d.split()[0] for d in DERIVED.split(", ")]]
    source = responses.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(kept)], *names)
    types = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]

    def run(batches):
        for part in slices(batches, "payload"):
            rows = [r for x in zip(*(part.column(c).to_pylist() for c in names)) for r in _derive(*x)]
            twice = pa.array([i for i in range(part.num_rows) for _ in range(2)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(i).take(twice) for i in range(len(kept))] + [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                names=[*kept, *[d.split()[0] for d in DERIVED.split(", ")]])

    schema = ", ".join([f"`{c}` {f.dataType.simpleString()}" for c, f in zip(kept, source.schema)] + [DERIVED])
    return source.mapInArrow(run, schema)


def serialized(derived: DataFrame, compress: bool = True) -> DataFrame:
    """(record_id, record): the bytes of each derived record; end to end, in any order, they are a WARC file.

    With ``compress`` every record is a gzip member of its own, as archives have it.
    """
    columns = ["warc_type", "record_id", "refers_to", "target_uri", "date", "content_type", "block_digest", "source_payload_digest", "block"]

    def run(batches):
        for part in slices(batches, "block"):
            out = []
            for kind, own, refers, target, date, content, block_digest, source, block in zip(*(part.column(c).to_pylist() for c in columns)):
                raw = block.encode("utf-8", "replace")
                fields = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", refers), ("WARC-Target-URI", target), ("WARC-Date", date),
                          ("WARC-Block-Digest", block_digest), ("WARC-Source-Payload-Digest", source), ("Content-Type", content), ("Content-Length", str(len(raw)))]
                record = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v).encode("utf-8", "replace") + b"\r\n" + raw + b"\r\n\r\n"
                out.append(gzip.compress(record, mtime=0) if compress else record)
            yield pa.RecordBatch.from_arrays([part.column("record_id"), pa.array(out, pa.binary())], names=["record_id", "record"])

    return derived.select(*columns).mapInArrow(run, "record_id string, record binary")


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of all records of a WARC file, plain or of gzip members; a cut-off last record is left out."""
    if data[:2] == b"\x1f\x8b":
        plain = []
        while data:
            unzip = zlib.decompressobj(31)
            plain.append(unzip.decompress(data))
            data = unzip.unused_data
        data = b"".join(plain)
    at = 0
    while True:
        while data[at:at + 2] == b"\r\n":  # what closes the record before
            at += 2
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").strip().split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields.get("content-length", "0"))
        if end + 4 + size > len(data):
            return
        yield fields, data[end + 4:end + 4 + size]
        at = end + 4 + size


def read_responses(files: DataFrame) -> DataFrame:
    """Responses of archive files, from the (path, content) rows of Spark's ``binaryFile`` source; other records are passed over."""
    names = [c.split()[0] for c in RESPONSES.split(", ")]

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields, block in records(content.as_py() or b""):
                    if fields.get("warc-type") == "response":
                        head, gap, body = block.partition(b"\r\n\r\n")
                        rows.append((fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-date"),
                                     (head + gap).decode("utf-8", "replace"), body.decode("utf-8", "replace"),
                                     fields.get("warc-block-digest") or digest(block), fields.get("warc-payload-digest") or digest(body)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)

    return files.select("content").mapInArrow(run, RESPONSES)
