"""WARC derivatives: responses become linked metadata records and plain-text conversion records."""

from __future__ import annotations

import gzip
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A page's parts: comments, elements whose text is not shown, and tags; one that is not closed goes on to the end.
PART = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b[^>]*>(.*?)(?:</\1\s*>|\Z)|<title\b[^>]*>(.*?)(?:</title\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9-]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
BLANKS = re.compile(r"[^\S\n]+")
# Elements that start a line, and where elements keep their links.
LINES = frozenset(
    "address article aside blockquote body br caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section table tbody td tfoot th thead tr ul".split()
)
LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "source": "src", "video": "src", "audio": "src", "embed": "src", "form": "action"}
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

RECORD = (
    "warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
    "content_length bigint, block_digest string, source_payload_digest string, source_headers string, content string"
)
NAMES = [c.split()[0] for c in RECORD.split(", ")]


def attributes(tag: str) -> dict[str, str]:
    return {name.lower(): html.unescape(a or b or c or "") for name, a, b, c in ATTRIBUTE.findall(tag)}


def read_page(page: str, base: str) -> tuple[str, str, list[dict[str, str]], dict[str, str], str]:
    """Plain text, title, links, named meta values and language of a page.

    Text keeps a line for each block element; references are decoded, white space is collapsed, empty lines go.
    """
    out: list[str] = []
    title, lang, at = "", "", 0
    links: list[dict[str, str]] = []
    metas: dict[str, str] = {}
    for m in PART.finditer(page):
        out.append(page[at : m.start()].replace("\n", " "))
        at = m.end()
        if m[3] is not None:
            title = title or " ".join(html.unescape(m[3]).split())
        name = (m[5] or m[1] or "").lower()
        if not name:
            continue
        if name in LINES:
            out.append("\n")
        if m[4]:
            continue
        opening = m[6] if m[5] else page[m.start() : page.find(">", m.start()) + 1 or m.end()]
        if "=" not in opening:
            continue
        held = attributes(opening)
        if LINKS.get(name) in held:
            links.append({"path": f"{name.upper()}@/{LINKS[name]}", "url": joined(base, held[LINKS[name]])})
        elif name == "meta":
            key = held.get("name") or held.get("property") or held.get("http-equiv") or ("charset" if "charset" in held else "")
            if key:
                metas[key.lower()] = held.get("content", held.get("charset", ""))
        elif name == "html":
            lang = held.get("lang", "")
    out.append(page[at:].replace("\n", " "))
    text = BLANKS.sub(" ", html.unescape("".join(out)))
    return "\n".join(line for line in map(str.strip, text.split("\n")) if line), title, links, metas, lang


def joined(base: str, link: str) -> str:
    try:
        return urljoin(base, link)
    except ValueError:
        return link


def digest(raw: bytes) -> str:
    return "sha256:" + hashlib.sha256(raw).hexdigest()


def derived(record_id: str, uri: str | None, date: str, headers: str, payload: str, block: str, payload_digest: str) -> list[tuple]:
    """The metadata and the conversion record of a response."""
    text, title, links, metas, lang = read_page(payload, uri or "")
    status, _, fields = headers.partition("\r\n")
    http = [line.partition(":")[::2] for line in fields.split("\r\n") if line]
    told = {
        "Envelope": {
            "WARC-Header-Metadata": {
                "WARC-Type": "response", "WARC-Record-ID": record_id, "WARC-Target-URI": uri, "WARC-Date": date,
                "WARC-Block-Digest": block, "WARC-Payload-Digest": payload_digest,
            },
            "Payload-Metadata": {
                "HTTP-Response-Metadata": {
                    "Response-Message": status, "Headers": [[k, v.strip()] for k, v in http],
                    "HTML-Metadata": {"Head": {"Title": title, "Metas": metas, "Lang": lang}, "Links": links},
                }
            },
        }
    }
    rows = []
    for kind, content_type, content in (
        ("metadata", "application/json", json.dumps(told, ensure_ascii=False, sort_keys=True)), ("conversion", "text/plain; charset=utf-8", text),
    ):
        raw = content.encode("utf-8", "replace")
        own = f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{record_id} {kind}')}>"
        rows.append((kind, own, record_id, uri, date, content_type, len(raw), digest(raw), payload_digest, headers, content))
    return rows


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table of pages (page_id, url, html): page_id, record_id, target_uri, warc_date, http_headers,
    payload, block_digest, payload_digest. The id follows from page_id, url and html, so rows repeated as a whole share one.
    """
    payload = F.coalesce("html", F.lit(""))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n"))
    digits = F.md5(F.concat_ws("\n", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")), payload))
    return pages.select(
        "page_id", F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>").alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"), headers.alias("http_headers"), payload.alias("payload"),
        _sha(F.concat(headers, F.lit("\r\n"), payload)).alias("block_digest"), _sha(payload).alias("payload_digest"),
    )


def _sha(column: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(column, 256))


def derivatives(given: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Two records for every response: its metadata (links, title, metas, source headers and digests as JSON) and its plain text.

    given has record_id, target_uri, warc_date, http_headers, payload, block_digest, payload_digest. Both records refer to the
    response by its id and carry its URI, date, headers and payload digest unchanged; their own ids
    follow from it, and their block digests and lengths are of their content in UTF-8. keep names columns of given to hand on.
    Null payloads and headers count as empty; null URIs stay null; repeated rows give repeated records. No shuffle.
    """
    keep = keep or []
    kept = [given.schema[c] for c in keep]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            columns = [batch[c].to_pylist() for c in ("record_id", "target_uri", "warc_date", "http_headers", "payload", "block_digest", "payload_digest")]
            rows = [r for source in zip(*columns, strict=True) for r in derived(*source)]
            twice = [i for i in range(batch.num_rows) for _ in range(2)]
            out = [batch[c].take(pa.array(twice, pa.int64())) for c in keep]
            out += [pa.array([r[i] for r in rows], pa.int64() if n == "content_length" else pa.string()) for i, n in enumerate(NAMES)]
            yield pa.RecordBatch.from_arrays(out, [*keep, *NAMES])

    lead = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    source = given.select(
        *keep, *[c for c in ("record_id", "target_uri", "warc_date") if c not in keep],
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("http_headers", "payload", "block_digest", "payload_digest") if c not in keep],
    )
    return source.mapInArrow(batches, f"{lead}, {RECORD}" if lead else RECORD)


def framed(record: dict) -> bytes:
    """A record as it stands in a WARC file, as a gzip member of its own."""
    body = (record["content"] or "").encode("utf-8", "replace")
    fields = [
        ("WARC-Type", record["warc_type"]), ("WARC-Record-ID", record["record_id"]), ("WARC-Date", record["warc_date"]),
        ("WARC-Target-URI", record["target_uri"]), ("WARC-Refers-To", record["refers_to"]), ("WARC-Refers-To-Target-URI", record["target_uri"]),
        ("WARC-Refers-To-Date", record["warc_date"]), ("WARC-Block-Digest", record["block_digest"]),
        ("WARC-Refers-To-Payload-Digest", record["source_payload_digest"]), ("Content-Type", record["content_type"]), ("Content-Length", str(len(body))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v)
    return gzip.compress(head.encode() + b"\r\n" + body + b"\r\n\r\n", mtime=0)


def segments(records: DataFrame, segment_bytes: int = 64 << 20) -> DataFrame:
    """(partition, segment, n_records, warc): the records as .warc.gz contents of about segment_bytes, each a valid file."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[bytes] = []
        size, number, partition = 0, 0, TaskContext.get().partitionId()

        def row() -> pa.RecordBatch:
            values = [[partition], [number], [len(held)], [b"".join(held)]]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["partition", "segment", "n_records", "warc"])

        for batch in parts:
            for record in batch.to_pylist():
                held.append(framed(record))
                size += len(held[-1])
                if size >= segment_bytes:
                    yield row()
                    held, size, number = [], 0, number + 1
        if held:
            yield row()

    return records.select(*NAMES).mapInArrow(batches, "partition int, segment int, n_records bigint, warc binary")
