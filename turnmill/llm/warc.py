"""WARC archives: writing captures, and assembling transactions from the records read back.

A capture is a request, a response (or a revisit of an earlier response with the same
payload) and a metadata record; request and metadata name the response in their
``WARC-Concurrent-To`` header. Each record is a gzip member of its own.

Rows with a null payload have an empty one. A null page id sorts last among the rows of a
payload. Repeated rows are captures of their own; record ids come from the archive's name
and the place in it, so they never meet. An empty table gives no file and no rows. Other columns are not
read, so their names don't matter.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.llm.common import attach, bounded_batches, filesystem, spread, staged, write_file
from turnmill.session import run_dir

#: Payloads below this many bytes are always kept in full.
REVISIT_FROM_BYTES = 100
#: Uncompressed bytes after which a task opens its next archive.
ARCHIVE_BYTES = 128 << 20
DATE = "2024-01-01T00:00:00Z"
LEVEL = 4
READ_BYTES = 1 << 20

RECORD = (
    "record_id string, type string, target_uri string, concurrent_to array<string>, refers_to string, "
    "payload_digest string, payload_bytes long, digest_ok boolean, fields map<string,string>, payload binary"
)


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", LEVEL, mtime=0)


def one_line(value: str | None) -> str:
    """A header's value: line ends would start a new header."""
    return " ".join((value or "").split())


def capture(archive: str, number: int, row: dict) -> bytes:
    """The three records of a row: page_id, url, payload (None for a revisit), digest, bytes, first."""
    own, asked_id, meta_id = (f"<urn:uuid:{uuid.uuid5(uuid.UUID(archive), f'{kind}:{number}')}>" for kind in "abc")
    url = one_line(row["url"])
    base = [("WARC-Date", DATE), ("WARC-Target-URI", url)]
    host, _, path = url.partition("://")[2].partition("/")
    asked = f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    head = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n"
    ).encode()
    kind = [("WARC-Payload-Digest", f"sha256:{row['digest']}"), ("Content-Type", "application/http;msgtype=response")]
    if row["payload"] is None:
        what, body = "revisit", b""
        kind += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To-Target-URI", one_line(row["first"]["url"])),
            ("WARC-Refers-To-Date", DATE),
        ]
    else:
        what, body = "response", row["payload"]
    page = "" if row["page_id"] is None else f"page-id: {row['page_id']}\r\n"
    parts = [
        record(
            [("WARC-Type", "request"), ("WARC-Record-ID", asked_id), *base,
             ("WARC-Concurrent-To", own), ("Content-Type", "application/http;msgtype=request")],
            asked,
        ),
        record([("WARC-Type", what), ("WARC-Record-ID", own), *base, *kind], head + body),
        record(
            [("WARC-Type", "metadata"), ("WARC-Record-ID", meta_id), *base,
             ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")],
            page.encode(),
        ),
    ]
    return b"".join(parts)


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the captures of ``pages`` to the shared folder; returns the manifest (path, n_captures).

    Of rows with one payload those with the least page id are written in full. A revisit
    names the payload's digest, by which readers find its response.
    """
    body = F.coalesce(F.encode(F.col(html), "utf-8"), F.lit(b""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        body.alias("payload"),
        F.sha2(body, 256).alias("digest"),
        F.length(body).cast("long").alias("bytes"),
    ).select(
        "*",
        # Short payloads have no first row: a null key finds nothing.
        F.when(F.col("bytes") >= REVISIT_FROM_BYTES, F.col("digest")).alias("key"),
        F.xxhash64("page_id", "url").alias("salt"),
    )
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "url")
    found = attach(rows, "key", rows.select("key", "salt", "page_id", "url"), (F.min(order).alias("first"), "min"))
    revisit = F.col("first").isNotNull() & ~F.col("first")["page_id"].eqNullSafe(F.col("page_id"))
    found = found.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "digest", "bytes", "first"
    )
    folder = run_dir(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for row in rows:
            count, archive = 0, str(uuid.uuid4())

            def parts(row=row, archive=archive):
                nonlocal count
                size = 0
                while row is not None:
                    count += 1
                    size += row["bytes"] + 1000
                    yield capture(archive, count, row)
                    row = next(rows, None) if size < ARCHIVE_BYTES else None

            path = write_file(folder, ".warc.gz", parts())
            yield pa.RecordBatch.from_pydict({"path": [path], "n_captures": [count]})

    return staged(bounded_batches(found).mapInArrow(write, "path string, n_captures long"), "warc-manifest")


def members(path: str) -> Iterator[bytes]:
    """The uncompressed records of an archive, one at a time."""
    fs, inner = filesystem(path)
    with fs.open_input_stream(inner, compression=None) as raw:
        engine, parts, rest = zlib.decompressobj(31), [], b""
        while True:
            data = rest or raw.read(READ_BYTES)
            if not data:
                break
            parts.append(engine.decompress(data))
            rest = engine.unused_data
            if engine.eof:
                yield b"".join(parts)
                engine, parts = zlib.decompressobj(31), []
        if parts and any(parts):
            raise ValueError(f"{path} ends inside a record")


def parse(data: bytes, with_payload: bool) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    pairs = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
    named = dict(pairs)
    block = rest[: int(named["content-length"])]
    out = {
        "record_id": named["warc-record-id"], "type": named["warc-type"], "target_uri": named.get("warc-target-uri"),
        "concurrent_to": [v for k, v in pairs if k == "warc-concurrent-to"], "refers_to": named.get("warc-refers-to-target-uri"),
        "payload_digest": named.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        "payload_bytes": None, "digest_ok": None, "fields": None, "payload": None,
    }
    if named["warc-type"] in ("response", "revisit"):
        http, _, body = block.partition(b"\r\n\r\n")
        if named["warc-type"] == "response":
            digest = hashlib.sha256(body).hexdigest()
            out |= {"payload_bytes": len(body), "digest_ok": digest == out["payload_digest"], "payload_digest": digest}
            out["payload"] = body if with_payload else None
        else:  # the payload is elsewhere; its length stands in the kept response head
            sizes = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            out["payload_bytes"] = int(sizes[0]) if sizes else None
    elif named["warc-type"] == "metadata":
        fields = (x.partition(":") for x in block.decode().split("\r\n") if x)
        out["fields"] = [(k.strip(), v.strip()) for k, _, v in fields]
    return out


def read_records(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives named in ``manifest.path``; each archive is streamed by one task."""
    schema = pa.schema(
        [("record_id", pa.string()), ("type", pa.string()), ("target_uri", pa.string()),
         ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("payload_digest", pa.string()),
         ("payload_bytes", pa.int64()), ("digest_ok", pa.bool_()), ("fields", pa.map_(pa.string(), pa.string())),
         ("payload", pa.binary())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                for data in members(path):
                    rows.append(parse(data, with_payload))
                    size += len(data) if with_payload else 500
                    if size > READ_BYTES * 8:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return spread(manifest.select("path")).mapInArrow(read, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response (or revisit), its request and its metadata records.

    Links run from a request or metadata record to the response or the other way round.
    A record id that occurs twice counts once. Captures without request or metadata have
    null there; requests that name no known response are left out.
    """
    main = records.where(F.col("type").isin("response", "revisit")).dropDuplicates(["record_id"])
    others = records.where(F.col("type").isin("request", "metadata"))
    forth = others.select(F.col("record_id").alias("other"), F.explode("concurrent_to").alias("main"))
    back = main.select(F.explode("concurrent_to").alias("other"), F.col("record_id").alias("main"))
    links = forth.unionByName(back).distinct()
    part = F.struct("record_id", "target_uri", "fields", "payload")
    joined = others.select(F.col("record_id").alias("other"), "type", part.alias("part")).join(links, "other")
    of = lambda kind: F.when(F.col("type") == kind, F.col("part"))
    gathered = joined.groupBy(F.col("main").alias("record_id")).agg(
        F.min_by(of("request"), F.when(F.col("type") == "request", F.col("other"))).alias("request"),
        F.min_by(of("metadata"), F.when(F.col("type") == "metadata", F.col("other"))).alias("metadata"),
    )
    response = F.struct("type", "target_uri", "refers_to", "payload_digest", "payload_bytes", "digest_ok", "payload")
    return main.select("record_id", response.alias("response")).join(gathered, "record_id", "left")


def page_of(captures: DataFrame) -> Column:
    """The page id a capture's metadata record carries."""
    return F.col("metadata")["fields"]["page-id"].cast("long")


def page_captures(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Captures with the page they hold and, for revisits, the page of the response with that payload.

    Many revisits may share a response: they are dealt to pieces, each of which gets the
    response's page.
    """
    captures = staged(assemble(staged(read_records(manifest, with_payload), "warc-records")), "captures")
    response = F.col("response")
    full = (response["type"] == "response") & (response["payload_bytes"] >= REVISIT_FROM_BYTES)
    known = captures.select(
        response["payload_digest"].alias("key"),
        F.xxhash64("record_id").alias("salt"),
        F.when(full, page_of(captures)).alias("page_id"),
    )
    asking = captures.select(
        "*",
        page_of(captures).alias("page_id"),
        F.when(response["type"] == "revisit", response["payload_digest"]).alias("key"),
        F.xxhash64("record_id").alias("salt"),
    )
    return attach(asking, "key", known, (F.min("page_id").alias("refers_to_page"), "min")).drop("key", "salt")
