"""WARC files: writing captures, reading records, assembling transactions.

A capture is three records: a request, a response (or a revisit of an earlier equal payload), and a
metadata record; request and metadata name the capture by WARC-Concurrent-To. ``write`` gives each
task one gzip file (a member per record) that appears by an atomic rename. ``read`` parses records
of any such file, compressed or plain. ``assemble`` joins the records of a transaction through their
concurrent-to identifiers, in whichever direction they point, into one nested row per capture.

Equal payloads of at least ``LEAST_REVISIT`` bytes: the row with the largest page_id is the response,
the others are revisits that refer to it. That choice is an aggregate of (digest, page_id) joined
back on the digest: broadcast if few digests repeat, else dealt by a salt, as one digest may be that of a
third of all pages, and rows without one are spread.

Defined cases: null html -> empty payload; null page_id -> written, a revisit if an equal payload has
an id; rows equal in page_id and payload -> all of them responses (or all revisits); empty table -> no
file, no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, urlsplit
from uuid import UUID

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import AtomicFile, bound_batches, fresh_path, hot_join, make_folder, materialize, open_input

LEAST_REVISIT = 1_000
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 5
#: Rows (of two columns) up to which a side is broadcast, after counting them.
BROADCAST_ROWS = 200_000
#: Bytes read from a file at a time.
CHUNK = 1 << 20

RECORD = "path string, record_id string, type string, concurrent_to array<string>, target_uri string, date string, refers_to string, payload_digest string, payload_bytes long, fields map<string,string>, payload binary"


def record_id(*parts) -> str:
    return f"<urn:uuid:{UUID(bytes=hashlib.md5('|'.join(map(str, parts)).encode()).digest())}>"


def _uri(url: str | None) -> str:
    """A URL that fits one header line."""
    return quote(url or "about:blank", safe="%/:=&?~#+!$,;'@()*[]")


def record(kind: str, identity: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in [("WARC-Type", kind), ("WARC-Record-ID", identity), *headers, ("Content-Length", len(block))])]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def capture(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool, date: str, unique: str) -> list[bytes]:
    """The three records of one page."""
    sha = hashlib.sha1(payload)
    digest = "sha1:" + base64.b32encode(sha.digest()).decode()
    uri = _uri(url)
    own = record_id("capture", page_id, sha.hexdigest(), "revisit " + unique if is_revisit else "" if len(payload) >= LEAST_REVISIT else unique)
    shared = [("WARC-Date", date), ("WARC-Target-URI", uri)]
    parts = urlsplit(uri)
    request = f"GET {parts.path or '/'}{'?' + parts.query if parts.query else ''} HTTP/1.1\r\nHost: {parts.netloc}\r\n\r\n".encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    note = "".join(f"{k}: {v}\r\n" for k, v in (("page-id", "" if page_id is None else page_id), ("payload-bytes", len(payload)))).encode()
    if is_revisit:
        more = [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id("capture", refers_to, sha.hexdigest(), ""))]
        main = record("revisit", own, [*shared, *more, ("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")], http)
    else:
        main = record("response", own, [*shared, ("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")], http + payload)
    return [
        main,
        record("request", record_id("request", own, unique), [*shared, ("WARC-Concurrent-To", own), ("Content-Type", "application/http; msgtype=request")], request),
        record("metadata", record_id("metadata", own, unique), [*shared, ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")], note),
    ]


def write(pages: DataFrame, folder: str, date: str | None = None) -> list[str]:
    """Write a capture for every row of ``pages``; the files' paths (one for each task with rows)."""
    make_folder(folder)
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = bound_batches(pages).select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").alias("url"), html.alias("payload"))
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= LEAST_REVISIT, F.sha1("payload")))
    equal = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("copies"))
    equal = materialize(equal.where("copies > 1").select("digest", "first_id"), "equal-payloads")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = hot_join(rows, equal, "digest", BROADCAST_ROWS, "left").select("page_id", "url", "payload", "first_id", again.alias("is_revisit"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, out, n = TaskContext.get().partitionId(), None, 0
        path = f"{folder}/captures-{number:06d}.warc.gz"
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page_id, url, payload, first, again = (c[i].as_py() for c in columns)
                if out is None:
                    out = AtomicFile(path)
                    out.write(_member(record("warcinfo", record_id("info", folder, number), [("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")))
                for r in capture(page_id, url, payload, first, again, date, f"{number}-{n}"):
                    out.write(_member(r))
                n += 1
        if out:
            out.commit()
            yield pa.RecordBatch.from_pydict({"path": [path], "captures": [n]})

    return sorted(r["path"] for r in rows.mapInArrow(save, "path string, captures long").collect())


class _Stream:
    """Buffered reader over a plain or gzip file with any number of members."""

    def __init__(self, uri: str):
        self.file, self.buffer, self.z = open_input(uri), b"", None
        head = self.file.read(2)
        self.file.seek(0)
        self.packed, self.raw = head == b"\x1f\x8b", b""

    def _more(self) -> bytes:
        if not self.packed:
            return self.file.read(CHUNK)
        while True:
            data = self.raw or self.file.read(CHUNK)
            if not data:
                return b""
            self.z = self.z or zlib.decompressobj(31)
            out = self.z.decompress(data)
            self.raw = self.z.unused_data
            if self.z.eof:
                self.z = None
            if out:
                return out

    def line(self) -> bytes | None:
        while (at := self.buffer.find(b"\n")) < 0:
            more = self._more()
            if not more:
                out, self.buffer = self.buffer, b""
                return out or None
            self.buffer += more
        out, self.buffer = self.buffer[: at + 1], self.buffer[at + 1 :]
        return out

    def take(self, n: int) -> bytes:
        parts, have = [self.buffer], len(self.buffer)
        while have < n and (more := self._more()):
            parts.append(more)
            have += len(more)
        whole = b"".join(parts)
        self.buffer = whole[n:]
        return whole[:n]


def records(uri: str) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(headers by lower-case name, block) of each record of a file."""
    stream = _Stream(uri)
    while (first := stream.line()) is not None:
        if not first.startswith(b"WARC/"):
            continue
        headers: dict[str, list[str]] = {}
        while (line := stream.line()) and line.strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        yield headers, stream.take(int(headers.get("content-length", ["0"])[0]))
    stream.file.close()


def _fields(block: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").splitlines()) if k.strip()}


def _row(path: str, headers: dict[str, list[str]], block: bytes, with_payload: bool) -> dict:
    one = lambda k: headers.get(k, [None])[0]
    kind, digest, size, payload, fields = one("warc-type"), None, None, None, []
    if kind in ("response", "revisit", "request"):
        head, _, payload = block.partition(b"\r\n\r\n")
        fields = list(_fields(head.partition(b"\r\n")[2]).items())
    elif kind == "metadata":
        fields = list(_fields(block).items())
    if kind == "response":
        digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
    elif kind == "revisit":  # the payload is elsewhere: its digest and size are those the headers carry
        named = (one("warc-payload-digest") or "").partition(":")[2]
        digest, size = base64.b32decode(named).hex() if named else None, int(dict(fields).get("content-length", 0))
    return {
        "path": path, "record_id": one("warc-record-id"), "type": kind, "concurrent_to": headers.get("warc-concurrent-to", []), "target_uri": one("warc-target-uri"), "date": one("warc-date"),
        "refers_to": one("warc-refers-to"), "payload_digest": digest, "payload_bytes": size, "fields": fields, "payload": payload if with_payload and kind == "response" else None,
    }


_ARROW = pa.schema([("path", pa.string()), ("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("target_uri", pa.string()), ("date", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def read(spark: SparkSession, paths: list[str], with_payload: bool = True) -> DataFrame:
    """A row per record of the files. Response payloads are hashed from their bytes, not from headers."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for headers, block in records(path):
                    rows.append(_row(path, headers, block, with_payload))
                    held += len(block) if with_payload else 500
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return files.mapInArrow(parse, RECORD)


def assemble(found: DataFrame) -> DataFrame:
    """One row per capture: the response or revisit, with its request and metadata records nested."""
    captures = found.where(F.col("type").isin("response", "revisit"))
    others = found.where(F.col("type").isin("request", "metadata")).select("record_id", "type", "concurrent_to", F.struct("record_id", "target_uri", "date", "fields").alias("rec"))
    named = others.select(F.explode("concurrent_to").alias("capture_id"), "type", "rec")
    pointing = captures.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("record_id"))
    # merge joins: the size of what a Python reader yields cannot be estimated, so nothing is broadcast
    named = named.unionByName(pointing.hint("merge").join(others.drop("concurrent_to"), "record_id").select("capture_id", "type", "rec"))
    by_id = lambda kind: F.min_by(F.when(F.col("type") == kind, F.col("rec")), F.when(F.col("type") == kind, F.col("rec.record_id")))
    joined = named.groupBy("capture_id").agg(by_id("request").alias("request"), by_id("metadata").alias("metadata"))
    return captures.hint("merge").join(joined, captures["record_id"] == joined["capture_id"], "left").select(
        F.col("record_id").alias("capture_id"), "target_uri", "date", F.col("type").alias("record_type"), "payload_digest", "payload_bytes", F.col("refers_to").alias("refers_to_record"), "payload", "request", "metadata"
    )


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages, read the files back, and give per page what the files say."""
    spark = pages.sparkSession
    paths = write(pages, folder or fresh_path(spark, "warc"))
    whole = assemble(materialize(read(spark, paths, with_payload=False), "warc-records"))
    page = F.expr("try_cast(metadata.fields['page-id'] as bigint)")
    rows = materialize(whole.select("capture_id", page.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to_record"), "captures")
    named = rows.where("refers_to_record is not null").select("refers_to_record").distinct()
    first = materialize(rows.where("record_type = 'response'").groupBy(F.col("capture_id").alias("refers_to_record")).agg(F.max("page_id").alias("refers_to")).join(named, "refers_to_record", "left_semi"), "responses")
    return hot_join(rows, first, "refers_to_record", BROADCAST_ROWS, "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
