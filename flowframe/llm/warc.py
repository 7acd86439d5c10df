"""WARC archives: written by tasks, read back record by record.

Each record is one gzip member. The reader goes through an archive from front to back in
chunks: it decompresses one member at a time, frames the record's block by its Content-Length
and verifies the digests; a task never holds more than one record and one chunk.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.llm.common import shared_folder

CHUNK = 1 << 20
ARCHIVE_BYTES = 64 << 20
MIN_REVISIT_BYTES = 100
_END = b"\r\n\r\n"

RECORD = (
    "archive string, position long, record_type string, record_id string, target_uri string, "
    "refers_to_id string, payload_bytes long, payload_digest string, status string, payload binary"
)
MANIFEST = "archive string, records long, bytes long"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that every executor reaches, and the path within it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")


def _digest(algorithm: str, data: bytes) -> str:
    return f"{algorithm}:{hashlib.new(algorithm, data).hexdigest()}"


def _line(text: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str
) -> bytes:
    """One WARC record, not yet compressed. A revisit holds the response's HTTP head alone."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: {_digest('sha256', payload)}",
        f"WARC-Block-Digest: {_digest('sha256', block)}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + _END + block + _END


def member(record: bytes, level: int = 1) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def write_warc(
    pages: DataFrame,
    folder: str,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write page_id, url, payload and refers_to as archives; returns the manifest.

    Every task writes archives of about `archive_bytes`, each under a name of its own attempt.
    The manifest is a table that Spark commits, so archives of attempts that failed or ran twice
    are in no manifest. A row with refers_to becomes a revisit. An empty table gives no archive.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        attempt = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        done, out, name, n, size = [], None, "", 0, 0
        for batch in batches:
            for page, url, payload, refers in zip(*(batch.column(i) for i in range(4)), strict=True):
                if out is None:
                    name, n, size = f"{attempt}-{len(done):05d}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}")
                data = member(record_bytes(page.as_py(), url.as_py(), payload.as_py() or b"", refers.as_py(), date))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n, size))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
                names=["archive", "records", "bytes"],
            )

    spark = pages.sparkSession
    manifest = f"{folder}-manifest"
    pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("payload").cast("binary"), F.col("refers_to").cast("long")
    ).mapInArrow(write, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def members(stream: Any, chunk: int = CHUNK) -> Iterator[tuple[int, bytes | None]]:
    """(position, data) of each gzip member of a stream, decompressed chunk by chunk.

    Data is None for a member that is cut short or broken; nothing can be framed behind that.
    Zero bytes between members are padding.
    """
    at, rest = 0, b""
    while True:
        while not (rest := rest.lstrip(b"\0")):
            data = stream.read(chunk)
            if not data:
                return
            at, rest = at + len(data), data
        begin = at - len(rest)
        z, parts = zlib.decompressobj(31), []
        while True:
            try:
                parts.append(z.decompress(rest))
            except zlib.error:
                yield begin, None
                return
            if z.eof:
                rest = z.unused_data
                break
            rest = stream.read(chunk)
            if not rest:
                yield begin, None
                return
            at += len(rest)
        yield begin, b"".join(parts)


_KNOWN = {"sha1", "sha256", "sha512", "md5"}


def _matches(stated: str | None, data: bytes) -> bool | None:
    """Whether a labelled digest (hex or base32) is that of the data; None if it can't be told."""
    if not stated or ":" not in stated:
        return None
    algorithm, _, value = stated.partition(":")
    if algorithm.lower() not in _KNOWN:
        return None
    h = hashlib.new(algorithm.lower(), data)
    return value.strip().lower() in (h.hexdigest(), base64.b32encode(h.digest()).decode().lower())


def parse_record(data: bytes) -> dict[str, Any]:
    """A record's fields, its payload, and a status: ok, bad_frame, bad_digest or unverified."""
    head, sep, rest = data.partition(_END)
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = fields.get("content-length", "")
    bad = {"fields": fields, "payload": b"", "status": "bad_frame"}
    if not sep or not lines[0].startswith("WARC/") or not length.isdigit():
        return bad
    block, tail = rest[: int(length)], rest[int(length) :]
    if len(block) != int(length) or tail != _END:
        return bad
    payload = block
    if fields.get("content-type", "").replace(" ", "").lower().startswith("application/http"):
        payload = block.partition(_END)[2]
    checks = [_matches(fields.get("warc-block-digest"), block)]
    if fields.get("warc-type") != "revisit":
        checks.append(_matches(fields.get("warc-payload-digest"), payload))
    status = "bad_digest" if False in checks else "ok" if True in checks else "unverified"
    return {"fields": fields, "payload": payload, "status": status}


def read_warc(manifest: DataFrame, payloads: bool = True, tasks: int | None = None) -> DataFrame:
    """One row per record of the archives in column `archive`; see RECORD.

    payload_bytes and payload_digest are of the full payload, also for revisits (whose payload
    is empty here). A record that is broken comes with status bad_frame (a member cut short,
    wrong framing) or bad_digest; the rows before it stand. With payloads=False the payloads are
    verified and left out.
    """
    schema = pa.schema(
        [("archive", pa.string()), ("position", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string())]
        + [("target_uri", pa.string()), ("refers_to_id", pa.string()), ("payload_bytes", pa.int64())]
        + [("payload_digest", pa.string()), ("status", pa.string()), ("payload", pa.binary())]
    )

    def row(archive: str, position: int, data: bytes | None) -> tuple:
        if data is None:
            return (archive, position, None, None, None, None, None, None, "bad_frame", None)
        r = parse_record(data)
        f, payload = r["fields"], r["payload"]
        revisit = f.get("warc-type") == "revisit"
        stated = f.get("warc-payload-digest", "")
        if revisit:
            size = int(f["warc-payload-length"]) if f.get("warc-payload-length", "").isdigit() else None
            digest = stated.partition(":")[2] or None
        else:
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        return (
            archive,
            position,
            f.get("warc-type"),
            f.get("warc-record-id"),
            f.get("warc-target-uri"),
            f.get("warc-refers-to"),
            size,
            digest,
            r["status"],
            payload if payloads else None,
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                fs, path = open_fs(archive)
                rows, held = [], 0
                with fs.open_input_stream(path) as stream:
                    for position, data in members(stream):
                        rows.append(row(archive, position, data))
                        held += len(data or b"") if payloads else 0
                        if len(rows) >= 2000 or held >= 8 << 20:
                            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    names = manifest.select("archive")
    # a given number of partitions is kept: names are few bytes, and would be merged into one task
    n = tasks or int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return names.repartition(n, "archive").mapInArrow(read, RECORD)


def with_revisits(pages: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload and refers_to of page_id, url and html.

    Of pages with equal payloads of `least` bytes or more, that with the smallest page_id is the
    response and the others refer to it. Only digests go into the grouping, and only those of
    more than one page into the join, whose large keys adaptive execution may split. Rows that
    repeat the response's own id are responses as well; a page without an id refers to the
    response, and is one where no page of the group has an id. A null html is an empty payload.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", payload.alias("payload")).withColumn("_digest", F.sha2("payload", 256))
    first = (
        keyed.where(F.octet_length("payload") >= least)
        .groupBy("_digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_digest", "_first")
    )
    joined = keyed.join(first, "_digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return joined.select(
        "page_id", "url", "payload", refers.alias("refers_to")
    )


def archive_and_read(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages as archives into the shared folder, and their records as read back."""
    manifest = write_warc(with_revisits(pages), shared_folder(spark, "warc"))
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return read_warc(manifest, payloads=False).select(
        number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number(F.col("refers_to_id")).alias("refers_to"),
        "target_uri",
        "status",
    )


#: The records as SQL over `pages`.
WARC_SQL = r"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
k AS (SELECT *, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM k)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to,
       url AS target_uri, 'ok' AS status
FROM f
"""
