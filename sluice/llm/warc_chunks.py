"""WARC archives written from pages and read back as a table of payload chunks.

Writing: one record per row, gzip member per record, archives per task.  Of
records with equal payloads of at least ``min_payload`` bytes the one with the
smallest page_id is a ``response``, the others are ``revisit`` records that
refer to it (identical-payload-digest profile, WARC 1.1) and store no payload;
shorter payloads are always stored.

Reading: archives are streamed.  A payload becomes rows (archive, record number,
chunk number) of at most ``chunk_bytes`` bytes; every row carries the SHA-1 of
the payload up to and including its chunk, so the last row of a record has the
whole digest and no record is ever held whole, however long it is.

Null html: empty payload.  Null url: no target URI.  Null page_id: the record id
says ``null``; such a record never is the one that others refer to (unless all
of its group have none: then all are responses).  Rows that repeat page_id and
payload are each a record of the same type.  Empty table: no archive, no rows.

Archives lie in the shared work folder.  Tasks write under a name of their own
per attempt and only the manifest of finished tasks says which archives count,
so a task that is run again leaves nothing double.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_work_dir
from .common import salted_left_join, written

CHUNK_BYTES = 32 << 10
ARCHIVE_BYTES = 512 << 20
BATCH_BYTES = 4 << 20
RECORD_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNK_SCHEMA = ("archive string, record_no long, record_id string, record_type string, target_uri string, "
                "refers_to string, declared_digest string, declared_bytes long, chunk_no int, "
                "data binary, digest_so_far string, is_last boolean")
MANIFEST_SCHEMA = "archive string, n_records long, n_bytes long"


def _file_system(uri: str):
    """(file system, path) of a URI as pyarrow names them; s3a and s3n are s3."""
    from pyarrow import fs

    scheme, sep, rest = uri.partition(":")
    if not sep or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme in ("s3a", "s3n"):
        uri = "s3:" + rest
    return fs.FileSystem.from_uri(uri)


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(raw).decode()


def plan_records(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """page_id, url, html, digest (hex), record_type, refers_to.

    Digests are taken JVM-side; groups of equal payloads are counted with a
    map-side combine and joined back salted, so a group of any size is spread."""
    body = F.coalesce(F.col("html"), F.lit(""))
    hashed = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("page_id").alias("_id"),
                          F.col("url").alias("url"), body.alias("html"),
                          F.sha1(body.cast("binary")).alias("digest"))
    groups = pages.select("page_id", F.sha1(body.cast("binary")).alias("digest"),
                          F.octet_length(body).alias("_n")).where(F.col("_n") >= min_payload).groupBy(
        "digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_copies")).where(
        "_copies > 1 AND _first IS NOT NULL").select("digest", "_first")
    joined = salted_left_join(hashed, groups, "digest", "_id")
    again = F.col("_first").isNotNull() & (F.col("_id").isNull() | (F.col("_id") != F.col("_first")))
    return joined.select("page_id", "url", "html", "digest",
                         F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
                         F.when(again, F.col("_first").cast("string")).alias("refers_to"))


def _record_head(page_id, url, kind, refers_to, digest_hex, n_payload, n_block) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id or 'null'}>",
             f"WARC-Date: {RECORD_DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{base32_sha1(bytes.fromhex(digest_hex))}",
              f"X-Payload-Length: {n_payload}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {n_block}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _writer(folder: str):
    def write(batches):
        out = fs = path = final = None
        n_records = n_bytes = 0
        done = []

        def close():
            out.close()
            done.append((path if final is None else final, n_records, n_bytes))

        for batch in batches:
            cols = [batch.column(i) for i in range(6)]
            for i in range(batch.num_rows):
                if out is not None and n_bytes >= ARCHIVE_BYTES:
                    close()
                    out = None
                if out is None:
                    final = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz"
                    fs, path = _file_system(final)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out, n_records, n_bytes = fs.open_output_stream(path, compression=None), 0, 0
                page_id, url, _, digest, kind, refers = (c[i].as_py() if j != 2 else None for j, c in enumerate(cols))
                payload = memoryview(cols[2][i].as_buffer() or b"")
                http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"Content-Length: {len(payload)}\r\n\r\n").encode()
                kept = payload if kind == "response" else payload[:0]
                gz = zlib.compressobj(3, zlib.DEFLATED, 31)
                n_bytes += out.write(gz.compress(_record_head(
                    page_id, url, kind, refers, digest, len(payload), len(http) + len(kept)) + http)) or 0
                for at in range(0, len(kept), 1 << 20):
                    part = gz.compress(kept[at:at + (1 << 20)])
                    n_bytes += len(part)
                    out.write(part)
                part = gz.compress(b"\r\n\r\n") + gz.flush()
                n_bytes += len(part)
                out.write(part)
                n_records += 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
             pa.array([d[2] for d in done], pa.int64())], ["archive", "n_records", "n_bytes"])

    return write


def write_archives(pages: DataFrame, folder: str | None = None, min_payload: int = 0) -> DataFrame:
    """Write the archives; returns their manifest (archive, n_records, n_bytes)."""
    folder = folder or new_work_dir(pages.sparkSession, "warc")
    return written(plan_records(pages, min_payload).mapInArrow(_writer(folder), MANIFEST_SCHEMA), "warc-manifest")


def _fields(stream) -> dict | None:
    """Header fields of the next record, by lower-case name; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:60]!r}")
    fields = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _skip(stream, n: int) -> None:
    while n > 0 and (part := stream.read(min(n, 1 << 16))):
        n -= len(part)


def record_chunks(raw, chunk_bytes: int = CHUNK_BYTES):
    """Rows of one archive from an open seekable file, gzip or plain; holds one
    chunk at a time."""
    packed = raw.read(2) == b"\x1f\x8b"
    raw.seek(0)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if packed else raw, 1 << 16)
    record_no = 0
    while (f := _fields(stream)) is not None:
        left = int(f["content-length"])
        if f.get("content-type", "").startswith("application/http"):
            while left > 0:
                line = stream.readline(left)
                left -= len(line)
                if line in (b"\r\n", b"\n", b""):
                    break
        strip = lambda x: x[1:-1] if x and x[0] == "<" else x
        kind = f.get("warc-type", "")
        declared = f.get("warc-payload-digest", "").partition(":")[2] or None
        size = f.get("x-payload-length")
        head = (record_no, strip(f.get("warc-record-id")), kind, f.get("warc-target-uri"),
                strip(f.get("warc-refers-to")), declared, int(size) if size else None)
        sha, chunk_no, n = hashlib.sha1(), 0, left
        while True:
            data = stream.read(min(chunk_bytes, n))
            if not data and n:
                raise ValueError(f"archive ends inside record {record_no}")
            n -= len(data)
            sha.update(data)
            so_far = declared if kind == "revisit" else base32_sha1(sha.digest())
            yield (*head, chunk_no, data, so_far, n == 0)
            chunk_no += 1
            if n == 0:
                break
        _skip(stream, 4)
        record_no += 1


def _reader(chunk_bytes: int):
    names = [x.split()[0] for x in CHUNK_SCHEMA.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(),
             pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.bool_()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types, strict=True)], names)

    def read(batches):
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                fs, path = _file_system(archive)
                rows, held = [], 0
                with fs.open_input_file(path) as raw:
                    for row in record_chunks(raw, chunk_bytes):
                        rows.append((archive, *row))
                        held += len(row[8]) + 200
                        if held >= BATCH_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return read


def read_archives(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunk table of the archives named in column ``archive``, one archive a task."""
    n = max(1, archives.count())
    return archives.select("archive").repartition(n).mapInArrow(_reader(chunk_bytes), CHUNK_SCHEMA)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record of a chunk table: sizes summed, digest of the last chunk,
    ``intact``: the digest computed while reading equals the one in the header."""
    by = ["archive", "record_no"]
    one = chunks.groupBy(*by).agg(
        F.min("record_id").alias("record_id"), F.min("record_type").alias("record_type"),
        F.min("refers_to").alias("refers_to"), F.min("declared_digest").alias("declared_digest"),
        F.min("declared_bytes").alias("declared_bytes"), F.count(F.lit(1)).alias("n_chunks"),
        F.sum(F.octet_length("data")).cast("long").alias("stored_bytes"),
        F.max(F.when(F.col("is_last"), F.col("digest_so_far"))).alias("digest"))
    return one.withColumn("intact", (F.col("digest") == F.col("declared_digest")) & (
        (F.col("record_type") == "revisit") | (F.col("stored_bytes") == F.col("declared_bytes"))))


def warc_query(pages: DataFrame) -> DataFrame:
    """Digest of a round trip: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    got = records(read_archives(write_archives(pages)))
    page = lambda c: F.when(c != "urn:page:null", F.substring_index(c, ":", -1)).cast("long")
    return got.select(
        page(F.col("record_id")).alias("page_id"),
        F.when(F.col("record_type") == "revisit", F.col("declared_bytes")).otherwise(
            F.col("stored_bytes")).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), "record_type", page(F.col("refers_to")).alias("refers_to"),
        "n_chunks", "intact")
