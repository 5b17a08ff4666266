"""WARC archives written and read as a chunked record table.

A payload travels as rows of a record and a chunk number, at most ``CHUNK`` bytes
each, so no task holds an oversized record.  The writer streams chunk rows into
gzip members (one per record), and the reader streams archives back into chunk
rows.  Both carry an incremental SHA-256: after each chunk the digest of the
payload so far, at the last chunk the payload's, which must equal the header's.

Of records with equal payloads of at least ``LEAST`` bytes, that with the smallest
id is a response; the others are revisits, without the payload, that refer to
it.  Smaller payloads are always responses.

Each task writes files of its own names under a shared folder and returns a
manifest row for every finished file.  The manifest is the archive: what a lost
task left behind isn't in it.

Defined cases: null payload is empty; a null URL leaves the header out, and
control characters in a URL are percent-encoded; of rows that repeat the smallest id,
all are responses; a row without an id is a revisit if an equal payload has one,
else a response; an empty table gives an empty archive; other columns are
ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, table
from ..sources.pagefiles import open_store
from .common import saved

CHUNK = 1 << 20                # payload bytes of a chunk row, at most
LEAST = 100                    # payloads below this size are never revisits
FILE_BYTES = 128 << 20         # a new archive begins after this many bytes
LEVEL = 3                      # gzip level
BATCH_BYTES = 8 << 20          # chunk bytes handed over at once
DATE = "1970-01-01T00:00:00Z"  # of records whose capture time isn't known
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CONTROL = re.compile(rb"[\x00-\x20\x7f]")


# -- chunk rows to write -----------------------------------------------------------

def record_chunks(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  chunk: int = CHUNK, least: int = LEAST) -> DataFrame:
    """``(id, url, digest, size, refers, revisit, chunk_no, data)``; the chunks of a
    record are consecutive rows of one partition."""
    data = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("number"),
                     F.col(url_col).cast("string").alias("url"), data.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    first = saved(rows.where(F.col("size") >= least).groupBy("digest").agg(
        F.min("number").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").select(
        F.col("digest").alias("of"), "first"), "warc-first")
    rows = rows.join(first, F.col("digest") == F.col("of"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("number").eqNullSafe(F.col("first"))
    rows = rows.select("id", "url", "digest", "size", F.when(revisit, F.col("first").cast("string")).alias("refers"),
                       revisit.alias("revisit"), F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"))
    last = F.greatest(F.lit(0), F.ceil(F.octet_length("payload") / chunk).cast("int") - 1)
    rows = rows.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
    return rows.withColumn("data", F.substr("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk))).drop("payload")


# -- writing -----------------------------------------------------------------------

def _head(id_: str | None, url: str | None, digest: str, size: int, refers: str | None, revisit: bool) -> bytes:
    """A record's header and the HTTP header that its block begins with."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{id_ or ''}>",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(http) + (0 if revisit else size)}"]
    if url is not None:
        clean = _CONTROL.sub(lambda m: b"%%%02X" % m[0][0], url.encode("utf-8", "replace"))
        lines.append("WARC-Target-URI: " + clean.decode("utf-8"))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers or ''}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write_archives(chunks: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write chunk rows as ``.warc.gz`` files under ``path``; returns the manifest,
    ``(file, records, bytes)``, once everything is written.  A folder that Python tasks
    can't open is an error before anything is written."""
    open_store(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(path)
        fs.create_dir(root, recursive=True)
        out, name, done, records, size = None, "", [], 0, 0
        pack = digest = want = None

        def end_record() -> int:
            if digest.hexdigest() != want:
                raise ValueError("the chunks of a record don't add up to its digest")
            tail = pack.compress(b"\r\n\r\n") + pack.flush()
            out.write(tail)
            return len(tail)

        for b in batches:
            for id_, url, sha, total, refers, revisit, no, data in zip(*(c.to_pylist() for c in b.columns)):
                if no == 0:
                    if pack:
                        size += end_record()
                    if out is None or size >= file_bytes:
                        if out is not None:
                            out.close()
                            done.append((name, records, size))
                        name, records, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = fs.open_output_stream(name, compression=None)
                    records += 1
                    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    digest, want = hashlib.sha256(), hashlib.sha256(b"").hexdigest() if revisit else sha
                    part = pack.compress(_head(id_, url, sha, total, refers, revisit))
                    out.write(part)
                    size += len(part)
                digest.update(data)
                part = pack.compress(data)
                out.write(part)
                size += len(part)
        if out is not None:
            size += end_record()
            out.close()
            done.append((name, records, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["file", "records", "bytes"])

    cols = chunks.select("id", "url", "digest", "size", "refers", "revisit", "chunk_no", "data")
    return saved(cols.mapInArrow(work, "file string, records long, bytes long"), "warc-manifest")


# -- reading -----------------------------------------------------------------------

def _headers(stream) -> dict[str, str]:
    out = {}
    while line := stream.readline().rstrip(b"\r\n"):
        key, _, value = line.decode("utf-8").partition(":")
        out[key.strip().lower()] = value.strip()
    return out


def _urn(value: str) -> str | None:
    return value.removeprefix("<urn:page:").removesuffix(">") or None


def records(stream, chunk: int = CHUNK) -> Iterator[tuple]:
    """Chunk rows of an open, uncompressed archive: (record_id, url, record_type,
    refers_to, payload_bytes, chunk_no, is_last, digest so far, data)."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError("an archive's record begins without its version")
            continue
        h = _headers(stream)
        kind, left = h["warc-type"], int(h["content-length"])
        block = io.BytesIO()
        while (line := stream.readline()).strip():
            block.write(line)
        left -= block.tell() + len(line)
        block.seek(0)
        block.readline()
        size = int(_headers(block)["content-length"])
        want = h["warc-payload-digest"].removeprefix("sha256:")
        who = (_urn(h["warc-record-id"]), h.get("warc-target-uri"), kind, _urn(h.get("warc-refers-to", "")), size)
        if kind == "revisit":
            yield (*who, 0, True, want, b"")
            continue
        digest, no = hashlib.sha256(), 0
        while True:
            data = stream.read(min(chunk, left))
            if len(data) < min(chunk, left):
                raise ValueError("an archive ends inside a record")
            left -= len(data)
            digest.update(data)
            if not left and digest.hexdigest() != want:
                raise ValueError("a payload doesn't have its record's digest")
            yield (*who, no, not left, digest.hexdigest(), data)
            if not left:
                break
            no += 1


def read_archives(manifest: DataFrame, path: str, payload: bool = True, chunk: int = CHUNK) -> DataFrame:
    """The manifest's archives as chunk rows ``(record_id, url, record_type, refers_to,
    payload_bytes, chunk_no, is_last, digest, data)``; without ``payload`` the data
    are read and checked, but not returned.  A task reads whole files."""
    names = ["record_id", "url", "record_type", "refers_to", "payload_bytes", "chunk_no", "is_last", "digest", "data"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_store(path)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(name, compression=None) as raw:
                    for row in records(io.BufferedReader(gzip.GzipFile(fileobj=raw), CHUNK), chunk):
                        rows.append(row if payload else (*row[:-1], b""))
                        size += len(rows[-1][-1]) + 300
                        if size >= BATCH_BYTES:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    kinds = [pa.string()] * 4 + [pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    files = manifest.select("file")
    files = files.repartition(max(1, min(files.count(), 100_000)))
    return files.mapInArrow(work, "record_id string, url string, record_type string, refers_to string, payload_bytes long, "
                                  "chunk_no int, is_last boolean, digest string, data binary")


def resolve_revisits(chunks: DataFrame) -> DataFrame:
    """Chunk rows in which revisits carry the payload of the response they refer to."""
    own = chunks.where("record_type <> 'revisit'")
    again = chunks.where("record_type = 'revisit'").select("record_id", "url", "record_type", "refers_to")
    there = own.where("record_id is not null").select(F.col("record_id").alias("of"), "payload_bytes", "chunk_no",
                                                      "is_last", "digest", "data")
    return own.unionByName(again.join(there, F.col("refers_to") == F.col("of")).drop("of"))


# -- query -------------------------------------------------------------------------

def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    path = scratch_dir(spark, "warc")
    manifest = write_archives(record_chunks(pages), path)
    rows = read_archives(manifest, path, payload=False).where("is_last")
    return rows.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes",
                       F.col("digest").alias("payload_digest"), "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"))


ORACLE = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                  sha256(coalesce(html, '')) as payload_digest from pages),
f as (select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by payload_digest)
select page_id, payload_bytes, p.payload_digest,
       case when f.first is not null and f.first <> page_id then 'revisit' else 'response' end as record_type,
       case when f.first is not null and f.first <> page_id then f.first end as refers_to
from p left join f on p.payload_digest = f.payload_digest and p.payload_bytes >= 100"""
