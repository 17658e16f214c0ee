"""WARC archives: write with an index, read selected records by byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.session import scratch, staged

INDEX = (
    "file string, offset long, length long, page_id long, url string, payload_digest string, "
    "record_type string"
)
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)
#: Neighbouring records closer than GAP are read together, RANGE bytes at most at once.
GAP = 64 << 10
RANGE = 8 << 20
READ_PER_TASK = 64 << 20
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _store(path: str):
    """The file system of a path or URI, and the path within it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        fs.LocalFileSystem(), path
    )


def sha1_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int) -> bytes:
    return b"<urn:page:%d>" % page_id


def record(page_id, url, payload: bytes, refers_to, digest: str) -> bytes:
    """One record.  Blanks in a URL become %20, so that it stays on its line."""
    revisit = refers_to is not None
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response")]
    name = _urn(page_id) if page_id is not None else b"<urn:uuid:%s>" % str(uuid.uuid4()).encode()
    head += [b"WARC-Record-ID: " + name, b"WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(b"WARC-Target-URI: " + "%20".join(url.split()).encode("utf-8", "surrogatepass"))
    head.append(b"WARC-Payload-Digest: sha1:" + digest.encode())
    head.append(b"X-Payload-Length: %d" % len(payload))
    if revisit:
        head += [b"WARC-Refers-To: " + _urn(refers_to), b"WARC-Profile: " + PROFILE]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head += [
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of a record; a response's digest and length come from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    block = rest[: int(fields[b"Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    kind = fields[b"WARC-Type"].decode()
    name, refers = fields[b"WARC-Record-ID"], fields.get(b"WARC-Refers-To")
    number = lambda urn: int(urn[len(b"<urn:page:") : -1])
    url = fields.get(b"WARC-Target-URI")
    digest = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
    if kind == "response" and sha1_of(payload) != digest:
        raise ValueError(f"payload of {name!r} does not match its digest")
    return {
        "page_id": number(name) if name.startswith(b"<urn:page:") else None,
        "url": None if url is None else url.decode("utf-8", "surrogatepass"),
        "payload_bytes": int(fields[b"X-Payload-Length"]) if kind == "revisit" else len(payload),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number(refers) if refers else None,
        "payload": payload if kind == "response" else None,
    }


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (part.split() for part in ddl.split(", "))])


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write every page as a WARC record below ``folder``; return the index of records.

    ``pages`` has ``page_id``, ``url`` and ``html`` (null: empty payload).  Of equal
    payloads of at least ``least_bytes`` bytes the one with the largest ``page_id`` is
    written as a response and the others as revisits of it; rows that repeat that id
    are responses too, as are rows without an id.  Each task writes one archive of
    gzip members under a name of its own, and only archives of tasks that succeeded
    enter the index, so a repeated task leaves nothing but an unread file.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("body"))
    rows = rows.withColumn("same", F.sha2("body", 256))
    leaders = staged(
        rows.where(F.octet_length("body") >= least_bytes)
        .groupBy("same")
        .agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and leader is not null")
        .select("same", "leader"),
        "warc-leaders",
    )
    led = rows.join(leaders, "same", "left").select(
        "page_id",
        "url",
        "body",
        F.when(F.col("leader") != F.col("page_id"), F.col("leader")).alias("refers_to"),
    )
    schema = _schema(INDEX)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        out, offset = None, 0
        for batch in batches:
            if out is None:
                out = store.open_output_stream(f"{base}/{name}", compression=None)
            found = []
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                digest = sha1_of(payload)
                member = gzip.compress(record(page_id, url, payload, refers_to, digest), 4, mtime=0)
                out.write(member)
                kind = "response" if refers_to is None else "revisit"
                found.append((name, offset, len(member), page_id, url, digest, kind))
                offset += len(member)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*found), schema)], schema=schema
                )
        if out is not None:
            out.close()

    index = staged(led.mapInArrow(write, INDEX), "warc-index")
    return index


def read_warc(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Read the records of ``index`` (any selection of it), by coalesced byte ranges.

    The selection is range-partitioned by file and offset into tasks of about 64 MB
    of archive, sorted within each, and neighbours are read in one go.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // READ_PER_TASK))
    schema = _schema(RECORDS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        name, source = None, None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            at = 0
            while at < len(rows):
                file, start, length = rows[at]
                to, end = at + 1, start + length
                while (
                    to < len(rows)
                    and rows[to][0] == file
                    and rows[to][1] - end <= GAP
                    and rows[to][1] + rows[to][2] - start <= RANGE
                ):
                    end = max(end, rows[to][1] + rows[to][2])
                    to += 1
                if file != name:
                    name, source = file, store.open_input_file(f"{base}/{file}")
                piece = source.read_at(end - start, start)
                found = [
                    parse(gzip.decompress(piece[o - start : o - start + n])) for _, o, n in rows[at:to]
                ]
                if not payloads:
                    for x in found:
                        x["payload"] = None
                yield pa.RecordBatch.from_pylist(found, schema=schema)
                at = to

    dealt = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset")
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(read, RECORDS)


def archive_and_read(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages into a fresh folder below the shared one and read them back."""
    folder = scratch(pages.sparkSession, "warc")
    index = write_warc(pages, folder, least_bytes)
    return read_warc(index, folder, payloads=False).drop("payload")
