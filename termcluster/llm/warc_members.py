"""WARC archives: whole-file gzip streams rewritten as one gzip member a record.

1. ``write_archives`` writes one record per page, in archives that are single gzip
   streams (as a crawler piping its output through gzip leaves them): a ``response``
   with the whole payload, or a ``revisit`` without it, if an equal payload has a
   smaller page id.
2. ``normalise`` inflates each archive once, from front to back, rewrites every
   record as a gzip member of its own, and writes a sidecar index beside it: for each
   record, offset and length of its member (two little-endian 64-bit integers).
3. ``read_records`` reads records by these offsets: any range of any archive can go
   to any task.

Archives lie in a folder that driver and executors share, opened by pyarrow's file
systems. A task names its files with a token of its own and returns the names as
rows; what a lost or repeated task attempt has written is in no manifest, and so
never read. An archive takes ARCHIVE_BYTES of records, then a new one begins, so a
task inflates a bounded file; it holds one record at a time, whole (a record of many
megabytes is held as such), and never a file.

Equal payloads are found by SHA-1 in a partial aggregate of 20-byte digests; only
digests met twice go on, and join the pages by Spark's own choice: broadcast below
the size limit, else a sort-merge join of which AQE splits a hot digest's pages.

Defined cases: null html is the empty payload, and payloads of fewer than
``least_bytes`` are never revisits. The smallest page id of equal payloads is the
response; rows that share this id are all responses; null ids come after all others
(only null ids: all are responses). A null url is left out of its record; control
characters in urls are percent-encoded. An empty table gives no archives and no
records. Extra columns are ignored. Truncated streams, records cut short and payloads
that don't have their digest raise ValueError."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termcluster.llm.shared import scratch, shared_folder

ARCHIVE_BYTES = 64 << 20  # of records, before compression
RANGE_RECORDS = 2048  # that one task reads at a time
CHUNK = 1 << 20
LEAST_BYTES = 0
GZIP = 31  # zlib's window bits of a gzip stream
STREAM_LEVEL, MEMBER_LEVEL = 1, 4

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"1970-01-01T00:00:00Z"  # pages have no date
END = b"\r\n\r\n"

MANIFEST = "path string, records long"
INDEXED = "path string, index string, records long"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def urn(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"" if page_id is None else str(page_id).encode())


def page_of(value: bytes) -> int | None:
    digits = value.removeprefix(b"<urn:page:").removesuffix(b">")
    return int(digits) if digits else None


def base32_sha1(payload: bytes) -> bytes:
    return base64.b32encode(hashlib.sha1(payload).digest())


def record(fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    head = b"".join(b"%s: %s\r\n" % f for f in fields)
    return b"%s\r\n%sContent-Length: %d\r\n\r\n%s%s" % (VERSION, head, len(block), block, END)


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, revisit: bool, first: int | None) -> bytes:
    """The record of one page; of a revisit, the block has the HTTP header alone."""
    fields = [(b"WARC-Type", b"revisit" if revisit else b"response"), (b"WARC-Record-ID", urn(page_id)), (b"WARC-Date", DATE)]
    if url is not None:
        fields.append((b"WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url).encode()))
    fields.append((b"WARC-Payload-Digest", b"sha1:" + base64.b32encode(digest)))
    if revisit:
        fields += [(b"WARC-Refers-To", urn(first)), (b"WARC-Profile", PROFILE)]
    fields.append((b"Content-Type", b"application/http; msgtype=response"))
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    return record(fields, head if revisit else head + payload)


def info_record(name: str) -> bytes:
    return record([(b"WARC-Type", b"warcinfo"), (b"WARC-Record-ID", b"<urn:archive:%s>" % name.encode()), (b"WARC-Date", DATE), (b"Content-Type", b"application/warc-fields")], b"format: WARC File Format 1.1\r\n")


def archive_rows(folder: str, archive_bytes: int, level: int):
    """Write a task's pages; the archives' paths."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        token, files, held = uuid.uuid4().hex, [], None
        for b in batches:
            columns = (b.column(c) for c in ("page_id", "url", "payload", "digest", "revisit", "first"))
            for page in zip(*columns, strict=True):
                raw = page_record(*(x.as_py() for x in page))
                if held and held[2] + len(raw) > archive_bytes:
                    held[0].write(held[1].flush())
                    held[0].close()
                    held = None
                if not held:
                    name = f"{token}-{len(files):05d}.warc.gz"
                    held = [system.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, GZIP), 0]
                    held[0].write(held[1].compress(info_record(name)))
                    files.append([f"{folder}/{name}", 1])
                held[0].write(held[1].compress(raw))
                held[2] += len(raw)
                files[-1][1] += 1
        if held:
            held[0].write(held[1].flush())
            held[0].close()
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in files], pa.string()), pa.array([f[1] for f in files], pa.int64())], names=["path", "records"])
    return rows


def inflated(stream, path: str) -> Iterator[bytes]:
    """The bytes of a gzip stream, in pieces; members that follow each other count
    as one stream."""
    z, begun, limit = zlib.decompressobj(GZIP), False, 4 * CHUNK
    try:
        while chunk := stream.read(CHUNK):
            piece = b""
            while chunk or len(piece) == limit:  # a full piece: more may be waiting inside
                begun = True
                piece = z.decompress(chunk, limit)
                yield piece
                chunk = z.unconsumed_tail
                if z.eof:
                    chunk, z, begun, piece = z.unused_data, zlib.decompressobj(GZIP), False, b""
    except zlib.error as e:
        raise ValueError(f"{path}: {e}") from e
    if begun:
        raise ValueError(f"{path}: the gzip stream ends early")


def split_records(pieces: Iterator[bytes], path: str) -> Iterator[bytes]:
    """Whole records, with their header and the two line ends after them."""
    held = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        if piece is None:
            return False
        held.extend(piece)
        return True

    while True:
        searched = 0
        while (head := held.find(END, searched)) < 0:
            searched = max(0, len(held) - 3)
            if not more():
                if held.strip(b"\r\n"):
                    raise ValueError(f"{path}: a record header ends early")
                return
        size = head + len(END) + content_length(bytes(held[:head]), path) + len(END)
        while len(held) < size:
            if not more():
                raise ValueError(f"{path}: a record ends early")
        if held[size - len(END):size] != END:
            raise ValueError(f"{path}: a record isn't followed by two line ends")
        yield bytes(held[:size])
        del held[:size]


def content_length(head: bytes, path: str) -> int:
    found = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)\s*(?:\r\n|$)", head)
    if not head.startswith(b"WARC/") or not found:
        raise ValueError(f"{path}: not a WARC record: {head[:60]!r}")
    return int(found[1])


def normalised_rows(folder: str, level: int):
    """Rewrite each archive as members, and its sidecar index."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_system, base = opened(folder)
        for b in batches:
            for path in b.column("path").to_pylist():
                system, at = opened(path)
                name = f"{at.rpartition('/')[2].removesuffix('.gz').removesuffix('.warc')}-{uuid.uuid4().hex[:12]}"
                lengths = []
                with system.open_input_stream(at, compression=None) as stream, out_system.open_output_stream(f"{base}/{name}.warc.gz", compression=None) as out:
                    for raw in split_records(inflated(stream, path), path):
                        z = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                        member = z.compress(raw) + z.flush()
                        out.write(member)
                        lengths.append(len(member))
                size = np.array(lengths, "<u8")
                with out_system.open_output_stream(f"{base}/{name}.idx", compression=None) as out:
                    out.write(np.stack([np.cumsum(size, dtype="<u8") - size, size], axis=1).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}.{x}"]) for x in ("warc.gz", "idx")] + [pa.array([len(lengths)])], names=["path", "index", "records"])
    return rows


def parsed(raw: bytes, path: str) -> dict | None:
    """The fields of a response or revisit; None for other records."""
    head, _, rest = raw.partition(END)
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    kind = fields[b"WARC-Type"]
    if kind not in (b"response", b"revisit"):
        return None
    block = rest[:-len(END)]
    http, _, payload = block.partition(END)
    digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:")
    size = int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)[1])
    if kind == b"response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"{path}: the payload of {fields[b'WARC-Record-ID']!r} isn't the one of its digest")
    url, refers = fields.get(b"WARC-Target-URI"), fields.get(b"WARC-Refers-To")
    return {"page_id": page_of(fields[b"WARC-Record-ID"]), "url": url and url.decode(), "record_type": kind.decode(), "payload_bytes": size, "payload_digest": digest.decode(),
            "refers_to": page_of(refers) if refers else None, "payload": payload if kind == b"response" else None}


def record_rows(with_payload: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
        for b in batches:
            for path, index, begin, end in zip(*(b.column(c).to_pylist() for c in ("path", "index", "begin", "end")), strict=True):
                system, at = opened(index)
                with system.open_input_file(at) as f:
                    places = np.frombuffer(f.read_at(16 * (end - begin), 16 * begin), "<u8").reshape(-1, 2).tolist()
                if len(places) != end - begin:
                    raise ValueError(f"{index}: the index ends early")
                system, at = opened(path)
                with system.open_input_file(at) as f:
                    found, size = [], 0
                    for offset, length in places:
                        got = parsed(zlib.decompress(f.read_at(length, offset), GZIP), path)
                        if got:
                            got["payload"] = got["payload"] if with_payload else None
                            found.append(got)
                            size += len(got["payload"] or b"")
                        if size > 8 * CHUNK:
                            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in types.items()], names=list(types))
                            found, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in types.items()], names=list(types))
    return rows


def spread(manifest: DataFrame) -> DataFrame:
    """A row a task: what it names is large."""
    return manifest.repartition(max(1, manifest.count()))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES, level: int = STREAM_LEVEL) -> DataFrame:
    """Write the pages' archives under ``folder``; their manifest: path, records."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    base = base.withColumn("digest", F.unhex(F.sha1("payload")))
    copies = (base.filter(F.octet_length("payload") >= least_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first", F.lit(True).alias("copied")))
    revisit = F.col("copied").isNotNull() & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = base.join(copies, "digest", "left").select("page_id", "url", "payload", "digest", revisit.alias("revisit"), "first")
    return scratch(rows.mapInArrow(archive_rows(folder, archive_bytes, level), MANIFEST), "archives")


def normalise(manifest: DataFrame, folder: str, level: int = MEMBER_LEVEL) -> DataFrame:
    """Rewrite the archives named in the column ``path`` under ``folder``; path, index
    and number of records of each."""
    return scratch(spread(manifest.select("path")).mapInArrow(normalised_rows(folder, level), INDEXED), "members")


def read_records(indexed: DataFrame, with_payload: bool = True, range_records: int = RANGE_RECORDS) -> DataFrame:
    """One row per response and revisit: page_id, url, record_type, payload_bytes,
    payload_digest, refers_to, payload (of responses)."""
    begin = F.explode(F.sequence(F.lit(0), F.col("records") - 1, F.lit(range_records)))
    ranges = indexed.filter("records > 0").select("path", "index", "records", begin.alias("begin"))
    ranges = ranges.select("path", "index", "begin", F.least(F.col("begin") + range_records, "records").alias("end"))
    out = spread(ranges).mapInArrow(record_rows(with_payload), RECORD)
    return out if with_payload else out.drop("payload")


def warc_round_trip(pages: DataFrame, with_payload: bool = False, **options) -> DataFrame:
    """Write archives to a new place in the shared folder, normalise them, and read
    the records back."""
    spark: SparkSession = pages.sparkSession
    base = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}-warc"
    for part in ("streams", "members"):
        system, at = opened(f"{base}/{part}")
        system.create_dir(at, recursive=True)
    archives = write_archives(pages, f"{base}/streams", **options)
    return read_records(normalise(archives, f"{base}/members"), with_payload)
