"""WARC archives, index first.

Writing: pages with equal payloads are found by their SHA-1 (heavy digests are settled on
the map side, the rest by an ordinary shuffle; see ``exact_dedup``); the page with the
smallest id becomes a ``response``, the others ``revisit`` records without a payload.  Every
task writes gzip-member-per-record files into the shared folder through pyarrow's file
systems and returns one index row per record: file, offset, length, URL, digest.  The index
is written as Parquet and is the only way to the records, so files of failed or repeated
task attempts (each has a name of its own) are never read.

Reading: the selected index rows are range-partitioned and sorted by (file, offset); ranges
that lie close together are coalesced into one read of at most ``READ_BYTES`` and cut into
records.  Digests are verified.

Defined cases: a null or empty payload is a record of 0 bytes; records smaller than
``min_bytes`` are all responses; rows that repeat the smallest id with the same payload are
all responses; a null id loses to any id, and null ids alone stay responses; a null URL
writes no target; control characters in URLs are percent-encoded; an empty table gives an
empty index; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32encode
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import exact_dedup as dd
from .common import ready

FILE_BYTES = 256 << 20      # a task starts a new file beyond this
GAP_BYTES = 64 << 10        # ranges this close are read together
READ_BYTES = 8 << 20        # most bytes of one coalesced read
TASK_BYTES = 64 << 20       # archive bytes that one task reads back
DATE = "1970-01-01T00:00:00Z"   # pages carry no fetch time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in RFC 4648 base 32: 40 bits (10 hex digits) at a time."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _ALPHABET)


def file_system(uri: str):
    """pyarrow file system and path of a folder or file URI."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def record_bytes(page, url, kind: str, refers, payload: bytes, size: int, digest: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP header only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    block = http + payload if kind == "response" else http
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(0x21, 0x7F))).replace("%", "")))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record: type, id, url, digest, refers_to, size, payload (None for revisits)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = h["WARC-Type"]
    if kind == "response" and (len(payload) != size or b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
    name = lambda k: h[k].removeprefix("<urn:page:").removesuffix(">") if k in h else None
    return {"type": kind, "id": name("WARC-Record-ID"), "refers_to": name("WARC-Refers-To"), "digest": digest,
            "url": unquote(h["WARC-Target-URI"]) if "WARC-Target-URI" in h else None,
            "size": size, "payload": payload if kind == "response" else None}


INDEX = ("file string, offset long, length long, url string, digest string, {id}, record_type string, payload_bytes long")


def _record_types(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """id, url, payload (null for revisits), size, digest, first id of the equal payloads."""
    payload = F.coalesce(F.col(f"`{html_col}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{id_col}`").alias(dd._ID), F.col(f"`{url_col}`").alias("url"), payload.alias("payload"))
    rows = rows.withColumn(dd._SHA, F.unhex(F.sha1("payload")))
    size = F.octet_length("payload").cast("long")
    same = rows.filter(size >= min_bytes)
    s = dd.heavy_split(same.select(dd._ID, dd._SHA), F.min)
    heavy, light = dd._settle(same, s)
    out = []
    for part in (heavy, light):
        again = F.col("__dd_keep").isNotNull() & ~F.col(dd._ID).eqNullSafe(F.col("__dd_keep"))
        out.append(part.select(dd._ID, "url", F.when(~again, F.col("payload")).alias("payload"), size.alias("size"),
                               base32_sha1(F.col("payload")).alias("digest"),
                               F.when(again, F.col("__dd_keep")).alias("first")))
    if min_bytes > 0:
        out.append(rows.filter(size < min_bytes).select(
            dd._ID, "url", "payload", size.alias("size"), base32_sha1(F.col("payload")).alias("digest"),
            F.lit(None).cast(pages.schema[id_col].dataType).alias("first")))
    while len(out) > 1:
        out[:2] = [out[0].unionByName(out[1])]
    return out[0]


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write the archives and their index below ``folder`` (a shared URI); return the index."""
    spark = ready(pages.sparkSession)
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        fs, path = file_system(folder)
        fs.create_dir(path, recursive=True)
        task = TaskContext.get()
        out, name, at = None, None, 0
        for b in batches:
            files, offsets, lengths, kinds = [], [], [], []
            for page, url, payload, size, digest, first in zip(*[c.to_pylist() for c in b.columns]):
                if out is None or at >= FILE_BYTES:
                    if out:
                        out.close()
                    name = f"part-{task.partitionId():06d}-{task.attemptNumber()}-{uuid.uuid4().hex}.warc.gz"
                    out, at = fs.open_output_stream(f"{path}/{name}", compression=None), 0
                kind = "response" if payload is not None else "revisit"
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = z.compress(record_bytes(page, url, kind, first, payload, size, digest)) + z.flush()
                out.write(data)
                files.append(f"{folder}/{name}")
                offsets.append(at)
                lengths.append(len(data))
                kinds.append(kind)
                at += len(data)
            long = pa.int64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(files, pa.string()), pa.array(offsets, long), pa.array(lengths, long), b.column(1), b.column(4),
                 b.column(0), pa.array(kinds, pa.string()), b.column(3)], names=list("abcdefgh"))
        if out:
            out.close()

    index = _record_types(pages, id_col, url_col, html_col, min_bytes).mapInArrow(
        run, INDEX.format(id=f"`{id_col}` {id_type}"))
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX.format(id=f"`{id_col}` {id_type}")).parquet(f"{folder}/index")


def coalesce_ranges(ranges: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES):
    """Groups (first, last + 1, start, end) of sorted (offset, length) ranges read at once."""
    i = 0
    while i < len(ranges):
        start, end = ranges[i][0], sum(ranges[i])
        j = i + 1
        while j < len(ranges) and ranges[j][0] - end <= gap and sum(ranges[j]) - start <= most:
            end = max(end, sum(ranges[j]))
            j += 1
        yield i, j, start, end
        i = j


def read_tasks(selected: DataFrame) -> int:
    """Tasks that read the selected records: by their bytes in the archives, not by the bytes
    of the index (a row of it stands for a whole record)."""
    return max(1, -(-(selected.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES))


def read_records(selected: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the selected index rows, read back from the archives: record_id, url,
    record_type, payload_digest, payload_bytes, refers_to and, if asked for, payload."""
    ready(selected.sparkSession)
    rows = (selected.select("file", "offset", "length").repartitionByRange(read_tasks(selected), "file", "offset")
            .sortWithinPartitions("file", "offset"))

    def run(batches):
        handle, opened = None, None
        for b in batches:
            names, offsets, lengths = (c.to_pylist() for c in b.columns)
            at = 0
            while at < len(names):
                end = at
                while end < len(names) and names[end] == names[at]:
                    end += 1
                if opened != names[at]:
                    if handle:
                        handle.close()
                    fs, path = file_system(names[at])
                    handle, opened = fs.open_input_file(path), names[at]
                ranges = list(zip(offsets[at:end], lengths[at:end]))
                for i, j, start, stop in coalesce_ranges(ranges):
                    data = handle.read_at(stop - start, start)
                    got = [parse_record(zlib.decompress(data[o - start:o - start + n], 31)) for o, n in ranges[i:j]]
                    cols = [("id", pa.string()), ("url", pa.string()), ("type", pa.string()), ("digest", pa.string()),
                            ("size", pa.int64()), ("refers_to", pa.string())]
                    cols += [("payload", pa.binary())] if with_payload else []
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in got], t) for k, t in cols],
                                                     names=[k for k, _ in cols])
                at = end
        if handle:
            handle.close()

    return rows.mapInArrow(run, "record_id string, url string, record_type string, payload_digest string, "
                           "payload_bytes long, refers_to string" + (", payload binary" if with_payload else ""))
