"""WARC archives: writing, normalising and reading them.

``write_archives`` writes pages as WARC records, each file one whole-file gzip
stream. ``normalise`` inflates every such stream once, from start to end, and
rewrites each record as a gzip member of its own, beside a sidecar index (one
JSON line per record: offset, length, type, id, target, payload digest), so
that a record can be read alone. ``read_archives`` does that.

Files go through the file system of the folder's address (local or shared
paths, or what pyarrow.fs knows); a task's files carry its attempt in their
names and count only once the task's rows say so, so a lost executor leaves
nothing half-written behind that is read.

Records: pages with equal payloads of ``REVISIT_BYTES`` or more are one response
(the smallest page id) and revisits that refer to it; smaller ones are all
responses. A null html is an empty payload, a null url has no target header,
rows of null page id are responses that nothing refers to, repeated rows of the
smallest id are responses each; an empty table makes no file. Other columns
play no part.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import checkpoint_table, map_arrow

REVISIT_BYTES = 100
FILE_BYTES = 32 << 20
LEVEL = 6
COPY = 1 << 20
VERSION = b"WARC/1.1\r\n"
DATE = "2000-01-01T00:00:00Z"  # pages have no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def store(address: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(address.replace("s3a://", "s3://", 1))


# ---------------------------------------------------------------- records

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or (with ``refers_to``) a revisit record without payload."""
    revisit = refers_to is not None
    block = HTTP.format(len(payload)).encode() + (b"" if revisit else payload)
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}:{digest[:16]}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
        "X-Payload-Length": len(payload),
    }
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    if page_id is not None:
        head["X-Page-ID"] = page_id
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}:{digest[:16]}>",
                 "X-Refers-To-Page-ID": refers_to}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def read_head(stream) -> tuple[bytes, dict[str, str]] | None:
    """A record's header as it stands and as names in lower case; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    raw, head = [line], {}
    while (line := stream.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise ValueError("a WARC header breaks off")
        raw.append(line)
        name, _, value = line.decode("utf-8", "replace").partition(":")
        head[name.strip().lower()] = value.strip()
    return b"".join(raw) + b"\r\n", head


def copy_block(stream, length: int, write) -> None:
    while length:
        part = stream.read(min(COPY, length))
        if not part:
            raise ValueError("a WARC record breaks off")
        write(part)
        length -= len(part)


# ---------------------------------------------------------------- archives

def _writer(folder: str, file_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = store(folder)
        context = TaskContext.get()
        stem = f"{root}/{context.partitionId():06d}-{context.taskAttemptId()}"
        files: list[tuple[str, int]] = []
        out, size, count = None, 0, 0

        def close():
            nonlocal out, size, count
            if out is not None:
                out[0].close()
                out[1].close()
                files.append((out[2], count))
            out, size, count = None, 0, 0

        for b in batches:
            for row in zip(*[b.column(k) for k in ("page_id", "url", "html", "digest", "refers_to")], strict=True):
                page_id, url, html, digest, refers_to = (x.as_py() for x in row)
                if out is None:
                    fs.create_dir(root, recursive=True)
                    path = f"{stem}-{len(files):04d}.warc.gz"
                    sink = fs.open_output_stream(path, compression=None)
                    out = gzip.GzipFile(fileobj=sink, mode="wb", compresslevel=level, mtime=0), sink, path
                data = record(page_id, url, html.encode("utf-8", "surrogatepass"), digest, refers_to)
                out[0].write(data)
                size += len(data)
                count += 1
                if size >= file_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in files], pa.string()), pa.array([f[1] for f in files], pa.int64())], ["path", "records"])
    return run


def normalise_stream(source, sink, index, level: int = LEVEL) -> int:
    """Rewrites one inflated WARC stream: members to ``sink``, index lines to ``index``."""
    at = count = 0
    while (found := read_head(source)) is not None:
        raw, head = found
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        length = 0

        def put(data: bytes) -> None:
            nonlocal length
            if data:
                sink.write(data)
                length += len(data)

        put(z.compress(raw))
        copy_block(source, int(head["content-length"]), lambda part: put(z.compress(part)))
        put(z.compress(b"\r\n\r\n"))
        put(z.flush())
        line = {"offset": at, "length": length, "type": head.get("warc-type"), "id": head.get("warc-record-id"),
                "target": head.get("warc-target-uri"), "digest": head.get("warc-payload-digest")}
        index.write(json.dumps(line).encode() + b"\n")
        at += length
        count += 1
    return count


def _normaliser(folder: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = store(folder)
        attempt = TaskContext.get().taskAttemptId()
        for b in batches:
            for path in b.column("path").to_pylist():
                fs.create_dir(root, recursive=True)
                name = f"{root}/{attempt}-{path.rsplit('/', 1)[-1]}"
                with fs.open_input_stream(path, compression=None) as raw, \
                        io.BufferedReader(gzip.GzipFile(fileobj=raw), COPY) as source, \
                        fs.open_output_stream(name, compression=None) as sink, \
                        fs.open_output_stream(f"{name}.idx", compression=None) as index:
                    n = normalise_stream(source, sink, index, level)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([f"{name}.idx"]), pa.array([n])],
                                                 ["path", "index", "records"])
    return run


def member(data: bytes) -> tuple[dict[str, str], bytes]:
    """The header and payload (without the HTTP header) of one gzip member."""
    stream = io.BytesIO(zlib.decompress(data, 31))
    _, head = read_head(stream)
    block = stream.read(int(head["content-length"]))
    return head, block.partition(b"\r\n\r\n")[2]


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = store(folder)
        number = lambda x: None if x is None else int(x)
        for b in batches:
            for path, index in zip(b.column("path").to_pylist(), b.column("index").to_pylist(), strict=True):
                rows = []
                with fs.open_input_file(path) as f, fs.open_input_stream(index, compression=None) as lines:
                    for line in io.BufferedReader(lines):
                        at = json.loads(line)
                        f.seek(at["offset"])
                        head, payload = member(f.read(at["length"]))
                        digest = head["warc-payload-digest"].removeprefix("sha256:")
                        size = int(head["x-payload-length"])
                        if head["warc-type"] == "response" and (
                                len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"{path} at {at['offset']}: the payload is not what its header says")
                        rows.append((number(head.get("x-page-id")), size, digest, head["warc-type"],
                                     number(head.get("x-refers-to-page-id"))))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                            pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)],
                        ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return run


# ---------------------------------------------------------------- jobs

def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a smaller id has too."""
    info = pages.where(F.octet_length("html") >= least).select("page_id", "digest")
    firsts = checkpoint_table(info.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
                              .where("n > 1").drop("n"), "payloads")
    return info.join(firsts, "digest").where("page_id > refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, level: int = LEVEL) -> DataFrame:
    """Writes a record per row of (page_id, url, html); (path, records) of the files."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha2("html", 256))
    typed = p.join(revisits(p), ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")
    return checkpoint_table(map_arrow(typed, _writer(folder, file_bytes, level), "path string, records long"), "archives")


def normalise(archives: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """(path, index, records) of the archives rewritten, one task per file."""
    n = max(1, archives.count())
    return checkpoint_table(map_arrow(archives.select("path").repartition(n, "path"), _normaliser(folder, level),
                                      "path string, index string, records long"), "normalised")


def read_archives(normalised: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per record, by the index."""
    n = max(1, normalised.count())
    return map_arrow(normalised.select("path", "index").repartition(n, "path"), _reader(folder),
                     "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages written, normalised and read back, under the shared folder."""
    folder = scratch_path(spark, "warc")
    whole = write_archives(pages, f"{folder}/whole")
    return read_archives(normalise(whole, f"{folder}/records"), folder)
