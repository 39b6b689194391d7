"""Monolithic gzip normaliser for WARC archives.

``write_monoliths`` writes records as whole-file gzip streams, ``normalise``
inflates each such file once, as a stream, rewrites every record as a gzip
member of its own and writes a sidecar offset index beside it; ``read_back``
reads records by that index.  Between the two a record whose payload is
already held by another record becomes a ``revisit`` of it: of equal
payloads of at least 100 bytes the one with the smallest page_id stays
``response``.

Files lie under the cluster's shared folder; a task names its files by
itself, and only files listed by a finished task (a table in the same
folder) are read, so a lost or repeated task leaves nothing but unread
files.  Working memory is one record and the index of one file, whose size
is bounded when it is written.

Edge cases: a null html is an empty payload; payloads under 100 bytes are
never revisits; rows that repeat a page_id and payload are records of
their own, one of them the response; a null page_id sorts last, is read
back as null and referred to as null; urls may hold any character (control
characters are escaped in the header); other columns are ignored."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgraph.llm import common as C
from newsgraph.session import scratch_path

LEAST_BYTES = 100
FILE_BYTES = 32 << 20   # payload bytes after which a new archive begins
READ = 1 << 20
END = b"\r\n\r\n"
_OUT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _open(path: str):
    """File system and path of a shared-folder location."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def header(kind: str, page_id, url, digest: str, size: int, refers_to=None) -> bytes:
    """Header block of a record; a revisit carries no payload."""
    name = "none" if page_id is None else str(page_id)
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>",
             f"WARC-Target-URI: {quote(url or '', safe=_URL_SAFE)}", "WARC-Date: 2024-01-01T00:00:00Z",
             f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {size}", "Content-Type: text/html"]
    if kind == "revisit":
        target = "none" if refers_to is None else str(refers_to)
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{target}>"]
    lines.append(f"Content-Length: {0 if kind == 'revisit' else size}")
    return "\r\n".join(lines).encode() + END


_URL_SAFE = "".join(chr(c) for c in range(33, 127))


def parse(head: bytes) -> dict[str, str]:
    """Fields of a header block."""
    return dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:] if x)


def page_of(field: str):
    name = field.rsplit(":", 1)[1].rstrip(">")
    return None if name == "none" else int(name)


def write_monoliths(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages as whole-file gzip archives; the table of records
    written: (file, seq, page_id, digest, size)."""
    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        out = packer = name = None
        size = seq = 0
        for b in batches:
            rows = []
            for page_id, url, html in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                payload = (html or "").encode()
                if out is None:
                    name = f"{folder}/raw-{part:05d}-{number:04d}-{uuid.uuid4().hex[:12]}.warc.gz"
                    system, path = _open(name)
                    out, packer, size, seq, number = system.open_output_stream(path, compression=None), zlib.compressobj(1, zlib.DEFLATED, 31), 0, 0, number + 1
                digest = hashlib.sha256(payload).hexdigest()
                out.write(packer.compress(header("response", page_id, url, digest, len(payload)) + payload + END))
                rows.append((name, seq, page_id, digest, len(payload)))
                size, seq = size + len(payload), seq + 1
                if size >= FILE_BYTES:
                    out.write(packer.flush())
                    out.close()
                    out = None
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64()))],
                    ["file", "seq", "page_id", "digest", "size"])
        if out is not None:
            out.write(packer.flush())
            out.close()

    return C.keep(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
                  .mapInArrow(run, "file string, seq int, page_id long, digest string, size long"), "warc-records")


def revisits(records: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(file, seq, refers_to) of the records that repeat a payload."""
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "seq")
    first = (records.where(F.col("size") >= least).groupBy("digest").agg(F.min(rank).alias("f"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("digest").alias("h"), "f"))
    # a hot payload is one key of this join, which AQE splits
    return (records.join(first, records["digest"] == first["h"])
            .where((F.col("file") != F.col("f.file")) | (F.col("seq") != F.col("f.seq")))
            .select("file", "seq", F.col("f.page_id").alias("refers_to")))


def records_of(stream):
    """(header, payload) of each record of an inflated stream of chunks."""
    held = bytearray()
    for chunk in stream:
        held += chunk
        at = 0
        while (end := held.find(END, at)) >= 0:
            head = bytes(held[at:end])
            length = int(parse(head)["Content-Length"])
            stop = end + len(END) + length + len(END)
            if stop > len(held):
                break
            yield head, bytes(held[end + len(END):end + len(END) + length])
            at = stop
        del held[:at]
    if held:
        raise ValueError("archive ends inside a record")


def inflate(source):
    """Chunks of the data in a gzip stream of one member or several."""
    engine = zlib.decompressobj(31)
    while raw := source.read(READ):
        while raw:
            yield engine.decompress(raw)
            raw = engine.unused_data
            if engine.eof:
                engine = zlib.decompressobj(31)
    if engine.unconsumed_tail:
        yield engine.flush()


def normalise(records: DataFrame, folder: str) -> DataFrame:
    """Rewrite each monolithic archive with a member per record and a
    sidecar index; the table of files written: (file, idx, n)."""
    spark = records.sparkSession
    back = (revisits(records).groupBy("file").agg(F.collect_list(F.struct("seq", "refers_to")).alias("again")))
    files = records.select("file").distinct().join(back, "file", "left")
    # a list of few rows with much work each: dealt by a key of its own, which
    # neither the join's partitioning nor coalescing takes over
    files = files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("file", F.lit(1)))

    def run(batches):
        for b in batches:
            for name, again in zip(b.column("file").to_pylist(), b.column("again").to_pylist()):
                to = {x["seq"]: x["refers_to"] for x in again or ()}
                stem = f"{folder}/norm-{os.path.basename(name)[4:-8]}-{uuid.uuid4().hex[:8]}"
                system, path = _open(name)
                index, at, n = [], 0, 0
                with system.open_input_stream(path, compression=None) as source, \
                        system.open_output_stream(_open(f"{stem}.warc.gz")[1], compression=None) as out:
                    for head, payload in records_of(inflate(source)):
                        f = parse(head)
                        kind = "revisit" if n in to else "response"
                        if kind == "revisit":
                            block = _as_revisit(head, to[n])
                        else:
                            block = head + END + payload + END
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = packer.compress(block) + packer.flush()
                        out.write(member)
                        index.append({"offset": at, "length": len(member), "id": f["WARC-Record-ID"], "type": kind})
                        at, n = at + len(member), n + 1
                with system.open_output_stream(_open(f"{stem}.idx")[1], compression=None) as out:
                    out.write("".join(json.dumps(x) + "\n" for x in index).encode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{stem}.warc.gz"]), pa.array([f"{stem}.idx"]), pa.array([n], pa.int64())], ["file", "idx", "n"])

    return C.keep(files.mapInArrow(run, "file string, idx string, n long"), "warc-files")


def _as_revisit(head: bytes, refers_to) -> bytes:
    """The record of ``head`` without its payload, pointing at another."""
    target = "none" if refers_to is None else str(refers_to)
    lines = [x for x in head.split(b"\r\n") if not x.startswith((b"WARC-Type:", b"Content-Length:"))]
    lines[1:1] = [b"WARC-Type: revisit"]
    lines += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
              f"WARC-Refers-To: <urn:page:{target}>".encode(), b"Content-Length: 0"]
    return b"\r\n".join(lines) + END + END


def read_back(files: DataFrame) -> DataFrame:
    """One row per record of the normalised archives, each read by its index
    entry; the digest and length are those of the payload read, for a
    revisit those of the payload it stands for."""
    spark = files.sparkSession

    def run(batches):
        for b in batches:
            for name, idx in zip(b.column("file").to_pylist(), b.column("idx").to_pylist()):
                system, path = _open(name)
                with system.open_input_stream(_open(idx)[1], compression=None) as f:
                    entries = [json.loads(x) for x in f.read().splitlines()]
                rows = []
                with system.open_input_file(path) as f:
                    for e in entries:
                        f.seek(e["offset"])
                        block = zlib.decompress(f.read(e["length"]), 31)
                        head, payload = next(records_of([block]))
                        h = parse(head)
                        digest, size, to = h["WARC-Payload-Digest"][7:], int(h["WARC-Payload-Length"]), None
                        if h["WARC-Type"] == "revisit":
                            to = page_of(h["WARC-Refers-To"])
                        elif (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
                            raise ValueError(f"{name} at {e['offset']}: the payload is not the one recorded")
                        rows.append((page_of(h["WARC-Record-ID"]), size, digest, h["WARC-Type"], to))
                for lo in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows[lo:lo + 10_000]), (
                            pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                        ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return (files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file").mapInArrow(run, _OUT))


def op7(pages: DataFrame) -> DataFrame:
    """The registered query."""
    spark: SparkSession = pages.sparkSession
    C.use_small_batches(spark)
    folder = scratch_path(spark, "llm-warc")
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    return read_back(normalise(write_monoliths(pages, folder), folder))
