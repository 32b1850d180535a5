"""WARC archives as a chunked record table.

*Writing.* Payload digests and lengths are computed where the payload lies; of
equal payloads the largest key becomes the response and the others revisit it.
Only groups of several equal payloads meet the pages again, over ``SALTS`` copies,
so a payload shared by a third of all pages is spread. Pages then become rows of
(record, chunk number, at most ``CHUNK`` bytes), and each task streams its rows
into one archive, a gzip member per record, checking the digest as it goes. No
Python task holds more than a batch of chunks of a payload.

*Commit.* A task writes a file of a new name in the shared folder and returns its
name; the stored manifest of the successful tasks' files is what is read. Files
of lost or repeated attempts are never read.

*Reading.* Each archive is streamed through a bounded buffer into chunk rows that
carry the payload's length and digest up to and including the chunk; the last
one's are the record's. A record whose digest is not the declared one raises, as
does a truncated archive.

Null payloads are empty; null URLs have no target line; line ends in URLs are
percent-encoded. A null key is smaller than any other. Repeated rows of the
largest key are all responses. An empty table gives no archives and no records.
Archives are read and written through ``pyarrow.fs``, so the shared folder may be
any store that it knows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.scratch import fresh_path, partitions, ship, stored

CHUNK = 1 << 20
SALTS = 16
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
#: Fixed values of the format.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CHUNKS = (
    "path string, record_id string, page_id long, record_type string, refers_to long, "
    "chunk_no long, n_bytes long, digest string, last boolean, data binary"
)


def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
            chunk: int = CHUNK) -> DataFrame:
    """``page_id, url, sha1, n_bytes, record_type, refers_to, chunk_no, last, data``:
    the chunk rows of every page's record, a record's in order. Revisits have one
    row without data."""
    body = F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("body"))
    rows = rows.withColumn("sha1", F.sha1("body")).withColumn("n_bytes", F.octet_length("body").cast("long"))
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS))
    shared = (
        rows.groupBy("sha1", "n_bytes")
        .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("sha1", "n_bytes", "newest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")).alias("salt"))
    )
    known = rows.withColumn("salt", salt).join(shared, ["sha1", "n_bytes", "salt"], "left")
    again = F.col("newest").isNotNull() & ~F.col("newest").eqNullSafe(F.col("page_id"))
    known = known.select(
        "page_id", "url", "sha1", "n_bytes",
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(again, F.col("newest")).alias("refers_to"),
        F.when(~again, F.col("body")).alias("body"),
    )
    count = F.when(F.col("body").isNull(), F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / F.lit(chunk)))
    ).cast("long")
    cut = known.withColumn("chunks", count).withColumn(
        "chunk_no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    )
    return cut.select(
        "page_id", "url", "sha1", "n_bytes", "record_type", "refers_to", "chunk_no",
        (F.col("chunk_no") == F.col("chunks") - 1).alias("last"),
        F.expr(f"substring(body, cast(chunk_no * {chunk} + 1 as int), {chunk})").alias("data"),
    )


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode("ascii")


def record_head(page_id, url, sha1_hex, n_bytes, record_type, refers_to) -> bytes:
    """A record up to its payload: the header, a blank line and the HTTP head."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    length = len(http) + (n_bytes if record_type == "response" else 0)
    lines = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{_base32(bytes.fromhex(sha1_hex))}")
    if record_type == "revisit":
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_name(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + http


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Write the chunk rows as archives under ``folder``; the stored manifest:
    ``path, n_records, n_bytes`` of every archive."""
    ship(chunks.sparkSession)

    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        out = None
        n_records = n_written = 0
        for b in batches:
            for page_id, url, sha1, size, kind, refers, no, last, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    store.create_dir(base, recursive=True)
                    path = f"{base}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(path, compression=None)
                if no == 0:
                    member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    running = hashlib.sha1()
                    n_written += out.write(member.compress(record_head(page_id, url, sha1, size, kind, refers)))
                if data:
                    running.update(data)
                    n_written += out.write(member.compress(data))
                if last:
                    if kind == "response" and running.hexdigest() != sha1:
                        raise ValueError(f"chunks of page {page_id} do not make up its payload")
                    n_written += out.write(member.compress(b"\r\n\r\n") + member.flush())
                    n_records += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([n_records]), pa.array([n_written])], names=["path", "n_records", "n_bytes"]
            )

    return stored(chunks.mapInArrow(run, "path string, n_records long, n_bytes long"), "warc-manifest")


class _Reader:
    """A gzip archive as lines and blocks, through a bounded buffer."""

    def __init__(self, stream):
        self.blocks = self._plain(stream)
        self.buffer = bytearray()

    @staticmethod
    def _plain(stream) -> Iterator[bytes]:
        member, begun = zlib.decompressobj(31), False
        while block := stream.read(1 << 18):
            block = bytes(block)
            while block:
                begun = True
                out = member.decompress(block, CHUNK)
                if out:
                    yield out
                if member.eof:
                    block, member, begun = member.unused_data, zlib.decompressobj(31), False
                else:
                    block = member.unconsumed_tail
        if begun:
            raise ValueError("the archive ends within a record")

    def _more(self) -> bool:
        block = next(self.blocks, None)
        if block is None:
            return False
        self.buffer += block
        return True

    def line(self) -> bytes | None:
        """The next line without its end; null at the end of the archive."""
        while (at := self.buffer.find(b"\r\n")) < 0:
            if not self._more():
                if self.buffer:
                    raise ValueError("the archive ends within a line")
                return None
        out = bytes(self.buffer[:at])
        del self.buffer[: at + 2]
        return out

    def block(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def fields(self) -> dict[str, str]:
        out = {}
        while line := self.line():
            name, _, value = line.decode("utf-8", "surrogatepass").partition(": ")
            out[name] = value
        return out


def _page(name: str | None) -> int | None:
    value = name[len("<urn:page:") : -1] if name else "null"
    return None if value == "null" else int(value)


def chunk_rows(stream, path: str, chunk: int = CHUNK) -> Iterator[tuple]:
    """The chunk rows of one archive."""
    reader = _Reader(stream)
    while (version := reader.line()) is not None:
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        head = reader.fields()
        kind, left = head["WARC-Type"], int(head["Content-Length"])
        status = reader.line()
        http = reader.fields()
        size = int(http["Content-Length"])
        left -= len(status) + 2 + sum(len(k) + len(v.encode()) + 4 for k, v in http.items()) + 2
        record, page = head["WARC-Record-ID"], _page(head["WARC-Record-ID"])
        declared = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "revisit":
            yield path, record, page, kind, _page(head["WARC-Refers-To"]), 0, size, declared, True, None
        else:
            running, done, no = hashlib.sha1(), 0, 0
            while True:
                data = reader.block(min(chunk, left - done))
                running.update(data)
                done += len(data)
                digest = _base32(running.copy().digest())
                if done == left and digest != declared:
                    raise ValueError(f"{record} in {path}: digest {digest}, declared {declared}")
                yield path, record, page, kind, None, no, done, digest, done == left, data
                no += 1
                if done == left:
                    break
        if reader.block(4) != b"\r\n\r\n":
            raise ValueError(f"{record} in {path} does not end where it says")


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, with_data: bool = True) -> DataFrame:
    """The chunk table of the archives in the manifest: ``path, record_id, page_id,
    record_type, refers_to, chunk_no, n_bytes, digest, last, data``; without
    ``with_data`` the payload bytes stay in the task that reads them."""
    ship(spark)
    names = [f.split()[0] for f in _CHUNKS.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
             pa.bool_(), pa.binary()]

    def run(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path in b.column(0).to_pylist():
                held, size = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for row in chunk_rows(stream, path):
                        held.append(row if with_data else (*row[:-1], None))
                        size += 400 + len(held[-1][-1] or b"")
                        if size > 8 * CHUNK:
                            yield _batch(held)
                            held, size = [], 0
                if held:
                    yield _batch(held)

    def _batch(rows):
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return manifest.select("path").repartition(partitions(spark), "path").mapInArrow(run, _CHUNKS)


def op3_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written as a record and read back from its archive."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = fresh_path(spark, "warc")
    manifest = write_archives(records(pages), folder)
    return read_archives(spark, manifest, folder, with_data=False).where("last").select(
        "page_id",
        F.col("n_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        "path",
    )


__all__ = ["records", "record_head", "write_archives", "read_archives", "chunk_rows", "op3_warc"]
