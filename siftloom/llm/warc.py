"""WARC as a table of record chunks.

A reader streams each file and gives every payload as rows of a record identifier
and a chunk number; each row carries the digest of the payload so far, so a record
can be verified, or read on, without ever standing whole in memory. A writer puts
table rows into WARC files, each record a gzip member of its own.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import expire, positional, scratch

#: Bytes of payload in a chunk.
CHUNK_BYTES = 1 << 20
_PIECE = 1 << 18
_LONGEST_LINE = 1 << 16
_MAGIC = b"\x1f\x8b\x08"

CHUNKS = (
    "record_id string, warc_type string, source_id string, url string, chunk_no int, chunk_start long, "
    "n_bytes int, sha256 string, last boolean, intact boolean, payload binary"
)


#: Schemes of Hadoop that the library has under another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfs", "abfss": "abfss", "gs": "gs", "gcs": "gs", "s3": "s3", "file": "file"}


def _filesystem(uri: str):
    """(file system, path) of a URI as Hadoop writes it; a path without a scheme is
    a file of this machine. Other schemes are left to the Hadoop client library."""
    from pyarrow import fs

    scheme, mark, rest = uri.partition(":")
    if not mark or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme in _SCHEMES:
        return fs.FileSystem.from_uri(f"{_SCHEMES[scheme]}:{rest}")
    host, _, path = rest.removeprefix("//").partition("/")
    return fs.HadoopFileSystem.from_uri(f"{scheme}://{host}"), f"/{path}"


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write ``pages`` as ``resource`` records below ``path``, a file for each
    partition, and return (file, records, payload_bytes).

    A task writes under a name of its own and renames at the end, so a repeated
    task leaves one file. The record identifier is a digest of id, URL and payload:
    equal rows have the same. A null id or URL has no header; a null payload is an
    empty one with the header ``X-Payload: null``. Extra columns aren't written.
    """
    d, (i, u, p) = positional(pages, id_col, url_col, payload_col)
    sid, url, body = F.col(i).cast("string"), F.regexp_replace(F.col(u), r"[\r\n]", ""), F.col(p)
    digest = F.md5(F.concat_ws("\n", F.coalesce(sid, F.lit("")), F.coalesce(url, F.lit("")), F.md5(F.coalesce(body, F.lit("")).cast("binary"))))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    rows = d.select(F.concat_ws("-", *parts).alias("record_id"), F.regexp_replace(sid, r"[\r\n]", "").alias("sid"), url.alias("url"), body.cast("binary").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileType
        from pyspark import TaskContext

        fs, root = _filesystem(path)
        fs.create_dir(root, recursive=True)
        name = f"{root}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        own = f"{root}/.{uuid.uuid4().hex}"
        try:
            records, total = put(fs, own, batches)
            if records:
                fs.move(own, name)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records]), pa.array([total])], ["file", "records", "payload_bytes"])
        finally:  # nothing of a task that failed stays
            if fs.get_file_info(own).type != FileType.NotFound:
                fs.delete_file(own)

    def put(fs, own: str, batches: Iterator[pa.RecordBatch]) -> tuple[int, int]:
        records = total = 0
        with fs.open_output_stream(own, compression=None) as out:
            for b in batches:
                for rid, sid, url, body in zip(*(b.column(k) for k in range(4))):
                    body = body.as_buffer() if body.is_valid else None
                    size = body.size if body else 0
                    head = ["WARC/1.1", "WARC-Type: resource", f"WARC-Record-ID: <urn:uuid:{rid.as_py()}>", "WARC-Date: 2000-01-01T00:00:00Z", "Content-Type: text/html; charset=utf-8"]
                    head += [f"WARC-Target-URI: {url.as_py()}"] if url.is_valid else []
                    head += [f"X-Source-Id: {sid.as_py()}"] if sid.is_valid else []
                    head += ["X-Payload: null"] if body is None else []
                    digest = hashlib.sha256(body or b"").hexdigest()
                    head += [f"WARC-Block-Digest: sha256:{digest}", f"Content-Length: {size}", "", ""]
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    out.write(z.compress("\r\n".join(head).encode()))
                    for lo in range(0, size, _PIECE):
                        out.write(z.compress(memoryview(body)[lo : lo + _PIECE]))
                    out.write(z.compress(b"\r\n\r\n") + z.flush())
                    records, total = records + 1, total + size
        return records, total

    return rows.mapInArrow(run, "file string, records long, payload_bytes long")


class _Stream:
    """Bytes of a file, plain or of any number of gzip members, read piece by piece.
    A member that can't be read on ends what can be read until :meth:`resume`."""

    def __init__(self, raw):
        self.raw, self.held, self.at, self.z = raw, b"", 0, None
        self.broken = False
        self.rest = raw.read(_PIECE)
        self.gzip = self.rest[:2] == _MAGIC[:2]

    def _more(self) -> bool:
        """Add a piece to what is held; False at the end of the file or of what is whole."""
        piece = b""
        while not piece:
            if self.broken:
                return False
            if not self.rest:
                self.rest = self.raw.read(_PIECE)
                if not self.rest:
                    return False
            if not self.gzip:
                piece, self.rest = self.rest, b""
                continue
            if self.z is None:
                self.z = zlib.decompressobj(31)
            try:
                piece = self.z.decompress(self.rest, _PIECE)
            except zlib.error:
                self.broken, self.z = True, None
                return False
            if self.z.eof:
                self.rest, self.z = self.z.unused_data.lstrip(b"\0"), None
            else:
                self.rest = self.z.unconsumed_tail
        self.held, self.at = self.held[self.at :] + piece, 0
        return True

    def resume(self) -> None:
        """Go on at the next member after a broken one."""
        self.held, self.at, self.broken = b"", 0, False
        self.rest = self.rest[1:]
        while (k := self.rest.find(_MAGIC)) < 0:
            piece = self.raw.read(_PIECE)
            self.rest = self.rest[-2:] + piece if piece else b""
            if not piece:
                return
        self.rest = self.rest[k:]

    def read(self, n: int) -> bytes:
        while len(self.held) - self.at < n and self._more():
            pass
        out = self.held[self.at : self.at + n]
        self.at += len(out)
        return out

    def line(self) -> tuple[bytes | None, bool]:
        """(the next line without its end, whether it is whole); None at the end of
        the file. Of a line beyond ``_LONGEST_LINE`` the beginning is given and the
        rest is passed over."""
        kept, whole = b"", True
        while (k := self.held.find(b"\n", self.at)) < 0:
            if len(self.held) - self.at > _LONGEST_LINE:
                kept, whole = kept or self.held[self.at : self.at + _LONGEST_LINE], False
                self.held, self.at = b"", 0
            if not self._more():
                out, self.at = kept or self.held[self.at :], len(self.held)
                return out or None, whole
        out, self.at = kept or self.held[self.at : k], k + 1
        return out.rstrip(b"\r"), whole


def _header(s: _Stream) -> tuple[dict[str, str], bool]:
    """Fields of a record's header, and whether all of it could be read."""
    head: dict[str, str] = {}
    last, sound = None, True
    while True:
        line, whole = s.line()
        if not line:
            return head, sound and line is not None
        sound &= whole
        if line[:1] in b" \t" and last:
            head[last] += " " + line.decode("utf-8", "replace").strip()
            continue
        name, _, value = line.decode("utf-8", "replace").partition(":")
        last = name.strip().lower()
        head[last] = value.strip()


def records(raw, chunk_bytes: int) -> Iterator[tuple]:
    """Rows of ``CHUNKS`` of one open file. Memory holds one chunk and one piece.
    Damage is one row that is last and not intact; what can be read goes on after it."""
    s = _Stream(raw)
    nothing = hashlib.sha256().hexdigest()
    lost = (None, None, None, None, 0, 0, 0, nothing, True, False, None)
    skipping = False
    while True:
        line, _ = s.line()
        if line is None:
            if not s.broken:
                return
            if not skipping:  # a member that broke before its record began
                yield lost
            s.resume()
            skipping = False
            continue
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            if not skipping:
                yield lost
            skipping = True
            continue
        skipping = False
        head, sound = _header(s)
        rid = head.get("warc-record-id", "").strip("<>").removeprefix("urn:uuid:")
        names = (rid, head.get("warc-type"), head.get("x-source-id"), head.get("warc-target-uri"))
        length = head.get("content-length", "0")
        if not (length.isascii() and length.isdigit() and len(length) < 19):
            yield *names, *lost[4:]
            skipping = True
            continue
        size = int(length)
        said = head.get("warc-block-digest", "").partition("sha256:")[2].lower()
        digest, done, no = hashlib.sha256(), 0, 0
        while True:
            part = s.read(min(chunk_bytes, size - done))
            short = len(part) < min(chunk_bytes, size - done)
            digest.update(part)
            so_far = digest.copy().hexdigest()
            end = short or done + len(part) == size
            intact = not short and (not end or sound and so_far == (said or so_far))
            payload = None if head.get("x-payload") == "null" else part
            yield *names, no, done, len(part), so_far, end, intact, payload
            done, no = done + len(part), no + 1
            if end:
                break
        if short and s.broken:
            skipping = True  # its row has told of the damage


def read_warc(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunks of all records of the WARC files (plain or gzip) below ``path``.

    Every record has at least one row: an empty payload is one chunk of no bytes.
    ``sha256`` is of the payload up to the chunk's end. ``last`` marks the record's
    last chunk, where ``intact`` is false if the payload is shorter than declared
    or doesn't fit the digest declared; before it is true.

    Damage costs what is damaged only. A file that ends, or a gzip member that
    breaks, within a record gives what there is, not intact; reading goes on with
    the next member. A record whose ``Content-Length`` isn't a number gives one
    chunk without a payload, not intact, and reading goes on at the next line that
    begins a record; so does a stretch that isn't a record at all, with nulls in
    all names. Of a header line beyond 64 KiB the beginning counts, and the
    record isn't intact.
    """
    if chunk_bytes < 1:
        raise ValueError("chunk_bytes must be at least 1")
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    kinds = [pa.string()] * 4 + [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

        for b in batches:
            for name in b.column(0).to_pylist():
                fs, at = _filesystem(name)
                with fs.open_input_stream(at, compression=None) as raw:
                    for row in records(raw, chunk_bytes):
                        held.append(row)
                        size += row[6] + 256
                        if size >= 4 << 20:
                            yield batch()
                            held, size = [], 0
        if held:
            yield batch()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(path).select("path")
    return files.mapInArrow(run, CHUNKS)


def whole_records(chunks: DataFrame, largest: int = 64 << 20) -> DataFrame:
    """(record_id, source_id, url, n_bytes, whole, payload) of all records. Those of
    more than ``largest`` bytes aren't put together: ``whole`` is false, the payload
    null, and their chunks stay in the chunk table. Chunks without an identifier
    are left out."""
    size = chunks.where(F.col("record_id").isNotNull()).groupBy("record_id").agg(
        F.sum("n_bytes").alias("n_bytes"), F.min("source_id").alias("source_id"), F.min("url").alias("url")
    )
    size = size.withColumn("whole", F.col("n_bytes") <= largest)
    parts = chunks.select("record_id", "chunk_no", "payload").join(size.where("whole").select("record_id"), "record_id").groupBy("record_id").agg(F.array_sort(F.collect_set(F.struct("chunk_no", "payload"))).alias("c"))
    # an absent payload stays null: concat of nothing but nulls
    joined = F.aggregate(F.slice("c", 2, F.greatest(F.size("c") - 1, F.lit(0))), F.element_at("c", 1)["payload"], lambda a, x: F.concat(a, x["payload"]))
    return size.join(parts.select("record_id", joined.alias("payload")), "record_id", "left").select("record_id", "source_id", "url", "n_bytes", "whole", "payload")


def pages_as_chunks(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write ``pages`` as WARC files in the shared folder and read them back as
    (page_id, url, record_id, chunk_no, chunk_start, n_bytes, sha256, last, intact, payload)."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    total = write_warc(pages, path, id_col, url_col, payload_col).agg(F.sum("records")).first()[0]
    expire(spark, path)
    if not total:
        chunks = spark.createDataFrame([], CHUNKS)
    else:
        chunks = read_warc(spark, path, chunk_bytes)
    kind = pages.schema[id_col].dataType
    return chunks.select(F.col("source_id").cast(kind).alias("page_id"), "url", "record_id", "chunk_no", "chunk_start", "n_bytes", "sha256", "last", "intact", "payload")
