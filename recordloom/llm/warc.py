"""WARC archives: a writer with one gzip member per record, and a reader that splits files by byte ranges.

A reading task gets a byte range, looks in it for the gzip magic, and accepts a
candidate only if the member that starts there decodes to a WARC header.  It owns
the records that start in its range and reads past its end to finish the last.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.common import pieces_of, take, written
from recordloom.session import run_folder

MAGIC = b"\x1f\x8b\x08"
BLOCK = 1 << 20
RANGE_BYTES = 32 << 20
FEED = 1 << 13
MIN_REVISIT_BYTES = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it (``file:/a`` and ``file:///a`` alike)."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


# ---- writing


def mark_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
                  min_bytes: int = MIN_REVISIT_BYTES, salts: int = 16) -> DataFrame:
    """Rows ``page_id, url, payload, digest, refers_to``: of equal payloads of ``min_bytes`` or more the largest id is kept whole.

    ``refers_to`` is that id, null for a record that carries its payload.  Rows
    that tie on the largest id all carry it.  A null id is smaller than any other;
    if all ids of a group are null, all rows carry the payload.  Null payloads are
    empty.  Groups are aggregated before they are shuffled, and the join back is
    salted, so that one payload on a third of the pages is spread.
    """
    p = take(pages, page_id, url, payload).toDF("page_id", "url", "payload")
    p = p.withColumn("payload", F.coalesce(F.col("payload"), F.lit("")).cast("binary")).withColumn("digest", F.sha1("payload"))
    large = p.where(F.length("payload") >= min_bytes)
    groups = large.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n")
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    p = p.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    j = p.join(groups, ["digest", "salt"], "left")
    revisit = (F.length("payload") >= min_bytes) & F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return j.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("keeper")).alias("refers_to"))


def _line(value: object) -> str:
    return "".join(c if c >= " " and c != "\x7f" else "%%%02X" % ord(c) for c in str(value))


def _record(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else _line(page_id)}>"]
    head += [f"WARC-Date: {date}", *([f"WARC-Target-URI: {_line(url)}"] if url else [])]
    head += ["WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{_line(refers_to)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(records: DataFrame, folder: str, file_bytes: int = 256 << 20) -> DataFrame:
    """Write records of ``mark_revisits`` under ``folder``; the manifest ``path, bytes, records`` is returned as a written table.

    Files carry the task attempt in their name, and only files of attempts that
    ended are in the manifest, so a lost executor or a second attempt leaves
    nothing that is read.  Tasks start a new file beyond ``file_bytes``.
    """
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        tag = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        out, done = None, []
        for b in pieces_of(batches, 2):
            for row in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if out is None:
                    name = f"part-{tag}-{len(done):04d}.warc.gz"
                    out, size, n = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = gz.compress(_record(*row, date)) + gz.flush()
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, n))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], ["path", "bytes", "records"])

    return written(records.mapInArrow(run, "path string, bytes bigint, records bigint"), "warc-manifest")


# ---- reading


def warc_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, bytes`` of the archives at a path or glob.  Only names and lengths are read."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))


class _Window:
    """Bytes of a file from ``at`` on, read block by block; bytes before ``at`` are let go."""

    def __init__(self, file, at: int, size: int):
        self.file, self.at, self.size, self.buf, self.pos = file, at, size, b"", 0

    def more(self) -> bool:
        known = self.at + len(self.buf) - self.pos
        got = self.file.read_at(min(BLOCK, self.size - known), known) if known < self.size else b""
        self.buf, self.pos = self.buf[self.pos :] + got, 0
        return bool(got)

    def skip(self, n: int) -> None:
        self.pos, self.at = self.pos + n, self.at + n

    def find_magic(self) -> bool:
        """Move to the next gzip magic; False at the end of the file."""
        while (i := self.buf.find(MAGIC, self.pos)) < 0:
            self.skip(max(0, len(self.buf) - self.pos - len(MAGIC) + 1))
            if not self.more():
                return False
        self.skip(i - self.pos)
        return True

    def member(self) -> tuple[bytes, int] | None:
        """The decoded member that starts here and its coded length; None if none does."""
        gz, fed, parts, size, valid = zlib.decompressobj(31), 0, [], 0, False
        while not gz.eof:
            if self.pos + fed == len(self.buf) and not self.more():
                return None  # cut off
            part = self.buf[self.pos + fed : self.pos + fed + FEED]
            try:
                parts.append(gz.decompress(part))
            except zlib.error:
                return None
            fed, size = fed + len(part), size + len(parts[-1])
            if not valid and size >= 5:
                if not b"".join(parts).startswith(b"WARC/"):
                    return None
                valid = True
        return (b"".join(parts), fed - len(gz.unused_data)) if valid else None


def _headers(raw: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def _parse(data: bytes) -> tuple | None:
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        return None
    h = _headers(head)
    block = rest[: int(h["content-length"])] if h.get("content-length", "").isdigit() else rest
    payload, full = block, len(block)
    if h.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        stated = _headers(http).get("content-length", "")
        full = int(stated) if stated.isdigit() else len(payload)
    kind = h.get("warc-type")
    if kind == "revisit":
        payload = None
    digest = h.get("warc-payload-digest", "")
    stated_digest = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") and len(digest) == 37 else None
    actual = stated_digest if payload is None else hashlib.sha1(payload).hexdigest()
    return (h.get("warc-record-id"), kind, h.get("warc-target-uri"), h.get("warc-date"), h.get("warc-refers-to"), payload, full if payload is None else len(payload), actual,
            payload is None or stated_digest is None or stated_digest == actual)


_READ = [("path", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()),
         ("refers_to", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_())]


def records_in(path: str, start: int, end: int, size: int) -> Iterator[tuple]:
    """The records that start in ``[start, end)`` of a file."""
    store, name = _open(path)
    with store.open_input_file(name) as f:
        w = _Window(f, start, size)
        while w.at < end and w.find_magic() and w.at < end:
            got = w.member()
            row = _parse(got[0]) if got else None
            if row is None:
                w.skip(1)
                continue
            yield (path, w.at, *row)
            w.skip(got[1])


def read_warc(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of the archives in ``files`` (``path, bytes``): one row each, columns as in ``_READ``.

    Bytes that are no WARC member (damage, padding, other gzip data) are passed
    over; a member that is cut off is no record.  A revisit has a null payload and
    the length that its HTTP header states; ``digest_ok`` is false where a payload
    does not match its stated digest.  A file listed twice is read twice; empty
    files and an empty list give no rows.
    """
    f = take(files, "path", "bytes").where("bytes > 0")
    r = f.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint"))).alias("start"))
    n = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    r = r.repartition(n, "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0

        def pack() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(zip(*held, strict=True), _READ, strict=True)], [n for n, _ in _READ])

        for b in batches:
            for path, size, start in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                for row in records_in(path, start, min(start + range_bytes, size), size):
                    held.append(row)
                    weight += len(row[7] or b"") + 200
                    if weight >= 8 << 20:
                        yield pack()
                        held, weight = [], 0
        if held:
            yield pack()

    schema = ", ".join(f"{n} {'bigint' if t == pa.int64() else 'binary' if t == pa.binary() else 'boolean' if t == pa.bool_() else 'string'}" for n, t in _READ)
    return r.mapInArrow(run, schema)


def archive(pages: DataFrame, tag: str = "warc", **columns: str) -> tuple[str, DataFrame]:
    """Write pages as archives in the shared folder: the folder and the manifest."""
    folder = run_folder(pages.sparkSession, tag)
    return folder, write_warc(mark_revisits(pages, **columns), folder)
