"""WARC archives: a Spark source and sink (format ``warc``), and an archiver that writes equal payloads once.

Archives are ``.warc.gz`` files of WARC 1.1 records, each record one gzip member.  A ``response`` holds an HTTP response head and
the payload; a ``revisit`` (identical payload digest) holds the head alone and names the response's record.  Digests are SHA-1.

Sequential reader: a task reads an archive from its beginning in chunks.  Each member is inflated incrementally and its bytes are
framed as they come: the record's head up to the blank line, then a block of ``Content-Length`` bytes, of which the part
after the HTTP head is the payload, then two line ends.  Digests are taken along the way and compared with those in the head.  Without
payloads (``payload=false``) a task holds a chunk, whatever the records' sizes.  A record whose block or payload does not fit its
length or digest has a text in ``error``.  Where inflating fails (a damaged or cut member) one row says so, and reading goes on at the
next member that begins a record.

Writer: a task appends records to archives of bounded size under a folder of the attempt's own; the commit moves those of the
attempts that succeeded into place, so a repeated or lost task leaves nothing twice.

Defined results of ``write_archives``: a null payload is empty; a null url gives no target; rows with a null id have no id in the archive and
are smaller than any other; control characters and spaces in a url are percent-encoded in the archive; rows that repeat the largest id
of equal payloads are all responses, under the same record id; empty tables give no archives; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from gridmart.llm.common import Scratch

MIN_REVISIT = 1000                # bytes; smaller payloads are always written
ARCHIVE_BYTES = 1 << 30           # a new archive is begun beyond this many compressed bytes
CHUNK = 1 << 18
MAX_HEAD = 1 << 20                # bytes of a record's or an HTTP head
DATE = "1970-01-01T00:00:00Z"     # of records without a date of their own, so that reruns agree
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"

#: What the sink takes (any of these columns, by name) and the source gives, besides place and error.
FIELDS = ("type string, record_id string, uri string, date string, refers_to string, refers_to_uri string, id string, "
          "payload_bytes long, payload_digest string, payload binary")
SCHEMA = f"archive string, offset long, {FIELDS}, error string"
_HEADERS = {"type": "WARC-Type", "record_id": "WARC-Record-ID", "uri": "WARC-Target-URI", "date": "WARC-Date",
            "refers_to": "WARC-Refers-To", "refers_to_uri": "WARC-Refers-To-Target-URI", "id": "X-Source-ID"}


# Records

def _digest(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def record(head: dict[str, str | None], block: bytes) -> bytes:
    """One gzip member."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in head.items() if v is not None), f"Content-Length: {len(block)}", "", ""]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + deflate.flush()


def _bracketed(x: str | None) -> str | None:
    return None if x is None else f"<{x}>"


def page_record(row: dict) -> bytes:
    """A response or revisit of a row with the columns of ``FIELDS``."""
    payload, revisit = row.get("payload") or b"", row["type"] == "revisit"
    digest = bytes.fromhex(row["payload_digest"]) if revisit else hashlib.sha1(payload).digest()
    size = row["payload_bytes"] if revisit else len(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block += b"" if revisit else payload
    return record({
        "WARC-Type": row["type"], "WARC-Record-ID": _bracketed(row["record_id"]), "WARC-Date": row.get("date") or DATE,
        "WARC-Target-URI": row.get("uri"), "WARC-Refers-To": _bracketed(row.get("refers_to")),
        "WARC-Refers-To-Target-URI": row.get("refers_to_uri"), "WARC-Profile": PROFILE if revisit else None,
        "X-Source-ID": row.get("id"), "WARC-Payload-Digest": _digest(digest),
        "WARC-Block-Digest": _digest(hashlib.sha1(block).digest()), "Content-Type": "application/http;msgtype=response"}, block)


class Damaged(ValueError):
    pass


@dataclass
class Framer:
    """Takes a member's bytes as they are inflated, and splits them into head, block and end."""

    keep: bool
    head: dict[str, str] = field(default_factory=dict)
    http: dict[str, str] = field(default_factory=dict)
    payload: list[bytes] = field(default_factory=list)
    size: int = 0                     # of the payload in the record

    def __post_init__(self):
        self.state, self.pending, self.left = "head", b"", 0
        self.block_sha1, self.payload_sha1 = hashlib.sha1(), hashlib.sha1()

    def _blank_line(self) -> bytes | None:
        """The pending bytes up to a blank line, taken off; None while there is none."""
        at = self.pending.find(b"\r\n\r\n")
        if at < 0:
            if len(self.pending) > MAX_HEAD:
                raise Damaged("no end of the head")
            return None
        text, self.pending = self.pending[:at], self.pending[at + 4:]
        return text

    @staticmethod
    def _fields(text: bytes) -> tuple[str, dict[str, str]]:
        first, *lines = text.decode("utf-8", "replace").split("\r\n")
        found: dict[str, str] = {}
        name = ""
        for line in lines:
            if line[:1] in (" ", "\t") and name:         # a folded line goes on with the one before
                found[name] += " " + line.strip()
            elif ":" in line:
                name, value = line.split(":", 1)
                name = name.strip().lower()
                found[name] = value.strip()
        return first, found

    def feed(self, data: bytes) -> None:
        if self.state == "payload" and not self.pending:
            return self._payload(data)
        self.pending += data
        if self.state == "head" and (text := self._blank_line()) is not None:
            version, self.head = self._fields(text)
            if not version.startswith("WARC/"):
                raise Damaged("not a WARC record")
            length = self.head.get("content-length", "")
            if not length.isascii() or not length.isdigit():
                raise Damaged("no Content-Length")
            self.left = int(length)
            self.state = "http" if self.head.get("content-type", "").replace(" ", "").startswith("application/http") else "payload"
        if self.state == "http":
            within = self.pending[: self.left]
            at = within.find(b"\r\n\r\n")
            if at >= 0 or len(self.pending) >= self.left:
                at = at + 4 if at >= 0 else self.left            # a block without an end of its head is all head
                self.block_sha1.update(within[:at])
                self.http = self._fields(within[:at].rstrip(b"\r\n"))[1]
                self.left -= at
                self.pending, self.state = self.pending[at:], "payload"
            elif len(self.pending) > MAX_HEAD:
                raise Damaged("no end of the HTTP head")
        if self.state == "payload":
            rest, self.pending = self.pending, b""
            self._payload(rest)

    def _payload(self, data: bytes) -> None:
        part = data[: self.left]
        self.block_sha1.update(part)
        self.payload_sha1.update(part)
        self.left -= len(part)
        self.size += len(part)
        if self.keep and part:
            self.payload.append(part)
        if not self.left:
            self.pending, self.state = data[len(part):], "end"

    def row(self) -> dict:
        """The finished record's columns of ``SCHEMA``."""
        error = None
        if self.state == "head":
            error = "no end of the head"
        elif self.state != "end" or self.left:
            error = f"the block is {self.left} bytes short"
        elif self.pending != b"\r\n\r\n":
            error = "the record does not end after its block"
        out = {name: self.head.get(header.lower()) for name, header in _HEADERS.items()}
        for name in ("record_id", "refers_to"):
            out[name] = out[name].strip("<>") if out[name] else None
        told = self.head.get("warc-payload-digest")
        revisit = out["type"] == "revisit"
        block = self.head.get("warc-block-digest")
        if error is None and block and not _same(block, self.block_sha1.digest()):
            error = "block digest"
        if error is None and told and not revisit and not _same(told, self.payload_sha1.digest()):
            error = "payload digest"
        out["payload_digest"] = _hex(told) if revisit and told else self.payload_sha1.hexdigest()
        length = self.http.get("content-length", "")
        out["payload_bytes"] = (int(length) if length.isascii() and length.isdigit() else None) if revisit else self.size
        out["payload"] = b"".join(self.payload) if self.keep and not revisit else None
        return {**out, "error": error}


def _hex(told: str) -> str | None:
    """The hex digits of a SHA-1 digest field in base 32 or 16; None if it is neither."""
    kind, _, value = told.partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        return (bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value.upper())).hex()
    except ValueError:
        return None


def _same(told: str, sha1: bytes) -> bool:
    """Whether a digest field agrees; one of another kind cannot be compared and passes."""
    return _hex(told) == sha1.hex() if told.lower().startswith("sha1:") else True


def records(file, keep: bool = True, chunk: int = CHUNK) -> Iterator[dict]:
    """The records of an open archive (``read``, ``seek``) from its beginning on, with ``offset``."""
    offset, buffer, lost = 0, b"", False
    while True:
        if not buffer:
            buffer = file.read(chunk)
            if not buffer:
                return
        inflate, framer, read = zlib.decompressobj(31), Framer(keep), 0
        try:
            while not inflate.eof:
                if not buffer:
                    buffer = file.read(chunk)
                    if not buffer:
                        raise Damaged("the member is cut off")
                out = inflate.decompress(buffer, 4 * chunk)
                rest = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
                read += len(buffer) - len(rest)
                if not out and len(rest) == len(buffer):
                    raise Damaged("inflating does not go on")
                buffer = rest
                framer.feed(out)
            yield {"offset": offset, **framer.row()}
            lost, offset = False, offset + read
        except (zlib.error, Damaged) as exc:
            if not lost:
                yield {"offset": offset, "error": f"damaged: {exc}"}
            lost = True
            offset = _next_member(file, offset + 1, chunk)
            if offset < 0:
                return
            file.seek(offset)
            buffer = b""


def _next_member(file, offset: int, chunk: int) -> int:
    """Where the next bytes that can begin a member are; -1 at the end."""
    file.seek(offset)
    tail = b""
    while data := file.read(chunk):
        at = (tail + data).find(MAGIC)
        if at >= 0:
            return offset - len(tail) + at
        offset += len(data)
        tail = (tail + data)[-(len(MAGIC) - 1):]
    return -1


# Source and sink

def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").mode("append").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], int(self.options.get("archivebytes", ARCHIVE_BYTES)), overwrite)


@dataclass
class Archive(InputPartition):
    path: str


def archives(path: str) -> list[fs.FileInfo]:
    """The archives of a folder, or the one that ``path`` is; files that begin with ``_`` or ``.`` are not looked at."""
    store, at = filesystem(path)
    info = store.get_file_info(at)
    if info.type == fs.FileType.File:
        return [info]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = store.get_file_info(fs.FileSelector(at))
    return sorted((f for f in found if f.base_name.endswith(".warc.gz") and f.base_name[0] not in "_."), key=lambda f: f.path)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, keep: bool):
        self.path, self.keep = path, keep

    def partitions(self) -> list[InputPartition]:
        return [Archive(f.path) for f in archives(self.path)] or [Archive("")]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, _ = filesystem(self.path)
        rows, held = [], 0
        with store.open_input_file(partition.path) as file:
            for row in records(file, self.keep):
                rows.append({"archive": partition.path.rsplit("/", 1)[-1], **row})
                held += len(row.get("payload") or b"")
                if len(rows) >= 1000 or held >= 8 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)


_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_ARROW_SCHEMA = pa.schema([(n, _ARROW[t]) for n, t in (f.split() for f in SCHEMA.split(", "))])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW_SCHEMA)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]              # where the attempt wrote it, where it belongs


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, archive_bytes: int, overwrite: bool):
        self.path, self.archive_bytes, self.overwrite = path, archive_bytes, overwrite
        self.run = uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext
        store, root = filesystem(self.path)
        context, attempt = TaskContext.get(), uuid.uuid4().hex[:12]
        folder = f"{root}/_temporary-{self.run}/{attempt}"
        files, out, held = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        store.create_dir(folder, recursive=True)
                        name = f"{self.run}-{context.partitionId():05d}-{len(files):05d}.warc.gz"
                        files.append((f"{folder}/{name}", f"{root}/{name}"))
                        out, held = store.open_output_stream(files[-1][0], compression=None), 0
                        held += out.write(_about(name))
                    held += out.write(page_record(row))
                    if held >= self.archive_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        old = [f.path for f in archives(self.path)] if self.overwrite else []
        for message in messages:
            for here, there in message.files if message else []:
                store.move(here, there)
        for path in old:
            store.delete_file(path)
        self._tidy(store, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._tidy(*filesystem(self.path))

    def _tidy(self, store: fs.FileSystem, root: str) -> None:
        left = f"{root}/_temporary-{self.run}"
        if store.get_file_info(left).type != fs.FileType.NotFound:
            store.delete_dir(left)


def _about(name: str) -> bytes:
    block = b"software: gridmart\r\nformat: WARC File Format 1.1\r\n"
    return record({"WARC-Type": "warcinfo", "WARC-Record-ID": _bracketed(f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}"),
                   "WARC-Date": DATE, "WARC-Filename": name, "WARC-Block-Digest": _digest(hashlib.sha1(block).digest()),
                   "Content-Type": "application/warc-fields"}, block)


# Archiver

def _urn(*parts: Column) -> Column:
    """A version 5 UUID of what the parts say."""
    h = F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("?")) for p in parts]).cast("binary"))
    return F.concat(F.lit("urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3),
                    F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def page_records(pages: DataFrame, scratch: Scratch, page_id: str = "page_id", url: str = "url", payload: str = "html",
                 min_revisit: int = MIN_REVISIT) -> DataFrame:
    """A row with the columns of ``FIELDS`` for each row of ``pages``: a response, or a revisit of the response with the largest
    id among equal payloads of at least ``min_revisit`` bytes.

    Payloads are grouped by SHA-256 and size.  Only payloads that occur twice are looked up; the table of those has no payloads."""
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    uri = F.col(f"`{url}`").cast("string")
    rows = pages.select(F.col(f"`{page_id}`").alias("_id"), uri.alias("_url"), body.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    same = F.concat(F.sha2("payload", 256), F.col("payload_bytes").cast("string"))
    # payloads that are too small to look up get keys of their own, spread by the row
    rows = rows.withColumn("_same", F.when(F.col("payload_bytes") >= min_revisit, same).otherwise(
        F.concat(F.lit("-"), F.xxhash64("_id", "_url").cast("string"))))
    groups = rows.filter(F.col("payload_bytes") >= min_revisit).groupBy("_same").agg(
        F.max(F.struct("_id", "_url")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = scratch.write(groups.select("_same", F.col("first._id").alias("_first"), F.col("first._url").alias("_first_url")), "repeated")
    both = rows.join(groups, "_same", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    digest = F.sha1("payload")
    escaped = F.transform(F.array("_url", "_first_url"), lambda u: F.regexp_replace(u, "[\\x00-\\x20\\x7F]", "%20"))
    return both.withColumn("_revisit", revisit).select(
        F.when(F.col("_revisit"), "revisit").otherwise("response").alias("type"),
        F.when(F.col("_revisit"), _urn(F.lit("revisit"), F.col("_id"), F.col("_url"), digest)).otherwise(
            _urn(F.lit("response"), F.col("_id"), digest)).alias("record_id"),
        F.get(escaped, F.lit(0)).alias("uri"), F.lit(None).cast("string").alias("date"),
        F.when(F.col("_revisit"), _urn(F.lit("response"), F.col("_first"), digest)).alias("refers_to"),
        F.when(F.col("_revisit"), F.get(escaped, F.lit(1))).alias("refers_to_uri"), F.col("_id").cast("string").alias("id"),
        "payload_bytes", digest.alias("payload_digest"), F.when(~F.col("_revisit"), F.col("payload")).alias("payload"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)


def write_archives(pages: DataFrame, path: str, scratch: Scratch, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Archives of ``pages`` in the folder ``path``."""
    register(pages.sparkSession)
    found = page_records(pages, scratch, page_id, url, payload, min_revisit)
    found.write.format("warc").option("archivebytes", archive_bytes).mode("append").save(path)
    return path


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Every record of the archives in a folder, with the columns of ``SCHEMA``."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def resolved(found: DataFrame) -> DataFrame:
    """Responses and revisits, with ``refers_to_id`` (the id of the response that a revisit names) and, for a revisit whose
    response is not there or has another digest, an ``error``."""
    pages = found.filter(F.col("type").isin("response", "revisit"))
    named = pages.filter("type = 'response'").groupBy(F.col("record_id").alias("_named")).agg(
        F.max(F.struct("id", "payload_digest")).alias("_of"))
    # a record that refers to nothing looks up a key of its own
    key = F.coalesce("refers_to", F.concat(F.lit("-"), F.col("record_id")))
    both = pages.withColumn("_key", key).join(named, F.col("_key") == F.col("_named"), "left")
    lost = F.when(F.col("type") == "revisit", F.when(F.col("_named").isNull(), "the response is not there").when(
        F.col("_of.payload_digest") != F.col("payload_digest"), "the response has another digest"))
    return both.select(*[c for c in found.columns if c != "error"], F.col("_of.id").alias("refers_to_id"),
                       F.coalesce("error", lost).alias("error"))
