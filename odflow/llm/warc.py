"""WARC archives as a PySpark data source (format ``warc``).

Writing.  Rows become WARC/1.1 records, one gzip member each, with the member
lengths of the standard's ``sl`` extra field.  Every task writes files of its
own name, rolled at FILE_BYTES; the commit writes a manifest of the files of
successful tasks, and only those are ever read, so lost executors and retried
tasks leave no doubled records.  Every commit has a manifest of its own: an
append adds one, an overwrite's names those that it replaces, which counts from
the moment it is there, and then removes them and their files.

Reading.  The driver lists the files (the manifest's, or all ``.warc`` and
``.warc.gz`` of a folder) and plans them into partitions of about
PARTITION_BYTES.  Filters on record type and on header columns (equal, in,
prefix, not null) are pushed down.  Of a record the headers are parsed first;
a record that the filters reject, and a payload nobody asked for (option
``payload`` false), is skipped: seeked over where lengths are known, inflated
without being kept where not.

Options: ``path`` (a URI with its scheme that pyarrow's file systems open;
``s3a`` is their ``s3``), ``payload`` (read; default true).  ``read_warc`` and
``archive`` take any path that Spark does and resolve it as Spark does; the bare
format refuses a path without a scheme, which would be each machine's own disk.
Files hold any mix of record types; an empty folder has no rows.  Null payloads
are empty, null headers are left out, control characters in header values are
percent-encoded.  Repeated rows are records of their own, also under one id;
columns beside those of SCHEMA are refused by the format and left out by
``archive``.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.datasource import EqualTo, In, IsNotNull, StringStartsWith

from odflow.llm.common import scratch, table

FILE_BYTES = 128 << 20
PARTITION_BYTES = 128 << 20
BATCH_BYTES = 16 << 20
BATCH_ROWS = 2000
BLOCK = 64 << 10
MANIFEST = "_files-"

#: Columns that are headers, and their names in the file.
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
}
SCHEMA = "record_id string, record_type string, target_uri string, date string, payload_digest string, refers_to string, payload_length long, payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3" + uri[3:]
    if "://" in uri or uri.startswith("file:"):
        uri = "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def _clean(value: str) -> str:
    return "".join([c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value])


def record_bytes(row: dict) -> bytes:
    """One record, uncompressed.  A revisit keeps the HTTP headers alone."""
    payload = row.get("payload") or b""
    length = row.get("payload_length")
    length = len(payload) if length is None else length
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        if row.get(column) is not None:
            lines.append(f"{header}: {'sha1:' if column == 'payload_digest' else ''}{_clean(row[column])}")
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    else:
        block += payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member with its compressed and plain lengths up front."""
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 24 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Files(WriterCommitMessage):
    names: list


def _manifests(files: pafs.FileSystem, root: str) -> dict[str, dict]:
    """The manifests that count, by name: all but those that another replaces."""
    if files.get_file_info(root).type != pafs.FileType.Directory:
        return {}
    found = {}
    for i in files.get_file_info(pafs.FileSelector(root)):
        if i.base_name.startswith(MANIFEST) and i.base_name.endswith(".json"):
            with files.open_input_stream(i.path, compression=None) as f:
                found[i.base_name] = json.loads(f.read())
    replaced = {n for m in found.values() for n in m["replaces"]}
    return {n: m for n, m in found.items() if n not in replaced}


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool = False) -> None:
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        files, root = _open(self.path)
        files.create_dir(root, recursive=True)
        out, names, size = None, [], 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = files.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                data = member(record_bytes(row))
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return Files(names)

    def commit(self, messages: list) -> None:
        files, root = _open(self.path)
        files.create_dir(root, recursive=True)
        names = sorted(n for m in messages if m is not None for n in m.names)
        old = _manifests(files, root) if self.overwrite else {}
        own = f"{MANIFEST}{uuid.uuid4().hex}.json"
        part = f"{root}/.{own}"
        with files.open_output_stream(part, compression=None) as f:
            f.write(json.dumps({"files": names, "replaces": sorted(old)}).encode())
        files.move(part, f"{root}/{own}")
        # the replaced manifests stop counting above; their files go first, so none is left without a manifest
        for name, manifest in old.items():
            for file in [*manifest["files"], name]:
                files.delete_file(f"{root}/{file}")

    def abort(self, messages: list) -> None:
        """Files without a manifest are never read."""


class Source:
    """Random access to a file through a window of blocks."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file, self.size = file, file.size()
        self.at, self.data = 0, b""

    def read(self, offset: int, n: int) -> bytes:
        if not (self.at <= offset and offset + n <= self.at + len(self.data)):
            self.at, self.data = offset, self.file.read_at(min(max(n, BLOCK), max(0, self.size - offset)), offset)
        return self.data[offset - self.at:offset - self.at + n]


class Plain:
    """The bytes of an uncompressed file from an offset on."""

    length = None

    def __init__(self, source: Source, offset: int) -> None:
        self.source, self.at = source, offset

    def peek(self, n: int) -> bytes:
        return self.source.read(self.at, min(n, self.source.size - self.at))

    def skip(self, n: int) -> None:
        self.at += n

    def end(self) -> int:
        return self.at


class Inflated:
    """The plain bytes of one gzip member; what is skipped is not kept."""

    def __init__(self, source: Source, offset: int) -> None:
        head = source.read(offset, 10)
        flags, at, self.length = head[3], offset + 10, None
        if flags & 4:
            n = struct.unpack("<H", source.read(at, 2))[0]
            extra = source.read(at + 2, n)
            at += 2 + n
            while len(extra) >= 4:
                m = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and m == 8:
                    self.length = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + m:]
        for flag in (8, 16):
            if flags & flag:
                while source.read(at, 1) != b"\x00":
                    at += 1
                at += 1
        at += 2 * bool(flags & 2)
        self.source, self.start, self.at = source, offset, at
        self.inflate, self.data = zlib.decompressobj(-15), b""

    def _more(self) -> bytes:
        piece = self.source.read(self.at, min(BLOCK, self.source.size - self.at))
        if not piece:
            raise ValueError("gzip member ends early")
        self.at += len(piece)
        return self.inflate.decompress(piece)

    def peek(self, n: int) -> bytes:
        pieces, have = [self.data], len(self.data)
        while have < n and not self.inflate.eof:
            pieces.append(self._more())
            have += len(pieces[-1])
        self.data = b"".join(pieces)
        return self.data[:n]

    def skip(self, n: int) -> None:
        while n > len(self.data) and not self.inflate.eof:
            n -= len(self.data)
            self.data = self._more()
        self.data = self.data[n:]

    def end(self) -> int:
        """Offset of the next member."""
        if self.length:
            return self.start + self.length
        while not self.inflate.eof:
            self._more()
        return self.at - len(self.inflate.unused_data) + 8


def _headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def _record(stream, wanted, payload: bool) -> tuple[bool, dict | None]:
    """(whether there was a record, its row if wanted); the stream then stands
    behind it, or, where its member's length is known, may stay in it."""
    size, stop, head = 8192, -1, b""
    while stop < 0:
        head = stream.peek(size)
        lead = len(head) - len(head.lstrip(b"\r\n"))
        stop = head.find(b"\r\n\r\n", lead)
        if stop < 0 and len(head) < size:
            if head.strip():
                raise ValueError("a record's headers do not end")
            return False, None
        size *= 2
    if not head[lead:].startswith(b"WARC/"):
        raise ValueError("no record where one should begin")
    headers = _headers(head[lead:stop])
    length = int(headers["content-length"])
    row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
    row["payload_digest"] = (row["payload_digest"] or "").removeprefix("sha1:") or None
    keep = wanted(row)
    if not keep and stream.length:
        return True, None
    stream.skip(stop + 4)
    if not keep:
        stream.skip(length)
        return True, None
    body, row["payload_length"] = 0, length
    if headers.get("content-type", "").startswith("application/http"):
        top = stream.peek(min(length, BLOCK))
        cut = top.find(b"\r\n\r\n")
        if cut >= 0:
            body = cut + 4
            row["payload_length"] = int(_headers(top[:cut]).get("content-length") or length - body)
    stream.skip(body)
    row["payload"] = None
    if payload:
        row["payload"] = stream.peek(length - body)
    elif stream.length:
        return True, row
    stream.skip(length - body)
    return True, row


def records(source: Source, wanted, payload: bool) -> Iterator[dict]:
    """The records of a file whose header columns ``wanted`` accepts: plain,
    or gzip members of one or more records."""
    offset = 0
    while offset < source.size:
        packed = source.read(offset, 2) == b"\x1f\x8b"
        stream = Inflated(source, offset) if packed else Plain(source, offset)
        more = True
        while more:
            more, row = _record(stream, wanted, payload)
            if row is not None:
                yield row
            if packed and stream.length:
                break       # lengths are given for members of one record
        offset = stream.end() if packed else source.size


@dataclass
class FilePartition(InputPartition):
    files: list


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool) -> None:
        self.path, self.payload, self.filters = path, payload, []

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, (EqualTo, In, StringStartsWith, IsNotNull)):
                self.filters.append((type(f).__name__, name, getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        for kind, name, value in self.filters:
            x = row[name]
            if x is None or kind == "EqualTo" and x != value or kind == "In" and x not in value \
                    or kind == "StringStartsWith" and not x.startswith(value):
                return False
        return True

    def partitions(self) -> list:
        files, root = _open(self.path)
        manifests = _manifests(files, root)
        if manifests:
            infos = files.get_file_info([f"{root}/{n}" for m in manifests.values() for n in m["files"]])
        elif files.get_file_info(root).type == pafs.FileType.File:
            infos = [files.get_file_info(root)]
        else:
            infos = [i for i in files.get_file_info(pafs.FileSelector(root)) if i.base_name.endswith((".warc", ".warc.gz"))]
        out, size = [], PARTITION_BYTES
        for i in sorted(infos, key=lambda i: -i.size):
            if size + i.size > PARTITION_BYTES:
                out.append(FilePartition([]))
                size = 0
            out[-1].files.append(i.path)
            size += i.size
        return out or [FilePartition([])]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        files, _ = _open(self.path)
        kinds = [(f.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in SCHEMA.split(", ")]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in kinds], [n for n, _ in kinds])

        rows, size = [], 0
        for path in partition.files:
            with files.open_input_file(path) as f:
                for row in records(Source(f), self.wanted, self.payload):
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
        yield batch(rows)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def path(self) -> str:
        path = self.options["path"]
        if ":" not in path.split("/")[0]:
            raise ValueError(f"{path}: give the path with its scheme, as read_warc and archive do")
        return path

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.path(), self.options.get("payload", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.path(), overwrite)


def resolved(spark: SparkSession, path: str) -> str:
    """The path with scheme and folder, as Spark resolves it (the default file
    system for one without)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(resolved(spark, path))


def base32_sha1(payload):
    """Upper-case base32 of the SHA-1, as archives write digests: five hex
    digits at a time are four base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def archive(pages: DataFrame, path: str, min_bytes: int = 0, mode: str = "append") -> None:
    """Writes ``pages`` (page_id, url, html) to ``path``, beside the records
    that are there (``mode`` append) or in their place (overwrite).  Of records with
    equal payloads of at least ``min_bytes`` bytes the one with the smallest
    page_id is the response (all rows of that id, should it repeat; rows
    without an id where none has one) and the others revisit it.

    Only ids and digests are shuffled by digest; a payload that a third of the
    pages share is one key with partial minima, and the pages themselves are
    joined by id.
    """
    register(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    narrow = pages.select("page_id", base32_sha1(payload).alias("digest"), F.octet_length(payload).alias("n")).filter(f"n >= {min_bytes}")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("times"))
    first = first.filter("times > 1 and first is not null").select(F.col("digest").alias("_digest"), "first")
    again = (narrow.join(first, F.col("digest") == F.col("_digest")).filter("not page_id <=> first")
             .select(F.col("page_id").alias("_id"), "_digest", "first").distinct())
    rows = pages.select("page_id", F.col("url").alias("target_uri"), payload.alias("payload"), base32_sha1(payload).alias("payload_digest"))
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("first").isNotNull()
    rows.select(
        name(F.col("page_id")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.lit("1970-01-01T00:00:00Z").alias("date"), "payload_digest",
        F.when(revisit, name(F.col("first"))).alias("refers_to"), F.octet_length("payload").cast("long").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    ).write.format("warc").mode(mode).save(resolved(pages.sparkSession, path))


def op3_warc_archive(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    page = lambda c: F.expr(f"try_cast(substring({c}, 11, length({c}) - 11) as bigint)")
    return read_warc(spark, path).select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type",
        page("refers_to").alias("refers_to"),
        F.when(F.col("record_type") == "response", base32_sha1(F.col("payload")) == F.col("payload_digest")).alias("payload_intact"))
