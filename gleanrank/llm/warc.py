"""WARC archives as a Spark data source, and deduplicated writing (method 10).

`spark.read.format("warc")` plans partitions of whole files of about `partition_bytes`, large files first; a file
is not split, so the writer starts a new one at `roll_bytes`. Conditions on the record type, the target and
the other header columns are taken over by the reader: it parses the header of a record first and, if the record is
not wanted, or its payload is not, goes on to the next one without decoding the rest. In a gzip archive every
record is a member of its own; the writer puts the member's length in an extra field ("sl"), by which the
reader skips it without inflating. Archives without that field, and plain ones, are read as well.

Paths may be in any store pyarrow knows (file, hdfs, s3, gs). The writer's tasks write below `_temporary` and
the commit moves their files into place, so a task that is lost or run twice leaves nothing behind.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith,
    WriterCommitMessage,
)

from gleanrank.session import materialize

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
    "payload_length long, headers map<string,string>, payload binary, file string, offset long"
)
_ARROW = pa.schema([
    ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
    ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_length", pa.int64()),
    ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()), ("file", pa.string()), ("offset", pa.int64()),
])
# Fixed names of the format.
_COLUMN_HEADERS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
    "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LENGTH_HEADER = "X-Payload-Length"
_HTTP = "application/http; msgtype=response"
_FIRST_READ = 16 << 10
_BATCH_RECORDS, _BATCH_BYTES = 500, 16 << 20


def _open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


# ---- records -------------------------------------------------------------------------------------------------


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as it stands in an archive. Line breaks in header values are percent-encoded."""
    lines = ["WARC/1.1"]
    for name, value in headers:
        lines.append(f"{name}: " + value.replace("\r", "%0D").replace("\n", "%0A"))
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""])
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """`data` as a gzip member that says in its extra field how long it is."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    length = 10 + 2 + 12 + len(body) + 8
    if max(length, len(data)) >> 32:
        extra, flag = b"", 0
    else:
        extra, flag = struct.pack("<H2sHII", 12, b"sl", 8, length, len(data)), 4
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08" + bytes([flag]) + b"\0\0\0\0\0\xff" + extra + body + tail


def parse_headers(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name, from the version line to the empty line."""
    lines = head.decode("utf-8", "replace").split("\r\n") if b"\r\n" in head else head.decode("utf-8", "replace").split("\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not the start of a record: {lines[0][:40]!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return fields


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """What the server sent: the block of a record without the HTTP header it may start with."""
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _header_end(data: bytes) -> int:
    """Where the block starts, or -1 if the header goes on."""
    crlf, lf = data.find(b"\r\n\r\n"), data.find(b"\n\n")
    if crlf >= 0 and (lf < 0 or crlf < lf):
        return crlf + 4
    return lf + 2 if lf >= 0 else -1


class _Source:
    """Sequential bytes of an open file, with a way to skip, and to give back what was just taken."""

    def __init__(self, file, start: int = 0):
        self.file, self.at = file, start
        self.held, self.gone = bytearray(), 0  # bytes read, and how many of them are taken

    def _fill(self, n: int) -> None:
        if self.gone and len(self.held) - self.gone < n:
            del self.held[: self.gone]
            self.gone = 0
        while len(self.held) - self.gone < n:
            more = self.file.read(max(n - len(self.held) + self.gone, 64 << 10))
            if not more:
                return
            self.held += more

    def peek(self, n: int) -> bytes:
        self._fill(n)
        with memoryview(self.held) as view:
            return bytes(view[self.gone : self.gone + n])

    def take(self, n: int) -> bytes:
        data = self.peek(n)
        self.gone += len(data)
        self.at += len(data)
        return data

    def give_back(self, n: int) -> None:
        self.gone -= n
        self.at -= n

    def skip(self, n: int) -> None:
        if n <= len(self.held) - self.gone:
            self.gone += n
        else:
            self.file.seek(self.at + n)
            self.held.clear()
            self.gone = 0
        self.at += n


def _plain_records(source: _Source, wanted, payload: bool) -> Iterator[tuple[int, dict, bytes | None]]:
    while True:
        while source.peek(1) in (b"\r", b"\n"):
            source.skip(1)
        if not source.peek(1):
            return
        at, n = source.at, _FIRST_READ
        while (end := _header_end(source.peek(n))) < 0:
            if len(source.peek(n)) < n:
                raise ValueError("an archive ends inside a record header")
            n *= 2
        headers = parse_headers(source.take(end))
        length = int(headers.get("content-length", 0))
        if not wanted(headers):
            source.skip(length)
        elif payload:
            block = source.take(length)
            if len(block) < length:
                raise ValueError("an archive ends inside a record")
            yield at, headers, payload_of(headers, block)
        else:
            source.skip(length)
            yield at, headers, None


def _member_length(head: bytes) -> int | None:
    """The length that the extra field of a gzip member states."""
    if len(head) < 12 or not head[3] & 4:
        return None
    size = struct.unpack_from("<H", head, 10)[0]
    at = 12
    while at + 4 <= 12 + size and at + 4 <= len(head):
        name, n = struct.unpack_from("<2sH", head, at)
        if name == b"sl" and n == 8:
            return struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + n
    return None


def _gzip_records(source: _Source, wanted, payload: bool) -> Iterator[tuple[int, dict, bytes | None]]:
    while source.peek(1):
        at = source.at
        length = _member_length(source.peek(64))
        inflate, data = zlib.decompressobj(31), bytearray()

        def more(size: int) -> bool:
            room = size if length is None else min(size, at + length - source.at)
            chunk = source.take(room) if room > 0 and not inflate.eof else b""
            data.extend(inflate.decompress(chunk))
            if inflate.eof:
                source.give_back(len(inflate.unused_data))
            return bool(chunk)

        while (end := _header_end(data)) < 0:
            if not more(_FIRST_READ):
                raise ValueError("an archive ends inside a record header")
        headers = parse_headers(bytes(data[:end]))
        keep = wanted(headers)
        if keep and payload or length is None:
            while not inflate.eof and more(256 << 10):
                if not (keep and payload):
                    data.clear()
        if length is not None:
            source.skip(at + length - source.at)
        if keep and payload:
            size = int(headers.get("content-length", 0))
            if len(data) - end < size:
                raise ValueError("an archive ends inside a record")
            with memoryview(data) as view:
                block = bytes(view[end : end + size])
            yield at, headers, payload_of(headers, block)
        elif keep:
            yield at, headers, None


def read_records(file, wanted=lambda headers: True, payload: bool = True) -> Iterator[tuple[int, dict, bytes | None]]:
    """(offset, headers, payload) of the wanted records of an open archive, plain or gzip."""
    source = _Source(file)
    return (_gzip_records if source.peek(2) == b"\x1f\x8b" else _plain_records)(source, wanted, payload)


# ---- the data source -----------------------------------------------------------------------------------------


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.partition_bytes = int(options.get("partition_bytes", 128 << 20))
        self.conditions: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Take over what the record header answers, and leave the rest to Spark."""
        for f in filters:
            name = getattr(f, "attribute", ())
            header = _COLUMN_HEADERS.get(name[0]) if len(name) == 1 else None
            if header and isinstance(f, EqualTo) and isinstance(f.value, str):
                self.conditions.append((header, "in", (f.value,)))
            elif header and isinstance(f, In) and all(isinstance(v, str) for v in f.value):
                self.conditions.append((header, "in", tuple(f.value)))
            elif header and isinstance(f, StringStartsWith):
                self.conditions.append((header, "starts", f.value))
            elif header and isinstance(f, IsNotNull):
                self.conditions.append((header, "held", None))
            else:
                yield f

    def partitions(self):
        store, root = _open_folder(self.path)
        info = store.get_file_info(root)
        found = [info] if info.type == pafs.FileType.File else store.get_file_info(pafs.FileSelector(root, recursive=True))
        files = sorted(
            ((f.size or 0, f.path) for f in found if f.type == pafs.FileType.File and not any(
                p.startswith(("_", ".")) for p in f.path[len(root):].split("/"))),
            key=lambda f: (-f[0], f[1]),
        )
        groups, group, size = [], [], 0
        for length, path in files:
            if group and size + length > self.partition_bytes:
                groups.append(Files(tuple(group)))
                group, size = [], 0
            group.append(path)
            size += length
        return groups + [Files(tuple(group))] if group else groups or [Files(())]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, value in self.conditions:
            told = headers.get(name)
            if told is None or (kind == "in" and told not in value) or (kind == "starts" and not told.startswith(value)):
                return False
        return True

    def read(self, partition: Files):
        store, _ = _open_folder(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as file:
                for at, headers, payload in read_records(file, self._wanted, self.payload):
                    length = headers.get(LENGTH_HEADER.lower())
                    rows.append({
                        **{c: headers.get(h) for c, h in _COLUMN_HEADERS.items()},
                        "payload_length": int(length) if length else None, "headers": list(headers.items()),
                        "payload": payload, "file": path, "offset": at,
                    })
                    size += len(payload or b"")
                    if len(rows) >= _BATCH_RECORDS or size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


@dataclass
class Written(WriterCommitMessage):
    files: tuple[str, ...]


class WarcWriter(DataSourceArrowWriter):
    """Rows of (record_type, record_id, target_uri, date, refers_to, payload_digest, payload_length, payload)."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.level = int(options.get("level", 6))
        self.gzip = options.get("compression", "gzip") == "gzip"
        self.roll = int(options.get("roll_bytes", 128 << 20))
        # A folder for this job alone: another one's end must not take its files.
        self.own = f"_temporary-{uuid.uuid4().hex}"

    def _record(self, row: dict) -> bytes:
        told = [
            ("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"]),
            ("WARC-Target-URI", row["target_uri"]), ("WARC-Payload-Digest", row["payload_digest"]),
            (LENGTH_HEADER, str(row["payload_length"])), ("WARC-Refers-To", row["refers_to"]),
            ("WARC-Profile", PROFILE if row["record_type"] == "revisit" else None), ("Content-Type", _HTTP),
        ]
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        block += b"Content-Length: %d\r\n\r\n" % row["payload_length"]
        data = record_bytes([(n, v) for n, v in told if v is not None], block + (row["payload"] or b""))
        return gzip_member(data, self.level) if self.gzip else data

    def write(self, iterator):
        store, root = _open_folder(self.path)
        store.create_dir(f"{root}/{self.own}", recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size >= self.roll:
                        if out is not None:
                            out.close()
                        name = f"part-{uuid.uuid4().hex}.warc" + (".gz" if self.gzip else "")
                        out, size = store.open_output_stream(f"{root}/{self.own}/{name}", compression=None), 0
                        files.append(name)
                    data = self._record(row)
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(tuple(files))

    def commit(self, messages):
        store, root = _open_folder(self.path)
        store.create_dir(root, recursive=True)
        for message in messages:
            for name in message.files if message else ():
                store.move(f"{root}/{self.own}/{name}", f"{root}/{name}")
        self._clean(store, root)

    def abort(self, messages):
        self._clean(*_open_folder(self.path))

    def _clean(self, store, root):
        if store.get_file_info(f"{root}/{self.own}").type == pafs.FileType.Directory:
            store.delete_dir(f"{root}/{self.own}")


class WarcDataSource(DataSource):
    """format("warc"). Options of the reader: payload (true or false), partition_bytes; of the writer:
    compression (gzip or none), level, roll_bytes."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make format("warc") known to the session, and let Spark hand conditions to Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of the archives below `path`, in the columns of SCHEMA; `payload` is null if not wanted."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


# ---- pages as archives ---------------------------------------------------------------------------------------


def page_records(pages: DataFrame, least_bytes: int = 100, date: str = "2024-01-01T00:00:00Z",
                 max_broadcast_rows: int = 100_000) -> DataFrame:
    """One record row for each row of `pages` (page_id, url, html), ready for the writer.

    Of equal payloads of at least `least_bytes` bytes the one with the least page_id is a response, the others
    are revisits of it, without a payload of their own.

    Defined cases: a null html is an empty payload, a null url leaves the target out; a null page_id is
    written as `null`: such a row revisits a numbered page with its payload if there is one, and is a
    response otherwise; repeated rows of the least page_id are all responses. Other columns are ignored. An
    empty table writes an empty folder.
    """
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256)).withColumn("length", F.octet_length("payload").cast("long"))
    first = materialize(
        base.filter(F.col("length") >= least_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
        .select("digest", "first"),
        "warc-firsts",
    )
    if first.limit(max_broadcast_rows + 1).count() <= max_broadcast_rows:
        first = F.broadcast(first)
    urn = lambda id: F.concat(F.lit("<urn:page:"), F.coalesce(id.cast("string"), F.lit("null")), F.lit(">"))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return base.join(first, "digest", "left").select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), urn(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"), F.when(again, urn(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"), F.col("length").alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, compression: str = "gzip", **options) -> None:
    """Write `pages` as WARC archives into the folder `path`, which must not exist."""
    register(pages.sparkSession)
    page_records(pages, **options).write.format("warc").option("compression", compression).mode("append").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the page records of archives.

    Length and digest of a response are taken from its payload, those of a revisit from its header.
    """
    number = lambda urn: F.nullif(F.regexp_extract(urn, "^<urn:page:(-?[0-9]+)>$", 1), F.lit("")).cast("long")
    records = read_warc(spark, path).filter(F.col("record_type").isin("response", "revisit"))
    is_response = F.col("record_type") == "response"
    return records.select(
        number(F.col("record_id")).alias("page_id"),
        F.when(is_response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(is_response, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type", number(F.col("refers_to")).alias("refers_to"),
    )
