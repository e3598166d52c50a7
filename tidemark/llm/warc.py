"""WARC archives as a Spark data source written in Python, and revisit records for equal payloads.

Reading: a partition is a list of whole files of about ``partitionBytes``. A record's header is parsed first;
predicates on its columns (type, target, digest, ...) are pushed to that point. What is not wanted is skipped
without decoding: by its Content-Length, or in a gzip member by the skip length of the standard's ``sl`` field.

Writing: each task writes files of about ``fileBytes`` under hidden names; the driver renames them when all tasks
have succeeded, so a task that is run again leaves nothing behind that a reader sees.
"""

from __future__ import annotations

import io
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan,
    GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains,
    StringEndsWith, StringStartsWith, WriterCommitMessage)

from tidemark.functions.rows import loose

# Fixed values of the format: header fields by column, and the profile of a revisit with an equal payload.
FIELDS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
    "profile": "WARC-Profile", "content_type": "Content-Type",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ", ".join(f"{c} string" for c in FIELDS) + ", headers map<string,string>, payload binary"
ARROW = pa.schema([*[(c, pa.string()) for c in FIELDS], ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
STANDARD = {v.lower(): k for k, v in FIELDS.items()}
HTTP = "application/http;msgtype=response"
MIN_REVISIT = 100          # bytes of a payload that is worth a revisit record
CHUNK = 1 << 16
EPOCH = "1970-01-01T00:00:00Z"


def clean(value: str) -> str:
    """A header value cannot hold line ends; they are percent-encoded."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict) -> bytes:
    """One uncompressed record. The payload is put behind an HTTP head if the content type says so."""
    head = {v: row.get(c) for c, v in FIELDS.items()} | dict(row.get("headers") or {})
    block = row.get("payload") or b""
    if row.get("content_type") == HTTP:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + block
    lines = ["WARC/1.1", *[f"{k}: {clean(v)}" for k, v in head.items() if v is not None], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member with the skip lengths of its compressed and plain size in an ``sl`` field."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(data) + deflate.flush()
    size = 12 + 12 + len(body) + 8          # head with field length, the field, the body, the check
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data) & 0xFFFFFFFF)
            + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


class _Plain:
    """Bytes of a record in an uncompressed file."""

    def __init__(self, file):
        self.file, self.held = file, b""

    def more(self) -> bytes:
        return self.file.read(CHUNK)

    def begin(self) -> bool:
        while len(self.held) < 5 and (got := self.more()):
            self.held += got
        self.held = self.held.lstrip(b"\r\n")
        if not self.held and (got := self.more()):
            self.held = got
        return bool(self.held)

    def until(self, mark: bytes) -> bytes:
        while (at := self.held.find(mark)) < 0:
            got = self.more()
            if not got:
                raise ValueError("a WARC header does not end")
            self.held += got
        out, self.held = self.held[:at], self.held[at + len(mark):]
        return out

    def take(self, n: int) -> bytes:
        parts, have = [self.held[:n]], len(self.held[:n])
        self.held = self.held[n:]
        while have < n:
            got = self.more()
            if not got:
                raise ValueError("a WARC record is cut short")
            parts.append(got[:n - have])
            self.held = got[n - have:]
            have += len(parts[-1])
        return b"".join(parts)

    def skip(self, n: int) -> None:
        beyond = n - len(self.held)
        self.held = self.held[n:]
        if beyond > 0:
            self.file.seek(beyond - 1, io.SEEK_CUR)
            if not self.file.read(1):
                raise ValueError("a WARC record is cut short")

    def end(self) -> None:
        """Nothing lies between records but line ends."""


class _Zipped(_Plain):
    """Bytes of the records in one gzip member after another; a member may hold any number of records."""

    def __init__(self, file):
        super().__init__(file)
        self.at, self.raw, self.inflate, self.next = 0, b"", None, None
        self.inside = False         # the next record is in the same member

    def begin(self) -> bool:
        if self.inside:
            self.inside = False
            return True
        self.held, self.raw = b"", b""
        self.file.seek(self.at)
        self.raw = self.file.read(CHUNK)
        if not self.raw:
            return False
        self.inflate, self.next = zlib.decompressobj(16 + zlib.MAX_WBITS), None
        self.fed = len(self.raw)
        if self.raw[:4] == b"\x1f\x8b\x08\x04" and len(self.raw) >= 24 and self.raw[12:14] == b"sl":
            self.next = self.at + struct.unpack_from("<I", self.raw, 16)[0]
        return True

    def more(self) -> bytes:
        while not self.inflate.eof:
            if not self.raw:
                self.raw = self.file.read(CHUNK)
                self.fed += len(self.raw)
                if not self.raw:
                    return b""
            out = self.inflate.decompress(self.raw, CHUNK)
            self.raw = self.inflate.unconsumed_tail
            if out:
                return out
        return b""

    def skip(self, n: int) -> None:
        if self.next is None:
            super_n = n - len(self.held)
            self.held = self.held[n:]
            while super_n > 0:
                got = self.more()
                if not got:
                    raise ValueError("a WARC record is cut short")
                self.held = got[super_n:]
                super_n -= len(got)

    def end(self) -> None:
        if self.next is None:
            self.held = self.held.lstrip(b"\r\n")
            while not self.held and (got := self.more()):
                self.held = got.lstrip(b"\r\n")
            if self.held:
                self.inside = True
                return
            if not self.inflate.eof:
                raise ValueError("a gzip member is cut short")
            self.next = self.at + self.fed - len(self.inflate.unused_data)
        self.at = self.next


def _value(head: dict, filter_: Filter):
    name = filter_.attribute[0]
    return head.get(name) if len(filter_.attribute) == 1 and name in FIELDS else NotImplemented


TESTS = {
    EqualTo: lambda v, f: v is not None and v == f.value, EqualNullSafe: lambda v, f: v == f.value,
    In: lambda v, f: v is not None and v in f.value, IsNull: lambda v, f: v is None, IsNotNull: lambda v, f: v is not None,
    GreaterThan: lambda v, f: v is not None and v > f.value, GreaterThanOrEqual: lambda v, f: v is not None and v >= f.value,
    LessThan: lambda v, f: v is not None and v < f.value, LessThanOrEqual: lambda v, f: v is not None and v <= f.value,
    StringStartsWith: lambda v, f: v is not None and v.startswith(f.value),
    StringEndsWith: lambda v, f: v is not None and v.endswith(f.value),
    StringContains: lambda v, f: v is not None and f.value in v,
}


def holds(head: dict, filter_: Filter) -> bool | None:
    """Whether a header passes; null where a comparison with null is neither true nor false."""
    if isinstance(filter_, Not):
        inner = holds(head, filter_.child)
        return None if inner is None else not inner
    value = _value(head, filter_)
    if value is None and not isinstance(filter_, (IsNull, IsNotNull, EqualNullSafe)):
        return None
    return TESTS[type(filter_)](value, filter_)


def supported(filter_: Filter) -> bool:
    if isinstance(filter_, Not):
        return supported(filter_.child)
    return type(filter_) in TESTS and len(filter_.attribute) == 1 and filter_.attribute[0] in FIELDS


def records(file, zipped: bool, filters: list[Filter], payloads: frozenset | None) -> Iterator[dict]:
    """The records of an open file that pass; ``payloads``: record types whose payload is read (null: all)."""
    source = _Zipped(file) if zipped else _Plain(file)
    while source.begin():
        lines = source.until(b"\r\n\r\n").decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        head, other, size = dict.fromkeys(FIELDS), {}, 0
        for line in lines[1:]:
            key, _, value = line.partition(":")
            if key.lower() == "content-length":
                size = int(value)
            elif key.lower() in STANDARD:
                head[STANDARD[key.lower()]] = value.strip(" ")
            else:
                other[key] = f"{other[key]}, {value.strip(' ')}" if key in other else value.strip(" ")
        if not all(holds(head, f) for f in filters):
            source.skip(size)
        else:
            payload = None
            if payloads is None or head["record_type"] in payloads:
                payload = source.take(size)
                if (head["content_type"] or "").replace(" ", "").startswith("application/http"):
                    payload = payload.partition(b"\r\n\r\n")[2]
            else:
                source.skip(size)
            yield head | {"headers": other, "payload": payload}
        source.end()


@dataclass
class Files(InputPartition):
    paths: list[str]

    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.bytes = int(options.get("partitionbytes", 64 << 20))
        wanted = options.get("payloads", "*")
        self.payloads = None if wanted == "*" else frozenset(filter(None, wanted.split(",")))
        self.filters: list[Filter] = []

    def pushFilters(self, filters):
        for f in filters:
            if supported(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Whole files, gathered to about ``partitionBytes``; no file opened."""
        fs, root = pafs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File
                       and not posixpath.basename(f.path).startswith((".", "_")) and f.path.endswith((".warc", ".warc.gz")))
        groups, size = [], self.bytes
        for path, n in files:
            if size + n > self.bytes:
                groups.append([])
                size = 0
            groups[-1].append(path)
            size += n
        return [Files(g) for g in groups] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        held, size = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as file:
                for r in records(file, path.endswith(".gz"), self.filters, self.payloads):
                    held.append(r | {"headers": list(r["headers"].items())})
                    size += len(r["payload"] or b"") + 500
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, ARROW)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, ARROW)


@dataclass
class Written(WriterCommitMessage):
    names: list[str] = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.bytes = int(options.get("filebytes", 256 << 20))
        self.level = int(options.get("level", 6))
        self.ending = ".warc.gz" if self.level else ".warc"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        out, names, size = None, [], 0
        try:
            for whole in iterator:
                for at in range(0, whole.num_rows, 200):
                    for row in whole.slice(at, 200).to_pylist():
                        if out is None or size >= self.bytes:
                            if out is not None:
                                out.close()
                            names.append(f"part-{uuid.uuid4().hex}{self.ending}")
                            out, size = fs.open_output_stream(f"{root}/_{names[-1]}", compression=None), 0
                        data = record(row)
                        data = member(data, self.level) if self.level else data
                        out.write(data)
                        size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for m in messages:
            for name in (m.names if m else []):
                fs.move(f"{root}/_{name}", f"{root}/{name}")

    def abort(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for m in messages:
            for name in (m.names if m else []):
                fs.delete_file(f"{root}/_{name}")


class WarcDataSource(DataSource):
    """``spark.read.format("warc")`` / ``df.write.format("warc")``; options path, payloads, partitionBytes, fileBytes, level."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read(spark: SparkSession, path: str, payloads: str = "*", **options) -> DataFrame:
    """Records under ``path``; ``payloads`` lists the record types whose payload is decoded, ``*`` for all."""
    register(spark)
    return spark.read.format("warc").option("payloads", payloads).options(**options).load(path)


def write(rows: DataFrame, path: str, **options) -> None:
    """Append records (columns of ``SCHEMA``) as archives under ``path``."""
    register(rows.sparkSession)
    rows.select(*[F.col(c) for c in [*FIELDS, "headers", "payload"]]).write.format("warc").mode("append").options(
        **options).save(path)


def page_records(pages: DataFrame, least: int = MIN_REVISIT) -> DataFrame:
    """One record per row of ``pages`` (page_id, url, html): a response, or a revisit of an equal payload.

    Of rows with one payload of ``least`` bytes or more, those with the smallest page_id are responses (more
    than one only if that page_id is repeated), the others revisit it. Null ids come after all others; if
    all ids of a payload are null, all are responses. Null html is an empty payload, a null url is left out.
    Payloads are folded by digest before the join, whose hot digests adaptive execution can split.
    """
    digest = F.sha2(F.coalesce(F.col("html"), F.lit("")).cast("binary"), 256)
    own = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
                       digest.alias("digest"))
    firsts = pages.select("page_id", digest.alias("digest"), F.octet_length("html").alias("n")).filter(
        F.col("n") >= least).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("rows")).filter(
        "rows > 1 and first_id is not null").select("digest", "first_id")
    joined = own.join(loose(firsts), "digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    blank = F.lit(None).cast("string")
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.coalesce(name(F.col("page_id")), F.concat(F.lit("<urn:sha256:"), "digest", F.lit(">"))).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(EPOCH).alias("warc_date"),
        F.when(again, name(F.col("first_id"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(again, REVISIT).otherwise(blank).alias("profile"), F.lit(HTTP).alias("content_type"),
        F.map_filter(F.create_map(
            F.lit("X-Page-Id"), F.col("page_id").cast("string"),
            F.lit("X-Payload-Length"), F.octet_length("payload").cast("string")), lambda _, v: v.isNotNull()).alias("headers"),
        F.when(~again, F.col("payload")).alias("payload"))


def page_digests(found: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Per record read back page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's size and digest are those of the payload that was read; a revisit has them in its header.
    """
    whole = F.col("record_type") == "response"
    return found.select(
        F.col("headers")["X-Page-Id"].cast(id_type).alias("page_id"),
        F.when(whole, F.octet_length("payload")).otherwise(F.col("headers")["X-Payload-Length"]).cast("bigint").alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type", F.regexp_extract("refers_to", "<urn:page:(.*)>", 1).cast(id_type).alias("refers_to"))
