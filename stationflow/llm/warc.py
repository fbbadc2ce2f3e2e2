"""WARC archives as a Python data source, and de-duplicated archives of pages.

``spark.read.format("warc")`` plans one partition for each group of files, tests pushed
predicates on the record type and other headers as soon as the headers are parsed, and
then skips the rest of a record: in ``.warc`` files by its Content-Length, in
``.warc.gz`` files by the skip length that the writer, with one gzip member a record, leaves
in the member's extra field; members of several records are inflated to their end. Payloads are only decoded when the schema asks for them.

``df.write.format("warc")`` writes such files. Files of failed or repeated tasks are
never read: the commit lists the files that count, and the reader goes by that list.
Paths are opened through pyarrow, so any shared file system that it knows will do.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In,
                                    InputPartition, IsNotNull, IsNull, Not, StringContains, StringEndsWith,
                                    StringStartsWith, WriterCommitMessage)

from .common import small_batches

SCHEMA = ("record_id string, record_type string, target_uri string, date string, content_type string, "
          "refers_to string, payload_digest string, http_length bigint, payload binary")
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
           "date": "warc-date", "content_type": "content-type", "refers_to": "warc-refers-to",
           "payload_digest": "warc-payload-digest"}
MANIFEST = "_files.json"
FILE_BYTES, PARTITION_BYTES, CHUNK = 256 << 20, 64 << 20, 64 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _filesystem(path: str):
    from pyarrow import fs

    if "://" not in path and re.match(r"\w+:/", path):  # file:/x as Hadoop writes it
        path = path.replace(":/", ":///", 1)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


# ---------------------------------------------------------------- writing

def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(row: dict) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP headers of its page and no payload."""
    payload = row.get("payload") or b""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_clean(row['record_id'])}"]
    if row.get("target_uri") is not None:
        head.append(f"WARC-Target-URI: {_clean(row['target_uri'])}")
    head += [f"WARC-Date: {row['date']}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
             "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_clean(row['refers_to'])}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    """A gzip member whose extra field ``sl`` tells its compressed and its plain length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 24 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return (b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        store, root = _filesystem(self.path)
        store.create_dir(root, recursive=True)
        files: list[str] = []
        sink, size = None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if sink is None or size >= FILE_BYTES:
                        if sink is not None:
                            sink.close()
                        files.append(f"{uuid.uuid4().hex}.warc.gz")
                        sink, size = store.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                    size += sink.write(gzip_member(record(row)))
        finally:
            if sink is not None:
                sink.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        store, root = _filesystem(self.path)
        store.create_dir(root, recursive=True)
        earlier = [] if self.overwrite else (_listed(store, root) or [])
        files = earlier + [f for m in messages if m is not None for f in m.files]
        with store.open_output_stream(f"{root}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list) -> None:
        store, root = _filesystem(self.path)
        for m in messages:
            for f in m.files if m is not None else ():
                store.delete_file(f"{root}/{f}")


def _listed(store, root: str) -> list[str] | None:
    from pyarrow import fs

    if store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with store.open_input_stream(f"{root}/{MANIFEST}", compression=None) as f:
        return json.loads(f.read())


# ---------------------------------------------------------------- reading

@dataclass
class _Files(InputPartition):
    files: tuple[str, ...]


class _Window:
    """Sequential reads of a file with skips that don't read what they skip."""

    def __init__(self, raw):
        self.raw = io.BufferedReader(raw, 1 << 18)

    def take(self, n: int) -> bytes:
        return self.raw.read(n)

    def at(self) -> int:
        return self.raw.tell()

    def go(self, to: int) -> None:
        self.raw.seek(to)


def _parse(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, sep, v in (x.partition(":") for x in lines[1:]) if sep}


class _Member:
    """The inflated bytes of a gzip member, record after record."""

    def __init__(self, window: _Window):
        self.window, self.inflater, self.text = window, zlib.decompressobj(-15), b""

    def more(self) -> bytes:
        """The next bytes; none at the end of the member."""
        while not self.inflater.eof:
            data = self.inflater.unconsumed_tail or self.window.take(CHUNK)
            part = self.inflater.decompress(data, CHUNK) if data else b""
            if part:
                return part
            if not data:
                raise ValueError("truncated record")
        return b""

    def head(self) -> bytes | None:
        """Headers of the next record, None if nothing but line ends is left."""
        while not (text := self.text.lstrip(b"\r\n")) and (part := self.more()):
            self.text = part
        while (end := text.find(b"\r\n\r\n")) < 0 and (part := self.more()):
            text += part
        if end < 0 and text:
            raise ValueError("truncated record")
        self.text = text[end + 4:] if text else b""
        return text[:end] if text else None

    def block(self, size: int, keep: bool) -> bytes | None:
        parts = []
        while len(self.text) < size:
            size -= len(self.text)
            if keep:
                parts.append(self.text)
            if not (part := self.more()):
                raise ValueError("truncated record")
            self.text = part
        parts.append(self.text[:size])
        self.text = self.text[size:]
        return b"".join(parts) if keep else None


def _gzip_records(window: _Window, wanted) -> Iterator[tuple[dict, bytes | None]]:
    """(headers, block) of each record of each member; the block is None where it was not wanted."""
    while len(start := window.take(10)) == 10:
        origin, size, plain = window.at() - 10, 0, 0
        if start[:3] != b"\x1f\x8b\x08" or start[3] & 0xE0:
            raise ValueError("not a gzip member")
        if start[3] & 4:
            extra = window.take(struct.unpack("<H", window.take(2))[0])
            if extra[:2] == b"sl":
                size, plain = struct.unpack("<II", extra[4:12])
        for _ in range((start[3] >> 3 & 1) + (start[3] >> 4 & 1)):  # name and comment
            while window.take(1) not in (b"\0", b""):
                pass
        if start[3] & 2:
            window.take(2)
        member, skip = _Member(window), 0
        while not skip and (raw := member.head()) is not None:
            head = _parse(raw)
            length, keep = int(head["content-length"]), wanted(head)
            if not keep and size and (len(raw) + length + 8) & 0xFFFFFFFF == plain:  # alone in its member
                skip = size
                yield head, None
            else:
                yield head, member.block(length, keep)
        window.go(origin + skip if skip else window.at() - len(member.inflater.unused_data) + 8)


def _plain_records(window: _Window, wanted) -> Iterator[tuple[dict, bytes | None]]:
    while line := window.raw.readline():
        if not line.strip():
            continue
        lines = [line]
        while (line := window.raw.readline()).strip():
            lines.append(line)
        head = _parse(b"".join(lines))
        size = int(head["content-length"])
        if wanted(head):
            yield head, window.take(size)
        else:
            window.go(window.at() + size)
            yield head, None


def _test(f: Filter):
    """Headers -> bool for a predicate on a header column; None if it can't be pushed."""
    if isinstance(f, Not):
        inner = _test(f.child)
        column = getattr(f.child, "attribute", None)
        if inner is None or isinstance(f.child, (IsNull, IsNotNull)):
            return None
        name = HEADERS[column[0]]
        return lambda head: name in head and not inner(head)
    column = getattr(f, "attribute", None)
    if not column or len(column) != 1 or column[0] not in HEADERS:
        return None
    name = HEADERS[column[0]]
    if isinstance(f, IsNotNull):
        return lambda head: name in head
    if isinstance(f, IsNull):
        return lambda head: name not in head
    value = getattr(f, "value", None)
    tests = {EqualTo: lambda x: x == value, In: lambda x: x in value, StringStartsWith: lambda x: x.startswith(value),
             StringEndsWith: lambda x: x.endswith(value), StringContains: lambda x: value in x}
    test = tests.get(type(f))
    if test is None or value is None:
        return None
    return lambda head: name in head and test(head[name])


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns, self.filters = path, columns, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if _test(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, root = _filesystem(self.path)
        files = _listed(store, root)
        if files is None:
            found = store.get_file_info(fs.FileSelector(root, recursive=True))
            infos = [i for i in found if re.search(r"\.warc(\.gz)?$", i.path)]
        else:
            infos = store.get_file_info([f"{root}/{f}" for f in files]) if files else []
        groups: list[list[str]] = []
        size = PARTITION_BYTES
        for info in infos:
            if size + info.size > PARTITION_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(info.path)
            size += info.size
        return [_Files(tuple(g)) for g in groups] or [_Files(())]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        store, _ = _filesystem(self.path)
        tests = [_test(f) for f in self.filters]
        payload = "payload" in self.columns or "http_length" in self.columns

        def passes(head: dict) -> bool:
            return all(t(head) for t in tests)

        def wanted(head: dict) -> bool:
            return payload and passes(head)

        for file in partition.files:
            records = _gzip_records if file.endswith(".gz") else _plain_records
            with store.open_input_file(file) as raw:
                for head, block in records(_Window(raw), wanted):
                    if block is not None or passes(head):
                        yield self._row(head, block)

    def _row(self, head: dict, block: bytes | None) -> tuple:
        values: dict = {c: head.get(h) for c, h in HEADERS.items()}
        if block is not None and (head.get("content-type") or "").startswith("application/http"):
            http, _, body = block.partition(b"\r\n\r\n")
            length = _parse(http).get("content-length")
            values["http_length"] = int(length) if length else None
            if head.get("warc-type") != "revisit":
                values["payload"] = body
                told = (head.get("warc-payload-digest") or "").removeprefix("sha1:")
                if told and told != payload_digest(body):
                    raise ValueError(f"payload of {head.get('warc-record-id')} doesn't have its digest")
        elif block is not None:
            values["payload"] = block
        return tuple(values.get(c) for c in self.columns)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"], schema.names)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    small_batches(spark)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the archives under ``path``. Without payloads, blocks are never decoded."""
    register(spark)
    reader = spark.read.format("warc")
    if not payloads:
        reader = reader.schema(SCHEMA.partition(", http_length")[0])
    return reader.load(path)


def write_pages(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                date: str = "1970-01-01T00:00:00Z", min_bytes: int = 0) -> None:
    """One record per row. Of rows with equal payloads of at least ``min_bytes`` bytes, the one
    with the smallest page id is a response and the others are revisits that refer to it;
    smaller payloads are all responses.

    A null html is an empty payload; a null url leaves its header out; a null page id
    comes after all others. Rows repeated with the smallest id are all responses. Record
    ids are ``<urn:page:ID>``. An empty table writes an empty list of files."""
    register(pages.sparkSession)
    rows = pages.select(F.col(page_id).cast("string").alias("id"), F.col(page_id).alias("rank"),
                        F.col(url).cast("string").alias("target_uri"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    # The SHA-256 and the length stand for the payload, so that the hottest payload is one
    # narrow group, combined before it is shuffled.
    rows = rows.withColumn("same", F.concat_ws(":", F.sha2("payload", 256), F.octet_length("payload")))
    first = rows.groupBy("same").agg(F.min(F.struct(F.col("rank").isNull(), "rank", "id")).alias("first"))
    told = rows.join(first, "same")
    revisit = (F.octet_length("payload") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("first.id"))

    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(c, F.lit("")), F.lit(">"))

    out = told.select(urn(F.col("id")).alias("record_id"),
                      F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
                      F.lit(date).alias("date"), F.when(revisit, urn(F.col("first.id"))).alias("refers_to"), "payload")
    out.write.format("warc").mode("append").save(path)
