"""WARC archives as a PySpark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading takes the columns of the schema given by the user, a subset of ``COLUMNS``. A partition is one
file. Of each record the header block is parsed first; a record that a pushed filter rejects, or
whose payload is no column of the schema, is passed over by its stored length: nothing of its payload is
inflated. Records whose member gives no length are inflated in small pieces that are thrown away.

Filters are pushed when ``spark.sql.python.filterPushdown.enabled`` is true.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

#: Column -> header field of the record.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
}
COLUMNS = ", ".join(f"{c} {'bigint' if c == 'payload_length' else 'string'}" for c in HEADERS) + ", payload binary"
MANIFEST = "_files.json"
#: Extra field of a gzip member: its own length and the length of what it holds.
EXTRA = struct.Struct("<2sHQQ")
FIXED = struct.pack("<4BIBB", 0x1F, 0x8B, 8, 4, 0, 0, 255)


def located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def member(record: bytes, level: int) -> bytes:
    """A gzip member that tells its own length."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    size = len(FIXED) + 2 + EXTRA.size + len(body) + 8
    extra = EXTRA.pack(b"LX", EXTRA.size - 4, size, len(record))
    return b"".join([FIXED, struct.pack("<H", EXTRA.size), extra, body, struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)])


def record(fields: dict[str, object], payload: bytes) -> bytes:
    """One WARC/1.1 record; line breaks in header values become blanks, null values are left out."""
    lines = ["WARC/1.1"]
    lines += [f"{HEADERS[k]}: {' '.join(str(v).splitlines())}" for k, v in fields.items() if k in HEADERS and v is not None]
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


class Members:
    """The records of a file: header fields first, the payload only when asked for."""

    def __init__(self, file, piece: int = 1 << 16) -> None:
        self.file, self.piece, self.at = file, piece, 0
        self.size = file.size()

    def __iter__(self) -> Iterator[tuple[dict[str, str], "Members"]]:
        while self.at < self.size:
            self.file.seek(self.at)
            self.head = self.file.read(min(2048, self.size - self.at))
            packed = self.head[:2] == b"\x1f\x8b"
            stored = self.stored_length() if packed else None
            self.next = None if stored is None else self.at + stored
            self.inflate = zlib.decompressobj(31) if packed else None
            self.read_to = self.at + len(self.head)
            self.plain = self.inflate.decompress(self.head) if packed else self.head
            while b"\r\n\r\n" not in self.plain and self.more():
                pass
            head, _, self.plain = self.plain.partition(b"\r\n\r\n")
            pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
            fields = {k.strip().lower(): v.strip() for k, v in pairs}
            self.length = int(fields.get("content-length", 0))
            if not packed:
                self.next = self.at + len(head) + 4 + self.length + 4
            yield fields, self
            self.at = self.next if self.next is not None else self.end()

    def stored_length(self) -> int | None:
        if len(self.head) >= 12 + EXTRA.size and self.head[3] & 4:
            mark, _, size, _ = EXTRA.unpack_from(self.head, 12)
            return size if mark == b"LX" else None
        return None

    def more(self) -> bool:
        """Read and inflate one more piece; false at the end of the member or file."""
        if self.inflate is not None and self.inflate.eof:
            return False
        self.file.seek(self.read_to)
        data = self.file.read(min(self.piece, self.size - self.read_to))
        self.read_to += len(data)
        self.plain += self.inflate.decompress(data) if self.inflate is not None else data
        return bool(data)

    def payload(self) -> bytes:
        parts, have = [self.plain], len(self.plain)
        while have < self.length:
            self.plain = b""
            if not self.more():
                break
            parts.append(self.plain)
            have += len(self.plain)
        self.plain = b""
        return b"".join(parts)[: self.length]

    def end(self) -> int:
        """The end of a member that does not tell its length, found by inflating the rest in pieces."""
        while not self.inflate.eof:
            self.plain = b""
            if not self.more():
                break
        return self.read_to - len(self.inflate.unused_data)


@dataclass
class File(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    """Reads record headers and, if wanted, payloads; equality and IN filters on header columns are pushed."""

    def __init__(self, uri: str, schema: StructType) -> None:
        self.uri, self.schema, self.wanted = uri, schema, {}

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in HEADERS and name != "payload_length":
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted.get(name, values) & values
            else:
                yield f

    def partitions(self) -> list[File]:
        """One partition per file; of a folder written by ``WarcWriter`` only the committed files count."""
        system, path = located(self.uri)
        if system.get_file_info(path).type == fs.FileType.File:
            return [File(path)]
        manifest = system.get_file_info(f"{path}/{MANIFEST}")
        if manifest.type == fs.FileType.File:
            with system.open_input_stream(manifest.path) as file:
                names = json.loads(file.read())
        else:
            found = system.get_file_info(fs.FileSelector(path))
            names = sorted(x.base_name for x in found if x.base_name.endswith((".warc", ".warc.gz")))
        return [File(f"{path}/{name}") for name in names] or [File("")]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in self.schema.fields]
        kinds = {"payload": pa.binary(), "payload_length": pa.int64()}
        schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
        rows, size = [], 0
        if not partition.path:
            return
        system, _ = located(self.uri)
        with system.open_input_file(partition.path) as file:
            for fields, body in Members(file):
                values = {c: fields.get(h.lower()) for c, h in HEADERS.items()}
                if all(values[c] in allowed for c, allowed in self.wanted.items()):
                    if values["payload_length"] is not None:
                        values["payload_length"] = int(values["payload_length"])
                    if "payload" in names:
                        values["payload"] = body.payload()
                        size += len(values["payload"])
                    rows.append([values[n] for n in names])
                    size += 200
                    if size > 1 << 23:
                        yield as_batch(rows, schema)
                        rows, size = [], 0
        if rows:
            yield as_batch(rows, schema)


def as_batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if len(schema) else []
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Writes one or more files per task; a file that no commit names is ignored by the reader.

    A task that runs again writes files of new names, so lost executors leave no record twice.
    """

    def __init__(self, uri: str, roll: int, level: int) -> None:
        self.uri, self.roll, self.level = uri, roll, level

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = located(self.uri)
        system.create_dir(folder, recursive=True)
        names, file, size = [], None, 0
        for batch in iterator:
            columns = batch.schema.names
            for i in range(batch.num_rows):
                values = {c: batch.column(c)[i].as_py() for c in columns}
                if file is None:
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    file, size = system.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
                data = member(record(values, values.get("payload") or b""), self.level)
                file.write(data)
                size += len(data)
                if size >= self.roll:
                    file.close()
                    file = None
        if file is not None:
            file.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = located(self.uri)
        system.create_dir(folder, recursive=True)
        names = sorted(name for m in messages if m for name in m.names)
        with system.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as file:
            file.write(json.dumps(names).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = located(self.uri)
        for name in (name for m in messages if m for name in m.names):
            system.delete_file(f"{folder}/{name}")


class WarcSource(DataSource):
    """Options: ``path`` (a file or folder), ``roll_bytes`` (a file is closed beyond it), ``level`` of gzip."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("roll_bytes", 1 << 26)), int(self.options.get("level", 2)))


def register(spark: SparkSession) -> None:
    """Make the format ``warc`` known to the session and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
