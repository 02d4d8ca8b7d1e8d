"""SequenceFiles as a Spark data source (R3/K3): typed keys and values, splits
at sync markers, Arrow batches in and out, one commit per written task.

``spark.read.format("sequence").load(path)`` gives ``key`` and ``value`` with
the types of the files' Writable classes; ``df.write.format("sequence")`` takes
two columns and the options ``keyClass``, ``valueClass``, ``compression`` (NONE,
RECORD, BLOCK) and ``codec``.  A file is cut into ranges of ``splitBytes``; a
task reads the records behind the sync markers that start in its range, so a
large file is read by many tasks and every record once.  A task holds one record
or one compressed block at a time, and batches of about ``BATCH_BYTES``.

Files are reached through Arrow's file systems; ``path`` is a folder, a file or
several of them joined by commas.  Names that start with ``_`` or ``.`` are not
data.  An empty file holds no records.
"""

from __future__ import annotations

import bz2
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.types import StructType

PACKAGE = "org.apache.hadoop.io."

# Writable class -> Spark type, Arrow type, big-endian layout
# (None: a length or a variable-length number comes first).
CLASSES = {
    "Text": ("string", pa.string(), None),
    "BytesWritable": ("binary", pa.binary(), None),
    "NullWritable": ("string", pa.string(), None),
    "BooleanWritable": ("boolean", pa.bool_(), ">u1"),
    "ByteWritable": ("tinyint", pa.int8(), ">i1"),
    "IntWritable": ("int", pa.int32(), ">i4"),
    "LongWritable": ("bigint", pa.int64(), ">i8"),
    "VIntWritable": ("int", pa.int32(), None),
    "VLongWritable": ("bigint", pa.int64(), None),
    "FloatWritable": ("float", pa.float32(), ">f4"),
    "DoubleWritable": ("double", pa.float64(), ">f8"),
}

# Codec class -> (compress, decompress).
CODECS = {
    "DefaultCodec": (zlib.compress, zlib.decompress),
    "DeflateCodec": (zlib.compress, zlib.decompress),
    "GzipCodec": (lambda b: zlib.compress(b, wbits=31), lambda b: zlib.decompress(b, wbits=31)),
    "BZip2Codec": (bz2.compress, bz2.decompress),
}

# Fixed values of the format: magic and version, the mark that a sync follows.
MAGIC, ESCAPE = b"SEQ\x06", b"\xff\xff\xff\xff"

SPLIT_BYTES = 128 << 20
BATCH_BYTES = 4 << 20
SYNC_EVERY = 64 << 10
BLOCK_BYTES = 1 << 20


def class_name(name: str) -> str:
    """``LongWritable``, ``Long`` or the full class name -> the short class name."""
    short = name.rsplit(".", 1)[-1]
    for known in (short, f"{short}Writable"):
        if known in CLASSES:
            return known
    raise ValueError(f"unknown Writable class {name!r}")


def codec_of(name: str):
    short = name.rsplit(".", 1)[-1]
    if short not in CODECS:
        raise ValueError(f"unknown codec {name!r}")
    return CODECS[short]


# --------------------------------------------------------------------------
# Values
# --------------------------------------------------------------------------

def put_vlong(n: int) -> bytes:
    """A number as its tag byte and the bytes that it needs, big end first."""
    if -112 <= n <= 127:
        return struct.pack("b", n)
    tag, n = (-120, ~n) if n < 0 else (-112, n)
    size = (n.bit_length() + 7) // 8
    return struct.pack("b", tag - size) + n.to_bytes(size, "big")


def get_vlong(buf: bytes, at: int = 0) -> tuple[int, int]:
    """The number at ``at`` and the place after it."""
    tag = buf[at] - 256 if buf[at] > 127 else buf[at]
    if tag >= -112:
        return tag, at + 1
    size = -112 - tag if tag >= -120 else -120 - tag
    n = int.from_bytes(buf[at + 1:at + 1 + size], "big")
    return (~n if tag < -120 else n), at + 1 + size


def decode_column(raw: list[bytes], cls: str) -> pa.Array:
    """The serialised values of one class as an Arrow column."""
    _, arrow, layout = CLASSES[cls]
    if cls == "NullWritable":
        return pa.nulls(len(raw), arrow)
    if layout:
        values = np.frombuffer(b"".join(raw), layout)
        return pa.array(values != 0 if cls == "BooleanWritable" else values.astype(layout[1:]), arrow)
    if cls == "BytesWritable":
        return pa.array([b[4:] for b in raw], arrow)
    if cls == "Text":
        cut = (b[get_vlong(b)[1]:] for b in raw)
        return pa.array([b.decode("utf-8", "replace") for b in cut], arrow)
    return pa.array([get_vlong(b)[0] for b in raw], arrow)


def encode_column(column: pa.Array, cls: str) -> list[bytes]:
    """An Arrow column as serialised values.  NULL is an empty Text or
    BytesWritable and an error in a class that has no empty value."""
    _, arrow, layout = CLASSES[cls]
    if cls == "NullWritable":
        return [b""] * len(column)
    column = column.cast(arrow)
    if cls in ("Text", "BytesWritable"):
        head: Callable[[int], bytes] = put_vlong if cls == "Text" else struct.Struct(">i").pack
        values = [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]
        return [head(len(v)) + v for v in values]
    if column.null_count:
        raise ValueError(f"{cls} can't hold NULL")
    if layout is None:
        return [put_vlong(v) for v in column.to_pylist()]
    width = int(layout[2:])
    data = column.to_numpy(zero_copy_only=False).astype(layout).tobytes()
    return [data[i:i + width] for i in range(0, len(data), width)]


# --------------------------------------------------------------------------
# Files
# --------------------------------------------------------------------------

class _Input:
    """Buffered reads at a known place of a random-access file."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file, self.size = fs.open_input_file(path), fs.get_file_info(path).size
        self.buf, self.base, self.at = b"", 0, 0

    @property
    def place(self) -> int:
        return self.base + self.at

    def seek(self, place: int) -> None:
        self.file.seek(place)
        self.buf, self.base, self.at = b"", place, 0

    def fill(self, n: int) -> bool:
        """Whether ``n`` more bytes lie in the buffer after reading on."""
        missing = n - (len(self.buf) - self.at)
        if missing > 0:
            more = self.file.read(max(missing, 1 << 20))
            self.buf, self.base, self.at = self.buf[self.at:] + more, self.place, 0
        return len(self.buf) - self.at >= n

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise ValueError(f"the file ends inside a record at byte {self.place}")
        self.at += n
        return self.buf[self.at - n:self.at]

    def vlong(self) -> int:
        self.fill(9)
        n, self.at = get_vlong(self.buf, self.at)
        return n

    def text(self) -> str:
        return self.take(self.vlong()).decode("utf-8")

    def find(self, mark: bytes, end: int) -> bool:
        """Go to the first ``mark`` that starts before ``end``."""
        while self.place < end and self.fill(len(mark)):
            hit = self.buf.find(mark, self.at)
            if hit >= 0:
                self.at = hit
                return self.place < end
            self.at = len(self.buf) - len(mark) + 1
        return False


@dataclass
class Header:
    key: str
    value: str
    block: bool
    decompress: Callable[[bytes], bytes] | None
    sync: bytes


def read_header(src: _Input) -> Header:
    if src.take(4) != MAGIC:
        raise ValueError("not a SequenceFile of version 6")
    key, value = class_name(src.text()), class_name(src.text())
    packed, block = src.take(1) != b"\0", src.take(1) != b"\0"
    decompress = codec_of(src.text())[1] if packed else None
    for _ in range(2 * struct.unpack(">i", src.take(4))[0]):
        src.text()
    return Header(key, value, block, decompress, src.take(16))


def records(src: _Input, head: Header, start: int, end: int) -> Iterator[tuple[bytes, bytes]]:
    """The records behind the sync markers that start in ``[start, end)``; the
    first range also has those before the first marker."""
    mark = ESCAPE + head.sync
    if start > 0:
        first = src.place
        src.seek(max(start, first))
        if not src.find(mark, end):
            return
    while src.place < src.size:
        place = src.place
        size = struct.unpack(">i", src.take(4))[0]
        if size == -1:
            if place >= end:
                return
            if src.take(16) != head.sync:
                raise ValueError(f"a wrong sync marker at byte {place}")
            if head.block and src.place < src.size:
                yield from _block(src, head)
        else:
            n_key = struct.unpack(">i", src.take(4))[0]
            key, value = src.take(n_key), src.take(size - n_key)
            yield key, head.decompress(value) if head.decompress else value


def _block(src: _Input, head: Header) -> Iterator[tuple[bytes, bytes]]:
    n = src.vlong()
    key_sizes, keys, value_sizes, values = (head.decompress(src.take(src.vlong())) for _ in range(4))
    k = v = k_at = v_at = 0
    for _ in range(n):
        n_key, k_at = get_vlong(key_sizes, k_at)
        n_value, v_at = get_vlong(value_sizes, v_at)
        yield keys[k:k + n_key], values[v:v + n_value]
        k, v = k + n_key, v + n_value


class _Output:
    """One file in the making: records, sync markers, compressed blocks."""

    def __init__(self, file, key: str, value: str, compression: str, codec: str):
        self.file, self.sync, self.since = file, uuid.uuid4().bytes, 0
        self.block, self.compress = compression == "BLOCK", None
        self.keys: list[bytes] = []
        self.values: list[bytes] = []
        head = MAGIC + b"".join(put_vlong(len(c)) + c for c in ((PACKAGE + n).encode() for n in (key, value)))
        head += bytes([compression != "NONE", self.block])
        if compression != "NONE":
            self.compress = codec_of(codec)[0]
            name = f"{PACKAGE}compress.{codec.rsplit('.', 1)[-1]}".encode()
            head += put_vlong(len(name)) + name
        file.write(head + struct.pack(">i", 0) + self.sync)

    def add(self, keys: list[bytes], values: list[bytes]) -> None:
        for key, value in zip(keys, values):
            if self.block:
                self.keys.append(key)
                self.values.append(value)
                self.since += len(key) + len(value)
                if self.since >= BLOCK_BYTES:
                    self.flush()
                continue
            if self.since >= SYNC_EVERY:
                self.file.write(ESCAPE + self.sync)
                self.since = 0
            if self.compress:
                value = self.compress(value)
            record = struct.pack(">ii", len(key) + len(value), len(key)) + key + value
            self.since += len(record)
            self.file.write(record)

    def flush(self) -> None:
        if not self.keys:
            return
        out = ESCAPE + self.sync + put_vlong(len(self.keys))
        for part in (self.keys, self.values):
            for data in (b"".join(put_vlong(len(b)) for b in part), b"".join(part)):
                packed = self.compress(data)
                out += put_vlong(len(packed)) + packed
        self.file.write(out)
        self.keys, self.values, self.since = [], [], 0


# --------------------------------------------------------------------------
# The data source
# --------------------------------------------------------------------------

def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it (not escaped), and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), os.path.abspath(path)
    return pafs.FileSystem.from_uri(quote(path, safe="/:@?=&%"))


def data_files(paths: str) -> list[tuple[str, str, int]]:
    """(path as given, path in its file system, length) of the files with data."""
    found = []
    for path in paths.split(","):
        fs, inner = file_system(path)
        info = fs.get_file_info(inner)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        infos = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(inner))
        found += [(path, i.path, i.size) for i in infos
                  if i.is_file and i.size and not i.base_name.startswith(("_", "."))]
    return sorted(found)


@dataclass
class Range(InputPartition):
    of: str
    path: str
    start: int
    end: int


class SequenceReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.path, self.split = options["path"], int(options.get("splitBytes", SPLIT_BYTES))
        self.types = [f.dataType.simpleString() for f in schema.fields]

    def partitions(self) -> list[Range]:
        return [Range(of, path, start, min(start + self.split, size))
                for of, path, size in data_files(self.path) for start in range(0, size, self.split)] or [
                    Range("", "", 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        src = _Input(file_system(part.of)[0], part.path)
        head = read_header(src)
        if [CLASSES[head.key][0], CLASSES[head.value][0]] != self.types:
            raise ValueError(f"{part.path} holds {head.key}, {head.value}, not {self.types}")
        keys, values, size = [], [], 0

        def batch() -> pa.RecordBatch:
            columns = [decode_column(keys, head.key), decode_column(values, head.value)]
            return pa.RecordBatch.from_arrays(columns, names=["key", "value"])

        for key, value in records(src, head, part.start, part.end):
            keys.append(key)
            values.append(value)
            size += len(key) + len(value) + 64
            if size >= BATCH_BYTES:
                yield batch()
                keys, values, size = [], [], 0
        if keys:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class SequenceWriter(DataSourceArrowWriter):
    """Tasks write below a folder of this job; the commit moves the files that
    the successful attempts name, so lost or repeated attempts leave nothing."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        self.key = class_name(options.get("keyClass", "NullWritable"))
        self.value = class_name(options.get("valueClass", "Text"))
        self.compression = options.get("compression", "NONE").upper()
        self.codec = options.get("codec", "DefaultCodec")

    def _staging(self) -> tuple[pafs.FileSystem, str, str]:
        fs, root = file_system(self.path)
        return fs, root.rstrip("/"), f"{root.rstrip('/')}/_temporary-{self.job}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return Written(None)
        fs, _, staging = self._staging()
        fs.create_dir(staging, recursive=True)
        name = f"part-{uuid.uuid4().hex}.seq"
        with fs.open_output_stream(f"{staging}/{name}") as file:
            out = _Output(file, self.key, self.value, self.compression, self.codec)
            for b in chain([first], batches):
                out.add(encode_column(b.column(0), self.key), encode_column(b.column(1), self.value))
            out.flush()
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root, staging = self._staging()
        fs.create_dir(root, recursive=True)
        old = [i for i in fs.get_file_info(pafs.FileSelector(root)) if i.is_file] if self.overwrite else []
        for m in messages:
            if m is not None and m.name:
                fs.move(f"{staging}/{m.name}", f"{root}/{m.name}")
        for info in old:
            fs.delete_file(info.path)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _, staging = self._staging()
        if fs.get_file_info(staging).type != pafs.FileType.NotFound:
            fs.delete_dir(staging)


class SequenceSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sequence"

    def schema(self) -> str:
        files = data_files(self.options["path"])
        if not files:
            return "key string, value string"
        head = read_header(_Input(file_system(files[0][0])[0], files[0][1]))
        return f"key {CLASSES[head.key][0]}, value {CLASSES[head.value][0]}"

    def reader(self, schema: StructType) -> SequenceReader:
        return SequenceReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> SequenceWriter:
        return SequenceWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format ``sequence`` known to the session."""
    spark.dataSource.register(SequenceSource)
