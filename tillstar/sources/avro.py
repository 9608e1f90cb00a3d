"""Avro object container files as a Spark data source (S4), read and written by Spark's tasks.

``spark.read.format("tillstar_avro").schema(...).option("path", ...)``, or ``files.read_avro``.

* A file is read by several tasks: it is cut into byte ranges, and a task reads the blocks whose
  preceding sync marker begins in its range, as Avro's container format allows.
* The read schema is resolved against each file's own: fields are matched by name, int widens to long,
  float and double, a field that a file lacks is NULL. Fields that are not asked for are skipped, not decoded.
* Codecs null, deflate, snappy, bzip2 and xz (snappy through pyarrow). Rows travel as Arrow batches.
* Files are opened through ``pyarrow.fs`` (local and shared folders, HDFS, S3, GCS), in tasks; the driver lists them
  and reads one header when no schema is given. Paths that only the JVM knows (viewfs) are refused by pyarrow.
* A write puts each task's file below a folder of its own and moves the files of the tasks that
  counted when all are done, so a lost or repeated task leaves nothing behind.
"""

from __future__ import annotations

import bz2
import json
import lzma
import re
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, datetime, timezone
from decimal import Decimal

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # executors need no copy of the package

FORMAT = "tillstar_avro"
# Fixed values of the container format.
MAGIC = b"Obj\x01"
SYNC = 16
CODECS = ("null", "deflate", "snappy", "bzip2", "xz")
# Columns a reader may ask for beside the file's own: where a row was read.
POSITION = {"_file_ordinal": T.IntegerType(), "_file_path": T.StringType(), "_split_start": T.LongType(), "_row_id": T.LongType(), "_in_row": T.IntegerType()}
BATCH_ROWS = 10_000
EPOCH = datetime(1970, 1, 1)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The pyarrow file system of a path or URI, and the path within it."""
    local = re.sub(r"^file:/*", "/", path)
    if local.startswith("/"):
        return pafs.LocalFileSystem(), local
    return pafs.FileSystem.from_uri(path)


def list_files(paths: list[str]) -> list[tuple[str, int, int]]:
    """(path, bytes, ordinal): the data files, in the order of the list and by name within a folder."""
    found = []
    for ordinal, path in enumerate(paths):
        fs, inner = file_system(path)
        prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
        info = fs.get_file_info(inner)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(path)
        infos = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(inner, recursive=True))
        for i in sorted(infos, key=lambda i: i.path):
            hidden = any(p.startswith(("_", ".")) for p in i.path[len(inner):].split("/"))
            if i.type == pafs.FileType.File and i.size and not hidden:
                found.append((prefix + i.path, i.size, ordinal))
    return found


# ---- binary form --------------------------------------------------------------------------------------------------------

def read_long(buf: bytes, at: int) -> tuple[int, int]:
    b = buf[at]
    at += 1
    if b < 128:
        return (b >> 1) ^ -(b & 1), at
    n, shift = b & 127, 7
    while True:
        b = buf[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return (n >> 1) ^ -(n & 1), at
        shift += 7


def write_long(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


Decode = Callable[[bytes, int], tuple]


class Resolver:
    """Decoders of a file's types into values of Spark types. A decoder takes (bytes, place), gives (value, next place)."""

    def __init__(self):
        self.named: dict[str, dict] = {}

    def known(self, kind):
        """The full form of a type: named types are defined once and then referred to by name, with or without namespace."""
        if isinstance(kind, str):
            return self.named.get(kind.rsplit(".", 1)[-1], kind)
        if isinstance(kind, dict) and kind["type"] in ("record", "enum", "fixed"):
            self.named[kind["name"].rsplit(".", 1)[-1]] = kind
        return kind

    def spark_type(self, kind) -> T.DataType:
        kind = self.known(kind)
        if isinstance(kind, list):
            types = [self.spark_type(k) for k in kind if k != "null"]
            if len(set(types)) > 1:
                order = [t for t in (T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType())]
                if not all(t in order for t in types):
                    raise ValueError(f"a union of {kind} has no Spark type")
                return max(types, key=order.index)
            return types[0] if types else T.NullType()
        if isinstance(kind, dict):
            logical = kind.get("logicalType")
            if logical == "decimal":
                return T.DecimalType(kind["precision"], kind.get("scale", 0))
            if logical in ("timestamp-millis", "timestamp-micros"):
                return T.TimestampType()
            if logical in ("local-timestamp-millis", "local-timestamp-micros"):
                return T.TimestampNTZType()
            if logical == "date":
                return T.DateType()
            if kind["type"] == "record":
                return T.StructType([T.StructField(f["name"], self.spark_type(f["type"])) for f in kind["fields"]])
            if kind["type"] == "array":
                return T.ArrayType(self.spark_type(kind["items"]))
            if kind["type"] == "map":
                return T.MapType(T.StringType(), self.spark_type(kind["values"]))
            return self.spark_type(kind["type"])
        return {"null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
                "double": T.DoubleType(), "bytes": T.BinaryType(), "fixed": T.BinaryType(), "string": T.StringType(), "enum": T.StringType()}[kind]

    def decoder(self, kind, want: T.DataType | None) -> Decode:
        """``want`` None: the value is not asked for and only passed over."""
        kind = self.known(kind)
        if isinstance(kind, list):
            branches = [self.decoder(k, want) for k in kind]

            def union(buf, at):
                branch, at = read_long(buf, at)
                return branches[branch](buf, at)
            return union
        name = kind if isinstance(kind, str) else kind["type"]
        if isinstance(name, (dict, list)):
            return self.decoder(name, want)
        if name == "null":
            return lambda buf, at: (None, at)
        if name == "record":
            return self._record(kind, want)
        if name in ("array", "map"):
            return self._blocks(kind, name, want)
        logical = kind.get("logicalType") if isinstance(kind, dict) else None
        if name in ("int", "long"):
            return self._number(logical, want)
        if name == "boolean":
            self._expect(want, T.BooleanType)
            return lambda buf, at: (buf[at] == 1, at + 1)
        if name in ("float", "double"):
            import struct
            form, size = (struct.Struct("<f"), 4) if name == "float" else (struct.Struct("<d"), 8)
            self._expect(want, T.DoubleType, *((T.FloatType,) if name == "float" else ()))
            return (lambda buf, at: (None, at + size)) if want is None else lambda buf, at: (form.unpack_from(buf, at)[0], at + size)
        if name == "enum":
            symbols = kind["symbols"]
            self._expect(want, T.StringType)

            def enum(buf, at):
                k, at = read_long(buf, at)
                return symbols[k], at
            return enum
        size = kind["size"] if name == "fixed" else None
        return self._bytes(name, logical, size, kind, want)

    @staticmethod
    def _expect(want, *types) -> None:
        if want is not None and not isinstance(want, types):
            raise ValueError(f"the file holds {'/'.join(t.__name__ for t in types)} where {want.simpleString()} is asked for")

    def _number(self, logical, want) -> Decode:
        if want is None or logical is None and isinstance(want, (T.IntegerType, T.LongType)):
            return read_long
        if isinstance(want, (T.FloatType, T.DoubleType)) and logical is None:
            def real(buf, at):
                n, at = read_long(buf, at)
                return float(n), at
            return real
        if logical == "date":
            self._expect(want, T.DateType)
            return read_long
        self._expect(want, T.TimestampType, T.TimestampNTZType, T.LongType)
        times = 1000 if logical and logical.endswith("millis") and not isinstance(want, T.LongType) else 1

        def micros(buf, at):
            n, at = read_long(buf, at)
            return n * times, at
        return micros

    def _bytes(self, name, logical, size, kind, want) -> Decode:
        def span(buf, at):
            if size is not None:
                return at, at + size
            n, at = read_long(buf, at)
            return at, at + n

        if want is None:
            return lambda buf, at: (None, span(buf, at)[1])
        if logical == "decimal":
            self._expect(want, T.DecimalType)
            scale = kind.get("scale", 0)

            def number(buf, at):
                a, b = span(buf, at)
                return Decimal(int.from_bytes(buf[a:b], "big", signed=True)).scaleb(-scale), b
            return number
        if name == "string":
            self._expect(want, T.StringType)

            def text(buf, at):
                a, b = span(buf, at)
                return buf[a:b].decode(), b
            return text
        self._expect(want, T.BinaryType)

        def raw(buf, at):
            a, b = span(buf, at)
            return buf[a:b], b
        return raw

    def fields(self, kind: dict, want: T.StructType | None) -> list[tuple[int | None, Decode]]:
        """(place among the wanted fields or None, decoder) for each field of the file, in its order."""
        names = {f.name: i for i, f in enumerate(want.fields)} if want is not None else {}
        return [(names.get(f["name"]), self.decoder(f["type"], want.fields[names[f["name"]]].dataType if f["name"] in names else None)) for f in kind["fields"]]

    def _record(self, kind: dict, want) -> Decode:
        self._expect(want, T.StructType)
        parts, names = self.fields(kind, want), [f.name for f in want.fields] if want is not None else []

        def record(buf, at):
            out = dict.fromkeys(names)
            for place, decode in parts:
                value, at = decode(buf, at)
                if place is not None:
                    out[names[place]] = value
            return (out if want is not None else None), at
        return record

    def _blocks(self, kind: dict, name: str, want) -> Decode:
        self._expect(want, T.ArrayType if name == "array" else T.MapType)
        inner = None if want is None else want.elementType if name == "array" else want.valueType
        decode = self.decoder(kind["items" if name == "array" else "values"], inner)
        key = self.decoder("string", T.StringType())

        def blocks(buf, at):
            out = []
            while True:
                n, at = read_long(buf, at)
                if n == 0:
                    return (out if want is not None else None), at
                if n < 0:
                    n = -n
                    _, at = read_long(buf, at)
                for _ in range(n):
                    k = None
                    if name == "map":
                        k, at = key(buf, at)
                    value, at = decode(buf, at)
                    out.append(value if name == "array" else (k, value))
        return blocks


def decompress(codec: str, data: bytes) -> bytes:
    if codec == "null":
        return data
    if codec == "deflate":
        return zlib.decompress(data, -15)
    if codec == "bzip2":
        return bz2.decompress(data)
    if codec == "xz":
        return lzma.decompress(data)
    if codec == "snappy":                       # followed by the CRC-32 of the plain bytes
        size, shift, at = 0, 0, 0
        while True:
            size |= (data[at] & 127) << shift
            if data[at] < 128:
                break
            shift, at = shift + 7, at + 1
        plain = pa.decompress(data[:-4], decompressed_size=size, codec="snappy", asbytes=True)
        if zlib.crc32(plain).to_bytes(4, "big") != data[-4:]:
            raise ValueError("a block's checksum is wrong")
        return plain
    raise ValueError(f"unknown codec {codec!r}; known: {CODECS}")


def compress(codec: str, data: bytes) -> bytes:
    if codec == "deflate":
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        return packer.compress(data) + packer.flush()
    if codec == "snappy":
        return pa.compress(data, codec="snappy", asbytes=True) + zlib.crc32(data).to_bytes(4, "big")
    return {"null": lambda: data, "bzip2": lambda: bz2.compress(data), "xz": lambda: lzma.compress(data)}[codec]()


@dataclass
class Header:
    schema: dict
    codec: str
    sync: bytes
    end: int                                    # where the first block begins


def read_header(source) -> Header:
    data = source.read(1 << 16)
    while True:
        try:
            if data[:4] != MAGIC:
                raise ValueError("not an Avro object container file")
            at, meta = 4, {}
            while True:
                n, at = read_long(data, at)
                if n == 0:
                    break
                if n < 0:
                    n = -n
                    _, at = read_long(data, at)
                for _ in range(n):
                    size, at = read_long(data, at)
                    key, at = data[at:at + size].decode(), at + size
                    size, at = read_long(data, at)
                    if at + size > len(data):
                        raise IndexError
                    meta[key], at = data[at:at + size], at + size
            if at + SYNC > len(data):
                raise IndexError
            return Header(json.loads(meta["avro.schema"]), meta.get("avro.codec", b"null").decode(), data[at:at + SYNC], at + SYNC)
        except IndexError:                      # a long header: read on
            more = source.read(len(data))
            if not more:
                raise ValueError("the file ends in its header") from None
            data += more


def blocks_of(source, size: int, header: Header, start: int, end: int) -> Iterator[tuple[int, int, bytes]]:
    """(place, rows, bytes) of the blocks whose preceding sync marker begins in [start, end)."""
    marker = header.end - SYNC
    if start > marker:
        marker = find_sync(source, header.sync, start, min(end + SYNC, size))
    while marker is not None and marker < end and marker + SYNC < size:
        at = marker + SYNC
        source.seek(at)
        head = source.read(20)
        rows, used = read_long(head, 0)
        length, used = read_long(head, used)
        source.seek(at + used)
        data = source.read(length + SYNC)
        if len(data) != length + SYNC or data[length:] != header.sync:
            raise ValueError(f"the block at byte {at} does not end in the file's sync marker")
        yield at, rows, decompress(header.codec, data[:length])
        marker = at + used + length


def find_sync(source, sync: bytes, start: int, end: int) -> int | None:
    """The first place in [start, end) where the marker begins and ends before ``end``."""
    at, tail = start, b""
    while at < end:
        source.seek(at)
        data = tail + source.read(min(1 << 20, end - at))
        found = data.find(sync)
        if found >= 0:
            return at - len(tail) + found
        at += len(data) - len(tail)
        tail = data[-(SYNC - 1):]
    return None


# ---- reading ------------------------------------------------------------------------------------------------------------

@dataclass
class Split(InputPartition):
    path: str
    size: int
    start: int
    end: int
    ordinal: int


class AvroReader(DataSourceReader):
    def __init__(self, paths: list[str], split_bytes: int, schema: T.StructType):
        self.paths, self.split_bytes, self.schema = paths, split_bytes, schema

    def partitions(self) -> list[Split]:
        splits = [Split(path, size, at, min(at + self.split_bytes, size), ordinal)
                  for path, size, ordinal in list_files(self.paths) for at in range(0, size, self.split_bytes)]
        return splits or [Split("", 0, 0, 0, 0)]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        if not split.path:
            return
        arrow = to_arrow_schema(self.schema)
        own = T.StructType([f for f in self.schema.fields if f.name not in POSITION])
        fs, inner = file_system(split.path)
        with fs.open_input_file(inner) as source:
            header = read_header(source)
            resolver = Resolver()
            parts = resolver.fields(resolver.known(header.schema), own)
            columns: list[list] = [[] for _ in own.fields]
            missing = [i for i in range(len(columns)) if i not in {place for place, _ in parts}]
            rows = done = 0
            plan = [(columns[place].append if place is not None else None, decode) for place, decode in parts]

            def batch() -> pa.RecordBatch:
                nonlocal done
                for i in missing:
                    columns[i].extend([None] * rows)
                at = {"_file_ordinal": [split.ordinal] * rows, "_file_path": [re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*:/*", "/", split.path)] * rows,
                      "_split_start": [split.start] * rows, "_row_id": range(done, done + rows), "_in_row": [0] * rows}
                values = iter(columns)
                out = pa.RecordBatch.from_arrays([pa.array(list(at[f.name]) if f.name in POSITION else next(values), f.type) for f in arrow], schema=arrow)
                done += rows
                for c in columns:
                    c.clear()
                return out

            for _, count, data in blocks_of(source, split.size, header, split.start, split.end):
                place = 0
                for _ in range(count):
                    for keep, decode in plan:
                        value, place = decode(data, place)
                        if keep is not None:
                            keep(value)
                    rows += 1
                    if rows >= BATCH_ROWS:
                        yield batch()
                        rows = 0
            if rows:
                yield batch()


# ---- writing ------------------------------------------------------------------------------------------------------------

def avro_type(kind: T.DataType, name: str):
    simple = {T.BooleanType: "boolean", T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float",
              T.DoubleType: "double", T.StringType: "string", T.BinaryType: "bytes", T.DateType: {"type": "int", "logicalType": "date"},
              T.TimestampType: {"type": "long", "logicalType": "timestamp-micros"}, T.TimestampNTZType: {"type": "long", "logicalType": "local-timestamp-micros"}}
    if type(kind) in simple:
        return simple[type(kind)]
    if isinstance(kind, T.DecimalType):
        return {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
    if isinstance(kind, T.StructType):
        return {"type": "record", "name": name, "fields": [
            {"name": f.name, "type": ["null", avro_type(f.dataType, f"{name}_{f.name}")] if f.nullable else avro_type(f.dataType, f"{name}_{f.name}")} for f in kind.fields]}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": ["null", avro_type(kind.elementType, f"{name}_item")]}
    if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        return {"type": "map", "values": ["null", avro_type(kind.valueType, f"{name}_value")]}
    raise ValueError(f"{kind.simpleString()} has no Avro form here")


def encoder(kind: T.DataType, nullable: bool = True) -> Callable[[object], bytes]:
    import struct
    if nullable:
        inner = encoder(kind, False)
        return lambda v: b"\x00" if v is None else b"\x02" + inner(v)
    if isinstance(kind, T.BooleanType):
        return lambda v: b"\x01" if v else b"\x00"
    if isinstance(kind, T.DateType):
        return lambda v: write_long((v - date(1970, 1, 1)).days)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        def micros(v):
            gap = (v.astimezone(timezone.utc).replace(tzinfo=None) if v.tzinfo else v) - EPOCH
            return write_long((gap.days * 86_400 + gap.seconds) * 1_000_000 + gap.microseconds)
        return micros
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return write_long
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return struct.Struct("<f" if isinstance(kind, T.FloatType) else "<d").pack
    if isinstance(kind, T.DecimalType):
        def number(v):
            n = int(v.scaleb(kind.scale))
            raw = n.to_bytes(n.bit_length() // 8 + 1, "big", signed=True)
            return write_long(len(raw)) + raw
        return number
    if isinstance(kind, T.StructType):
        parts = [(f.name, encoder(f.dataType, f.nullable)) for f in kind.fields]
        return lambda v: b"".join(e(v[n]) for n, e in parts)
    if isinstance(kind, T.ArrayType):
        item = encoder(kind.elementType)
        return lambda v: (write_long(len(v)) + b"".join(map(item, v)) if v else b"") + b"\x00"
    if isinstance(kind, T.MapType):
        value, key = encoder(kind.valueType), encoder(T.StringType(), False)
        return lambda v: (write_long(len(v)) + b"".join(key(k) + value(x) for k, x in v) if v else b"") + b"\x00"

    def raw(v):
        data = v.encode() if isinstance(v, str) else v
        return write_long(len(data)) + data
    return raw


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class AvroWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool, codec: str, block_bytes: int):
        if codec not in CODECS:
            raise ValueError(f"unknown codec {codec!r}; known: {CODECS}")
        self.path, self.schema, self.overwrite, self.codec, self.block_bytes = path, schema, overwrite, codec, block_bytes
        self.staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = file_system(self.staging)
        name, sync = f"{folder}/part-{uuid.uuid4().hex}.avro", uuid.uuid4().bytes
        encoders = [encoder(f.dataType, f.nullable) for f in self.schema.fields]
        sink, buffer, held, rows = None, [], 0, 0

        def flush():
            nonlocal held, rows
            data = compress(self.codec, b"".join(buffer))
            sink.write(write_long(rows) + write_long(len(data)) + data + sync)
            buffer.clear()
            held = rows = 0

        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if sink is None:
                    fs.create_dir(folder, recursive=True)
                    sink = fs.open_output_stream(name)
                    meta = {"avro.schema": json.dumps(avro_type(self.schema, "row")).encode(), "avro.codec": self.codec.encode()}
                    sink.write(MAGIC + write_long(len(meta)) + b"".join(write_long(len(k)) + k.encode() + write_long(len(v)) + v for k, v in meta.items()) + b"\x00" + sync)
                for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    said = b"".join([e(v) for e, v in zip(encoders, row, strict=True)])
                    buffer.append(said)
                    held, rows = held + len(said), rows + 1
                    if held >= self.block_bytes:
                        flush()
            if rows:
                flush()
        finally:
            if sink is not None:
                sink.close()
        return Written(name if sink is not None else None)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        old = [i.path for i in fs.get_file_info(pafs.FileSelector(folder)) if i.type == pafs.FileType.File] if self.overwrite else []
        for m in messages:
            if m is not None and m.path:
                fs.move(m.path, f"{folder}/{m.path.rsplit('/', 1)[1]}")
        for path in old:
            fs.delete_file(path)
        self.abort(messages)

    def abort(self, messages) -> None:
        fs, folder = file_system(self.staging)
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)


class AvroSource(DataSource):
    """Options: ``path`` or ``paths`` (a JSON list), ``splitBytes``; for writing ``path``, ``codec``, ``blockBytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _paths(self) -> list[str]:
        return json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]

    def schema(self) -> T.StructType:
        found = list_files(self._paths())
        if not found:
            raise ValueError("no Avro file to take the schema from; give one")
        fs, inner = file_system(found[0][0])
        with fs.open_input_file(inner) as source:
            kind = Resolver().spark_type(read_header(source).schema)
        if not isinstance(kind, T.StructType):
            raise ValueError("the file's rows are not records")
        return kind

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return AvroReader(self._paths(), int(self.options.get("splitBytes", 128 << 20)), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return AvroWriter(self.options["path"], schema, overwrite, self.options.get("codec", "deflate"), int(self.options.get("blockBytes", 64 << 10)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(AvroSource)
