"""Sharded record files: a Python data source for length-framed, checksummed protobuf examples.

A record file is a sequence of frames::

    uint64 length (little-endian) | uint32 masked CRC-32C of the length bytes | data | uint32 masked CRC-32C of data

and each record's data is a serialised ``Example``: a map from feature name to
a list of byte strings (field 1), 32-bit floats (field 2) or 64-bit integers
(field 3). The data source reads one file per partition through
``pyarrow.fs`` (local paths, ``file://``, ``hdfs://`` and other schemes that
Arrow opens), checks both checksums, decodes the features that the schema
names and yields its rows in order. Features missing from a record are null, so
shards with slightly different schemas read into one table.

Options: ``mode`` = ``FAILFAST`` (a bad frame raises, the default) or
``PERMISSIVE`` (a bad frame gives one row whose ``_corrupt`` column says why
and ends the file, since its framing is lost), ``verify`` = ``true``/``false``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField,
                               StructType)

FORMAT = "records"
BATCH_ROWS = 1024
_MASK_DELTA = 0xA282EAD8  # fixed: the framing's checksum mask constant
_POLY = 0x82F63B78  # fixed: reflected CRC-32C (Castagnoli) polynomial


def _crc_table() -> list[int]:
    table = []
    for byte in range(256):
        crc = byte
        for _ in range(8):
            crc = (crc >> 1) ^ (_POLY if crc & 1 else 0)
        table.append(crc)
    return table


_TABLE = _crc_table()


def crc32c(data: bytes) -> int:
    crc, table = 0xFFFFFFFF, _TABLE
    for byte in data:
        crc = table[(crc ^ byte) & 0xFF] ^ (crc >> 8)
    return crc ^ 0xFFFFFFFF


def masked_crc(data: bytes) -> int:
    crc = crc32c(data)
    return ((((crc >> 15) | (crc << 17)) & 0xFFFFFFFF) + _MASK_DELTA) & 0xFFFFFFFF


class CorruptRecord(ValueError):
    pass


def frames(stream, verify: bool = True) -> Iterator[tuple[int, bytes]]:
    """(offset, data) of each frame of an open binary stream; a bad or cut frame raises ``CorruptRecord``."""
    offset = 0
    while True:
        head = stream.read(12)
        if not head:
            return
        if len(head) < 12:
            raise CorruptRecord(f"cut header at byte {offset}")
        length_bytes, (length_crc,) = head[:8], struct.unpack("<I", head[8:])
        if verify and masked_crc(length_bytes) != length_crc:
            raise CorruptRecord(f"bad length checksum at byte {offset}")
        (length,) = struct.unpack("<Q", length_bytes)
        data = stream.read(length)
        tail = stream.read(4)
        if len(data) < length or len(tail) < 4:
            raise CorruptRecord(f"cut record at byte {offset}")
        if verify and masked_crc(data) != struct.unpack("<I", tail)[0]:
            raise CorruptRecord(f"bad data checksum at byte {offset}")
        yield offset, data
        offset += 16 + length


def frame(data: bytes) -> bytes:
    length = struct.pack("<Q", len(data))
    return length + struct.pack("<I", masked_crc(length)) + data + struct.pack("<I", masked_crc(data))


# protobuf wire format


def _varint(buf: bytes, at: int) -> tuple[int, int]:
    result = shift = 0
    while True:
        if at >= len(buf):
            raise CorruptRecord("cut varint")
        byte = buf[at]
        at += 1
        result |= (byte & 0x7F) << shift
        if byte < 0x80:
            return result, at
        shift += 7


def _fields(buf: bytes) -> Iterator[tuple[int, int, object]]:
    """(field number, wire type, value) of a message; length-delimited values are bytes."""
    at = 0
    while at < len(buf):
        key, at = _varint(buf, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = _varint(buf, at)
        elif wire == 1:
            value, at = buf[at:at + 8], at + 8
        elif wire == 2:
            size, at = _varint(buf, at)
            if at + size > len(buf):
                raise CorruptRecord("cut field")
            value, at = buf[at:at + size], at + size
        elif wire == 5:
            value, at = buf[at:at + 4], at + 4
        else:
            raise CorruptRecord(f"wire type {wire}")
        yield number, wire, value


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def decode_example(data: bytes) -> dict[str, tuple[str, list]]:
    """Feature name -> (kind, values) with kind ``bytes``, ``float`` or ``int64``."""
    out = {}
    for number, _, features in _fields(data):
        if number != 1:
            continue
        for entry_number, _, entry in _fields(features):
            if entry_number != 1:
                continue
            name, feature = "", b""
            for field, _, value in _fields(entry):
                if field == 1:
                    name = value.decode("utf-8")
                elif field == 2:
                    feature = value
            for kind, _, values in _fields(feature):
                if kind == 1:
                    out[name] = ("bytes", [v for f, _, v in _fields(values) if f == 1])
                elif kind == 2:
                    floats = []
                    for f, wire, v in _fields(values):
                        if f == 1:
                            floats.extend(struct.unpack(f"<{len(v) // 4}f", v) if wire == 2 else struct.unpack("<f", v))
                    out[name] = ("float", floats)
                elif kind == 3:
                    ints = []
                    for f, wire, v in _fields(values):
                        if f != 1:
                            continue
                        if wire == 2:
                            at = 0
                            while at < len(v):
                                n, at = _varint(v, at)
                                ints.append(_signed(n))
                        else:
                            ints.append(_signed(v))
                    out[name] = ("int64", ints)
    return out


def _key(number: int, wire: int) -> bytes:
    return _put_varint((number << 3) | wire)


def _put_varint(v: int) -> bytes:
    v &= (1 << 64) - 1
    out = bytearray()
    while True:
        byte = v & 0x7F
        v >>= 7
        if v:
            out.append(byte | 0x80)
        else:
            out.append(byte)
            return bytes(out)


def _len_field(number: int, payload: bytes) -> bytes:
    return _key(number, 2) + _put_varint(len(payload)) + payload


def encode_example(features: dict[str, object]) -> bytes:
    """An Example of str/bytes (bytes list), float (float list) or int (int64 list) values, or lists of them; None is left out."""
    entries = b""
    for name, value in features.items():
        if value is None:
            continue
        values = value if isinstance(value, list) else [value]
        if all(isinstance(v, (bytes, str)) for v in values):
            body = _len_field(1, b"".join(_len_field(1, v.encode("utf-8") if isinstance(v, str) else v) for v in values))
        elif all(isinstance(v, int) and not isinstance(v, bool) for v in values):
            body = _len_field(3, _len_field(1, b"".join(_put_varint(v) for v in values)))
        else:
            body = _len_field(2, _len_field(1, struct.pack(f"<{len(values)}f", *values)))
        entries += _len_field(1, _len_field(1, name.encode("utf-8")) + _len_field(2, body))
    return _len_field(1, entries)


def _convert(kind: str, values: list, target) -> object:
    element = target.elementType if isinstance(target, ArrayType) else target
    if isinstance(element, StringType):
        values = [v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v) for v in values]
    elif isinstance(element, BinaryType):
        values = [v if isinstance(v, bytes) else str(v).encode() for v in values]
    elif isinstance(element, (LongType, IntegerType)):
        values = [int(v) for v in values] if kind == "int64" else None
    elif isinstance(element, (DoubleType, FloatType)):
        values = [float(v) for v in values] if kind in ("float", "int64") else None
    if values is None:
        return None
    if isinstance(target, ArrayType):
        return values
    return values[0] if values else None


class _FilePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def _open(path: str):
    filesystem, inner = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    return filesystem, inner


def list_files(path: str) -> list[str]:
    """Files of ``path`` (a file, a folder, or a folder with a ``*suffix`` pattern), sorted; hidden files left out."""
    pattern = ""
    if "*" in path.rsplit("/", 1)[-1]:
        path, pattern = path.rsplit("/", 1)
    filesystem, inner = _open(path)
    info = filesystem.get_file_info(inner)
    if info.type == pafs.FileType.File:
        return [path]
    prefix = path.split("://", 1)[0] + "://" if "://" in path else ""
    found = filesystem.get_file_info(pafs.FileSelector(inner, recursive=True))
    suffix = pattern.replace("*", "")
    names = [f.path for f in found if f.type == pafs.FileType.File and not f.base_name.startswith((".", "_")) and f.base_name.endswith(suffix)]
    if prefix.startswith("file://") or not prefix:
        return sorted(names)
    return sorted(prefix + n.lstrip("/") if not n.startswith(prefix) else n for n in names)


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, options: dict):
        self.path, self.schema = path, schema
        self.mode = options.get("mode", "FAILFAST").upper()
        self.verify = options.get("verify", "true").lower() != "false"

    def partitions(self) -> list[InputPartition]:
        return [_FilePartition(p) for p in list_files(self.path)]

    def read(self, partition: _FilePartition) -> Iterable[pa.RecordBatch]:
        fields = self.schema.fields
        rows: list[tuple] = []
        filesystem, inner = _open(partition.path)
        with filesystem.open_input_stream(inner) as stream:
            try:
                for offset, data in frames(stream, self.verify):
                    try:
                        features = decode_example(data)
                    except (CorruptRecord, UnicodeDecodeError, struct.error) as bad:
                        if self.mode == "FAILFAST":
                            raise CorruptRecord(f"{partition.path} at byte {offset}: {bad}") from bad
                        rows.append(self._row(partition.path, offset, {}, f"bad example: {bad}"))
                        continue
                    rows.append(self._row(partition.path, offset, features, None))
                    if len(rows) >= BATCH_ROWS:
                        yield from rows
                        rows = []
            except CorruptRecord as bad:
                if self.mode == "FAILFAST":
                    raise CorruptRecord(f"{partition.path}: {bad}") from bad
                rows.append(self._row(partition.path, None, {}, str(bad)))
        yield from rows

    def _row(self, path: str, offset, features: dict, corrupt) -> tuple:
        out = []
        for field in self.schema.fields:
            if field.name == "_file":
                out.append(path)
            elif field.name == "_offset":
                out.append(offset)
            elif field.name == "_corrupt":
                out.append(corrupt)
            elif field.name in features:
                out.append(_convert(*features[field.name], field.dataType))
            else:
                out.append(None)
        return tuple(out)


class RecordFileSource(DataSource):
    """``spark.read.format("records").schema(...).option("mode", ...).load(path)``.

    The schema names the features to decode (string, binary, long, int,
    double, float or arrays of them) and may add ``_file`` (string),
    ``_offset`` (long) and ``_corrupt`` (string). Without a schema only the
    bookkeeping columns are read.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "_file string, _offset long, _corrupt string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordFileSource)


def read_records(spark: SparkSession, path: str, schema: str, mode: str = "FAILFAST"):
    register(spark)
    return spark.read.format(FORMAT).schema(schema).option("mode", mode).load(path)


def write_records(df, path: str, shards: int | None = None) -> str:
    """Writes every row of ``df`` as an Example, one shard file a partition, into the folder ``path``.

    Each task writes its own file through ``pyarrow.fs`` under a name of its
    partition; a rerun task overwrites its own file only.
    """
    frame_df = df.repartition(shards) if shards else df
    columns = frame_df.columns

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        target = f"{path.rstrip('/')}/part-{part:05d}.records"
        filesystem, inner = _open(target)
        filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        count = 0
        with filesystem.open_output_stream(inner) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    out.write(frame(encode_example({c: row[c] for c in columns})))
                    count += 1
        yield pa.RecordBatch.from_pydict({"file": [target], "rows": [count]})

    frame_df.mapInArrow(write, "file string, rows long").collect()
    return path
