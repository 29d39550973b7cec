"""TFRecord sequence-example sink and source (S7, S8, D5) as a Python Data Source.

Spark has no built-in TFRecord format, so this registers ``tfrecord_seq``
through ``pyspark.sql.datasource``:

* write: every task encodes its rows as ``SequenceExample`` records and writes
  one file ``part-r-<partition>-<attempt>-<uuid>.tfrecord``; the driver's
  commit writes a ``_MANIFEST`` listing the files of the successful attempts,
  so files of failed or retried attempts are never read. Files go through
  ``pyarrow.fs`` (local, HDFS or S3 paths alike);
* read: one input partition per committed file (D5: many part files form one
  dataset), decoded back into the declared schema. Both ways a task holds the
  Python objects of a few hundred records, whatever the size of its file.

Record layout: ``array<array<float>>`` columns (``[steps][1]``) and
``array<float>`` columns become feature lists (one ``Feature`` per step);
scalar columns become context features (string -> bytes, integral -> int64,
float -> float, timestamp -> int64 epoch microseconds, date -> int64 days). Framing per record: little-endian uint64 length, masked
CRC-32C of the length, payload, masked CRC-32C of the payload.

CRC-32C is computed with numpy over all records of a batch in lockstep (the
bitwise recurrence runs once per byte position, vectorised across records).
"""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
import datetime as _dt

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DateType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_EPOCH = _dt.datetime(1970, 1, 1)
_EPOCH_DAY = _dt.date(1970, 1, 1)


def _micros(v: _dt.datetime) -> int:
    return (v - _EPOCH) // _dt.timedelta(microseconds=1)

FORMAT = "tfrecord_seq"
MANIFEST = "_MANIFEST"

# Fixed values of the record format: CRC-32C (Castagnoli) reflected polynomial
# and the TFRecord CRC mask constant.
CRC32C_POLY = 0x82F63B78
CRC_MASK_DELTA = 0xA282EAD8

#: Records and bytes that a task holds at once.
READ_ROWS = 512
READ_BYTES = 8 << 20


def _crc_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint32)
    for i in range(256):
        c = i
        for _ in range(8):
            c = (c >> 1) ^ CRC32C_POLY if c & 1 else c >> 1
        table[i] = c
    return table


_TABLE = _crc_table()


def crc32c_many(bufs: Sequence[bytes]) -> np.ndarray:
    """CRC-32C of every buffer, vectorised across buffers."""
    m = len(bufs)
    if m == 0:
        return np.zeros(0, dtype=np.uint32)
    lens = np.fromiter((len(b) for b in bufs), dtype=np.int64, count=m)
    width = int(lens.max()) if m else 0
    mat = np.zeros((m, max(width, 1)), dtype=np.uint8)
    for i, b in enumerate(bufs):
        if b:
            mat[i, : len(b)] = np.frombuffer(b, dtype=np.uint8)
    crc = np.full(m, 0xFFFFFFFF, dtype=np.uint32)
    for j in range(width):
        nxt = _TABLE[(crc ^ mat[:, j]) & 0xFF] ^ (crc >> np.uint32(8))
        crc = np.where(lens > j, nxt, crc)
    return crc ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    c = crc.astype(np.uint64)
    rot = ((c >> np.uint64(15)) | (c << np.uint64(17))) & np.uint64(0xFFFFFFFF)
    return ((rot + np.uint64(CRC_MASK_DELTA)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def frame_records(payloads: Sequence[bytes]) -> bytes:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    len_crc = masked(crc32c_many(lengths))
    data_crc = masked(crc32c_many(payloads))
    out = bytearray()
    for ln, lc, p, dc in zip(lengths, len_crc, payloads, data_crc):
        out += ln
        out += struct.pack("<I", int(lc))
        out += p
        out += struct.pack("<I", int(dc))
    return bytes(out)


def read_records(stream, verify: bool = True, batch_rows: int = READ_ROWS, batch_bytes: int = READ_BYTES) -> Iterator[list[bytes]]:
    """The records of a stream, checked, in lists of at most ``batch_rows`` records and about ``batch_bytes`` bytes."""
    recs, lens, lcrcs, dcrcs, held = [], [], [], [], 0

    def checked() -> list[bytes]:
        if verify and recs:
            if not (np.array_equal(masked(crc32c_many(lens)), np.array(lcrcs, dtype=np.uint32))
                    and np.array_equal(masked(crc32c_many(recs)), np.array(dcrcs, dtype=np.uint32))):
                raise ValueError("TFRecord CRC mismatch")
        return recs

    while head := stream.read(12):
        if len(head) < 12:
            raise ValueError("truncated TFRecord header")
        n, lc = struct.unpack("<QI", head)
        data = stream.read(n)
        foot = stream.read(4)
        if len(data) != n or len(foot) != 4:
            raise ValueError("truncated TFRecord payload")
        recs.append(data)
        lens.append(head[:8])
        lcrcs.append(lc)
        dcrcs.append(struct.unpack("<I", foot)[0])
        held += n
        if len(recs) >= batch_rows or held >= batch_bytes:
            yield checked()
            recs, lens, lcrcs, dcrcs, held = [], [], [], [], 0
    if recs:
        yield checked()


def unframe_records(blob: bytes, verify: bool = True) -> list[bytes]:
    return [r for some in read_records(io.BytesIO(blob), verify) for r in some]


# --- minimal protobuf encoding of SequenceExample ----------------------------


def _varint(v: int) -> bytes:
    v &= (1 << 64) - 1
    out = bytearray()
    while True:
        b = v & 0x7F
        v >>= 7
        if v:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def _ld(field: int, payload: bytes) -> bytes:
    return _varint((field << 3) | 2) + _varint(len(payload)) + payload


def _float_feature(values: Sequence[float]) -> bytes:
    packed = struct.pack(f"<{len(values)}f", *values)
    return _ld(2, _ld(1, packed))  # Feature.float_list(FloatList.value packed)


def _int_feature(values: Sequence[int]) -> bytes:
    packed = b"".join(_varint(int(v)) for v in values)
    return _ld(3, _ld(1, packed))


def _bytes_feature(values: Sequence[bytes]) -> bytes:
    return _ld(1, b"".join(_ld(1, v) for v in values))


# One time step holding one float, as a FeatureList element:
# FeatureList.feature (field 1, 8 bytes) > Feature.float_list (field 2, 6 bytes)
# > FloatList.value packed (field 1, 4 bytes) > float32. Fixed 10-byte pattern.
_STEP_HEADER = np.frombuffer(b"\x0a\x08\x12\x06\x0a\x04", dtype=np.uint8)
_STEP = 10


def _float_steps(values: Sequence[float]) -> bytes:
    """Encoded FeatureList body of one-float steps, built with numpy."""
    n = len(values)
    arr = np.empty((n, _STEP), dtype=np.uint8)
    arr[:, :6] = _STEP_HEADER
    arr[:, 6:] = np.asarray(values, dtype="<f4").view(np.uint8).reshape(n, 4)
    return arr.tobytes()


def _decode_float_steps(payload: bytes) -> list[list[float]] | None:
    """Inverse of :func:`_float_steps`; None when the payload has another shape."""
    if not payload or len(payload) % _STEP:
        return None
    arr = np.frombuffer(payload, dtype=np.uint8).reshape(-1, _STEP)
    if not (arr[:, :6] == _STEP_HEADER).all():
        return None
    vals = arr[:, 6:].copy().view("<f4").reshape(-1)
    return [[float(v)] for v in vals]


def _map_entry(key: str, value: bytes) -> bytes:
    return _ld(1, key.encode()) + _ld(2, value)


def encode_sequence_example(context: dict[str, bytes], lists: dict[str, list[bytes] | bytes]) -> bytes:
    """``lists`` values are either encoded Features or an already encoded FeatureList body."""
    ctx = b"".join(_ld(1, _map_entry(k, v)) for k, v in context.items())
    fl = b"".join(
        _ld(1, _map_entry(k, feats if isinstance(feats, bytes) else b"".join(_ld(1, f) for f in feats)))
        for k, feats in lists.items()
    )
    out = b""
    if ctx:
        out += _ld(1, ctx)
    if fl:
        out += _ld(2, fl)
    return out


def _read_varint(buf: bytes, pos: int) -> tuple[int, int]:
    shift = result = 0
    while True:
        b = buf[pos]
        pos += 1
        result |= (b & 0x7F) << shift
        if not b & 0x80:
            return result, pos
        shift += 7


def _fields(buf: bytes) -> Iterator[tuple[int, int, object]]:
    pos, end = 0, len(buf)
    while pos < end:
        tag, pos = _read_varint(buf, pos)
        field, wire = tag >> 3, tag & 7
        if wire == 2:
            n, pos = _read_varint(buf, pos)
            yield field, wire, buf[pos : pos + n]
            pos += n
        elif wire == 0:
            v, pos = _read_varint(buf, pos)
            yield field, wire, v
        elif wire == 5:
            yield field, wire, buf[pos : pos + 4]
            pos += 4
        elif wire == 1:
            yield field, wire, buf[pos : pos + 8]
            pos += 8
        else:
            raise ValueError(f"unsupported wire type {wire}")


def _decode_feature(buf: bytes):
    for field, _, payload in _fields(buf):
        if field == 2:  # FloatList
            vals = []
            for f2, w2, p2 in _fields(payload):
                if w2 == 2:
                    vals.extend(struct.unpack(f"<{len(p2) // 4}f", p2))
                else:
                    vals.append(struct.unpack("<f", p2)[0])
            return vals
        if field == 3:  # Int64List
            vals = []
            for f2, w2, p2 in _fields(payload):
                if w2 == 2:
                    pos = 0
                    while pos < len(p2):
                        v, pos = _read_varint(p2, pos)
                        vals.append(v - (1 << 64) if v >= 1 << 63 else v)
                else:
                    vals.append(p2 - (1 << 64) if p2 >= 1 << 63 else p2)
            return vals
        if field == 1:  # BytesList
            return [p2 for _, _, p2 in _fields(payload)]
    return []


def _decode_map(buf: bytes) -> dict[str, bytes]:
    out = {}
    for _, _, entry in _fields(buf):
        key, value = None, b""
        for f, _, p in _fields(entry):
            if f == 1:
                key = p.decode()
            elif f == 2:
                value = p
        out[key] = value
    return out


def decode_sequence_example(buf: bytes) -> tuple[dict[str, list], dict[str, list[list]]]:
    context, lists = {}, {}
    for field, _, payload in _fields(buf):
        if field == 1:
            context = {k: _decode_feature(v) for k, v in _decode_map(payload).items()}
        elif field == 2:
            lists = {}
            for k, v in _decode_map(payload).items():
                fast = _decode_float_steps(v)
                lists[k] = fast if fast is not None else [_decode_feature(f) for _, _, f in _fields(v)]
    return context, lists


# --- the data source ---------------------------------------------------------


def _fs(path: str):
    from pyarrow import fs

    filesystem, root = fs.FileSystem.from_uri(path if "://" in path else "file://" + _abs(path))
    return filesystem, root


def _abs(path: str) -> str:
    import os

    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def _encode_row(row, schema: StructType) -> bytes:
    context, lists = {}, {}
    for field in schema.fields:
        v = row[field.name]
        dt = field.dataType
        if isinstance(dt, ArrayType):
            if v is None:
                continue
            if isinstance(dt.elementType, ArrayType):
                if all(step is not None and len(step) == 1 and step[0] is not None for step in v):
                    lists[field.name] = _float_steps([step[0] for step in v]) if v else []
                else:
                    lists[field.name] = [_float_feature([x for x in (step or []) if x is not None]) for step in v]
            else:
                flat = [x for x in v if x is not None]
                lists[field.name] = _float_steps(flat) if flat else []
        elif v is None:
            continue
        elif isinstance(dt, (StringType, BinaryType)):
            context[field.name] = _bytes_feature([v.encode() if isinstance(v, str) else bytes(v)])
        elif isinstance(dt, IntegralType):
            context[field.name] = _int_feature([v])
        elif isinstance(dt, (FloatType, DoubleType)):
            context[field.name] = _float_feature([v])
        elif isinstance(dt, TimestampNTZType):
            context[field.name] = _int_feature([_micros(v)])
        elif isinstance(dt, TimestampType):
            context[field.name] = _int_feature([round(v.timestamp() * 1_000_000)])
        elif isinstance(dt, DateType):
            context[field.name] = _int_feature([(v - _EPOCH_DAY).days])
        else:
            raise TypeError(f"column {field.name}: type {dt.simpleString()} not supported")
    return encode_sequence_example(context, lists)


class _Commit(WriterCommitMessage):
    def __init__(self, files: list[str], rows: int):
        self.files = files
        self.rows = rows


class TFRecordWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool, batch_rows: int):
        self.path = path.rstrip("/")
        self.schema = schema
        self.overwrite = overwrite
        self.batch_rows = batch_rows

    def write(self, iterator):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        attempt = ctx.attemptNumber() if ctx else 0
        filesystem, root = _fs(self.path)
        filesystem.create_dir(root, recursive=True)
        name = f"part-r-{pid:05d}-{attempt}-{uuid.uuid4().hex[:8]}.tfrecord"
        rows = 0
        with filesystem.open_output_stream(f"{root}/{name}") as out:
            for batch in iterator:
                for lo in range(0, batch.num_rows, self.batch_rows):  # few rows at a time are Python objects
                    some = batch.slice(lo, self.batch_rows).to_pylist()
                    out.write(frame_records([_encode_row(row, self.schema) for row in some]))
                    rows += len(some)
        return _Commit([name], rows)

    def commit(self, messages):
        filesystem, root = _fs(self.path)
        names = sorted(n for m in messages if m is not None for n in m.files)
        if self.overwrite:
            from pyarrow import fs

            keep = set(names)
            for info in filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                base = info.path.rsplit("/", 1)[-1]
                if base.endswith(".tfrecord") and base not in keep:
                    filesystem.delete_file(info.path)
            listed = names
        else:
            listed = sorted(set(_manifest(self.path)) | set(names))
        with filesystem.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(("\n".join(listed) + "\n").encode())

    def abort(self, messages):
        filesystem, root = _fs(self.path)
        for m in messages:
            if m is None:
                continue
            for n in m.files:
                try:
                    filesystem.delete_file(f"{root}/{n}")
                except OSError:
                    pass


def _manifest(path: str) -> list[str]:
    filesystem, root = _fs(path)
    try:
        with filesystem.open_input_stream(f"{root}/{MANIFEST}") as fh:
            return [x for x in fh.read().decode().splitlines() if x]
    except (FileNotFoundError, OSError):
        return []


class _FilePartition(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)
        self.name = name


class TFRecordReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, verify: bool):
        self.path = path.rstrip("/")
        self.schema = schema
        self.verify = verify

    def partitions(self):
        names = _manifest(self.path)
        if not names:
            raise FileNotFoundError(f"no committed TFRecord files at {self.path}")
        return [_FilePartition(n) for n in names]

    def read(self, partition):
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(self.schema)
        filesystem, root = _fs(self.path)
        with filesystem.open_input_stream(f"{root}/{partition.name}", buffer_size=1 << 20) as fh:
            for some in read_records(fh, verify=self.verify):
                columns = zip(*map(self._row, some), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], names=kinds.names)

    def _row(self, rec: bytes) -> tuple:
        context, lists = decode_sequence_example(rec)
        out = []
        for field in self.schema.fields:
            dt = field.dataType
            if isinstance(dt, ArrayType):
                steps = lists.get(field.name)
                if steps is None:
                    out.append(None)
                elif isinstance(dt.elementType, ArrayType):
                    out.append([list(s) for s in steps])
                else:
                    out.append([s[0] if s else None for s in steps])
            else:
                vals = context.get(field.name)
                if not vals:
                    out.append(None)
                elif isinstance(dt, StringType):
                    out.append(vals[0].decode())
                elif isinstance(dt, BinaryType):
                    out.append(bytes(vals[0]))
                elif isinstance(dt, TimestampNTZType):
                    out.append(_EPOCH + _dt.timedelta(microseconds=vals[0]))
                elif isinstance(dt, TimestampType):
                    out.append(_EPOCH.replace(tzinfo=_dt.timezone.utc) + _dt.timedelta(microseconds=vals[0]))
                elif isinstance(dt, DateType):
                    out.append(_EPOCH_DAY + _dt.timedelta(days=vals[0]))
                else:
                    out.append(vals[0])
        return tuple(out)


class TFRecordSequenceSource(DataSource):
    """``spark.read/write.format("tfrecord_seq")``; options: ``path``,
    ``verify`` (CRC check on read, default true), ``batchRows`` (records per
    framing batch on write, default 512)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        raise ValueError("tfrecord_seq needs an explicit schema: spark.read.schema(...)")

    def writer(self, schema, overwrite):
        return TFRecordWriter(self.options["path"], schema, overwrite,
                              int(self.options.get("batchRows", 512)))

    def reader(self, schema):
        verify = str(self.options.get("verify", "true")).lower() != "false"
        return TFRecordReader(self.options["path"], schema, verify)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TFRecordSequenceSource)


def write_tfrecords(df, path: str, mode: str = "overwrite") -> None:
    register(df.sparkSession)
    df.write.format(FORMAT).mode(mode).save(path)


def read_tfrecords(spark: SparkSession, path: str, schema: StructType | str):
    register(spark)
    return spark.read.format(FORMAT).schema(schema).load(path)
