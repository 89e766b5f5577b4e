"""``tfrecord``: a Python Data Source for TFRecord files of ``tf.train.Example`` records, to read and to write.

One input partition per file, or several with ``index`` (see ``build_index``).  A record is ``uint64 length, uint32 crc, data, uint32 crc``;
``data`` is an ``Example`` protobuf (``features.feature`` map of bytes / float / int64 lists),
decoded here with a small wire-format reader (no TensorFlow needed).

Schema: given by the user (``.schema("sampleID binary, image binary, height bigint, ...")``), or
inferred from the first record (``bytes -> binary``, ``int64 -> bigint``, ``float -> float``;
lists with more than one value become arrays).  A field missing in a record is null.

Add ``_file string, _index bigint`` to the schema to get each record's file and position, ``_offset bigint`` for
its first byte and ``_raw binary`` for the data of a damaged record.

Both checksums of a record (masked CRC-32C) are verified and its length is held against the file's.
``mode=FAILFAST`` (default) raises at the first damage.  ``mode=DROPMALFORMED`` leaves out records whose data
are damaged; damage to a length loses the way to the rest of the file, which raises in this mode
too.  ``mode=PERMISSIVE`` needs a column ``_corrupt string`` in the schema: damage then becomes a row with
nothing but that column (what is wrong, at which byte), so lost records are counted, never silent.

Writing: each task writes its rows to files of its own, rolling at ``maxrecords`` or ``maxsize``; with ``fileColumn`` the rows are
expected together by that column and each value becomes files named after it.  Binary and string columns become byte
lists, integers and booleans int64 lists, floats and doubles float lists (of 32 bits, as the format has them), arrays
lists of several values; a null is an empty list of its kind.  Files are published by a list at the end (see
``sources.visible``): a failed or repeated attempt leaves nothing visible.
"""

from __future__ import annotations

import logging
import posixpath
import struct
import uuid
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType, FloatType, IntegerType, IntegralType, LongType,
                               StringType, StructField, StructType)

from capset.sources.tarshard import _fs
from capset.sources.visible import publish, visible_files


def _list_files(path: str) -> list[str]:
    from pyarrow import fs as pafs

    filesystem, p = _fs(path)
    info = filesystem.get_file_info(p)
    if info.type == pafs.FileType.File:
        return [p]
    published = visible_files(filesystem, p)
    if published is not None:
        return published
    sel = pafs.FileSelector(p, recursive=True)
    return sorted(i.path for i in filesystem.get_file_info(sel)
                  if i.type == pafs.FileType.File and i.path.split(".")[-1] in ("tfrecord", "tfrecords"))


# --- protobuf wire format -------------------------------------------------------------------

def _varint(buf: bytes, pos: int) -> tuple[int, int]:
    result, shift = 0, 0
    while True:
        b = buf[pos]
        pos += 1
        result |= (b & 0x7F) << shift
        if not b & 0x80:
            return result, pos
        shift += 7
        if shift > 70:
            raise ValueError("bad varint")


def _fields(buf: bytes):
    """Yield ``(field_number, wire_type, value)``; value is bytes for length-delimited fields."""
    pos, n = 0, len(buf)
    while pos < n:
        tag, pos = _varint(buf, pos)
        num, wt = tag >> 3, tag & 7
        if wt == 0:
            v, pos = _varint(buf, pos)
        elif wt == 2:
            ln, pos = _varint(buf, pos)
            if pos + ln > n:
                raise ValueError("truncated field")
            v = buf[pos:pos + ln]
            pos += ln
        elif wt == 5:
            v = buf[pos:pos + 4]
            pos += 4
        elif wt == 1:
            v = buf[pos:pos + 8]
            pos += 8
        else:
            raise ValueError(f"wire type {wt}")
        yield num, wt, v


def _signed64(v: int) -> int:
    return v - (1 << 64) if v >= (1 << 63) else v


def parse_example(data: bytes, wanted: set[str] | None = None) -> dict:
    """``{name: ('bytes'|'float'|'int64', [values])}`` of all features, or of the ``wanted`` ones."""
    out = {}
    for num, _, features in _fields(data):
        if num != 1:
            continue
        for fnum, _, entry in _fields(features):
            if fnum != 1:
                continue
            name, feature = None, b""
            for enum, _, ev in _fields(entry):
                if enum == 1:
                    name = bytes(ev).decode("utf-8")
                elif enum == 2:
                    feature = ev
            if name is not None and (wanted is None or name in wanted):
                out[name] = _feature(feature)
    return out


def _feature(feature: bytes) -> tuple[str, list]:
    kind, values = "bytes", []
    for knum, _, lst in _fields(feature):
        items = list(_fields(lst))
        if knum == 1:
            kind, values = "bytes", [bytes(v) for n, _, v in items if n == 1]
        elif knum == 2:
            kind, values = "float", []
            for _, _, v in items:  # packed or one by one: four bytes each
                values += struct.unpack(f"<{len(v) // 4}f", v)
        elif knum == 3:
            kind, values = "int64", []
            for _, wt, v in items:
                if wt == 0:
                    values.append(_signed64(v))
                p = 0
                while wt == 2 and p < len(v):
                    x, p = _varint(v, p)
                    values.append(_signed64(x))
    return kind, values


# --- checksums --------------------------------------------------------------------------------
_POLYNOMIAL = 0x82F63B78  # CRC-32C, reflected
_LANE = 1 << 12


@cache
def _crc_tables():
    """``t[d][b]``: what a byte ``b`` adds to the state with ``d`` more bytes after it."""
    import numpy as np

    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> 1) ^ np.uint32(_POLYNOMIAL), first >> 1)
    t = np.zeros((_LANE, 256), np.uint32)
    t[0] = first
    for d in range(1, _LANE):
        t[d] = first[t[d - 1] & 0xFF] ^ (t[d - 1] >> 8)
    return t


def crc32c(data: bytes) -> int:
    """CRC-32C of whole data: bytes add up (xor) by their distance from the end, a lane at a time."""
    import numpy as np

    t, state = _crc_tables(), 0xFFFFFFFF
    for s in range(0, len(data), _LANE):
        lane = np.frombuffer(data, np.uint8, min(_LANE, len(data) - s), s).copy()
        if len(lane) < 4:
            for b in lane.tolist():
                state = int(t[0][(state ^ b) & 0xFF]) ^ (state >> 8)
            continue
        lane[:4] ^= np.frombuffer(struct.pack("<I", state), np.uint8)
        state = int(np.bitwise_xor.reduce(t[np.arange(len(lane) - 1, -1, -1), lane]))
    return state ^ 0xFFFFFFFF


def masked_crc(data: bytes) -> int:
    crc = crc32c(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


class BrokenFrame(ValueError):
    """The place where the next record begins is unknown."""


class _Damaged(bytes):
    """Data whose checksum doesn't match."""


def iter_records(stream, size: int | None = None, at: int = 0, stop: int | None = None):
    """Yield ``(byte offset, payload)`` from byte ``at``; a payload whose checksum doesn't match is ``_Damaged``.

    Raises ``BrokenFrame`` at a length that is damaged or reaches beyond the file's ``size``."""
    while stop is None or at < stop:
        head = stream.read(12)
        if not head:
            return
        if len(head) < 12:
            raise BrokenFrame(f"truncated record header at byte {at}")
        length, check = struct.unpack("<QI", head)
        if masked_crc(head[:8]) != check:
            raise BrokenFrame(f"wrong checksum of a length at byte {at}")
        if size is not None and at + length + 16 > size:
            raise BrokenFrame(f"record at byte {at} reaches beyond the file")
        body = stream.read(length + 4)
        if len(body) < length + 4:
            raise BrokenFrame(f"truncated record at byte {at}")
        data = body[:length]
        yield at, data if masked_crc(data) == struct.unpack("<I", body[length:])[0] else _Damaged(data)
        at += length + 16


# --- data source -------------------------------------------------------------------------------

# Optional pseudo-columns: the file a record came from and its position among the good records
# of that file (for row ids in file order, see ``capset.operators.rows.with_row_id_from``).
FILE_COL = "_file"
INDEX_COL = "_index"
CORRUPT_COL = "_corrupt"
OFFSET_COL = "_offset"
RAW_COL = "_raw"
#: Bytes of values in a batch that goes to Spark, beyond which it is closed.
BATCH_BYTES = 32 << 20


def _convert(dt, kind, values):
    if isinstance(dt, ArrayType):
        return [_convert(dt.elementType, kind, [v]) for v in values]
    if not values:
        return None
    v = values[0]
    if isinstance(dt, BinaryType):
        return v if isinstance(v, bytes) else str(v).encode()
    if isinstance(dt, StringType):
        return v.decode("utf-8", errors="replace") if isinstance(v, bytes) else str(v)
    if isinstance(dt, (LongType, IntegerType)):
        return int(v)
    if isinstance(dt, (FloatType, DoubleType)):
        return float(v)
    return v


@dataclass
class FilePartition(InputPartition):
    path: str
    start: int = 0
    stop: int | None = None
    first: int | None = None  # place of the first record, where an index knows it
    wrong: str | None = None  # what the index found here


class TFRecordReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.schema = schema
        self.path = options.get("path")
        self.mode = options.get("mode", "FAILFAST").upper()
        self.index = options.get("index")
        if self.mode not in ("FAILFAST", "DROPMALFORMED", "PERMISSIVE"):
            raise ValueError(f"unknown mode {self.mode}")
        if self.mode == "PERMISSIVE" and CORRUPT_COL not in schema.fieldNames():
            raise ValueError(f"mode PERMISSIVE needs a column {CORRUPT_COL} string in the schema")

    def partitions(self):
        if not self.index:
            return [FilePartition(p) for p in _list_files(self.path)]
        files = {f: _fs(self.path)[0].get_file_info(f).size for f in _list_files(self.path)}
        splits = read_index(self.index)
        if {(r["file"], r["size"]) for r in splits} != set(files.items()):
            raise ValueError(f"the index {self.index} was built of other files than those under {self.path}")
        return [FilePartition(r["file"], r["start"], r["stop"], r["first"], r["wrong"]) for r in splits if r["stop"] > r["start"]]

    def read(self, partition):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        filesystem, _ = _fs(self.path)
        arrow = to_arrow_schema(self.schema)
        special = {FILE_COL, INDEX_COL, CORRUPT_COL, OFFSET_COL, RAW_COL}
        wanted = {f.name for f in self.schema.fields} - special
        rows, held, index = [], 0, partition.first or 0

        def batch():
            nonlocal held
            columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)]
            rows.clear()
            held = 0
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        def row(ex: dict, place: int, wrong: str | None, at: int, data: bytes | None) -> list:
            own = {FILE_COL: partition.path, INDEX_COL: None if wrong else place, CORRUPT_COL: wrong, OFFSET_COL: at, RAW_COL: data if wrong else None}
            return [own[f.name] if f.name in special else _convert(f.dataType, *ex.get(f.name, (None, []))) for f in self.schema.fields]

        with filesystem.open_input_file(partition.path) as stream:
            stream.seek(partition.start)
            for at, data, wrong in self._records(stream, partition):
                ex = {}
                if not wrong:
                    try:
                        ex = parse_example(data, wanted)
                    except (ValueError, IndexError, struct.error, UnicodeDecodeError) as e:
                        wrong = f"undecodable record at byte {at}: {e}"
                if wrong and self.mode == "FAILFAST":
                    raise ValueError(f"{partition.path}: {wrong}")
                if wrong and self.mode == "DROPMALFORMED":
                    logging.getLogger(__name__).warning("%s: %s", partition.path, wrong)
                    index += partition.first is not None
                    continue
                rows.append(row(ex, index, wrong, at, data))
                # an index counts all records, a scan without one only those that are good
                index += partition.first is not None or not wrong
                held += len(data or b"")
                if held >= BATCH_BYTES or len(rows) >= 4096:
                    yield batch()
        if rows:
            yield batch()

    def _records(self, stream, partition: FilePartition):
        """``(byte offset, payload, what is wrong)``."""
        at = partition.start
        try:
            if partition.wrong:
                raise BrokenFrame(partition.wrong)
            for at, data in iter_records(stream, stream.size(), partition.start, partition.stop):
                yield at, data, f"wrong checksum of the data at byte {at}" if isinstance(data, _Damaged) else None
                at += len(data) + 16
        except BrokenFrame as e:
            if self.mode != "PERMISSIVE":
                raise
            yield at, None, f"{e}; the rest of the {'file' if partition.stop is None or partition.wrong else 'split'} can't be read"


# --- index -------------------------------------------------------------------------------------
_INDEX = "file string, size long, start long, stop long, first long, records long, wrong string"


class _Window:
    """Small reads at rising places of a file, a window at a time."""

    def __init__(self, file, size: int = 1 << 16):
        self.file, self.step, self.at, self.data = file, size, 0, b""

    def read(self, at: int, n: int) -> bytes:
        if not self.at <= at <= at + n <= self.at + len(self.data):
            self.at, self.data = at, self.file.read_at(max(n, self.step), at)
        return self.data[at - self.at:at - self.at + n]


def file_splits(filesystem, path: str, split_bytes: int) -> list[tuple]:
    """The splits of a file, from its record lengths alone: each begins at a record and holds ``split_bytes`` or little more."""
    size = filesystem.get_file_info(path).size
    out, start, at, first, n = [], 0, 0, 0, 0
    with filesystem.open_input_file(path) as file:
        window = _Window(file)
        while at < size:
            head = window.read(at, 12)
            wrong = "truncated record header" if len(head) < 12 else "wrong checksum of a length" if masked_crc(head[:8]) != struct.unpack(
                "<I", head[8:])[0] else "record reaches beyond the file" if at + struct.unpack("<Q", head[:8])[0] + 16 > size else None
            if wrong or at - start >= split_bytes:
                if n:
                    out.append((path, size, start, at, first, n, None))
                start, first, n = at, first + n, 0
            if wrong:  # where the next record begins is unknown
                out.append((path, size, at, size, first, 0, f"{wrong} at byte {at}"))
                return out
            at += struct.unpack("<Q", head[:8])[0] + 16
            n += 1
    return [*out, (path, size, start, size, first, n, None)]


def build_index(spark: SparkSession, path: str, index: str, split_bytes: int = 64 << 20) -> DataFrame:
    """Write the splits of all files under ``path`` to the Parquet folder ``index``; a task reads the lengths in a file, no data.

    The rows (``file, size, start, stop, first, records, wrong``) are as many as there are splits; ``first`` is the place
    of a split's first record in its file."""
    import pandas as pd

    files = spark.createDataFrame([(p,) for p in _list_files(path)], "file string")

    def run(batches):
        filesystem, _ = _fs(path)
        for df in batches:
            rows = [r for p in df["file"] for r in file_splits(filesystem, p, split_bytes)]
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _INDEX.split(", ")], dtype=object)

    n = spark.sparkContext.defaultParallelism
    files.repartition(4 * n, "file").mapInPandas(run, _INDEX).write.mode("overwrite").parquet(index)
    return spark.read.parquet(index)


def read_index(index: str) -> list[dict]:
    import pyarrow.dataset as ds

    filesystem, p = _fs(index)
    return ds.dataset(p, filesystem=filesystem, format="parquet").to_table().sort_by([("file", "ascending"), ("start", "ascending")]).to_pylist()


def has_index(index: str) -> bool:
    from pyarrow import fs as pafs

    filesystem, p = _fs(index)
    return filesystem.get_file_info(posixpath.join(p, "_SUCCESS")).type == pafs.FileType.File


def read_indexed(spark: SparkSession, path: str, index: str, schema: str | StructType | None = None, split_bytes: int = 64 << 20, **options) -> DataFrame:
    """Read through the index, which is built first if it isn't there; without ``schema`` fields are those of the first record."""
    register(spark)
    if not has_index(index):
        build_index(spark, path, index, split_bytes)
    reader = spark.read.format("tfrecord").options(index=index, **options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


# --- writing -----------------------------------------------------------------------------------

def _put_varint(v: int) -> bytes:
    out = bytearray()
    while v > 0x7F:
        out.append(v & 0x7F | 0x80)
        v >>= 7
    out.append(v)
    return bytes(out)


def _put(number: int, data: bytes) -> bytes:
    return _put_varint(number << 3 | 2) + _put_varint(len(data)) + data


def _feature_kind(dt) -> str:
    dt = dt.elementType if isinstance(dt, ArrayType) else dt
    if isinstance(dt, (BinaryType, StringType)):
        return "bytes"
    if isinstance(dt, (IntegralType, BooleanType)):
        return "int64"
    if isinstance(dt, (FloatType, DoubleType)):
        return "float"
    raise ValueError(f"a TFRecord feature can't hold {dt.simpleString()}: cast it")


def encode_example(features: list[tuple[str, str, list]]) -> bytes:
    """``(name, kind, values)`` as a serialised ``tf.train.Example``; what ``parse_example`` reads."""
    entries = []
    for name, kind, values in features:
        if kind == "bytes":
            inner = _put(1, b"".join(_put(1, v.encode() if isinstance(v, str) else bytes(v)) for v in values))
        elif kind == "float":
            inner = _put(2, _put(1, struct.pack(f"<{len(values)}f", *values)))
        else:
            inner = _put(3, _put(1, b"".join(_put_varint(int(v) & 0xFFFFFFFFFFFFFFFF) for v in values)))
        entries.append(_put(1, _put(1, name.encode()) + _put(2, inner)))
    return _put(1, b"".join(entries))


def frame_record(data: bytes) -> bytes:
    head = struct.pack("<Q", len(data))
    return head + struct.pack("<I", masked_crc(head)) + data + struct.pack("<I", masked_crc(data))


@dataclass
class FilesCommit(WriterCommitMessage):
    files: list
    records: int


class TFRecordWriter(DataSourceArrowWriter):
    def __init__(self, schema: StructType, options, overwrite: bool):
        self.path, self.overwrite = options.get("path"), overwrite
        self.file_col = options.get("fileColumn") or options.get("filecolumn")
        self.fields = [(f.name, _feature_kind(f.dataType), isinstance(f.dataType, ArrayType)) for f in schema.fields if f.name != self.file_col]
        self.most, self.bytes = int(float(options.get("maxrecords", 1 << 62))), int(float(options.get("maxsize", 1 << 62)))
        if self.most < 1 or self.bytes < 1:
            raise ValueError("maxrecords and maxsize must be positive")

    def write(self, iterator):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        filesystem, base = _fs(self.path)
        filesystem.create_dir(base, recursive=True)
        run, files, records = uuid.uuid4().hex[:12], [], 0
        out, at, n, size = None, None, 0, 0

        try:
            for batch in iterator:
                columns = [batch.column(name).to_pylist() for name, _, _ in self.fields]
                names = batch.column(self.file_col).to_pylist() if self.file_col else [f"part-{ctx.partitionId():05d}"] * batch.num_rows
                for stem, *values in zip(names, *columns, strict=True):
                    if out is None or stem != at or n >= self.most or size >= self.bytes:
                        if out is not None:
                            out.close()
                        at, n, size = stem, 0, 0
                        files.append(f"{stem}-{len(files):05d}-{run}.tfrecord")
                        out = filesystem.open_output_stream(posixpath.join(base, files[-1]), compression=None)
                    frame = frame_record(encode_example([
                        (name, kind, [] if v is None else v if many else [v]) for (name, kind, many), v in zip(self.fields, values, strict=True)]))
                    out.write(frame)
                    n, size, records = n + 1, size + len(frame), records + 1
        finally:
            if out is not None:
                out.close()
        return FilesCommit(files, records)

    def commit(self, messages):
        filesystem, base = _fs(self.path)
        publish(filesystem, base, [f for m in messages if m is not None for f in m.files], self.overwrite)

    def abort(self, messages):
        filesystem, base = _fs(self.path)
        for f in (f for m in messages if m is not None for f in m.files):
            filesystem.delete_file(posixpath.join(base, f))


def infer_schema(path: str) -> StructType:
    """Schema from the first decodable record of the files in name order."""
    filesystem, _ = _fs(path)
    for p in _list_files(path):
        with filesystem.open_input_stream(p) as stream:
            try:
                for _, data in iter_records(stream, filesystem.get_file_info(p).size):
                    try:
                        ex = parse_example(data) if not isinstance(data, _Damaged) else {}
                    except (ValueError, IndexError, struct.error, UnicodeDecodeError):
                        continue
                    if ex:
                        base = {"bytes": BinaryType(), "float": FloatType(), "int64": LongType()}
                        return StructType([StructField(name, ArrayType(base[kind]) if len(values) > 1 else base[kind])
                                           for name, (kind, values) in ex.items()])
            except BrokenFrame:
                continue
    raise ValueError(f"no readable TFRecord under {path}")


class TFRecordDataSource(DataSource):
    @classmethod
    def name(cls):
        return "tfrecord"

    def schema(self):
        return infer_schema(self.options.get("path"))

    def reader(self, schema: StructType):
        return TFRecordReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool):
        return TFRecordWriter(schema, self.options, overwrite)


def register(spark) -> None:
    from capset.session import ship_package

    ship_package(spark)
    spark.dataSource.register(TFRecordDataSource)
