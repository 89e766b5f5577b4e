"""``tarshard``: a Python Data Source for sample shards in tar files (``.tar`` / ``.tar.gz``).

A sample is a run of consecutive tar members sharing a key (the member name up to the first
dot of its base name); the rest of the name is the field (``000000042.img``,
``000000042.cap``).  Columns other than ``key`` are fields; ``binary`` columns get raw bytes,
``string`` columns UTF-8 text.

Reading: one input partition per shard file, so shards are read in parallel by the
executors.  Writing: each task writes its rows to its own shards, rolling to the next shard
before a sample when ``maxcount`` samples or ``maxsize`` bytes are reached (so a shard exceeds
``maxsize`` by less than one sample).  With ``shardColumn`` the rows are expected to be
clustered by that column (``repartition(col)``) and each value becomes one shard named by
its number; appending counts on from the last number there.  ``pathFields`` names fields that hold
file paths: their bytes are read in the write task, so only paths are shuffled before it.
Files are written under temporary names and renamed by the driver's commit, which never moves a shard
onto another; an overwrite takes the old shards away after the new ones are in place.  Abort
or a failed attempt leaves no visible shard.

``commit=list`` is for object stores, where a rename is a copy: tasks write under final names that end in the attempt's own
mark, and the driver publishes one list of them (``sources.visible``), whatever their number.  Readers here see listed
shards alone; an overwrite hides the old ones and leaves the files.

Paths go through ``pyarrow.fs``, so local folders and object stores work alike.
"""

from __future__ import annotations

import io
import posixpath
import re
import tarfile
import time
import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.types import BinaryType, StringType, StructType

from capset.sources.visible import publish, visible_files

DEFAULT_SCHEMA = "key string, img binary, cap binary, json string"
SHARD_SUFFIXES = (".tar", ".tar.gz", ".tgz")
#: Bytes of fields in a batch that goes to Spark, beyond which it is closed.
BATCH_BYTES = 64 << 20


def _fs(path: str):
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.LocalFileSystem(), path


def _list_shards(path: str) -> list[str]:
    from pyarrow import fs as pafs

    filesystem, p = _fs(path)
    info = filesystem.get_file_info(p)
    published = None if info.type == pafs.FileType.File else visible_files(filesystem, p)
    if info.type == pafs.FileType.File:
        files = [p]
    elif published is not None:
        files = [f for f in published if f.endswith(SHARD_SUFFIXES)]
    else:
        sel = pafs.FileSelector(p, recursive=True)
        files = [i.path for i in filesystem.get_file_info(sel)
                 if i.type == pafs.FileType.File and i.path.endswith(SHARD_SUFFIXES)
                 and not posixpath.basename(i.path).startswith(".")]
    return sorted(files)


def _own_shards(path: str, prefix: str) -> list[str]:
    """Shards in the folder itself whose whole name this writer gives under the prefix."""
    from pyarrow import fs as pafs

    filesystem, p = _fs(path)
    name = re.compile(rf"{re.escape(prefix)}(\d{{6}}|([0-9a-f]{{12}}_)?\d{{5}}_\d{{6}})\.tar(\.gz)?")
    try:
        infos = filesystem.get_file_info(pafs.FileSelector(p, recursive=False))
    except FileNotFoundError:
        return []
    return sorted(i.path for i in infos if i.type == pafs.FileType.File and name.fullmatch(posixpath.basename(i.path)))


def split_member(name: str) -> tuple[str, str]:
    """``dir/000001.img.png`` -> (``dir/000001``, ``img.png``)."""
    d, b = posixpath.split(name)
    if "." not in b:
        return name, ""
    k, field = b.split(".", 1)
    return (posixpath.join(d, k) if d else k), field


@dataclass
class ShardPartition(InputPartition):
    path: str


class TarShardReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.schema = schema
        self.path = options.get("path")
        self.with_shard = "__shard__" in schema.fieldNames()

    def partitions(self):
        return [ShardPartition(p) for p in _list_shards(self.path)]

    def read(self, partition):
        filesystem, _ = _fs(self.path)
        fields = [f for f in self.schema.fields if f.name not in ("key", "__shard__")]
        mode = "r|gz" if partition.path.endswith((".gz", ".tgz")) else "r|"
        current, sample = None, {}
        wanted = {f.name for f in fields}

        def emit(key, sample):
            row = []
            for f in self.schema.fields:
                if f.name == "key":
                    row.append(key)
                elif f.name == "__shard__":
                    row.append(partition.path)
                else:
                    v = sample.get(f.name)
                    if v is not None and isinstance(f.dataType, StringType):
                        v = v.decode("utf-8", errors="replace")
                    row.append(v)
            return tuple(row)

        arrow_ok = all(isinstance(f.dataType, (StringType, BinaryType)) for f in self.schema.fields)
        buf, held = [], 0

        def flush():
            import pyarrow as pa

            nonlocal held
            held = 0

            cols = list(zip(*buf))
            arrays = [pa.array(list(c), type=pa.string() if isinstance(f.dataType, StringType) else pa.binary())
                      for c, f in zip(cols, self.schema.fields)]
            buf.clear()
            return pa.RecordBatch.from_arrays(arrays, names=self.schema.fieldNames())

        with filesystem.open_input_stream(partition.path, compression=None) as raw, \
                tarfile.open(fileobj=raw, mode=mode) as tf:
            for m in tf:
                if not m.isfile():
                    continue
                key, field = split_member(m.name)
                if key != current and current is not None:
                    buf.append(emit(current, sample))
                    sample = {}
                    if len(buf) >= 1024 or held >= BATCH_BYTES:
                        if arrow_ok:
                            yield flush()
                        else:
                            yield from buf
                            buf.clear()
                            held = 0
                current = key
                # a field goes by its whole name or by its first part (``img.png`` -> ``img``)
                names = {field, field.split(".", 1)[0]} & wanted
                if not names:
                    continue  # the stream skips its bytes
                content = tf.extractfile(m).read()
                held += len(content)
                for n in names:
                    if n == field or n not in sample:
                        sample[n] = content
            if current is not None:
                buf.append(emit(current, sample))
            if buf:
                if arrow_ok:
                    yield flush()
                else:
                    yield from buf


@dataclass
class ShardCommit(WriterCommitMessage):
    moves: list
    samples: int
    nbytes: int


class TarShardWriter(DataSourceArrowWriter):
    def __init__(self, schema: StructType, options, overwrite: bool):
        self.schema = schema
        self.path = options.get("path")
        self.maxcount = int(float(options.get("maxcount", 100000)))
        self.maxsize = int(float(options.get("maxsize", 1e9)))
        self.prefix = options.get("prefix", "ds_")
        self.gzip = options.get("compression", "none").lower() in ("gzip", "gz", "true")
        self.shard_col = options.get("shardColumn")
        self.job = uuid.uuid4().hex[:12]
        self.overwrite = overwrite
        self.path_fields = {f for f in options.get("pathfields", options.get("pathFields", "")).split(",") if f}
        self.first = 0
        self.listed = options.get("commit", "rename").lower() == "list"
        published = visible_files(*_fs(self.path))
        if not self.listed and published is not None:
            raise ValueError(f"the shards of {self.path} are published by a list: write with commit=list")
        if self.shard_col and not overwrite:
            own = [p for p in published or [] if posixpath.basename(p).startswith(self.prefix)] if self.listed else _own_shards(self.path, self.prefix)
            numbers = [int(m.group(1)) for p in own
                       if (m := re.search(r"(?<![0-9_])(\d{6})(?:-[0-9a-f]{20})?\.tar", posixpath.basename(p)[len(self.prefix):]))]
            self.first = max(numbers, default=-1) + 1
        if self.maxcount < 1 or self.maxsize < 1:
            raise ValueError("maxcount and maxsize must be positive")

    def _suffix(self):
        return ".tar.gz" if self.gzip else ".tar"

    def write(self, iterator):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        part = ctx.partitionId() if ctx else 0
        attempt = ctx.attemptNumber() if ctx else 0
        filesystem, base = _fs(self.path)
        filesystem.create_dir(base, recursive=True)
        fields = [f for f in self.schema.fields if f.name not in ("key", self.shard_col)]
        moves, total, total_bytes = [], 0, 0
        now = int(time.time())
        state = {"tar": None, "out": None, "count": 0, "size": 0, "seq": 0}

        def close():
            if state["tar"] is None:
                return
            state["tar"].close()
            state["out"].close()
            state.update(tar=None, out=None, count=0, size=0)

        def open_shard(name):
            # streamed straight to a temporary file; the driver's commit renames it, or to the name that it will be listed under
            tmp = posixpath.join(base, f".{name}.{self.job}.{part}.{attempt}.tmp")
            if self.listed:
                tmp = posixpath.join(base, f"{name.removesuffix(self._suffix())}-{self.job}{uuid.uuid4().hex[:8]}{self._suffix()}")
            state["out"] = filesystem.open_output_stream(tmp, compression=None)
            state["tar"] = tarfile.open(fileobj=state["out"], mode="w|gz" if self.gzip else "w|")
            moves.append((tmp, posixpath.join(base, name)))

        current_shard, opened = None, set()
        names = [f.name for f in fields]
        for batch in iterator:  # Arrow record batches: columns converted once per batch
            cols = {n: batch.column(n).to_pylist() for n in names + ["key"] +
                    ([self.shard_col] if self.shard_col else [])}
            for i in range(batch.num_rows):
                if self.shard_col:
                    s_no = int(cols[self.shard_col][i]) + self.first
                    if s_no != current_shard:
                        if s_no in opened:
                            raise ValueError(f"rows of shard {s_no} are not together: repartition and sort by {self.shard_col}")
                        close()
                        current_shard = s_no
                        opened.add(s_no)
                        open_shard(f"{self.prefix}{s_no:06d}{self._suffix()}")
                elif state["tar"] is None or state["count"] >= self.maxcount or state["size"] >= self.maxsize:
                    close()
                    # appending next to an earlier run: the job id keeps the names apart
                    run = "" if self.overwrite else f"{self.job}_"
                    open_shard(f"{self.prefix}{run}{part:05d}_{state['seq']:06d}{self._suffix()}")
                    state["seq"] += 1
                key = str(cols["key"][i])
                if "." in posixpath.basename(key):
                    raise ValueError(f"key {key!r} holds a dot: what follows it would be read as the field")
                for n in names:
                    v = cols[n][i]
                    if v is None:
                        continue
                    if n in self.path_fields:
                        source, where = _fs(v)
                        with source.open_input_stream(where, compression=None) as f:
                            v = f.read()
                    if isinstance(v, str):
                        v = v.encode("utf-8")
                    elif not isinstance(v, (bytes, bytearray)):
                        v = str(v).encode("utf-8")
                    info = tarfile.TarInfo(f"{key}.{n}")
                    info.size = len(v)
                    info.mtime = now
                    state["tar"].addfile(info, io.BytesIO(v))
                    state["size"] += len(v)
                    total_bytes += len(v)
                state["count"] += 1
                total += 1
        close()
        return ShardCommit(moves=moves, samples=total, nbytes=total_bytes)

    def commit(self, messages):
        from concurrent.futures import ThreadPoolExecutor

        filesystem, base = _fs(self.path)
        moves = [move for m in messages if m is not None for move in m.moves]
        finals = {final for _, final in moves}
        if self.listed:
            if len(finals) < len(moves):
                raise ValueError("two tasks wrote a shard of one number: repartition by the shard column")
            publish(filesystem, base, [posixpath.basename(own) for own, _ in moves], self.overwrite)
            return
        old = _own_shards(self.path, self.prefix)
        if len(finals) < len(moves) or (not self.overwrite and finals & set(old)):
            self._remove_temps(filesystem, base)
            raise ValueError("two tasks wrote a shard of one number: repartition by the shard column")
        # a rename each; object stores copy, so several at a time
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda move: filesystem.move(*move), moves))
        if self.overwrite:
            for p in old:
                if p not in finals:
                    filesystem.delete_file(p)
        self._remove_temps(filesystem, base)

    def abort(self, messages):
        filesystem, base = _fs(self.path)
        if self.listed:  # what no list names is invisible; what finished tasks report goes
            for own, _ in (move for m in messages if m is not None for move in m.moves):
                filesystem.delete_file(own)
            return
        self._remove_temps(filesystem, base)

    def _remove_temps(self, filesystem, base):
        from pyarrow import fs as pafs

        try:
            infos = filesystem.get_file_info(pafs.FileSelector(base, recursive=False))
        except FileNotFoundError:
            return
        for i in infos:
            b = posixpath.basename(i.path)
            if b.startswith(".") and f".{self.job}." in b and b.endswith(".tmp"):
                filesystem.delete_file(i.path)


class TarShardDataSource(DataSource):
    @classmethod
    def name(cls):
        return "tarshard"

    def schema(self):
        return DEFAULT_SCHEMA

    def reader(self, schema: StructType):
        return TarShardReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool):
        return TarShardWriter(schema, self.options, overwrite)


def register(spark) -> None:
    from capset.session import ship_package

    ship_package(spark)
    spark.dataSource.register(TarShardDataSource)

