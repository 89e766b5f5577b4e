"""File trees listed and read by tasks.

Spark's file sources list every file on the driver before the job begins.  Here a tree is listed folder by folder in tasks,
a level a job, and what is found stays a table: for trees of any number of files the driver holds a count of each level.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capset.functions import ids as I
from capset.session import scratch_path, ship_package
from capset.sources.tarshard import _fs

_FOUND = "path string, folder boolean, length long, modificationTime timestamp"
#: Bytes of contents in a batch that goes to Spark, beyond which it is closed; folders that a task lists.
BATCH_BYTES, FOLDERS = 32 << 20, 64


def _prefix(root: str) -> str:
    """What is left out of paths inside the file system: scheme and host (nothing, of local paths)."""
    inside = _fs(root)[1]
    return "" if root.startswith(("/", "file:")) else root.rstrip("/")[:-len(inside)] if root.rstrip("/").endswith(inside) else ""


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, modificationTime`` of all files below ``root``; names that begin with a dot or a low line are left out, with
    all below them.  A root that is a file lists itself; one that doesn't exist raises."""
    from pyarrow import fs as pafs

    ship_package(spark)
    filesystem, inside = _fs(root)
    info = filesystem.get_file_info(inside)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(root)
    if info.type == pafs.FileType.File:
        return spark.createDataFrame([(inside, False, info.size, info.mtime)], _FOUND).drop("folder")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, _ = _fs(root)
        for df in batches:
            for path in df["path"]:
                found = [i for i in files.get_file_info(pafs.FileSelector(path, recursive=False)) if not i.base_name.startswith((".", "_"))]
                if not found:
                    continue
                yield pd.DataFrame({"path": [i.path for i in found], "folder": [i.type == pafs.FileType.Directory for i in found],
                                    "length": [i.size or 0 for i in found], "modificationTime": [i.mtime for i in found]})

    levels, folders, n = [], spark.createDataFrame([(inside,)], "path string"), 1
    while n:
        written = scratch_path(spark, "listing")
        parts = max(1, min(n // FOLDERS + 1, 16 * spark.sparkContext.defaultParallelism))
        folders.repartition(parts).mapInPandas(run, _FOUND).write.parquet(written)
        level = spark.read.schema(_FOUND).parquet(written)
        levels.append(level.where("not folder").drop("folder"))
        folders = level.where("folder").select("path")
        n = folders.count()
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def with_contents(files: DataFrame, root: str, path: str = "path") -> DataFrame:
    """``files`` with ``content``, read once by the tasks that ask for it, some files at a time."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, _ = _fs(root)
        for df in batches:
            start, held, data = 0, 0, []
            for n, p in enumerate(df[path]):
                with filesystem.open_input_stream(p, compression=None) as f:
                    data.append(f.read())
                held += len(data[-1])
                if held > BATCH_BYTES or n + 1 == len(df):
                    yield df.iloc[start:n + 1].assign(content=data)
                    start, held, data = n + 1, 0, []

    return files.mapInPandas(run, f"{schema}, content binary")


def scan_tree(spark: SparkSession, root: str, exts=None, with_content: bool = False, depth: int | None = None) -> DataFrame:
    """As ``sources.files.scan_files``, with the listing and the reading in tasks: ``path, rel, folder, name, stem, ext, length,
    modificationTime, depth`` (+ ``content``)."""
    _, inside = _fs(root)
    base = inside.rstrip("/")
    df = list_tree(spark, root)
    rel = F.when(F.col("path").startswith(base + "/"), F.substring("path", len(base) + 2, 1 << 30)).otherwise(I.file_name("path"))
    df = df.withColumn("rel", rel).withColumns({
        "name": I.file_name("path"), "stem": I.file_stem("path"), "ext": I.file_extension("path"), "folder": F.coalesce(I.parent_dir("rel"), F.lit("")),
        "depth": F.size(F.split("rel", "/")) - 1})
    if exts:
        df = df.where(F.col("ext").isin([e.lower() for e in exts]))
    if depth is not None:
        df = df.where(F.col("depth") <= depth)
    if with_content:
        df = with_contents(df, root)
    return df.withColumn("path", F.concat(F.lit(_prefix(root)), "path"))
