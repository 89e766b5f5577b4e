"""File-tree scans: text/image/JSON files keyed by folder and stem, image validity, sidecars.

``binaryFile`` lists files without reading them as long as ``content`` is not selected, so
listing-only scans (pairing, counting) touch no bytes; content is read late, after the joins
that decide which files are needed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capset.functions import ids as I

PATH_NORM = r"^file:/+"


def _norm_path(c):
    """``file:///a`` and ``file:/a`` -> ``/a``; other schemes stay."""
    return F.regexp_replace(c, PATH_NORM, "/")


def _decoded(origin):
    """A percent-encoded location as the path that a listing gives (a plus sign is a plus sign)."""
    return F.try_url_decode(F.replace(origin, F.lit("+"), F.lit("%2B")))


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` as the listing names it: with scheme and working folder of the session's file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    return re.sub(PATH_NORM, "/", full).rstrip("/") or "/"


def ext_glob(exts) -> str:
    """``pathGlobFilter`` for a set of extensions, both cases (``*.{png,PNG,...}``)."""
    return "*.{" + ",".join(sorted({e.lower() for e in exts} | {e.upper() for e in exts})) + "}"


def scan_files(spark: SparkSession, root: str, exts=None, with_content: bool = False,
               depth: int | None = None) -> DataFrame:
    """Files below ``root``: ``path, rel, folder, name, stem, ext, length, modificationTime``
    (+ ``content``).  ``exts`` filters by extension, case-insensitive, inside the file listing
    (``pathGlobFilter``), so with ``content`` the bytes of other files are never read; ``depth``
    keeps files at most that many folders below ``root`` (0 = root only)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if exts:
        r = r.option("pathGlobFilter", ext_glob(exts))
    df = r.load(root)
    cols = ["path", "length", "modificationTime"] + (["content"] if with_content else [])
    df = df.select(*cols).withColumn("path", _norm_path(F.col("path")))
    base = qualified(spark, root).rstrip("/")
    # a root that is a file lists itself: its relative path is its name
    rel = F.when(F.col("path").startswith(base + "/"), F.substring("path", len(base) + 2, 1 << 30)).otherwise(I.file_name("path"))
    df = (df.withColumn("rel", rel)
            .withColumn("name", I.file_name("path"))
            .withColumn("stem", I.file_stem("path"))
            .withColumn("ext", I.file_extension("path"))
            .withColumn("folder", F.coalesce(I.parent_dir("rel"), F.lit("")))
            .withColumn("depth", F.size(F.split("rel", "/")) - 1))
    if exts:
        df = df.where(F.col("ext").isin([e.lower() for e in exts]))
    if depth is not None:
        df = df.where(F.col("depth") <= depth)
    return df


def folders_with_text(files: DataFrame) -> DataFrame:
    """Folders holding at least one ``.txt`` file (``bool_or`` per folder)."""
    return files.groupBy("folder").agg(F.bool_or(F.col("ext") == "txt").alias("has_text")) \
                .where("has_text").select("folder")


def image_profiles(spark: SparkSession, root: str, exts=("jpg", "jpeg", "png", "bmp")) -> DataFrame:
    """Width, height and validity of every image below ``root`` (Spark's ``image`` source
    decodes each file; invalid files get ``valid = false``)."""
    img = (spark.read.format("image").option("recursiveFileLookup", "true")
           .option("pathGlobFilter", ext_glob(exts)).load(root))
    return img.select(_norm_path(_decoded(F.col("image.origin"))).alias("path"),
                      F.col("image.width").alias("width"), F.col("image.height").alias("height"),
                      F.col("image.nChannels").alias("channels"),
                      (F.col("image.width") > 0).alias("valid"))


def scan_sidecars(spark: SparkSession, root: str) -> DataFrame:
    """JSON sidecars parsed and re-serialised (compact, keys sorted); corrupt ones give null
    ``json`` and ``corrupt = true``."""
    f = scan_files(spark, root, exts=["json"], with_content=True)
    raw = F.decode(F.col("content"), "UTF-8")
    parsed = F.try_parse_json(raw)
    return f.select("path", "folder", "stem", F.to_json(parsed).alias("json"), parsed.isNull().alias("corrupt"))


def text_lengths(spark: SparkSession, root: str) -> DataFrame:
    """Characters of every ``.txt`` file (content read for text files only)."""
    f = scan_files(spark, root, exts=["txt"], with_content=True)
    return f.select("path", F.length(F.decode("content", "UTF-8")).cast("long").alias("text_len"))


def file_tree(spark: SparkSession, root: str, exts=("txt", "jpg", "jpeg", "png", "bmp")) -> DataFrame:
    """Listing with ``text_len`` (texts) and ``valid`` (images) for the pair checks."""
    files = scan_files(spark, root, exts=exts)
    texts = text_lengths(spark, root)
    images = image_profiles(spark, root).select("path", "valid")
    joined = files.join(texts, "path", "left").join(images, "path", "left")
    return joined.withColumn("valid", F.when(F.col("ext").isin("jpg", "jpeg", "png", "bmp"), profiled("valid", "path")))


def profiled(valid: str, path: str):
    """The verdict on an image; a file that was listed but not looked at is an error, not an invalid image."""
    missing = F.raise_error(F.concat(F.lit("no image profile of "), F.col(path))).cast("boolean")
    return F.coalesce(F.col(valid), missing)
