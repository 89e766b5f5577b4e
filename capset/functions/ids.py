"""Identifier and path expressions: padded ids, folder numbers, stems, extensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_id(c, width: int = 9, prefix: str = "") -> Column:
    """``prefix + '%0{width}d' % id``.  Longer ids keep all digits (``lpad`` would cut them)."""
    return F.concat(F.lit(prefix), F.format_string(f"%0{width}d", _c(c).cast("long")))


def shard_dir(c, per_folder: int = 10000, width: int = 5) -> Column:
    """Folder of an id: ``'%05d' % int(id / 10000)``."""
    return F.format_string(f"%0{width}d", F.floor(_c(c).cast("long") / F.lit(per_folder)))


def batch_of(c, size: int) -> Column:
    """Batch number of a row id: ``floor(row_id / size)`` as bigint."""
    return F.floor(_c(c).cast("long") / F.lit(size))


def batch_name(c, size: int, width: int = 5, prefix: str = "") -> Column:
    return pad_id(batch_of(c, size), width, prefix)


def file_name(path) -> Column:
    """Last segment of a file path, every character of it (``#`` and ``?`` are part of file names)."""
    return F.regexp_extract(_c(path), r"(?s)([^/]*)/*$", 1)


def base_name(url) -> Column:
    """Last path segment of a URL (query string and fragment removed)."""
    return file_name(F.regexp_replace(_c(url), r"(?s)[?#].*$", ""))


def _stem(name: Column) -> Column:
    return F.regexp_extract(name, r"(?s)^(.+?)(\.[^.]*)?$", 1)


def _extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(?s)^.+?\.([^.]*)$", 1))


def stem(url) -> Column:
    """Base name of a URL without its last extension."""
    return _stem(base_name(url))


def file_stem(path) -> Column:
    """File name without its last extension (``Path.stem``)."""
    return _stem(file_name(path))


def extension(url) -> Column:
    """Last extension of a URL without the dot, lower-case; empty when none."""
    return _extension(base_name(url))


def file_extension(path) -> Column:
    """Last extension of a file path without the dot, lower-case; empty when none."""
    return _extension(file_name(path))


def parent_dir(c) -> Column:
    """Path without its last segment."""
    return F.regexp_extract(_c(c), r"^(.*)/[^/]*$", 1)


def _number(name: Column) -> Column:
    digits = F.regexp_extract(name, r"(\d+)(\.[^.]*)?$", 1)
    return F.when(digits != "", digits.try_cast("long"))


def numeric_id(url) -> Column:
    """Digits of a URL's base name before its extension, as bigint (``w00000042.txt`` -> 42); null if there
    are none or too many for a bigint."""
    return _number(base_name(url))


def file_number(path) -> Column:
    """The same of a file path."""
    return _number(file_name(path))


def last_part(c, sep: str = "_") -> Column:
    """Part after the last separator (``dataset_abc`` -> ``abc``)."""
    return F.substring_index(_c(c), sep, -1)


def is_svg(c, ignore_case: bool = True) -> Column:
    col = F.lower(_c(c)) if ignore_case else _c(c)
    return F.instr(col, ".svg") > 0


def media_kind(c) -> Column:
    return F.when(is_svg(c), F.lit("svg")).otherwise(F.lit("raster"))


def group_tag(file_name) -> Column:
    """Group of an input file from its name: the 1% sample or a numbered shard."""
    name = _c(file_name)
    shard = F.regexp_extract(name, r"-(\d+)-of-", 1)
    return (F.when(F.instr(name, "1percent") > 0, F.lit("onepercent"))
            .when(shard != "", F.concat(F.lit("main"), shard))
            .otherwise(F.lit("other")))
