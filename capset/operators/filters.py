"""Row filters and set operators that are one DataFrame call each, named as in the survey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_language(df: DataFrame, languages, col: str = "language") -> DataFrame:
    """``language IN (...)`` -- pushed into the Parquet scan as an ``In`` filter."""
    return df.where(F.col(col).isin(list(languages)))


def short_texts(df: DataFrame, min_chars: int = 5, col: str = "text") -> DataFrame:
    """Rows whose text has fewer than ``min_chars`` characters."""
    return df.where(F.length(col) < min_chars)


def ok_rows(df: DataFrame, status: str = "status", ok: str = "ok") -> DataFrame:
    """Failed rows out of the result."""
    return df.where(F.col(status) == ok)


def with_exists(df: DataFrame, files: DataFrame, on: str = "path", name: str = "exists") -> DataFrame:
    """``exists`` = the path is in the file listing (left join on the distinct listing)."""
    present = files.select(F.col(on)).distinct().withColumn(name, F.lit(True))
    return df.join(present, on, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def common_keys(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Keys present in both inputs (``INTERSECT`` of the key columns)."""
    keys = [key] if isinstance(key, str) else list(key)
    return a.select(*keys).intersect(b.select(*keys))


def only_in(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b`` (left anti join on distinct keys of ``b``)."""
    keys = [key] if isinstance(key, str) else list(key)
    return a.join(b.select(*keys).distinct(), keys, "left_anti")
