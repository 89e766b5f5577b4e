"""Duplicate removal by content hash, size rules and the run report.

``dedup_content`` keeps the first row (in input order) of every content hash.  It never puts a
whole hash group into one task: the first id per hash is a ``min`` aggregate (partial,
map-side), and the rows are then matched on their *unique* order key, so a hash that holds a
third of all rows costs no more than any other.

Order of the rules follows the reference: the duplicate test comes first, then the size rule on
the remaining first copies (so a discarded first copy still removes its later copies).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capset.functions.geometry import fit_size, size_action


def first_per_hash(df: DataFrame, hash_col: str, order: str) -> DataFrame:
    """``(hash, first order value)`` per distinct hash."""
    return df.groupBy(hash_col).agg(F.min(order).alias(order))


def flag_duplicates(df: DataFrame, hash_col: str, order: str, name: str = "is_duplicate") -> DataFrame:
    """All rows, with ``is_duplicate = true`` for every copy after the first (by ``order``)."""
    firsts = first_per_hash(df, hash_col, order).select(F.col(order), F.lit(True).alias("_first"))
    return df.join(firsts, order, "left") \
             .withColumn(name, F.col("_first").isNull()).drop("_first")


def dedup_content(df: DataFrame, content: str | None = None, order: str = "row_id",
                  hash_col: str = "md5") -> DataFrame:
    """Rows that are the first copy of their content (``md5`` computed from ``content`` if given)."""
    if content is not None:
        df = df.withColumn(hash_col, F.md5(F.col(content)))
    firsts = first_per_hash(df, hash_col, order).select(order)
    return df.join(firsts, order, "left_semi")


def apply_size_rule(df: DataFrame, w: str = "width", h: str = "height", min_side: int = 192,
                    max_side: int = 320) -> DataFrame:
    """Adds ``action`` (keep / resize / discard) and the target size of resized rows."""
    act = size_action(w, h, min_side, max_side)
    new = fit_size(w, h, max_side, max_side)
    return (df.withColumn("action", act)
              .withColumn("new_width", F.when(F.col("action") == "resize", new["new_w"]).otherwise(F.col(w)))
              .withColumn("new_height", F.when(F.col("action") == "resize", new["new_h"]).otherwise(F.col(h))))


def run_report(flagged: DataFrame, duplicate: str = "is_duplicate", action: str = "action") -> DataFrame:
    """One row: total, duplicates, discarded, to_resize, remaining (a single aggregate)."""
    dup = F.col(duplicate)
    return flagged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(dup).cast("long").alias("duplicates"),
        F.count_if(~dup & (F.col(action) == "discard")).cast("long").alias("discarded"),
        F.count_if(~dup & (F.col(action) == "resize")).cast("long").alias("to_resize"),
    ).withColumn("remaining", F.col("total") - F.col("duplicates") - F.col("discarded"))
