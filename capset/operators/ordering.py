"""Seeded shuffles and sorted output.

``seeded_shuffle`` is a global sort on a seeded hash (range partitioning, sorted runs per
task), the distributed form of "shuffle the index list".  ``buffer_shuffle`` reproduces a
shuffle buffer of ``size`` rows: order is only mixed inside consecutive blocks, so the window
is partitioned by block and holds ``size`` rows at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capset.functions.hashing import seeded_md5, seeded_unit


def seeded_shuffle(df: DataFrame, key: str, seed: int = 0, name: str = "shuffle_key") -> DataFrame:
    return df.withColumn(name, seeded_md5(key, seed)).orderBy(name)


def fast_shuffle(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Same idea with ``xxhash64`` (cheaper than md5; not reproducible outside Spark)."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)))


def buffer_shuffle(df: DataFrame, key: str, position: str, size: int = 8, seed: int = 0) -> DataFrame:
    """``block = position div size``; inside a block rows are ordered by a seeded hash."""
    blk = F.floor(F.col(position) / F.lit(size))
    w = Window.partitionBy("block").orderBy(seeded_md5(key, seed), F.col(position))
    return df.withColumn("block", blk).withColumn("pos_in_block", F.row_number().over(w) - 1)


def sorted_within(df: DataFrame, *cols) -> DataFrame:
    """Sorted inside each partition only (no global sort), e.g. before a per-partition write."""
    return df.sortWithinPartitions(*cols)


def weighted_interleave(df: DataFrame, file: str, index: str, weights: dict[str, float] | None = None, seed: int = 0,
                        name: str = "turn") -> DataFrame:
    """Mix the records of several files by weight: sorted by ``name``, record ``k`` of a file comes at ``(k + u) / weight``.

    ``u`` is a seeded draw in [0, 1) of file and place, so at each time as many records of a file have come as its weight says,
    to within one, until it ends; nothing is repeated or left out, and reruns agree.  Files without a weight (all, if ``weights`` is
    None: equal weights) weigh 1.  The turn needs no other row, so the sort (by ranges) is the only shuffle.
    """
    if any(w <= 0 for w in (weights or {}).values()):
        raise ValueError("weights must be positive")
    weight = F.lit(1.0)
    for f, w in (weights or {}).items():
        weight = F.when(F.col(file) == f, F.lit(float(w))).otherwise(weight)
    u = seeded_unit(F.concat_ws(":", F.col(file), F.col(index).cast("string")), seed)
    return df.withColumn(name, (F.col(index) + u) / weight).orderBy(name, file, index)
