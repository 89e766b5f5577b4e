"""Deterministic, seedable hashes that DuckDB can reproduce (md5 based)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seeded_md5(key, seed) -> Column:
    return F.md5(F.concat(_c(key).cast("string"), F.lit(str(seed))))


def seeded_bucket(key, seed, n: int) -> Column:
    """``int(md5(key || seed)[:8], 16) % n`` as bigint: a reproducible random choice in [0, n)."""
    head = F.substring(seeded_md5(key, seed), 1, 8)
    return (F.conv(head, 16, 10).cast("long") % F.lit(n)).cast("long")


def seeded_unit(key, seed) -> Column:
    """A reproducible draw in [0, 1) from the first 8 hex digits of the seeded md5."""
    head = F.substring(seeded_md5(key, seed), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(16 ** 8))


def content_md5(c) -> Column:
    return F.md5(_c(c))
