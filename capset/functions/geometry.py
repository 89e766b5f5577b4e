"""Image geometry as Column expressions (no pixels are touched here)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else F.lit(c) if isinstance(c, (int, float)) else c


def cover_scale(w, h, box_w, box_h) -> Column:
    """Scale factor that makes the image cover the box: ``max(W / w, H / h)`` in double; null if the
    image has no area."""
    w, h = _c(w), _c(h)
    return F.when((w > 0) & (h > 0), F.greatest(F.try_divide(_c(box_w).cast("double"), w), F.try_divide(_c(box_h).cast("double"), h)))


def fit_size(w, h, box_w, box_h) -> Column:
    """``struct(new_w, new_h)`` with truncation toward zero, as Python's ``int``."""
    a = cover_scale(w, h, box_w, box_h)
    return F.struct((_c(w) * a).cast("int").alias("new_w"), (_c(h) * a).cast("int").alias("new_h"))


def size_action(w, h, min_side: int, max_side: int) -> Column:
    """``discard`` when both sides are below ``min_side`` or one is unknown or not positive; ``resize`` when
    a side is above ``max_side``; ``keep`` otherwise (the discard test wins)."""
    w, h = _c(w), _c(h)
    known = F.coalesce((w > 0) & (h > 0), F.lit(False))
    return (F.when(~known | ((w < min_side) & (h < min_side)), F.lit("discard"))
            .when((w > max_side) | (h > max_side), F.lit("resize"))
            .otherwise(F.lit("keep")))
