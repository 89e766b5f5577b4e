"""Vector arithmetic on ``array<float>`` columns with higher-order functions (JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    sq = F.transform(_c(a), lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, x: acc + x))


def cosine(a, b, eps: float = 1e-8) -> Column:
    """Cosine similarity; a zero vector gives 0 instead of a division by zero."""
    den = norm(a) * norm(b)
    return F.when(den > eps, dot(a, b) / den).otherwise(F.lit(0.0))


def logit(a, b, scale: float = 100.0) -> Column:
    """Scaled cosine, the logit an image/text model compares."""
    return cosine(a, b) * F.lit(scale)
