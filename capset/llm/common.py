"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capset.session import ensure_checkpoint_dir, ship_package

#: Salts of a hot key: a key that holds a third of all rows leaves 0.5 % of them in one salt.
SALTS = 64
#: The white space of the contracts: blank and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder of the session and the package for Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def held_out(doc_id: Column) -> Column:
    """The fold that no model may learn from: crc32 of the id as text, divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def salt_of(c: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(salts)).cast("int")


def salt_bit(salt: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), salt)


def salts_in(mask: Column, salts: int = SALTS) -> Column:
    """The salts whose bits are set: at most ``salts`` values."""
    return F.filter(
        F.array(*[F.lit(i) for i in range(salts)]),
        lambda i: F.call_function("shiftrightunsigned", mask, i).bitwiseAND(F.lit(1).cast("long")) == 1,
    )


def with_group_values(df: DataFrame, keys: list[str], spread: Column, partial: dict[str, Column],
                      final: dict[str, Column]) -> DataFrame:
    """Attach aggregates of each row's group, safely for keys that hold a large share of all rows.

    Rows are aggregated by key and salt (with a map-side combine), the at most 64 rows of a key
    are combined, and the result goes back to the rows by key and salt.  No task gets all rows of
    a key.  ``spread`` is the column whose hash gives the salt; ``partial`` are the aggregates by
    key and salt, ``final`` those over the partial ones.  Keys must not be null.
    """
    salted = df.withColumn("_salt", salt_of(spread))
    part = salted.groupBy(*keys, "_salt").agg(*[c.alias(n) for n, c in partial.items()])
    whole = part.groupBy(*keys).agg(
        *[c.alias(n) for n, c in final.items()], F.bit_or(salt_bit(F.col("_salt"))).alias("_mask")
    )
    back = whole.withColumn("_salt", F.explode(salts_in(F.col("_mask")))).drop("_mask")
    return salted.join(back, [*keys, "_salt"]).drop("_salt")
