"""Connected components by alternating large-star and small-star.

Every star is written to the checkpoint folder before the next reads it: the next one's plan holds its input
twice, so plans of two stars and more would grow by powers of two, and with them what the driver plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capset.llm.common import with_group_values

MAX_ROUNDS = 60


def _with_least(pairs: DataFrame) -> DataFrame:
    """``u, v`` to ``u, v, m``: ``m`` is the smallest of ``u`` and all its ``v``; hot ``u`` are salted."""
    got = with_group_values(pairs, ["u"], F.col("v"), {"_m": F.min("v")}, {"_m": F.min("_m")})
    return got.select("u", "v", F.least("u", "_m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or itself)."""
    both = edges.select(F.explode(F.array(
        F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("_e")).select("_e.u", "_e.v")
    return _with_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .where(F.col("u") != F.col("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    got = _with_least(down)
    return got.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")) \
        .where(F.col("u") != F.col("v")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether links to smaller nodes are stars: a node has one such link at most, and none if a link leads to it."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("_e")).select("_e.*")
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``u, v`` (links, in any direction) to ``node, component``: the smallest node reachable.

    Only nodes with a link come back, each once.  Links to itself, repeated links, both directions and
    links with a null are fine (the latter and self links say nothing).  Every star is written to the
    checkpoint folder, so lost executors cost one at most.
    """
    both = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u != v")
    now = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    for _ in range(MAX_ROUNDS):
        if _settled(now):
            break
        now = _small_star(_large_star(now).checkpoint()).checkpoint()
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    member = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return member.union(now.select("v").distinct().select(F.col("v"), F.col("v")))
