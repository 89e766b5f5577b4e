"""Mixing sources to target weights by Sainte-Laguë apportionment.

All words of the corpus are dealt as equal blocks of ``block_words`` words.  The blocks go to the
sources by highest quotients (target / (2 s + 1)), a source's blocks to its groups of shards and
a group's to its shards in the same way (by their words), so every shard gets an integer quota.
A shard is a hash bucket of about ``shard_words`` words, so shards grow in number, not in size, and
a source with a third of all words is many shards.  Inside a shard the documents stand in seeded
order; the quota is met by whole passes over the shard and, for the rest, by the blocks that follow a
seeded one, around the shard's end.  So the mix takes whole documents, but for two a shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Words of a block, at most: a small corpus is cut into ``MIN_BLOCKS`` blocks.
BLOCK_WORDS, MIN_BLOCKS = 16, 1 << 16
SHARD_WORDS = 1 << 16
#: Shards of a source are apportioned in groups of about this many.
GROUP_SHARDS = 1 << 10
MAX_REPEATS = 3


def word_count(text: Column) -> Column:
    """Number of runs of characters other than blank and U+0009 to U+000D; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def sainte_lague(votes: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by the highest quotients votes / (2 s + 1); nobody gets more than their cap.

    Equal quotients go to the earlier entry.  Fewer seats are given only if the caps end first.
    """
    votes, caps = votes.astype(float), caps.astype(np.int64)
    caps = np.where(votes > 0, caps, 0)
    seats = int(min(seats, caps.sum()))
    if seats <= 0:
        return np.zeros(len(votes), np.int64)

    def at(divisor: float) -> np.ndarray:
        """Seats whose quotient is above the divisor: votes / (2 s + 1) > divisor."""
        return np.minimum(caps, np.maximum(0, np.ceil((votes / divisor - 1) / 2))).astype(np.int64)

    low, high = 0.0, votes.max()  # at(high) gives none
    low = votes[votes > 0].min() / (2.0 * seats + 2 * caps.max() + 3)  # at(low) gives all caps
    for _ in range(200):
        mid = (low + high) / 2
        if mid <= low or mid >= high:
            break
        if at(mid).sum() <= seats:
            high = mid
        else:
            low = mid
    got = at(high)
    while (rest := seats - int(got.sum())) > 0:  # ties at the divisor
        quotient = np.where(got < caps, votes / (2 * got + 1), -1.0)
        best = np.argsort(-quotient, kind="stable")
        got[best[:1] if quotient[best[0]] > quotient[best[min(rest, len(best)) - 1]] else best[:rest]] += 1
    return got


def _apportion(df: pd.DataFrame) -> pd.DataFrame:
    """For applyInPandas: a parent's ``_seats`` to its children by ``_votes`` up to ``_cap``."""
    df = df.sort_values("_order", kind="stable")
    df["_quota"] = sainte_lague(df["_votes"].to_numpy(), int(df["_seats"].iloc[0]), df["_cap"].to_numpy())
    return df


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size`` to ``target`` and ``weight``.

    Sources by code point, null last, weigh 1, 2, 3, repeating.  Targets are shares of all words by
    weight that stop at 3 times their source's words; the excess is shared by weight among the rest.
    """
    one = Window.orderBy(F.col("_source").isNull(), F.col("_source"))
    w = sizes.withColumn("_weight", (F.pmod(F.row_number().over(one) - 1, F.lit(3)) + 1).cast("double"))
    w = w.withColumn("_limit", (MAX_REPEATS * F.col("source_size")).cast("double"))
    # sources fill up in the order of limit / weight: those are full whose limit is below the
    # share that is left for them once all before them are full
    order = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("_source").isNull(), F.col("_source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    w = w.withColumns({
        "_left": F.sum("source_size").over(every) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)),
        "_rest": F.sum("_weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    w = w.withColumn("_full", F.col("_limit") * F.col("_rest") <= F.col("_left") * F.col("_weight"))
    w = w.withColumns({
        "_open": F.sum("source_size").over(every)
        - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_limit"))).over(every), F.lit(0.0)),
        "_weights": F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(every),
    })
    return w.select("_source", "source_size", "_weight", F.when(F.col("_full"), F.col("_limit")).otherwise(
        F.col("_open") * F.col("_weight") / F.col("_weights")).alias("target"))


def _chosen(start: Column, end: Column, words: Column, rest: Column, first: Column) -> Column:
    """How many of a document's words [start, end) are among the ``rest`` words from ``first`` on, around the end."""
    def shared(a: Column, b: Column) -> Column:
        return F.greatest(F.least(end, b) - F.greatest(start, a), F.lit(0).cast("long"))

    return shared(first, F.least(first + rest, words)) + shared(F.lit(0).cast("long"), first + rest - words)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = 17, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken, shard, quota``.

    ``taken`` is the number of the document's words in the mix, repeats counted, between 0 and 3
    times its size.  A null or empty text has size 0 and takes 0; a null source is a source of its
    own, ordered last.  Repeated rows are documents of their own.  The result depends on the
    rows alone, not on their order or partitions.  An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"),
                       word_count(F.col(text_col)).alias("size"))
    sizes = rows.groupBy("_source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes).withColumn(
        "_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"))
    # quotas of sources
    total = F.sum("source_size").over(Window.partitionBy())
    share = targets.withColumn("_block", F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(total / MIN_BLOCKS))).cast("long")) \
        .select("_source", "source_size", "target", "_shards", "_block", F.col("target").alias("_votes"),
                F.floor(MAX_REPEATS * F.col("source_size") / F.col("_block")).cast("long").alias("_cap"),
                F.coalesce(F.col("_source"), F.lit("\U0010ffff")).alias("_order"),
                F.floor(total / F.col("_block")).alias("_seats"), F.lit(0).alias("_all"))
    kind = "_source string, source_size long, target double, _shards long, _block long, _votes double, _cap long, " \
           "_order string, _seats long, _all int, _quota long"
    sources = share.groupBy("_all").applyInPandas(_apportion, kind).select(
        "_source", "source_size", "target", "_shards", "_block", F.col("_quota").alias("_source_quota"))
    # as many rows as sources: what each document needs of them is joined by source, in salts
    spread = F.lit(256)
    salted = sources.withColumn("_salt", F.explode(F.sequence(F.lit(0), spread - 1)))
    # nulls don't join
    named = rows.withColumns({"_name": _name(F.col("_source")), "_salt": F.pmod(F.xxhash64("_id"), spread).cast("int")})
    named = named.join(salted.select(_name(F.col("_source")).alias("_name"), "_salt", "source_size", "target", "_shards", "_block",
                                     "_source_quota"), ["_name", "_salt"]).withColumn(
        "shard", F.pmod(F.xxhash64("_id", F.lit(seed)), F.col("_shards"))).withColumn(
        "_group", F.floor(F.col("shard") / GROUP_SHARDS))
    shards = named.groupBy("_name", "_group", "shard").agg(
        F.sum("size").alias("_words"), F.first("_source_quota").alias("_source_quota"), F.first("_block").alias("_block"))
    groups = shards.groupBy("_name", "_group").agg(
        F.sum("_words").cast("double").alias("_votes"), F.first("_source_quota").alias("_seats"), F.first("_block").alias("_block"))
    groups = groups.select("_name", "_group", "_votes", "_seats", _cap("_votes").alias("_cap"), F.col("_group").alias("_order"))
    groups = groups.groupBy("_name").applyInPandas(
        _apportion, "_name string, _group long, _votes double, _seats long, _cap long, _order long, _quota long"
    ).select("_name", "_group", F.col("_quota").alias("_seats"))
    quotas = shards.join(groups, ["_name", "_group"]).select(
        "_name", "_group", "shard", F.col("_words").cast("double").alias("_votes"), "_seats",
        _cap("_words").alias("_cap"), F.col("shard").alias("_order"))
    quotas = quotas.groupBy("_name", "_group").applyInPandas(
        _apportion,
        "_name string, _group long, shard long, _votes double, _seats long, _cap long, _order long, _quota long"
    ).select("_name", "shard", F.col("_votes").cast("long").alias("_words"), F.col("_quota").alias("quota"))
    placed = named.join(quotas, ["_name", "shard"])
    order = Window.partitionBy("_name", "shard").orderBy(F.xxhash64("_id", F.lit(seed + 1)), "_id", "size")
    placed = placed.withColumn("_end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    want = F.least(F.col("quota") * F.col("_block"), F.col("_words") * MAX_REPEATS)
    placed = placed.withColumns({"_want": want, "_start": F.col("_end") - F.col("size")})
    words = F.greatest(F.col("_words"), F.lit(1).cast("long"))
    h = F.xxhash64("_name", "shard", F.lit(seed + 2))
    passes = F.floor(F.col("_want") / words)
    first = F.pmod(h, F.greatest(F.floor(F.col("_words") / F.col("_block")), F.lit(1).cast("long"))) * F.col("_block")
    taken = passes * F.col("size") + _chosen(F.col("_start"), F.col("_end"), F.col("_words"), F.col("_want") - passes * words, first)
    return placed.select(
        F.col("_id").alias("doc_id"), F.when(F.col("_name") != "n", F.substring(F.col("_name"), 2, 1 << 30)).alias("source"),
        "size", "source_size", "target", taken.cast("long").alias("taken"), "shard", "quota")


def _cap(words: str) -> Column:
    """Blocks that a part may get: those of three times its words, a started one with them."""
    return F.floor(MAX_REPEATS * F.col(words) / F.col("_block") + 1).cast("long")


def _name(source: Column) -> Column:
    """A key that is never null: null is ``n``, a name begins with ``s``."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))
