"""Exact dedup by skew-safe combining.

Stages, all of which compare whole texts (the text is part of every grouping key):

1. local: the map-side half of the aggregation keeps one row per text and task;
2. salted: rows of a digest meet in groups; a digest that holds more than a thousandth of all rows (so there
   are fewer than a thousand of them) is dealt to 64 salted groups;
3. global: the winners of the salts, at most 64 a text, meet by digest.  What had one salt is done.

The winner goes back to every row by digest, salt and a second fingerprint of the text (64 more
bits and the length), so that a join key has 1/64 of a hot text's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capset.llm.common import SPACE, salt_bit, salt_of, salts_in


def normalised(text: Column) -> Column:
    """Null counts as empty; each run of blanks and U+0009 to U+000D becomes one blank."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal normalised texts the smallest id stays.  Null texts equal empty ones.  Rows that repeat
    an id and its text are counted in ``group_size`` each and all come back, all kept if the id is
    the smallest; a null id never stays unless every id of its group is null (``keep_id`` null).
    An empty table gives an empty result.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text")).select(
        "_id", "_text", digest(F.col("_text")).alias("_digest"))
    narrow = rows.select("_id", "_digest", F.xxhash64("_text").alias("_x"), F.length("_text").alias("_len")).checkpoint()
    hot = _hot_digests(narrow)
    salt = F.when(F.col("_digest").isin(hot), salt_of(F.col("_id"))).otherwise(0)
    salted = rows.withColumn("_salt", salt).groupBy("_digest", "_salt", "_text").agg(
        F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    key = ["_digest", F.xxhash64("_text").alias("_x"), F.length("_text").alias("_len"), "keep_id", "group_size"]
    done = salted.where(~F.col("_digest").isin(hot)).select(*key, F.lit(0).alias("_salt"))
    winners = salted.where(F.col("_digest").isin(hot)).groupBy("_digest", "_text").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
        F.bit_or(salt_bit(F.col("_salt"))).alias("_mask")).select(*key, F.explode(salts_in(F.col("_mask"))).alias("_salt"))
    return narrow.withColumn("_salt", salt).join(done.union(winners), ["_digest", "_salt", "_x", "_len"]).select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size",
        F.coalesce(F.col("_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def _hot_digests(narrow: DataFrame, share: int = 1000) -> list[str]:
    """Digests with more than 1/``share`` of all rows: fewer than ``share`` of them, whatever the table."""
    total = narrow.count()
    return [r[0] for r in narrow.groupBy("_digest").count().where(F.col("count") * share > total).select("_digest").collect()]


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another row of smaller id has; all columns are kept.

    Rows that repeat an id and its text leave one row (any of them, if other columns differ).  A null id
    goes if another row has the text; of texts that only rows without an id have, one row stays.
    """
    kept = exact_groups(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("_keep"), "text_sha256").checkpoint()
    if docs.groupBy(id_col).count().where(F.col("count") > 1).isEmpty() and kept.where("_keep is null").isEmpty():
        return docs.join(kept, docs[id_col] == kept["_keep"], "left_semi")
    mark = sha256(normalised(F.col(text_col)))
    tagged = docs.withColumn("_capset_digest", mark)
    winners = kept.distinct()
    return tagged.join(winners, tagged[id_col].eqNullSafe(winners["_keep"])
                       & (tagged["_capset_digest"] == winners["text_sha256"]), "left_semi").withColumn(
        "_capset_id", F.col(id_col)).dropDuplicates(["_capset_id", "_capset_digest"]).drop("_capset_id", "_capset_digest")

