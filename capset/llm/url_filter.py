"""URL rules by a sort-merge range join.

A host is written with its labels reversed, each followed by a dot (``www.example.com`` becomes
``com.example.www.``).  The subdomains of a rule's host are then one interval of the sorted
keys, and intervals of different rules are nested or apart.  Pages and rules are dealt to key ranges
(a rule goes to each range that it meets), sorted inside, and swept once with a stack of the
rules whose interval holds the current key.

Ranges are cut from a bounded sample of keys that end in the page's id hash, so a host with a third
of all pages is cut into many ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capset.llm.common import ascii_lower

#: Keys in the sample that cuts the ranges; what the driver gets is bounded by it.
SAMPLE_KEYS = 20_000
#: Sorts after every key that begins with a rule's reversed host.
_LAST = "\U0010ffff"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.concat_ws("", F.transform(F.reverse(F.split(host, r"\.", -1)), lambda x: F.concat(x, F.lit("."))))


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by range, key and kind (rules first); the stack outlives the batches."""
    stack: list[tuple[str, str, str, str]] = []  # reversed host, path, rule, verdict
    at = None
    for df in batches:
        names, verdicts, keep = [], [], []
        for i, (part, key, is_page, path, rule, verdict) in enumerate(
                zip(df["_part"], df["_key"], df["_page"], df["path"], df["rule"], df["verdict"], strict=True)):
            if part != at:
                stack, at = [], part
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_page:
                stack.append((key, path, rule, verdict))
                continue
            fits = [r for r in stack if path.startswith(r[1])]
            best = max(fits, key=lambda r: (len(r[2]), r[2], r[3]), default=(None, None, None, "allow"))
            keep.append(i)
            names.append(best[2])
            verdicts.append(best[3])
        if keep:  # a batch may hold nothing but rules
            out = df.iloc[keep].drop(columns=["_part", "_key", "_page"])
            yield out.assign(rule=names, verdict=verdicts)


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict``.  A rule fits its host and all subdomains if the page's
    path starts with the rule's; the longest rule (host and path) wins, of equal ones the last by
    name and verdict (so ``block`` beats ``allow``).  Pages that no rule fits get ``default`` and a
    null rule.  A null url, or one without ``://``, has an empty host and path; only a rule with
    an empty host fits it.  Repeated pages each get a row; repeated rules change nothing.
    Rows of ``rules`` with a null are ignored.  Either table may be empty.
    """
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType
    # ids travel as text: pandas would make floats of a column of integers with nulls
    keyed = pages.select(F.col(id_col).cast("string").alias("_id"), F.col(url_col).alias("_url")).select(
        "_id", url_host(F.col("_url")).alias("host"), url_path(F.col("_url")).alias("path")
    ).withColumn("_key", reversed_host(F.col("host")))
    deal = F.concat(F.col("_key"), F.lit("\u0000"), F.hex(F.xxhash64("_id")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = pages.select(F.count(F.lit(1))).first()[0]
    share = min(1.0, SAMPLE_KEYS / 2 / max(n, 1))
    sample = sorted(r[0] for r in keyed.where(F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(1 << 30)) < share * (1 << 30))
                    .select(deal).limit(SAMPLE_KEYS).collect())
    cuts = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        # Python compares by code point, as the UTF-8 order of Spark's sort does
        return pd.Series(np.searchsorted(np.array(cuts, dtype=object), key.to_numpy(dtype=object), side="right"),
                         dtype="int32")

    bounds = rules.select("host", "path", "verdict").dropna().distinct().select(
        reversed_host(ascii_lower(F.col("host"))).alias("_key"), F.col("path"),
        F.concat("host", "path").alias("rule"), "verdict",
    )
    # a range is met if it starts before the interval ends and ends after it begins
    dealt_rules = bounds.withColumn("_part", F.explode(F.sequence(
        part_of(F.col("_key")), part_of(F.concat(F.col("_key"), F.lit(_LAST)))))).select(
        "_part", "_key", F.lit(False).alias("_page"), F.lit(None).cast("string").alias("_id"),
        F.lit(None).cast("string").alias("host"), "path", "rule", "verdict")
    dealt_pages = keyed.withColumn("_part", part_of(deal)).select(
        "_part", "_key", F.lit(True).alias("_page"), "_id", "host", "path",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    rows = dealt_rules.unionByName(dealt_pages).repartition(parts, "_part").sortWithinPartitions(
        "_part", "_key", "_page", "path", "verdict")
    swept = rows.mapInPandas(_sweep, "_id string, host string, path string, rule string, verdict string")
    return swept.select(F.col("_id").cast(kind).alias("page_id"), "host", "path", "rule",
                        F.when(F.col("rule").isNull(), F.lit(default)).otherwise(F.col("verdict")).alias("verdict"))
