"""SHA-256 of texts that are joined in order, without joining them.

The rows of a key are sorted by Spark (on disk where they are many) and hashed one after the other, so a key of any
size needs the memory of one batch.  A hash of one text can't be split: a key's rows pass one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame

EMPTY = hashlib.sha256(b"").hexdigest()


def ordered_sha256(rows: DataFrame, key: Column, order: list[str], text: Column, separator: str) -> DataFrame:
    """``_key`` (as text), ``sha256`` of its rows' ``text`` in ``order``, ``separator`` between; a null key is one too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state, sep = (), hashlib.sha256(), separator.encode()
        for df in batches:
            keys, digests = [], []
            for k, t in zip(df["_key"], df["_text"], strict=True):
                if at != (k,):
                    if at:
                        keys.append(at[0])
                        digests.append(state.hexdigest())
                    at, state = (k,), hashlib.sha256()
                else:
                    state.update(sep)
                state.update(t.encode("utf-8", "surrogatepass"))
            if keys:
                yield pd.DataFrame({"_key": pd.Series(keys, dtype=object), "sha256": digests})
        if at:
            yield pd.DataFrame({"_key": pd.Series([at[0]], dtype=object), "sha256": [state.hexdigest()]})

    dealt = rows.select(key.cast("string").alias("_key"), *order, text.alias("_text")).repartition("_key")
    return dealt.sortWithinPartitions("_key", *order).select("_key", "_text").mapInPandas(run, "_key string, sha256 string")
