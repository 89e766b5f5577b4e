"""Token counts by a linear longest-match automaton.

The vocabulary is a trie with a failure link and a count for each node: what the greedy longest-match
segmentation would pop off the node's string before it goes on at the link's node.  A text is
read once, each character costs constant time on average, and no piece is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capset.llm.vocabulary import Vocabulary

_CACHE = 1_000_000  # units whose counts a worker keeps


class Automaton:
    """Greedy longest-match lengths.  A character without a piece of its own counts its bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.child: list[dict[str, int]] = [{}]
        weight: list[int] = [0]  # of a node that is a piece
        for piece in [*vocabulary.pieces, *vocabulary.chars]:
            node = 0
            for c in piece:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    weight.append(0)
                node = self.child[node][c]
            if not weight[node]:
                weight[node] = 1 if piece in vocabulary.pieces else len(piece.encode("utf-8", "surrogatepass"))
        self.link, self.pops = [0] * len(self.child), [0] * len(self.child)
        layer = [0]
        while layer:  # by length, since links are shorter
            after = []
            for node in layer:
                for c, down in self.child[node].items():
                    after.append(down)
                    if weight[down]:
                        self.pops[down] = weight[down]
                        continue
                    popped, at = self.pops[node], self.link[node]
                    while c not in self.child[at]:  # single characters are pieces, so the root has it
                        popped, at = popped + self.pops[at], self.link[at]
                    self.pops[down], self.link[down] = popped, self.child[at][c]
            layer = after

    def count(self, text: str) -> int:
        child, link, pops, node, n = self.child, self.link, self.pops, 0, 0
        for c in text:
            while c not in child[node]:
                if not node:
                    n += len(c.encode("utf-8", "surrogatepass"))
                    break
                n, node = n + pops[node], link[node]
            else:
                node = child[node][c]
        while node:
            n, node = n + pops[node], link[node]
        return n


class _Counts(dict):
    def __init__(self, automaton: Automaton):
        self.count = automaton.count

    def __missing__(self, unit: str) -> int:
        self[unit] = n = self.count(unit)
        return n


def token_counts(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, n_tokens, n_units`` of the whole text.

    ``n_tokens`` is the length of the greedy longest-match segmentation, ``n_units`` the number of words
    and line ends it falls into.  Null and empty texts have none.  Repeated rows each get a row; null
    ids stay null; other columns are not read; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = shared.value
        counts = _Counts(Automaton(vocab))
        for df in batches:
            tokens, units = [], []
            for text in df["text"]:
                if len(counts) > _CACHE:
                    counts.clear()
                own = vocab.units(text)
                units.append(len(own))
                tokens.append(sum(map(counts.__getitem__, own)))
            yield pd.DataFrame({"_id": df["_id"], "n_tokens": tokens, "n_units": units})

    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "_id string, n_tokens long, n_units long").select(
        F.col("_id").cast(kind).alias("doc_id"), "n_tokens", "n_units")
