"""Vocabulary queries over the whole ``documents`` corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from capset.functions.text import WS
from capset.operators import vocab as V
from capset.plans import sqltext as S
from capset.plans.registry import load, register

COVERAGE = 0.9999
NUM_MERGES = 32
#: Entries of a whole vocabulary: the kept characters and as many merges as are left.
VOCAB_SIZE = 4096

_WORDS_SQL = f"list_filter(regexp_split_to_array(text, {S.q(WS + '+')}), lambda w: length(w) > 0)"


@register("word_split", oracle=f"""
WITH w AS (SELECT doc_id, {_WORDS_SQL} AS words FROM documents)
SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words, md5(array_to_string(words, ' ')) AS words_md5 FROM w
""")
def word_split(spark, sf):
    d = V.word_split(load(spark, sf, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.size("words").alias("n_words"),
                    F.md5(F.array_join("words", " ")).alias("words_md5"))


@register("word_freq", oracle=f"""
SELECT word, count(*) AS freq FROM (SELECT unnest({_WORDS_SQL}) AS word FROM documents) GROUP BY word
""")
def word_freq(spark, sf):
    return V.word_freq(load(spark, sf, "documents").select("text"))


@register("char_coverage", oracle=f"""
WITH c AS (SELECT ch AS char, count(*) AS n
           FROM (SELECT unnest(regexp_extract_all(text, '(?s).')) AS ch FROM documents) GROUP BY ch),
t AS (SELECT sum(n) AS total FROM c)
SELECT char, n, coalesce(sum(n) OVER (ORDER BY n DESC, char ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                < {COVERAGE} * (SELECT total FROM t) AS kept
FROM c
""")
def char_coverage(spark, sf):
    return V.alphabet(load(spark, sf, "documents").select("text"), coverage=COVERAGE)


def _bpe_sql() -> str:
    """The rounds written out: count pairs, take the best, replace it in every word."""
    sep = "chr(1)"
    parts = [f"""WITH words AS (SELECT word, count(*) AS freq FROM (SELECT unnest({_WORDS_SQL}) AS word FROM documents) GROUP BY word),
w0 AS MATERIALIZED (SELECT {sep} || array_to_string(regexp_extract_all(replace(word, {sep}, ''), '(?s).'), {sep} || {sep}) || {sep} AS w, freq
  FROM words WHERE length(replace(word, {sep}, '')) > 1)"""]
    for k in range(NUM_MERGES):
        parts.append(f"""m{k} AS MATERIALIZED (SELECT l, r, CAST(sum(freq) AS BIGINT) AS freq FROM (
  SELECT unnest(s[:-2]) AS l, unnest(s[2:]) AS r, freq FROM (
    SELECT string_split(substr(w, 2, length(w) - 2), {sep} || {sep}) AS s, freq FROM w{k}) WHERE len(s) > 1)
  GROUP BY l, r ORDER BY freq DESC, l, r LIMIT 1),
w{k + 1} AS MATERIALIZED (SELECT replace(w, {sep} || l || {sep} || {sep} || r || {sep}, {sep} || l || r || {sep}) AS w, w{k}.freq FROM w{k}, m{k})""")
    rows = " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS rank, l AS \"left\", r AS \"right\", freq FROM m{k}" for k in range(NUM_MERGES))
    return ",\n".join(parts) + "\n" + rows


@register("bpe_merges", oracle=_bpe_sql())
def bpe_merges(spark, sf):
    wf = V.word_freq(load(spark, sf, "documents").select("text"))
    return V.bpe_merges(wf, NUM_MERGES)


@register("bpe_vocabulary")
def bpe_vocabulary(spark, sf):
    """All merges of a vocabulary of 4,096 entries, as ``jobs.vocabulary_from_shards`` learns them.

    SQL would go through some 4,000 rounds over all words; tests hold it against a plain BPE instead."""
    d = load(spark, sf, "documents").select("text")
    kept = V.alphabet(d, coverage=COVERAGE).where("kept").count()
    return V.bpe_merges(V.word_freq(d), max(0, VOCAB_SIZE - kept))
