"""Shard packing, seeded shuffles and HTML unescape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from capset.functions import text as T
from capset.operators import ordering as O
from capset.operators import rows as R
from capset.plans import sqltext as S
from capset.plans.registry import load, register

MAXSIZE = 200_000      # scaled shard bounds (the reference: 1e9 bytes / 100,000 samples)
MAXCOUNT = 64
SEED = 42
BUFFER = 8


@register("shard_pack", oracle=f"""
WITH r AS (
  SELECT doc_id,
         coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         row_number() OVER (ORDER BY doc_id) - 1 AS rn
  FROM documents)
SELECT doc_id, CAST(dense_rank() OVER (ORDER BY floor(before / {MAXSIZE}), rn // {MAXCOUNT}) - 1 AS BIGINT) AS shard
FROM r
""")
def shard_pack(spark, sf):
    d = R.with_row_id(load(spark, sf, "documents").select("doc_id", "n_chars"))
    return R.shard_numbers(d, "n_chars", MAXSIZE, MAXCOUNT).select("doc_id", "shard")


@register("seeded_shuffle", oracle=f"""
SELECT doc_id, {S.seeded_md5('doc_id', SEED)} AS shuffle_key,
       row_number() OVER (ORDER BY {S.seeded_md5('doc_id', SEED)}) - 1 AS position
FROM documents
""")
def seeded_shuffle(spark, sf):
    d = O.seeded_shuffle(load(spark, sf, "documents").select("doc_id"), "doc_id", SEED)
    return R.dense_positions(d).select("doc_id", "shuffle_key", "position")


@register("buffer_shuffle", oracle=f"""
SELECT doc_id, CAST(doc_id // {BUFFER} AS BIGINT) AS block,
       row_number() OVER (PARTITION BY doc_id // {BUFFER} ORDER BY {S.seeded_md5('doc_id', SEED)}, doc_id) - 1
         AS pos_in_block
FROM documents
""")
def buffer_shuffle(spark, sf):
    d = R.with_row_id(load(spark, sf, "documents").select("doc_id"))
    return O.buffer_shuffle(d, "doc_id", "row_id", BUFFER, SEED) \
            .select("doc_id", F.col("block").cast("long").alias("block"),
                    F.col("pos_in_block").cast("long").alias("pos_in_block"))


def _unescape_sql() -> str:
    """Character references by the rules of HTML 5: the names and replacements are the standard library's."""
    import html
    from html.entities import html5

    names = ", ".join(f"({S.q(k)}, {S.q(v)})" for k, v in sorted(html5.items()))
    odd = ", ".join(f"({k}, {S.q(v)})" for k, v in sorted(html._invalid_charrefs.items()) if k)
    gone = ", ".join(map(str, sorted(html._invalid_codepoints)))
    return f"""
WITH names(name, value) AS (VALUES {names}),
odd(code, value) AS (VALUES {odd}),
parts AS (SELECT page_id, unnest(string_split(html, '&')) AS p, generate_subscripts(string_split(html, '&'), 1) AS i FROM pages),
refs AS (SELECT page_id, i, p, regexp_extract(p, '^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{{1,32}};?)', 1) AS ref FROM parts),
codes AS (SELECT DISTINCT ref, CASE WHEN ref[2] IN ('x', 'X') THEN TRY_CAST('0x' || rtrim(substr(ref, 3), ';') AS BIGINT)
  ELSE TRY_CAST(rtrim(substr(ref, 2), ';') AS BIGINT) END AS code FROM refs WHERE ref[1] = '#'),
numbers AS (SELECT ref, CASE WHEN odd.value IS NOT NULL THEN odd.value WHEN c.code IS NULL OR c.code = 0 OR c.code > 1114111
    OR c.code BETWEEN 55296 AND 57343 THEN chr(65533) WHEN c.code IN ({gone}) THEN '' ELSE chr(CAST(c.code AS INTEGER)) END AS value, '' AS rest
  FROM codes c LEFT JOIN odd ON odd.code = c.code),
named AS (SELECT ref, arg_max(value, length(name)) AS value, substr(ref, max(length(name)) + 1) AS rest
  FROM (SELECT DISTINCT ref FROM refs WHERE ref <> '' AND ref[1] <> '#') r
  JOIN names ON starts_with(ref, name) AND (name = ref OR length(name) >= 2) GROUP BY ref),
known AS (SELECT * FROM numbers UNION ALL SELECT * FROM named)
SELECT page_id, md5(string_agg(CASE WHEN i = 1 THEN p WHEN k.ref IS NULL THEN '&' || p
  ELSE k.value || k.rest || substr(p, length(k.ref) + 1) END, '' ORDER BY i)) AS text_md5
FROM refs LEFT JOIN known k ON k.ref = refs.ref AND i > 1 GROUP BY page_id
"""


@register("html_unescape", oracle=_unescape_sql())
def html_unescape(spark, sf):
    """All character references of the whole pages."""
    p = load(spark, sf, "pages")
    return p.select("page_id", F.md5(T.html_unescape("html")).alias("text_md5"))


TAR_MAXCOUNT = 250
TAR_MAXSIZE = 1e8


def documents_as_samples(spark, sf):
    from capset.operators.rows import with_row_id
    from capset.functions.ids import pad_id

    d = with_row_id(load(spark, sf, "documents"))
    return d.select("row_id", pad_id("doc_id", 9).alias("key"), F.encode("text", "UTF-8").alias("cap"),
                    F.to_json(F.struct("lang", "source")).alias("json"), "n_chars")


@register("tar_roundtrip", oracle=f"""
SELECT {S.pad_id('doc_id', 9)} AS key, md5(text) AS cap_md5,
       CAST(json_object('lang', lang, 'source', source) AS VARCHAR) AS json
FROM documents
""")
def tar_roundtrip(spark, sf):
    """Write the manifest as tar shards (global prefix packing), read them back."""
    from capset.session import scratch_path
    from capset.sinks import write_tar_shards
    from capset.sources import tarshard

    out = scratch_path(spark, "tar_roundtrip")
    samples = documents_as_samples(spark, sf)
    write_tar_shards(samples, out, maxcount=TAR_MAXCOUNT, maxsize=TAR_MAXSIZE, packing="prefix",
                     size_col="n_chars")
    tarshard.register(spark)
    back = spark.read.format("tarshard").schema("key string, cap binary, json string").load(out)
    return back.select("key", F.md5("cap").alias("cap_md5"), "json")
