"""Manifest queries: language filter, caption clean-up, ids and folders, batches, resume.

``documents(doc_id, text, lang, source, n_chars)`` stands for the URL–caption manifest (its
row position equals ``doc_id``); ``labels(doc_id, quality, toxic)`` for verdicts: done ids are
``toxic = 1``, failed ids are ``quality = 0``.  ``pages(page_id, url, html)`` is the content store.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from capset.functions import ids as I
from capset.functions import text as T
from capset.operators import resume, rows
from capset.plans import sqltext as S
from capset.plans.registry import load, register

LANGUAGES = ["en", "de"]
PER_FOLDER = 10000          # ids per numbered folder
BATCH_ROWS = 100            # scaled batch size (the reference uses 10k .. 500k rows)
PART_ROWS = 300             # target rows per near-equal part
SEGMENT_TAG = "the"         # a frequent word stands in for the ``English:`` line tag
SPAM_MARK = "cheap-pills"   # content store holds no page of this host


def _langs_sql() -> str:
    return ", ".join(S.q(x) for x in LANGUAGES)


def _manifest(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang", "text")
    return docs.where(F.col("lang").isin(LANGUAGES)).select(
        F.col("doc_id").alias("row_id"),
        I.pad_id("doc_id", 9).alias("key"),
        I.shard_dir("doc_id", PER_FOLDER, 5).alias("folder"),
        "lang",
        T.clean_caption(T.build_caption("text")).alias("caption"))


def _skip(spark, sf):
    lab = load(spark, sf, "labels")
    done = lab.where(F.col("toxic") == 1).select(F.col("doc_id").alias("row_id"))
    failed = lab.where(F.col("quality") == 0).select(F.col("doc_id").alias("row_id"))
    return resume.skip_ids(done, failed)


_CLEAN_SQL = S.clean_caption(S.build_caption("text"))

_MANIFEST_SQL = f"""
WITH man AS (
  SELECT doc_id AS row_id, {S.pad_id('doc_id', 9)} AS key,
         {S.shard_dir('doc_id', PER_FOLDER, 5)} AS folder, lang, {_CLEAN_SQL} AS caption
  FROM documents WHERE lang IN ({_langs_sql()})),
skip AS (
  SELECT doc_id AS row_id FROM labels WHERE toxic = 1
  UNION
  SELECT doc_id AS row_id FROM labels WHERE quality = 0)
"""


@register("caption_manifest", oracle=_MANIFEST_SQL + """
SELECT folder, lang, count(*) AS n_pending,
       CAST(sum(length(caption)) AS BIGINT) AS caption_chars,
       CAST(count(*) FILTER (WHERE length(caption) < 5) AS BIGINT) AS n_short,
       min(key) AS first_key, max(key) AS last_key
FROM man WHERE NOT EXISTS (SELECT 1 FROM skip WHERE skip.row_id = man.row_id)
GROUP BY folder, lang
""")
def caption_manifest(spark, sf):
    """Flagship: filter languages, clean captions, key + folder, skip done/failed, count."""
    pend = resume.pending(_manifest(spark, sf), _skip(spark, sf), on="row_id")
    return pend.groupBy("folder", "lang").agg(
        F.count(F.lit(1)).alias("n_pending"),
        F.sum(F.length("caption")).cast("long").alias("caption_chars"),
        F.count_if(F.length("caption") < 5).cast("long").alias("n_short"),
        F.min("key").alias("first_key"),
        F.max("key").alias("last_key"))


@register("lang_filter", oracle=f"""
SELECT doc_id, lang, n_chars FROM documents WHERE lang IN ({_langs_sql()})
""")
def lang_filter(spark, sf):
    return load(spark, sf, "documents").where(F.col("lang").isin(LANGUAGES)) \
        .select("doc_id", "lang", "n_chars")


@register("clean_caption", oracle=f"""
WITH c AS (SELECT doc_id, {_CLEAN_SQL} AS caption FROM documents)
SELECT doc_id, md5(caption) AS caption_md5, CAST(length(caption) AS BIGINT) AS caption_len,
       md5({S.collapse_lower('caption')}) AS lower_md5
FROM c
""")
def clean_caption(spark, sf):
    c = load(spark, sf, "documents").select("doc_id", "text").select(
        "doc_id", T.clean_caption(T.build_caption("text")).alias("caption"))
    return c.select("doc_id", F.md5("caption").alias("caption_md5"),
                    F.length("caption").cast("long").alias("caption_len"),
                    F.md5(T.collapse_lower("caption")).alias("lower_md5"))


@register("tagged_segment", oracle=f"""
WITH s AS (SELECT doc_id, {S.english_segment('text', SEGMENT_TAG)} AS seg FROM documents)
SELECT doc_id, md5(seg) AS seg_md5, CAST(length(seg) AS BIGINT) AS seg_len FROM s
""")
def tagged_segment(spark, sf):
    s = load(spark, sf, "documents").select("doc_id", "text").select(
        "doc_id", T.english_segment("text", SEGMENT_TAG).alias("seg"))
    return s.select("doc_id", F.md5("seg").alias("seg_md5"),
                    F.length("seg").cast("long").alias("seg_len"))


@register("pad_ids", oracle=f"""
SELECT doc_id, {S.pad_id('doc_id', 9)} AS key, {S.pad_id('doc_id', 8, 'w')} AS key_w,
       {S.pad_id('doc_id', 9, 'F')} AS key_f, {S.pad_id('doc_id * 1000000', 9)} AS key_wide
FROM documents
""")
def pad_ids(spark, sf):
    d = load(spark, sf, "documents")
    return d.select("doc_id", I.pad_id("doc_id", 9).alias("key"),
                    I.pad_id("doc_id", 8, "w").alias("key_w"),
                    I.pad_id("doc_id", 9, "F").alias("key_f"),
                    I.pad_id(F.col("doc_id") * 1000000, 9).alias("key_wide"))


@register("shard_dirs", oracle=f"""
SELECT doc_id, {S.shard_dir('doc_id', PER_FOLDER, 5)} AS folder,
       {S.pad_id(f'doc_id // {BATCH_ROWS}', 3)} AS batch3,
       {S.pad_id(f'doc_id // {BATCH_ROWS}', 4)} AS batch4,
       CAST(doc_id // {BATCH_ROWS} AS BIGINT) AS batch
FROM documents
""")
def shard_dirs(spark, sf):
    d = load(spark, sf, "documents")
    return d.select("doc_id", I.shard_dir("doc_id", PER_FOLDER, 5).alias("folder"),
                    I.batch_name("doc_id", BATCH_ROWS, 3).alias("batch3"),
                    I.batch_name("doc_id", BATCH_ROWS, 4).alias("batch4"),
                    I.batch_of("doc_id", BATCH_ROWS).alias("batch"))


_BASE_SQL = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/*$', 1)"
_HOST_SQL = "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)"


@register("parse_ids", oracle=f"""
SELECT page_id, {_BASE_SQL} AS base,
       regexp_extract({_BASE_SQL}, '^(.+?)(\\.[^.]*)?$', 1) AS stem,
       lower(regexp_extract({_BASE_SQL}, '^.+?\\.([^.]*)$', 1)) AS ext,
       CASE WHEN regexp_extract({_BASE_SQL}, '(\\d+)(\\.[^.]*)?$', 1) <> ''
            THEN CAST(regexp_extract({_BASE_SQL}, '(\\d+)(\\.[^.]*)?$', 1) AS BIGINT) END AS num_id,
       string_split({_HOST_SQL}, '.')[-1] AS tld,
       instr(lower(url), '.svg') > 0 AS is_svg
FROM pages
""")
def parse_ids(spark, sf):
    p = load(spark, sf, "pages")
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1)
    return p.select("page_id", I.base_name("url").alias("base"), I.stem("url").alias("stem"),
                    I.extension("url").alias("ext"), I.numeric_id("url").alias("num_id"),
                    I.last_part(host, ".").alias("tld"), I.is_svg("url").alias("is_svg"))


@register("row_batches", oracle=f"""
SELECT CAST(doc_id // {BATCH_ROWS} AS BIGINT) AS batch, count(*) AS n,
       min(doc_id) AS first_row, max(doc_id) AS last_row, CAST(sum(n_chars) AS BIGINT) AS chars
FROM documents GROUP BY 1
""")
def row_batches(spark, sf):
    d = rows.with_row_id(load(spark, sf, "documents"))
    return rows.batch(d, BATCH_ROWS).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_row"),
        F.max("row_id").alias("last_row"), F.sum("n_chars").cast("long").alias("chars"))


@register("near_equal_parts", oracle=f"""
SELECT doc_id, CAST(ntile((SELECT greatest(1, count(*) // {PART_ROWS}) FROM documents))
                    OVER (ORDER BY doc_id) AS BIGINT) AS part
FROM documents
""")
def near_equal_parts(spark, sf):
    d = rows.with_row_id(load(spark, sf, "documents").select("doc_id"))
    return rows.near_equal_parts(d, PART_ROWS).select("doc_id", "part")


@register("resume_anti_join", oracle=_MANIFEST_SQL + """
SELECT row_id, key, folder FROM man
WHERE row_id NOT IN (SELECT row_id FROM skip)
""")
def resume_anti_join(spark, sf):
    return resume.pending(_manifest(spark, sf), _skip(spark, sf)).select("row_id", "key", "folder")


@register("progress", oracle="""
WITH done AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
t AS (SELECT count(*) AS total,
             count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM done)) AS done
      FROM documents)
SELECT total, done, total - done AS remaining,
       round(CASE WHEN total > 0 THEN done * 100.0 / total END, 4) AS percent_done
FROM t
""")
def progress(spark, sf):
    lab = load(spark, sf, "labels")
    done = lab.where(F.col("toxic") == 1).select("doc_id")
    return resume.progress(load(spark, sf, "documents"), done, on="doc_id")


@register("resolve_content", oracle=f"""
WITH man AS (
  SELECT d.doc_id, p.url FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id),
content AS (
  SELECT url, max_by(html, (length(html), html)) AS content FROM pages
  WHERE instr(url, {S.q(SPAM_MARK)}) = 0 GROUP BY url)
SELECT m.doc_id, m.url,
       CASE WHEN m.url IS NULL THEN 'no_url' WHEN c.content IS NULL THEN 'missing'
            WHEN length(c.content) = 0 THEN 'empty' ELSE 'ok' END AS status,
       CAST(length(c.content) AS BIGINT) AS content_len
FROM man m LEFT JOIN content c ON c.url = m.url
""")
def resolve_content(spark, sf):
    pages = load(spark, sf, "pages")
    manifest = load(spark, sf, "documents").select("doc_id").join(
        pages.select(F.col("page_id").alias("doc_id"), "url"), "doc_id", "left")
    content = pages.where(F.instr("url", SPAM_MARK) == 0).select("url", F.col("html").alias("content"))
    out = resume.resolve_content(manifest, content, on="url", content_col="content")
    return out.select("doc_id", "url", "status", F.length("content").cast("long").alias("content_len"))


@register("sample_fields", oracle=f"""
SELECT {S.pad_id('doc_id', 9)} AS key, text AS cap, lang AS lang, source AS source
FROM documents
""")
def sample_fields(spark, sf):
    """Sample keys from row ids (taken before any filter) and fields named by the mapping; the
    encoder suffixes (``cap.txt``) are dropped here so that no result column holds a dot."""
    from capset.operators.samples import to_samples

    d = rows.sample_keys(rows.with_row_id(load(spark, sf, "documents").select("text", "lang", "source")))
    return to_samples(d, {"text": "cap.txt", "lang": "lang.cls", "source": "source.cls"}, use_encoder=False)


@register("ledger_resume", oracle="""
WITH ledger AS (
  SELECT doc_id AS row_id, CASE WHEN toxic = 1 THEN 'done' ELSE 'failed' END AS status,
         CASE WHEN toxic = 1 THEN 1 ELSE 2 - quality END AS attempts
  FROM labels),
skip AS (SELECT DISTINCT row_id FROM ledger WHERE status = 'done' OR (status = 'failed' AND attempts >= 2))
SELECT doc_id AS row_id FROM documents WHERE doc_id NOT IN (SELECT row_id FROM skip)
""")
def ledger_resume(spark, sf):
    """A ledger built from the verdicts: toxic rows are done; the others failed, low-quality
    ones after 2 attempts, the rest after 1.  Failed rows are retried until they reach 2
    attempts, so only the first kind is skipped with the done ones."""
    lab = load(spark, sf, "labels")
    ledger = lab.select(F.col("doc_id").alias("row_id"), F.lit("fetch").alias("stage"),
                        F.when(F.col("toxic") == 1, "done").otherwise("failed").alias("status"),
                        F.lit(None).cast("string").alias("error"),
                        F.when(F.col("toxic") == 1, 1).otherwise(2 - F.col("quality")).alias("attempts"))
    skip = resume.done_and_failed(ledger, retry_failed=True, max_attempts=2)
    docs = load(spark, sf, "documents").select(F.col("doc_id").alias("row_id"))
    return resume.pending(docs, skip)
