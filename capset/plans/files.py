"""File-tree queries (pairs, fault report, sidecars) and dedup / size-rule queries.

The driver tables stand for a dataset folder tree:

* text files: one per ``labels.doc_id`` (``<key>.txt``, its length = ``length(documents.text)``);
* image files: one per ``documents`` row with ``lang <> 'fr'``, extension by ``doc_id % 4``
  (jpg, png, jpeg, bmp); images of source ``src0`` do not decode;
* JSON sidecars: ``events`` of type ``view`` (key = ``event_id``, content = ``props``);
* folder = ``'%05d' % (doc_id div 100)``.

Sizes: ``part`` gives width ``p_size * 10`` and height ``(p_partkey % 50 + 1) * 10``;
``lineitem`` rows are samples whose image is their part (so later lines of a part are copies).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from capset.functions import geometry as G
from capset.functions import ids as I
from capset.operators import dedup as D
from capset.operators import pairs as P
from capset.plans import sqltext as S
from capset.plans.registry import load, register

IDS_PER_FOLDER = 100
NO_IMAGE_LANG = "fr"
BROKEN_SOURCE = "src0"
SIDECAR_TYPE = "view"
EXT_BY_ID = ("jpg", "png", "jpeg", "bmp")
MIN_CHARS = 5
MIN_SIDE, MAX_SIDE = 192, 320
BOX = 256


def _folder(c):
    return I.batch_name(c, IDS_PER_FOLDER, 5)


def _with_names(df):
    return (df.withColumn("name", F.concat("stem", F.lit("."), "ext"))
              .withColumn("path", F.concat(F.lit("data/"), "folder", F.lit("/"), "stem", F.lit("."), "ext")))


def _texts(spark, sf):
    lab = load(spark, sf, "labels").select("doc_id")
    docs = load(spark, sf, "documents").select("doc_id", F.length("text").cast("long").alias("text_len"))
    t = lab.join(docs, "doc_id").select(
        _folder("doc_id").alias("folder"), I.pad_id("doc_id", 9).alias("stem"), F.lit("txt").alias("ext"),
        "text_len", F.lit(None).cast("boolean").alias("valid"))
    return _with_names(t)


def _images(spark, sf):
    d = load(spark, sf, "documents").where(F.col("lang") != NO_IMAGE_LANG)
    ext = F.element_at(F.array(*[F.lit(e) for e in EXT_BY_ID]), (F.col("doc_id") % 4 + 1).cast("int"))
    i = d.select(_folder("doc_id").alias("folder"), I.pad_id("doc_id", 9).alias("stem"), ext.alias("ext"),
                 F.lit(None).cast("long").alias("text_len"), (F.col("source") != BROKEN_SOURCE).alias("valid"))
    return _with_names(i)


def _files(spark, sf):
    return _texts(spark, sf).unionByName(_images(spark, sf))


_FILES_SQL = f"""
WITH texts AS (
  SELECT {S.shard_dir('l.doc_id', IDS_PER_FOLDER, 5)} AS folder, {S.pad_id('l.doc_id', 9)} AS stem,
         'txt' AS ext, CAST(length(d.text) AS BIGINT) AS text_len, CAST(NULL AS BOOLEAN) AS valid
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
images AS (
  SELECT {S.shard_dir('doc_id', IDS_PER_FOLDER, 5)} AS folder, {S.pad_id('doc_id', 9)} AS stem,
         ['jpg', 'png', 'jpeg', 'bmp'][doc_id % 4 + 1] AS ext, CAST(NULL AS BIGINT) AS text_len,
         source <> {S.q(BROKEN_SOURCE)} AS valid
  FROM documents WHERE lang <> {S.q(NO_IMAGE_LANG)}),
files AS (
  SELECT *, stem || '.' || ext AS name, 'data/' || folder || '/' || stem || '.' || ext AS path
  FROM (SELECT * FROM texts UNION ALL SELECT * FROM images))
"""
_IMG = "ext IN ('jpg', 'jpeg', 'png', 'bmp')"


@register("pair_by_stem", oracle=_FILES_SQL + f"""
SELECT i.folder, i.stem, i.path AS img_path, t.path AS txt_path
FROM (SELECT * FROM files WHERE {_IMG}) i JOIN (SELECT * FROM files WHERE ext = 'txt') t
  ON t.folder = i.folder AND t.stem = i.stem
""")
def pair_by_stem(spark, sf):
    return P.pair(_images(spark, sf), _texts(spark, sf)).select("folder", "stem", "img_path", "txt_path")


@register("missing_sides", oracle=_FILES_SQL + f"""
, i AS (SELECT DISTINCT folder, stem FROM files WHERE {_IMG}),
t AS (SELECT DISTINCT folder, stem FROM files WHERE ext = 'txt')
SELECT coalesce(i.folder, t.folder) AS folder, coalesce(i.stem, t.stem) AS stem,
       CASE WHEN i.stem IS NOT NULL AND t.stem IS NOT NULL THEN 'both'
            WHEN i.stem IS NOT NULL THEN 'image_only' ELSE 'text_only' END AS side
FROM i FULL OUTER JOIN t ON i.folder = t.folder AND i.stem = t.stem
""")
def missing_sides(spark, sf):
    return P.missing_sides(_images(spark, sf), _texts(spark, sf))


@register("optional_sidecar", oracle=_FILES_SQL + f"""
, pairs AS (
  SELECT i.folder, i.stem FROM (SELECT * FROM files WHERE {_IMG}) i
  JOIN (SELECT * FROM files WHERE ext = 'txt') t ON t.folder = i.folder AND t.stem = i.stem),
side AS (
  SELECT {S.shard_dir('event_id', IDS_PER_FOLDER, 5)} AS folder, {S.pad_id('event_id', 9)} AS stem,
         max(props) AS raw
  FROM events WHERE event_type = {S.q(SIDECAR_TYPE)} GROUP BY ALL)
SELECT p.folder, p.stem, CAST(json(s.raw) AS VARCHAR) AS json,
       (s.raw IS NOT NULL AND json_valid(s.raw) = false) AS sidecar_corrupt
FROM pairs p LEFT JOIN side s ON s.folder = p.folder AND s.stem = p.stem
""")
def optional_sidecar(spark, sf):
    pairs = P.pair(_images(spark, sf), _texts(spark, sf)).select("folder", "stem")
    ev = load(spark, sf, "events").where(F.col("event_type") == SIDECAR_TYPE)
    side = ev.select(_folder("event_id").alias("folder"), I.pad_id("event_id", 9).alias("stem"),
                     F.col("props").alias("json"))
    return P.with_sidecar(pairs, side).select("folder", "stem", "json", "sidecar_corrupt")


@register("stem_check", oracle=_FILES_SQL + f"""
SELECT folder, stem, count(*) AS n_files, bool_or(ext = 'txt') AS has_text, bool_or({_IMG}) AS has_image,
       CASE WHEN bool_or(ext = 'txt') AND bool_or({_IMG}) THEN 'paired' ELSE 'incomplete' END AS status
FROM files GROUP BY folder, stem
""")
def stem_check(spark, sf):
    return P.stem_check(_files(spark, sf))


_FAULT_ROWS_SQL = _FILES_SQL + f"""
, per_stem AS (
  SELECT folder, stem, bool_or(ext = 'txt') AND bool_or({_IMG}) AS paired,
         coalesce(bool_or(ext = 'txt' AND text_len < {MIN_CHARS}), false) AS short,
         coalesce(bool_or({_IMG} AND NOT valid), false) AS corrupt
  FROM files GROUP BY folder, stem),
f AS (SELECT * FROM files JOIN per_stem USING (folder, stem)),
rows AS (
  SELECT folder, 'incomplete' AS kind, name AS file FROM f WHERE NOT paired
  UNION ALL SELECT folder, 'corrupt', name FROM f WHERE paired AND {_IMG} AND NOT valid
  UNION ALL SELECT folder, 'empty', name FROM f WHERE paired AND ext = 'txt' AND short
  UNION ALL SELECT folder, 'delete', path FROM f
            WHERE NOT paired OR ((short OR corrupt) AND (ext = 'txt' OR {_IMG})))
"""


@register("fault_report", oracle=_FAULT_ROWS_SQL + """
SELECT fo.folder,
       array_to_string(list_sort(coalesce(list(r.file) FILTER (WHERE r.kind = 'incomplete'), [])), ',') AS incomplete,
       array_to_string(list_sort(coalesce(list(r.file) FILTER (WHERE r.kind = 'corrupt'), [])), ',') AS corrupt,
       array_to_string(list_sort(coalesce(list(r.file) FILTER (WHERE r.kind = 'empty'), [])), ',') AS empty,
       array_to_string(list_sort(coalesce(list(r.file) FILTER (WHERE r.kind = 'delete'), [])), ',') AS "delete"
FROM (SELECT DISTINCT folder FROM files) fo LEFT JOIN rows r ON r.folder = fo.folder
GROUP BY fo.folder
""")
def fault_report(spark, sf):
    rep = P.fault_report(_files(spark, sf), MIN_CHARS)
    return rep.select("folder", *[F.array_join(k, ",").alias(k) for k in ("incomplete", "corrupt", "empty", "delete")])


@register("fault_rows", oracle=_FAULT_ROWS_SQL + "SELECT folder, kind, file FROM rows")
def fault_rows(spark, sf):
    return P.fault_rows(_files(spark, sf), MIN_CHARS)


@register("pair_counts", oracle=_FILES_SQL + f"""
, s AS (SELECT folder, stem, bool_or(ext = 'txt') AND bool_or({_IMG}) AS paired FROM files GROUP BY ALL)
SELECT CAST(count(*) FILTER (WHERE ext = 'txt') AS BIGINT) AS texts,
       CAST(count(*) FILTER (WHERE {_IMG}) AS BIGINT) AS images,
       CAST(count(*) FILTER (WHERE {_IMG} AND NOT coalesce(valid, true)) AS BIGINT) AS corrupt,
       (SELECT CAST(count(*) FILTER (WHERE paired) AS BIGINT) FROM s) AS pairs,
       (SELECT CAST(count(*) FILTER (WHERE NOT paired) AS BIGINT) FROM s) AS incomplete
FROM files
""")
def pair_counts(spark, sf):
    return P.pair_counts(_files(spark, sf))


# --- dedup and size rules -------------------------------------------------------------------

@register("dedup_md5", oracle="""
WITH h AS (SELECT doc_id, md5(text) AS md5 FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY md5 ORDER BY doc_id) AS rn FROM h)
SELECT doc_id, md5 FROM r WHERE rn = 1
""")
def dedup_md5(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", F.md5("text").alias("md5"))
    return D.first_per_hash(d, "md5", "doc_id").select("doc_id", "md5")


def _sizes(spark, sf):
    p = load(spark, sf, "part")
    return p.select("p_partkey", (F.col("p_size") * 10).alias("width"),
                    ((F.col("p_partkey") % 50 + 1) * 10).cast("int").alias("height"))


_SIZES_SQL = """
WITH s AS (SELECT p_partkey, p_size * 10 AS width, CAST((p_partkey % 50 + 1) * 10 AS INTEGER) AS height
           FROM part)
"""


@register("size_action", oracle=_SIZES_SQL + f"""
SELECT p_partkey, width, height,
       CASE WHEN width < {MIN_SIDE} AND height < {MIN_SIDE} THEN 'discard'
            WHEN width > {MAX_SIDE} OR height > {MAX_SIDE} THEN 'resize' ELSE 'keep' END AS action
FROM s
""")
def size_action(spark, sf):
    s = _sizes(spark, sf)
    return s.select("p_partkey", "width", "height",
                    G.size_action("width", "height", MIN_SIDE, MAX_SIDE).alias("action"))


@register("fit_size", oracle=_SIZES_SQL + f"""
, a AS (SELECT *, greatest({BOX}.0 / width, {BOX}.0 / height) AS a FROM s)
SELECT p_partkey, CAST(trunc(width * a) AS INTEGER) AS new_w, CAST(trunc(height * a) AS INTEGER) AS new_h
FROM a
""")
def fit_size(spark, sf):
    s = _sizes(spark, sf)
    f = G.fit_size("width", "height", BOX, BOX)
    return s.select("p_partkey", f["new_w"].alias("new_w"), f["new_h"].alias("new_h"))


@register("run_report", oracle=_SIZES_SQL + f"""
, li AS (SELECT l_orderkey * 8 + l_linenumber AS ord, l_partkey FROM lineitem),
firsts AS (SELECT l_partkey, min(ord) AS ord FROM li GROUP BY l_partkey),
flagged AS (
  SELECT li.ord, f.ord IS NULL AS is_duplicate,
         CASE WHEN s.width < {MIN_SIDE} AND s.height < {MIN_SIDE} THEN 'discard'
              WHEN s.width > {MAX_SIDE} OR s.height > {MAX_SIDE} THEN 'resize' ELSE 'keep' END AS action
  FROM li LEFT JOIN firsts f ON f.ord = li.ord JOIN s ON s.p_partkey = li.l_partkey)
SELECT count(*) AS total,
       CAST(count(*) FILTER (WHERE is_duplicate) AS BIGINT) AS duplicates,
       CAST(count(*) FILTER (WHERE NOT is_duplicate AND action = 'discard') AS BIGINT) AS discarded,
       CAST(count(*) FILTER (WHERE NOT is_duplicate AND action = 'resize') AS BIGINT) AS to_resize,
       count(*) - count(*) FILTER (WHERE is_duplicate)
                - count(*) FILTER (WHERE NOT is_duplicate AND action = 'discard') AS remaining
FROM flagged
""")
def run_report(spark, sf):
    # sample order = (l_orderkey, l_linenumber); line numbers are 1..7, so this key is unique
    li = load(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"), "l_partkey")
    flagged = D.flag_duplicates(li, "l_partkey", "ord")
    sized = flagged.join(_sizes(spark, sf).withColumnRenamed("p_partkey", "l_partkey"), "l_partkey")
    return D.run_report(D.apply_size_rule(sized, "width", "height", MIN_SIDE, MAX_SIDE))


@register("expected_counts", oracle="""
WITH skip AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
exp AS (SELECT source AS file, count(*) AS expected_rows,
               CAST(count(*) FILTER (WHERE lang = 'en') AS BIGINT) AS expected_en
        FROM documents GROUP BY source),
got AS (SELECT source AS file, count(*) AS rows,
               CAST(count(*) FILTER (WHERE lang = 'en') AS BIGINT) AS rows_en
        FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM skip) GROUP BY source)
SELECT e.file, e.expected_rows, e.expected_en, coalesce(g.rows, 0) AS rows,
       coalesce(g.rows_en, 0) AS rows_en, e.expected_rows - coalesce(g.rows, 0) AS missing_rows
FROM exp e LEFT JOIN got g ON g.file = e.file
""")
def expected_counts(spark, sf):
    from capset.operators.resume import expected_counts as ec, pending

    docs = load(spark, sf, "documents").select("doc_id", F.col("source").alias("file"), "lang")
    done = load(spark, sf, "labels").where(F.col("toxic") == 1).select("doc_id")
    return ec(pending(docs, done, on="doc_id"), docs)


@register("key_sets", oracle="""
SELECT doc_id, 'both' AS side FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)
UNION ALL
SELECT doc_id, 'documents_only' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def key_sets(spark, sf):
    """Key intersection and difference of the manifest and the verdict table."""
    from capset.operators.filters import common_keys, only_in

    d = load(spark, sf, "documents").select("doc_id")
    lab = load(spark, sf, "labels").select("doc_id")
    both = common_keys(d, lab, "doc_id").withColumn("side", F.lit("both"))
    only = only_in(d, lab, "doc_id").withColumn("side", F.lit("documents_only"))
    return both.unionByName(only)
