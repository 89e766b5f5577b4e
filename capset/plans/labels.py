"""Label and narrative queries.

``events(event_id, ts, user_id, event_type, value, props)`` stands for label annotations:
image = ``user_id``, label code = ``event_type``, certain = ``value >= 100``, order = ``event_id``,
split = ``user_id % 3`` (train / validation / test).  The label dictionary names every code but
``error`` (so unknown codes occur).  ``conversations(conv_id, turn, role, text)`` are the
narratives of ``documents`` (``conv_id = doc_id``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from capset.operators import labels as L
from capset.plans import sqltext as S
from capset.plans.registry import load, register

SEED = 7
CERTAIN_MIN = 100.0
NOT_IN_DICTIONARY = "error"
SPLITS = ("train", "validation", "test")
#: Templates of this query: an application brings its own.
TEMPLATES = ("{certain}", "visible: {certain}", "this frame holds {certain}")
MAYBE_ENDINGS = ("; unsure about {maybe}", " ({maybe}?)")


def _annotations(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select(F.col("user_id").alias("image_id"), F.col("event_type").alias("label"),
                     F.col("value"), F.col("event_id").alias("order"))


def _dictionary(spark, sf):
    ev = load(spark, sf, "events")
    codes = ev.select(F.col("event_type").alias("code")).distinct().where(F.col("code") != NOT_IN_DICTIONARY)
    return codes.select("code", F.concat(F.upper(F.substring("code", 1, 1)), F.substring("code", 2, 1 << 20))
                        .alias("name"))


def _per_image(spark, sf):
    return L.labels_per_image(_annotations(spark, sf), certain=F.col("value") >= CERTAIN_MIN,
                              dictionary=_dictionary(spark, sf))


def _split(col):
    return F.element_at(F.array(*[F.lit(s) for s in SPLITS]), (F.col(col) % 3 + 1).cast("int"))


_PER_IMAGE_SQL = f"""
WITH dict AS (
  SELECT code, upper(substr(code, 1, 1)) || substr(code, 2) AS name
  FROM (SELECT DISTINCT event_type AS code FROM events) WHERE code <> {S.q(NOT_IN_DICTIONARY)}),
per AS (
  SELECT user_id AS image_id, value >= {CERTAIN_MIN} AS certain, event_type AS code,
         min(event_id) AS first, count(*) AS n
  FROM events GROUP BY ALL),
named AS (
  SELECT p.*, coalesce(d.name, p.code) AS name, d.code IS NULL AS unknown
  FROM per p LEFT JOIN dict d ON d.code = p.code),
img AS (
  SELECT image_id,
         coalesce(list(name ORDER BY first) FILTER (WHERE certain), []) AS certain_labels,
         coalesce(list(name ORDER BY first) FILTER (WHERE NOT certain), []) AS uncertain_labels,
         coalesce(list(n ORDER BY first) FILTER (WHERE certain), []) AS certain_counts,
         coalesce(list(n ORDER BY first) FILTER (WHERE NOT certain), []) AS uncertain_counts,
         CAST(coalesce(sum(n) FILTER (WHERE certain), 0) AS BIGINT) AS n_certain,
         CAST(coalesce(sum(n) FILTER (WHERE NOT certain), 0) AS BIGINT) AS n_uncertain,
         CAST(count(*) FILTER (WHERE unknown) AS BIGINT) AS n_unknown
  FROM named GROUP BY image_id)
"""


@register("labels_per_image", oracle=_PER_IMAGE_SQL + """
SELECT image_id, array_to_string(certain_labels, ', ') AS certain_labels,
       array_to_string(uncertain_labels, ', ') AS uncertain_labels, array_to_string(certain_counts, ',') AS certain_counts,
       array_to_string(uncertain_counts, ',') AS uncertain_counts, n_certain, n_uncertain, n_unknown
FROM img
""")
def labels_per_image(spark, sf):
    p = _per_image(spark, sf)
    return p.select("image_id", F.array_join("certain_labels", ", ").alias("certain_labels"),
                    F.array_join("uncertain_labels", ", ").alias("uncertain_labels"),
                    F.array_join(F.col("certain_counts").cast("array<string>"), ",").alias("certain_counts"),
                    F.array_join(F.col("uncertain_counts").cast("array<string>"), ",").alias("uncertain_counts"),
                    "n_certain", "n_uncertain", "n_unknown")


@register("label_rows_per_image", oracle=f"""
WITH dict AS (
  SELECT code, upper(substr(code, 1, 1)) || substr(code, 2) AS name
  FROM (SELECT DISTINCT event_type AS code FROM events) WHERE code <> {S.q(NOT_IN_DICTIONARY)}),
named AS (SELECT user_id AS image_id, value >= {CERTAIN_MIN} AS certain, event_id, coalesce(name, event_type) AS name
          FROM events LEFT JOIN dict ON code = event_type)
SELECT image_id,
       coalesce(string_agg(name, ', ' ORDER BY event_id) FILTER (WHERE certain), '') AS certain_labels,
       coalesce(string_agg(name, ', ' ORDER BY event_id) FILTER (WHERE NOT certain), '') AS uncertain_labels
FROM named GROUP BY image_id
""")
def label_rows_per_image(spark, sf):
    """Every annotation row of an image in its lists, repeats kept, in row order."""
    p = L.labels_per_image(_annotations(spark, sf), certain=F.col("value") >= CERTAIN_MIN,
                           dictionary=_dictionary(spark, sf), repeats=True)
    return p.select("image_id", F.array_join("certain_labels", ", ").alias("certain_labels"),
                    F.array_join("uncertain_labels", ", ").alias("uncertain_labels"))


@register("split_report", oracle=_PER_IMAGE_SQL + f"""
, s AS (SELECT [{S.q(SPLITS[0])}, {S.q(SPLITS[1])}, {S.q(SPLITS[2])}][image_id % 3 + 1] AS split,
               len(certain_labels) = 0 AS dropped FROM img)
SELECT coalesce(split, 'total') AS split, count(*) AS num_samples,
       CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS dropped
FROM s GROUP BY ROLLUP (split)
""")
def split_report(spark, sf):
    p = L.flag_dropped(_per_image(spark, sf)).withColumn("split", _split("image_id"))
    return L.split_report(p)


MAYBE = L.maybe_templates(TEMPLATES, MAYBE_ENDINGS)


def _templates_sql(items) -> str:
    return "[" + ", ".join(S.q(t) for t in items) + "]"


def _caption_sql() -> str:
    plain = _templates_sql(TEMPLATES)
    maybe = _templates_sql(MAYBE)
    unit = f"(CAST(('0x' || substr({S.seeded_md5('image_id', SEED)}, 1, 8)) AS BIGINT) / 4294967296.0)"
    use_maybe = f"({unit} > 0.5 AND len(uncertain_labels) > 0)"
    t_plain = f"{plain}[{S.seeded_bucket('image_id', SEED, len(TEMPLATES))} + 1]"
    t_maybe = f"{maybe}[{S.seeded_bucket('image_id', SEED, len(MAYBE))} + 1]"
    filled = (f"replace(replace(CASE WHEN {use_maybe} THEN {t_maybe} ELSE {t_plain} END, "
              f"'{{certain}}', array_to_string(certain_labels, ', ')), "
              f"'{{maybe}}', array_to_string(uncertain_labels, ', '))")
    return f"SELECT image_id, {use_maybe} AS used_maybe, {S.collapse_lower(filled)} AS caption FROM img"


@register("template_captions", oracle=_PER_IMAGE_SQL + _caption_sql())
def template_captions(spark, sf):
    return L.render_captions(_per_image(spark, sf), TEMPLATES, MAYBE_ENDINGS, seed=SEED).select("image_id", "used_maybe", "caption")


def _narratives(spark, sf):
    return load(spark, sf, "conversations").select(
        F.col("conv_id").alias("doc_id"), "turn", F.col("text").alias("narrative"))


@register("narrative_override", oracle="""
WITH hit AS (
  SELECT d.doc_id, c.turn, true AS from_narrative, c.text AS caption
  FROM documents d JOIN conversations c ON c.conv_id = d.doc_id),
miss AS (
  SELECT d.doc_id, CAST(NULL AS BIGINT) AS turn, false AS from_narrative, d.text AS caption
  FROM documents d WHERE NOT EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = d.doc_id))
SELECT doc_id, turn, from_narrative, md5(caption) AS caption_md5 FROM hit
UNION ALL
SELECT doc_id, turn, from_narrative, md5(caption) AS caption_md5 FROM miss
""")
def narrative_override(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text").select("doc_id", F.col("text").alias("caption"))
    out = L.override_captions(docs, _narratives(spark, sf), on="doc_id", order="turn")
    return out.select("doc_id", "turn", "from_narrative", F.md5("caption").alias("caption_md5"))


@register("last_wins_union", oracle="""
WITH u AS (
  SELECT md5(text) AS key, doc_id, lang,
         CASE WHEN lang = 'de' THEN 0 WHEN lang = 'en' THEN 1 ELSE 2 END AS input
  FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY input DESC, doc_id DESC) AS rn FROM u)
SELECT key, doc_id, lang, input FROM r WHERE rn = 1
""")
def last_wins_union(spark, sf):
    rank = F.when(F.col("lang") == "de", 0).when(F.col("lang") == "en", 1).otherwise(2)
    d = load(spark, sf, "documents").select(F.md5("text").alias("key"), "doc_id", "lang", rank.alias("input"))
    return L.last_wins(d, key="key", input_col="input", order="doc_id").select("key", "doc_id", "lang", "input")


@register("image_paths", oracle=f"""
SELECT image_id, {S.q('images/256px/')} ||
       ['train-256/', 'validation/', 'test/'][image_id % 3 + 1] || CAST(image_id AS VARCHAR) || '.jpg' AS path
FROM (SELECT DISTINCT user_id AS image_id FROM events)
""")
def image_paths(spark, sf):
    from capset.operators.samples import image_path

    imgs = load(spark, sf, "events").select(F.col("user_id").alias("image_id")).distinct()
    return imgs.select("image_id", image_path(_split("image_id"), F.col("image_id").cast("string")).alias("path"))


GENERIC = ("{}", "seen here: {}", "{} and nothing else")


@register("generic_captions", oracle=_PER_IMAGE_SQL + f"""
, flat AS (SELECT image_id, list_concat(certain_labels, uncertain_labels) AS labels FROM img)
SELECT image_id, {S.collapse_lower(
    "replace(" + _templates_sql(GENERIC) + "["
    + S.seeded_bucket('image_id', SEED, 3) + " + 1], '{}', array_to_string(labels, ', '))")} AS caption,
       'events_' || CAST(image_id AS VARCHAR) AS caption_key
FROM flat
""")
def generic_captions(spark, sf):
    """Generic per-dataset rendering (flat label list = certain then uncertain labels)."""
    from capset.operators.samples import generate_captions

    p = _per_image(spark, sf).select("image_id", F.concat("certain_labels", "uncertain_labels").alias("labels"))
    return generate_captions(p, "events", {"events": GENERIC}, seed=SEED).select("image_id", "caption", "caption_key")


@register("label_row_parts", oracle="""
WITH p AS (SELECT user_id AS image_id, event_type, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 20 AS part FROM events)
SELECT image_id, CAST(part AS BIGINT) AS part, count(*) AS n, array_to_string(list(event_type ORDER BY event_id), ',') AS labels FROM p GROUP BY image_id, part
""")
def label_row_parts(spark, sf):
    """Every annotation row of an image, in lists of 20."""
    p = L.label_row_parts(_annotations(spark, sf), size=20)
    return p.select("image_id", "part", "n", F.array_join("labels", ",").alias("labels"))


@register("count_images_sketch", oracle=f"""
WITH s AS (SELECT CASE user_id % 3 WHEN 0 THEN {S.q(SPLITS[0])} WHEN 1 THEN {S.q(SPLITS[1])} ELSE {S.q(SPLITS[2])} END AS split, event_id FROM events)
SELECT coalesce(split, 'total') AS split, count(DISTINCT event_id) AS exact, true AS within FROM s GROUP BY ROLLUP(split)
""")
def count_images_sketch(spark, sf):
    """Images (here each event is one) by split and in all: counted, and estimated from sketches by split and type that are merged."""
    ev = load(spark, sf, "events").select(F.col("event_id").alias("image_id"), _split("user_id").alias("split"), "event_type")
    sketches = L.image_sketches(ev, ["split", "event_type"])
    about = L.count_sketched(sketches, ["split"]).unionByName(L.count_sketched(sketches.withColumn("split", F.lit("total")), ["split"]))
    exact = ev.rollup("split").agg(F.count_distinct("image_id").alias("exact")).withColumn("split", F.coalesce("split", F.lit("total")))
    within = F.abs(F.col("about") - F.col("exact")) <= F.ceil(F.col("exact") * L.SKETCH_ERROR)
    return exact.join(about, "split", "left").select("split", "exact", F.coalesce(within, F.col("exact") == 0).alias("within"))
