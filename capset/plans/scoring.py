"""Scoring queries over ``embeddings(vec_id, embedding float[64], label)``.

Image = ``vec_id % 8 = 0``; its candidates are the other vectors with the same ``vec_id div 8``;
candidate field = ``CAPTION_FIELDS[vec_id % 8 - 1]``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from capset.operators import scoring as SC
from capset.plans import sqltext as S
from capset.plans.registry import load, register

GROUP = 8
THRESHOLD = 0.3
SCALE = 100.0


def _scored(spark, sf):
    e = load(spark, sf, "embeddings")
    grp = F.floor(F.col("vec_id") / GROUP)
    pos = (F.col("vec_id") % GROUP).cast("int")
    images = e.where(pos == 0).select(grp.alias("grp"), F.col("vec_id").alias("image_id"),
                                      F.col("embedding").alias("image_vec"))
    fields = F.array(*[F.lit(f) for f in SC.CAPTION_FIELDS])
    cands = e.where(pos != 0).select(grp.alias("grp"), (pos - 1).alias("field_idx"),
                                     F.element_at(fields, pos).alias("field"),
                                     F.col("embedding").alias("text_vec"))
    return SC.score(images, cands, "grp").select("image_id", "field_idx", "field", "score")


_FIELDS_SQL = "[" + ", ".join(S.q(f) for f in SC.CAPTION_FIELDS) + "]"
_SCORED_SQL = f"""
WITH img AS (SELECT vec_id // {GROUP} AS grp, vec_id AS image_id, embedding AS a
             FROM embeddings WHERE vec_id % {GROUP} = 0),
cand AS (SELECT vec_id // {GROUP} AS grp, CAST(vec_id % {GROUP} - 1 AS INTEGER) AS field_idx,
                {_FIELDS_SQL}[vec_id % {GROUP}] AS field, embedding AS b
         FROM embeddings WHERE vec_id % {GROUP} <> 0),
pairs AS (
  SELECT i.image_id, c.field_idx, c.field,
         list_sum(list_transform(list_zip(i.a, c.b), lambda x: CAST(x[1] AS DOUBLE) * CAST(x[2] AS DOUBLE))) AS dot,
         sqrt(list_sum(list_transform(i.a, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) *
         sqrt(list_sum(list_transform(c.b, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS den
  FROM img i JOIN cand c ON c.grp = i.grp),
scored AS (
  SELECT image_id, field_idx, field,
         CASE WHEN den > 1e-8 THEN dot / den ELSE 0.0 END AS score FROM pairs)
"""


@register("caption_scores", oracle=_SCORED_SQL + "SELECT image_id, field_idx, field, round(score, 4) AS score FROM scored")
def caption_scores(spark, sf):
    return _scored(spark, sf).withColumn("score", F.round("score", 4))


@register("best_caption", oracle=_SCORED_SQL + f"""
, r AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, field_idx) AS rn,
               count(*) OVER (PARTITION BY image_id) AS n_candidates FROM scored)
SELECT image_id, field AS best_field, round(score, 4) AS best_score, n_candidates, score > {THRESHOLD} AS above
FROM r WHERE rn = 1
""")
def best_caption(spark, sf):
    return SC.best_caption(_scored(spark, sf), "image_id", threshold=THRESHOLD).withColumn("best_score", F.round("best_score", 4))


@register("score_softmax", oracle=_SCORED_SQL + f"""
, z AS (SELECT image_id, field,
               exp(score * {SCALE} - max(score * {SCALE}) OVER (PARTITION BY image_id)) AS e FROM scored)
SELECT image_id, field, round(e / sum(e) OVER (PARTITION BY image_id), 4) AS prob FROM z
""")
def score_softmax(spark, sf):
    s = SC.softmax(_scored(spark, sf), "image_id", scale=SCALE)
    return s.select("image_id", "field", F.round("prob", 4).alias("prob"))


@register("scores_wide", oracle=_SCORED_SQL + "SELECT image_id, " + ", ".join(
    f"round(max(score) FILTER (WHERE field = {S.q(f)}), 4) AS {f}" for f in SC.CAPTION_FIELDS) + " FROM scored GROUP BY image_id")
def scores_wide(spark, sf):
    return SC.scores_wide(_scored(spark, sf), "image_id")


TOP_K = 2


@register("top2_captions", oracle=_SCORED_SQL + f"""
, r AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, field_idx) AS rank FROM scored)
SELECT image_id, field, round(score, 4) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= {TOP_K}
""")
def top2_captions(spark, sf):
    """Top-k report per image (the limit is the feature); ties by field order."""
    t = SC.top_k(_scored(spark, sf), "image_id", "score", k=TOP_K, tie="field_idx")
    return t.select("image_id", "field", F.round("score", 4).alias("score"), "rank")


@register("scores_map", oracle=_SCORED_SQL + "SELECT image_id, string_agg(field || '=' || printf('%.4f', score), ';' "
          "ORDER BY field_idx) AS scores FROM scored GROUP BY image_id")
def scores_map(spark, sf):
    """Scores of an image as a map by field, written in field order."""
    from capset.operators.samples import scores_map as as_map

    m = as_map(_scored(spark, sf), "image_id")
    present = F.filter(F.array(*[F.lit(f) for f in SC.CAPTION_FIELDS]), lambda f: F.map_contains_key("scores", f))
    text = F.transform(present, lambda f: F.format_string("%s=%.4f", f, F.element_at("scores", f)))
    return m.select("image_id", F.array_join(text, ";").alias("scores"))


_WIDE = {"section_title": "lang", "caption_reference_description": "source", "context_page_description": "text"}


@register("candidates", oracle=f"""
SELECT doc_id, field_idx, field, md5(text) AS text_md5, length(text) >= 3 AS long_enough FROM (
  SELECT doc_id, 0 AS field_idx, 'section_title' AS field, nullif(lang, 'en') AS text FROM documents UNION ALL
  SELECT doc_id, 1, 'caption_reference_description', source FROM documents UNION ALL
  SELECT doc_id, 2, 'context_page_description', text FROM documents) WHERE text IS NOT NULL
""")
def candidates(spark, sf):
    """Wide caption columns unpivoted; nulls go, positions stay."""
    d = load(spark, sf, "documents").select("doc_id", F.nullif("lang", F.lit("en")).alias("section_title"), F.col("source").alias(
        "caption_reference_description"), F.col("text").alias("context_page_description"))
    c = SC.candidates(d, "doc_id", cols=list(_WIDE))
    return c.select("doc_id", "field_idx", "field", F.md5("text").alias("text_md5"), (F.length("text") >= 3).alias("long_enough"))
