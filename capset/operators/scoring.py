"""Caption scoring from embeddings: candidates, similarity, softmax, best caption, wide table.

The reference runs an image/text model per row; here image and caption embeddings are columns,
and the work is a join of each image with its own candidates (a handful of rows per image) plus
JVM-side vector arithmetic.  Windows are partitioned by image, so a window never holds more
than one image's candidates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capset.functions.vectors import cosine

# --- fixed values: the seven caption fields scored per image, in field order ----------------
CAPTION_FIELDS = (
    "section_title",
    "hierarchical_section_title",
    "caption_reference_description",
    "caption_attribution_description",
    "caption_alt_text_description",
    "context_page_description",
    "context_section_description",
)
# ---------------------------------------------------------------------------------------------


def candidates(df: DataFrame, key: str, cols=CAPTION_FIELDS) -> DataFrame:
    """Wide caption columns to long ``(key, field_idx, field, text)``; null candidates dropped,
    positions kept (``stack``)."""
    args = ", ".join(f"{i}, '{c}', `{c}`" for i, c in enumerate(cols))
    long = df.selectExpr(f"`{key}`", f"stack({len(cols)}, {args}) AS (field_idx, field, text)")
    return long.where(F.col("text").isNotNull())


def score(images: DataFrame, cands: DataFrame, on: str, image_vec: str = "image_vec",
          text_vec: str = "text_vec") -> DataFrame:
    """Cosine similarity of each image with each of its candidates.  Not rounded: ranks and softmax need the
    whole value; round what is written (``scores_wide``, ``scores_map``)."""
    return images.join(cands, on).withColumn("score", cosine(image_vec, text_vec))


def softmax(scored: DataFrame, image: str, value: str = "score", scale: float = 100.0,
            name: str = "prob") -> DataFrame:
    """Softmax of ``scale * value`` over the candidates of one image (numerically stable)."""
    w = Window.partitionBy(image)
    z = F.col(value) * F.lit(scale)
    e = F.exp(z - F.max(z).over(w))
    return scored.withColumn(name, e / F.sum(e).over(w))


def best_caption(scored: DataFrame, image: str, field: str = "field", field_idx: str = "field_idx",
                 value: str = "score", threshold: float | None = None) -> DataFrame:
    """Top candidate per image; ties go to the earlier field.  ``threshold`` adds ``above``."""
    best = F.max_by(F.struct(F.col(field), F.col(value)), F.struct(F.col(value), -F.col(field_idx)))
    out = scored.groupBy(image).agg(best.alias("_b"), F.count(F.lit(1)).alias("n_candidates"))
    out = out.select(image, F.col("_b")[field].alias("best_field"), F.col("_b")[value].alias("best_score"),
                     "n_candidates")
    if threshold is not None:
        out = out.withColumn("above", F.col("best_score") > F.lit(threshold))
    return out


def top_k(scored: DataFrame, group: str, value: str, k: int = 1, tie: str | None = None,
          salts: int = 32) -> DataFrame:
    """Rows ranked ``<= k`` within their group (a top-k report; the limit is the feature).

    Two stages, so a hot group never sits in one task: rows are first ranked inside
    ``(group, salt)`` (salt = a hash of the row, ``salts`` ways) keeping ``k`` per salt, then the
    at most ``k * salts`` survivors of a group are ranked again.  Exact: a row among a group's
    top ``k`` is also among the top ``k`` of its own salt.  Give ``tie`` to make the order total.
    """
    order = [F.col(value).desc()] + ([F.col(tie).asc()] if tie else [])
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in scored.columns]), F.lit(salts))
    first = (scored.withColumn("_tk_salt", salt)
                   .withColumn("_tk_r", F.row_number().over(Window.partitionBy(group, "_tk_salt").orderBy(*order)))
                   .where(F.col("_tk_r") <= k).drop("_tk_salt", "_tk_r"))
    w = Window.partitionBy(group).orderBy(*order)
    return first.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def scores_wide(scored: DataFrame, image: str, field: str = "field", value: str = "score",
                fields=CAPTION_FIELDS, decimals: int = 4) -> DataFrame:
    """One row per image, one column per field, rounded (``pivot`` with the value list given, so no
    extra job discovers the pivot values)."""
    return scored.groupBy(image).pivot(field, list(fields)).agg(F.round(F.first(value), decimals))


def above(df: DataFrame, threshold: float, col: str = "score") -> DataFrame:
    return df.where(F.col(col) > F.lit(threshold))
