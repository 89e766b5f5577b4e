"""Label annotations to captions: labels per image, label names, split report, templates,
narrative override and last-wins merge of splits.

Scale notes
-----------
* ``labels_per_image`` first aggregates ``(image, certain, label)`` with a map-side partial
  aggregate, so an image with millions of annotation rows collapses to one row per distinct
  label before anything is shuffled; the per-image list is then bounded by the label
  vocabulary, never by the number of rows.  A name is listed once, in first-seen order, and its number of
  annotations beside it (``certain_counts``/``uncertain_counts``); ``repeats=True`` lists every row.
* Label names are a dictionary; whether it is broadcast is left to the planner, which knows its size.
* ``override_captions`` splits the left join into an inner join (AQE can split a skewed key on
  either side) plus an anti join against *distinct* narrative keys.
* ``last_wins_union`` is a ``max_by`` aggregate, which is partial-aggregated map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capset.functions.hashing import seeded_bucket, seeded_unit
from capset.functions.text import collapse_lower


def maybe_templates(templates, endings) -> tuple[str, ...]:
    """Every template with every ending."""
    return tuple(t + e for e in endings for t in templates)


def with_label_names(df: DataFrame, dictionary: DataFrame, code: str = "code", name: str = "name",
                     on_unknown: str = "count") -> DataFrame:
    """Look up label names.  Unknown codes keep the code as name and ``unknown = true``;
    ``on_unknown='drop'`` removes them, ``'error'`` raises on the driver if any exists."""
    d = dictionary.select(F.col(code).alias("_code"), F.col(name).alias("_name")).dropDuplicates(["_code"])
    out = df.join(d, df[code] == F.col("_code"), "left")
    out = out.withColumn("unknown", F.col("_code").isNull()) \
             .withColumn(name, F.coalesce(F.col("_name"), F.col(code))).drop("_code", "_name")
    if on_unknown == "drop":
        return out.where(~F.col("unknown"))
    if on_unknown == "error":
        bad = out.where(F.col("unknown")).select(code).limit(5).collect()
        if bad:
            raise KeyError(f"unknown label codes, e.g. {[r[0] for r in bad]}")
    return out


def labels_per_image(df: DataFrame, image: str = "image_id", label: str = "label",
                     confidence: str = "confidence", order: str = "order", certain: Column | None = None,
                     dictionary: DataFrame | None = None, repeats: bool = False) -> DataFrame:
    """One row per image: certain / uncertain label lists (first-seen order), their counts, totals.

    ``certain`` defaults to ``confidence == 1``.  With a ``dictionary(code, name)`` the codes are
    replaced by names (unknown codes kept and counted in ``n_unknown``).  ``repeats=True`` gives each
    annotation row its own entry, in row order: an image's list is then as long as its rows are many.
    """
    cert = certain if certain is not None else (F.col(confidence) == 1)
    rows = df.select(F.col(image).alias("image_id"), F.col(label).alias("code"), cert.alias("certain"),
                     F.col(order).alias("_first"), F.lit(1).cast("long").alias("_n"))
    per = rows if repeats else rows.groupBy("image_id", "certain", "code").agg(
        F.min("_first").alias("_first"), F.sum("_n").alias("_n"))
    if dictionary is not None:
        per = with_label_names(per, dictionary, "code", "name")
    else:
        per = per.withColumn("name", F.col("code")).withColumn("unknown", F.lit(False))
    sure, unsure = F.col("certain"), ~F.col("certain")
    entry = F.struct("_first", "name", "_n")

    def listed(kind: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(kind, entry)))

    def total(kind: Column) -> Column:
        return F.coalesce(F.sum(F.when(kind, F.col("_n"))), F.lit(0)).cast("long")

    unknown = F.collect_set(F.when(F.col("unknown"), F.struct("certain", "code")))
    out = per.groupBy("image_id").agg(
        listed(sure).alias("_c"), listed(unsure).alias("_u"), total(sure).alias("n_certain"),
        total(unsure).alias("n_uncertain"), F.size(unknown).cast("long").alias("n_unknown"))
    return out.select(
        "image_id", F.col("_c.name").alias("certain_labels"), F.col("_u.name").alias("uncertain_labels"),
        F.col("_c._n").alias("certain_counts"), F.col("_u._n").alias("uncertain_counts"),
        "n_certain", "n_uncertain", "n_unknown")


def flag_dropped(per_image: DataFrame, files: DataFrame | None = None, path: str = "path") -> DataFrame:
    """``dropped`` = no certain label, or (with a file listing) no image file at ``path``.
    Dropped images stay in the output, as in the reference."""
    no_label = F.size("certain_labels") == 0
    if files is None:
        return per_image.withColumn("dropped", no_label)
    present = files.select(F.col(path).alias("_p")).distinct().withColumn("_exists", F.lit(True))
    j = per_image.join(present, per_image[path] == F.col("_p"), "left")
    return j.withColumn("dropped", no_label | F.col("_exists").isNull()).drop("_p", "_exists")


def count_images(df: DataFrame, image: str = "image_id", approx: bool = False) -> DataFrame:
    agg = F.approx_count_distinct(image) if approx else F.count_distinct(image)
    return df.agg(agg.alias("n_images"))


#: Registers of a sketch, as a power of two, and three standard errors of its estimates.
SKETCH_BITS = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def image_sketches(df: DataFrame, by: list[str], image: str = "image_id", bits: int = SKETCH_BITS) -> DataFrame:
    """A mergeable sketch of the images of each group (``sketch``, some kB): kept beside the data, it is never counted again."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(image), F.lit(bits)).alias("sketch"))


def count_sketched(sketches: DataFrame, by: list[str]) -> DataFrame:
    """About how many images groups of sketches hold together, to within ``SKETCH_ERROR`` of their number almost always."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"))


def label_row_parts(df: DataFrame, image: str = "image_id", label: str = "label", order: str = "order", size: int | None = None) -> DataFrame:
    """``image_id, part, n, labels``: every annotation row's label in row order, at most ``size`` in a list.

    The form of ``labels_per_image(repeats=True)`` for images with any number of rows."""
    from capset.operators.groups import LIST_ROWS, chunked_lists

    lists = chunked_lists(df.select(F.col(image).alias("image_id"), label, order), "image_id", label, [order], size or LIST_ROWS)
    return lists.withColumnRenamed("list", "labels")


def split_report(per_image: DataFrame, split: str = "split", dropped: str = "dropped") -> DataFrame:
    """Samples and dropped per split plus a ``total`` row (``rollup``)."""
    r = per_image.rollup(split).agg(F.count(F.lit(1)).alias("num_samples"),
                                    F.count_if(F.col(dropped)).cast("long").alias("dropped"))
    return r.select(F.coalesce(F.col(split), F.lit("total")).alias(split), "num_samples", "dropped")


def render_captions(per_image: DataFrame, templates, endings, seed: int = 0, key: str = "image_id",
                    strict: bool = True, p_maybe: float = 0.5) -> DataFrame:
    """Caption from a template: the "maybe" branch with probability ``p_maybe`` (seeded by key),
    then a seeded template; white space collapsed, lower-cased.

    ``templates`` hold ``{certain}`` where the certain labels go; the "maybe" branch takes a
    template with one of the ``endings``, which hold ``{maybe}`` for the uncertain ones.  Both are
    the caller's (any sequence of strings, as read from a file or table).

    ``strict=True`` takes the maybe branch only when uncertain labels exist; ``strict=False``
    follows the reference and may render an empty uncertain list.
    """
    templates, endings = tuple(templates), tuple(endings)
    maybe = maybe_templates(templates, endings)
    certain = F.array_join("certain_labels", ", ")
    uncertain = F.array_join("uncertain_labels", ", ")
    draw = seeded_unit(key, seed)
    use_maybe = draw > F.lit(1.0 - p_maybe)
    if strict:
        use_maybe = use_maybe & (F.size("uncertain_labels") > 0)
    t_plain = F.element_at(F.array(*[F.lit(t) for t in templates]),
                           (seeded_bucket(key, seed, len(templates)) + 1).cast("int"))
    t_maybe = F.element_at(F.array(*[F.lit(t) for t in maybe]),
                           (seeded_bucket(key, seed, len(maybe)) + 1).cast("int"))
    tmpl = F.when(use_maybe, t_maybe).otherwise(t_plain)
    filled = F.replace(F.replace(tmpl, F.lit("{certain}"), certain), F.lit("{maybe}"), uncertain)
    return per_image.withColumn("used_maybe", use_maybe).withColumn("caption", collapse_lower(filled))


def append_all(*dfs: DataFrame) -> DataFrame:
    """Append inputs (columns matched by name, missing ones null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def last_wins(df: DataFrame, key: str, input_col: str, order: str | None = None) -> DataFrame:
    """Of the rows of a key, the one of the largest ``input_col`` (and of these, of the largest ``order``):
    one scan where the inputs are told apart by a column."""
    rank = F.struct(F.col(input_col), F.col(order)) if order else F.col(input_col)
    cols = [c for c in df.columns if c != key]
    winner = F.max_by(F.struct(*[F.col(c) for c in cols]), rank).alias("_w")
    return df.groupBy(key).agg(winner).select(key, *[F.col("_w")[c].alias(c) for c in cols])


def last_wins_union(dfs, key: str, order: str | None = None) -> DataFrame:
    """Union by key where a later input wins (and within one input the largest ``order``)."""
    tagged = [d.withColumn("_input", F.lit(i)) for i, d in enumerate(dfs)]
    return last_wins(append_all(*tagged), key, "_input", order).withColumnRenamed("_input", "input")


def override_captions(df: DataFrame, narratives: DataFrame, on: str, caption: str = "caption",
                      narrative: str = "narrative", dedupe: str | None = None,
                      order: str | None = None) -> DataFrame:
    """Narratives replace captions; several narratives of one key fan out (one row each).

    ``dedupe='last'`` keeps only the narrative with the largest ``order`` per key.
    Result columns: those of ``df`` with ``caption`` replaced, plus ``from_narrative`` and the
    narrative's ``order`` column when given.
    """
    n = narratives
    if dedupe == "last":
        if order is None:
            raise ValueError("dedupe='last' needs order=")
        n = n.groupBy(on).agg(F.max_by(F.struct(F.col(narrative), F.col(order)), F.col(order)).alias("_l")) \
             .select(on, F.col("_l")[narrative].alias(narrative), F.col("_l")[order].alias(order))
    keep = [on, narrative] + ([order] if order else [])
    n = n.select(*keep)
    hit = df.join(n, on, "inner") \
            .withColumn(caption, F.col(narrative)).withColumn("from_narrative", F.lit(True)).drop(narrative)
    keys = n.select(on).distinct()
    miss = df.join(keys, on, "left_anti").withColumn("from_narrative", F.lit(False))
    if order:
        miss = miss.withColumn(order, F.lit(None).cast(n.schema[order].dataType))
    return hit.unionByName(miss)
