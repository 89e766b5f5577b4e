"""Samples for shards: field selection and naming, image paths, score maps, run metrics."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F



def to_samples(df: DataFrame, mapping: dict, key: str = "key", use_encoder: bool = False) -> DataFrame:
    """``{column: field}`` -> sample columns; with ``use_encoder`` a field ``image.pyd`` keeps its
    suffix (``--keep_keys 'image.pyd,label.cls'``), otherwise only the part before the dot.

    ``mapping`` may also be the reference's comma string ``'image.pyd,label.cls'``.
    """
    if isinstance(mapping, str):
        mapping = {k.split(".")[0]: k for k in mapping.split(",") if k}
    cols = [F.col(key).alias("key")]
    for src, field in mapping.items():
        name = field if use_encoder else field.split(".")[0]
        cols.append(F.col(src).alias(name))
    return df.select(*cols)


def image_text_keys(spec: str = "img,cap") -> tuple[str, str]:
    """Parse ``'img,cap'``; exactly two keys (the reference's assertion)."""
    keys = spec.split(",")
    if len(keys) != 2:
        raise ValueError("exactly two keys: image,text")
    return keys[0], keys[1]


# --- fixed values: split -> image folder of the downsampled label dataset ---------------------
SPLIT_DIRS = {"validation": "validation/", "train": "train-256/", "test": "test/"}
# ------------------------------------------------------------------------------------------------


def image_path(split, image_id, root: str = "images/256px/",
               split_dirs: dict = SPLIT_DIRS) -> Column:
    """``root + dir(split) + id + '.jpg'``; unknown splits give the root folder."""
    split_c = F.col(split) if isinstance(split, str) else split
    id_c = F.col(image_id) if isinstance(image_id, str) else image_id
    m = F.create_map(*[x for k, v in split_dirs.items() for x in (F.lit(k), F.lit(v))])
    return F.concat(F.lit(root), F.coalesce(F.element_at(m, split_c), F.lit("")), id_c, F.lit(".jpg"))


def scores_map(scored: DataFrame, image: str, field: str = "field", value: str = "score",
               decimals: int = 4) -> DataFrame:
    """``{field: round(score, 4)}`` per image (a handful of entries per image)."""
    entry = F.struct(F.col(field), F.round(F.col(value), decimals))
    return scored.groupBy(image).agg(F.map_from_entries(F.collect_list(entry)).alias("scores"))


def generate_captions(df: DataFrame, ds_name: str, templates_by_name: dict, labels: str = "labels",
                      key: str = "image_id", seed: int = 0) -> DataFrame:
    """Captions for a named dataset whose images have one flat label list: a seeded template for each row, the
    labels joined by ``', '`` in the place of its braces.  ``templates_by_name`` maps a name to a
    sequence of templates; a name it lacks raises on the driver."""
    from capset.functions.hashing import seeded_bucket
    from capset.functions.text import collapse_lower

    try:
        own = tuple(templates_by_name[ds_name])
    except KeyError:
        raise ValueError(f"no templates for {ds_name!r}; there are some for: {', '.join(sorted(templates_by_name))}") from None
    pick = (seeded_bucket(key, seed, len(own)) + 1).cast("int")
    chosen = F.element_at(F.array(*map(F.lit, own)), pick)
    caption = F.replace(chosen, F.lit("{}"), F.array_join(labels, ", "))
    return df.withColumns({"caption": collapse_lower(caption),
                           "caption_key": F.concat(F.lit(f"{ds_name}_"), F.col(key).cast("string"))})



def run_metrics(df: DataFrame, name: str = "run", duplicate: str | None = None,
                action: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach counters that are filled while the job runs (``DataFrame.observe``): rows and,
    when given, duplicates / discarded / resized.  Read ``obs.get`` after the action."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if duplicate:
        metrics.append(F.count_if(F.col(duplicate)).alias("duplicates"))
    if action:
        metrics.append(F.count_if(F.col(action) == "discard").alias("discarded"))
        metrics.append(F.count_if(F.col(action) == "resize").alias("resized"))
    return df.observe(obs, *metrics), obs


def timed(action) -> tuple[object, float]:
    """Run ``action()`` and return its result and the elapsed seconds (AGG-12)."""
    t0 = time.perf_counter()
    out = action()
    return out, time.perf_counter() - t0
