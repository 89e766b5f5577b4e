"""Image–text pairs in file trees: pairing by stem, missing sides, per-stem checks, fault
report, optional JSON sidecars.

A *file listing* is a DataFrame with at least ``folder, stem, ext, path`` (see
``capset.sources.files.scan_files``).  The key of a sample is ``(folder, stem)``; the
reference keys by stem only (the last folder silently wins), ``scope='stem'`` restores that.

All per-key work is an aggregate over ``(folder, stem)`` — a handful of files per key — and the
per-folder lists of the fault report are built from already-filtered fault rows, so a folder's
list grows with its *faults*, not with its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------
IMAGE_EXTS = ("jpg", "jpeg", "png", "bmp")
TEXT_EXT = "txt"
# When several images share a stem the reference keeps the last one scanned, scanning
# png, jpg, jpeg, bmp in this order.
SCAN_ORDER = ("png", "jpg", "jpeg", "bmp")
# ------------------------------------------------------------------------------------------


def _keys(scope: str) -> list[str]:
    return ["folder", "stem"] if scope == "folder" else ["stem"]


def by_extension(files: DataFrame, exts, ignore_case: bool = True, col: str = "ext") -> DataFrame:
    c = F.lower(F.col(col)) if ignore_case else F.col(col)
    return files.where(c.isin([e.lower() if ignore_case else e for e in exts]))


def one_file_per_stem(files: DataFrame, scope: str = "folder", ext_order=SCAN_ORDER) -> DataFrame:
    """One image per key: the extension scanned last wins, then the largest path."""
    rank = F.array_position(F.array(*[F.lit(e) for e in ext_order]), F.lower(F.col("ext")))
    cols = [c for c in files.columns if c not in _keys(scope)]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(rank, F.col("path")))
    return files.groupBy(*_keys(scope)).agg(best.alias("_b")) \
                .select(*_keys(scope), *[F.col("_b")[c].alias(c) for c in cols])


def pair(images: DataFrame, texts: DataFrame, scope: str = "folder") -> DataFrame:
    """Inner join of images and texts on the sample key (``img_path``, ``txt_path`` kept)."""
    k = _keys(scope)
    im = one_file_per_stem(images, scope).select(*k, F.col("path").alias("img_path"),
                                                 *[c for c in images.columns if c not in k + ["path", "ext"]])
    tx = texts.groupBy(*k).agg(F.max("path").alias("txt_path"))
    return im.join(tx, k, "inner")


def missing_sides(images: DataFrame, texts: DataFrame, on=("folder", "stem")) -> DataFrame:
    """Full outer join of the *distinct* keys: ``side`` = both / image_only / text_only."""
    on = list(on)
    a = images.select(*on).distinct().withColumn("_img", F.lit(True))
    b = texts.select(*on).distinct().withColumn("_txt", F.lit(True))
    j = a.join(b, on, "full_outer")
    side = (F.when(F.col("_img") & F.col("_txt"), F.lit("both"))
            .when(F.col("_img"), F.lit("image_only")).otherwise(F.lit("text_only")))
    return j.select(*on, side.alias("side"))


def stem_check(files: DataFrame, scope: str = "folder") -> DataFrame:
    """Files per key with ``has_text``, ``has_image`` and ``status`` (paired / incomplete)."""
    is_img = F.lower(F.col("ext")).isin(list(IMAGE_EXTS))
    is_txt = F.lower(F.col("ext")) == TEXT_EXT
    g = files.groupBy(*_keys(scope)).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.bool_or(is_txt).alias("has_text"),
        F.bool_or(is_img).alias("has_image"))
    return g.withColumn("status", F.when(F.col("has_text") & F.col("has_image"), F.lit("paired"))
                        .otherwise(F.lit("incomplete")))


def _fault_flags(files: DataFrame, min_chars: int):
    """Files with per-stem flags (window aggregates over ``(folder, stem)`` -- a handful of
    files per key -- so the listing and the text lengths behind it are read once, no self-join)
    and the four fault conditions per file."""
    img = F.lower(F.col("ext")).isin(list(IMAGE_EXTS))
    txt = F.lower(F.col("ext")) == TEXT_EXT
    w = Window.partitionBy("folder", "stem")
    f = (files.withColumn("_has_t", F.bool_or(txt).over(w))
              .withColumn("_has_i", F.bool_or(img).over(w))
              .withColumn("_short", F.coalesce(F.bool_or(txt & (F.col("text_len") < min_chars)).over(w), F.lit(False)))
              .withColumn("_corrupt", F.coalesce(F.bool_or(img & ~F.col("valid")).over(w), F.lit(False))))
    paired = F.col("_has_t") & F.col("_has_i")
    conds = {
        "incomplete": (~paired, F.col("name")),
        "corrupt": (paired & img & ~F.coalesce(F.col("valid"), F.lit(True)), F.col("name")),
        "empty": (paired & txt & F.col("_short"), F.col("name")),
        "delete": (~paired | ((F.col("_short") | F.col("_corrupt")) & (txt | img)), F.col("path")),
    }
    return f, conds


def fault_rows(files: DataFrame, min_chars: int = 5) -> DataFrame:
    """Faults in long form: ``(folder, kind, file)`` with kind in incomplete / corrupt / empty /
    delete (``file`` is the name, the full path for ``delete``).

    ``files`` needs ``folder, stem, ext, path, name`` plus ``text_len`` (characters of a text
    file, null for others) and ``valid`` (image decodes; null for others).  A stem is paired when
    it has a text and an image; files of unpaired stems are incomplete.  Short texts and corrupt
    images of paired stems are listed, and their text + image files are to be deleted.  The short
    flag is per stem (the reference carries it over to later stems by mistake).
    """
    f, conds = _fault_flags(files, min_chars)
    kinds = F.array(*[F.when(c, F.struct(F.lit(k).alias("kind"), v.alias("file"))) for k, (c, v) in conds.items()])
    out = f.select("folder", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("_k"))
    return out.select("folder", F.col("_k.kind").alias("kind"), F.col("_k.file").alias("file"))


def fault_report(files: DataFrame, min_chars: int = 5) -> DataFrame:
    """Per folder the four sorted lists (the reference's report layout); one scan, one
    aggregate.  Folders without any file have no row; folders whose files are all fine have
    empty lists.

    The lists hold faults only, and a folder holds at most the ids the dataset layout puts in
    one folder (10,000 per folder in the reference's layout), so a list is bounded by that
    capacity.  For trees without such a bound use ``fault_rows`` (long form, no grouping).
    """
    f, conds = _fault_flags(files, min_chars)
    return f.groupBy("folder").agg(
        *[F.sort_array(F.collect_list(F.when(c, v))).alias(k) for k, (c, v) in conds.items()])


def fault_report_parts(files: DataFrame, min_chars: int = 5, size: int | None = None) -> DataFrame:
    """``folder, kind, part, n, files``: the report's lists in parts of at most ``size`` names, for folders of any size."""
    from capset.operators.groups import LIST_ROWS, chunked_lists

    rows = fault_rows(files, min_chars).withColumn("_key", F.to_json(F.struct("folder", "kind")))
    lists = chunked_lists(rows, "_key", "file", ["file"], size or LIST_ROWS)
    key = F.from_json("_key", "folder string, kind string")
    return lists.select(key["folder"].alias("folder"), key["kind"].alias("kind"), "part", "n", F.col("list").alias("files"))


def pair_counts(files: DataFrame, scope: str = "folder") -> DataFrame:
    """One row: texts, images, pairs, incomplete stems, corrupt images (one scan, two aggregates)."""
    img = F.lower(F.col("ext")).isin(list(IMAGE_EXTS))
    txt = F.lower(F.col("ext")) == TEXT_EXT
    per_key = files.groupBy(*_keys(scope)).agg(
        F.count_if(txt).alias("_t"), F.count_if(img).alias("_i"),
        F.count_if(img & ~F.coalesce(F.col("valid"), F.lit(True))).alias("_c"))
    paired = (F.col("_t") > 0) & (F.col("_i") > 0)
    return per_key.agg(
        F.sum("_t").cast("long").alias("texts"),
        F.sum("_i").cast("long").alias("images"),
        F.sum("_c").cast("long").alias("corrupt"),
        F.count_if(paired).cast("long").alias("pairs"),
        F.count_if(~paired).cast("long").alias("incomplete"))


def with_sidecar(pairs: DataFrame, sidecars: DataFrame, on=("folder", "stem"),
                 json_col: str = "json") -> DataFrame:
    """Left join of an optional JSON sidecar, normalised (compact, keys sorted); a corrupt
    sidecar gives ``json = null`` and ``sidecar_corrupt = true``."""
    on = list(on)
    sc = sidecars.select(*on, F.col(json_col).alias("_raw")).groupBy(*on).agg(F.max("_raw").alias("_raw"))
    j = pairs.join(sc, on, "left")
    parsed = F.try_parse_json(F.col("_raw"))
    return (j.withColumn(json_col, F.to_json(parsed))
             .withColumn("sidecar_corrupt", F.col("_raw").isNotNull() & parsed.isNull())
             .drop("_raw"))


def delete_plan(files: DataFrame, min_chars: int = 5) -> DataFrame:
    """Files to delete as rows (nothing is deleted by the library), off the long form of the faults."""
    return fault_rows(files, min_chars).where(F.col("kind") == "delete").select("folder", F.col("file").alias("path"))
