"""End-to-end jobs, one per workflow of the reference scripts, composed from the operators.

Each job takes paths and the reference's parameters (same defaults) and runs as Spark jobs:

* ``shards_from_folder``   folder of image/text(/json) files -> tar shards
* ``shards_from_tfrecords`` TFRecord files -> duplicate removal -> size rule -> tar shards + run report
* ``captions_from_manifest`` wide manifest -> language filter -> caption clean-up -> resume -> captions by folder
* ``captions_from_labels``  label annotations (+ narratives) -> template captions per image
* ``vocabulary_from_shards`` tar shards or text files -> character coverage, word counts, BPE merges
* ``check_folder``          pair check and fault report of a dataset folder
* ``score_candidates``      caption candidates vs. image embeddings -> similarity table, best caption
* ``done_in_folder``        ids already written (text and image present) for resuming
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capset.functions import ids as I
from capset.functions import text as T
from capset.operators import dedup as D
from capset.operators import labels as L
from capset.operators import pairs as P
from capset.operators import resume as RS
from capset.operators import rows as R
from capset.operators import samples as SM
from capset.operators import vocab as V
from capset.operators.filters import filter_language
from capset.sinks import check_bounds, write_captions, write_captions_json, write_tar_shards
from capset.sources import files as FS
from capset.sources import manifests as M

# --- fixed values: defaults of the reference's command-line options --------------------------
TFRECORD_FEATURES = ("sampleID binary, image binary, format binary, label binary, "
                     "height bigint, width bigint")
# -----------------------------------------------------------------------------------------------


def shards_from_folder(spark: SparkSession, data: str, shards: str, maxsize: float = 1e9,
                       maxcount: float = 100000, image_text_keys: str = "img,cap", json: bool = False,
                       shard_prefix: str = "ds_", compression: bool = False, seed: int = 0,
                       scope: str = "folder") -> DataFrame:
    """Pairs of ``<stem>.txt`` and ``<stem>.{png,jpg,jpeg,bmp}`` (valid images only), optional
    ``<stem>.json`` sidecars, keys ``%09d`` in pair order, written in seeded random order.

    Returns the one-row count report (texts, images, pairs, invalid images, written samples).
    """
    check_bounds(maxsize, maxcount)
    img_key, cap_key = SM.image_text_keys(image_text_keys)
    files = FS.scan_files(spark, data)
    profiles = FS.image_profiles(spark, data).select(F.col("path").alias("img_path"), "valid")
    images = P.by_extension(files, P.IMAGE_EXTS)
    texts = P.by_extension(files, ["txt"])
    length = files.select(F.col("path").alias("_p"), F.col("length").alias("_n"))
    paired = P.pair(images, texts, scope).select("folder", "stem", "img_path", "txt_path") if scope == "folder" \
        else P.pair(images, texts, scope).select(F.lit("").alias("folder"), "stem", "img_path", "txt_path")
    paired = R.materialize(paired.join(profiles, "img_path", "left").withColumn("valid", FS.profiled("valid", "img_path")))
    # everything up to the write works on paths and lengths: positions, seeded order, shards
    valid = paired.where("valid")
    keys = ["folder", "stem"]
    numbered = R.dense_positions(valid.orderBy(*keys), "pos").withColumn("key", I.pad_id("pos", 9))
    cols = ["key", img_key, cap_key]
    samples = numbered.withColumns({img_key: F.col("img_path"), cap_key: F.col("txt_path")})
    if json:
        side = FS.scan_sidecars(spark, data).where(~F.col("corrupt")).select("folder", "stem", "json")
        if scope != "folder":
            side = side.groupBy("stem").agg(F.max("json").alias("json")).withColumn("folder", F.lit(""))
        samples = P.with_sidecar(samples, side, on=keys)
        cols.append("json")
    for side, name in (("img_path", "_img_n"), ("txt_path", "_txt_n")):
        samples = samples.join(length.withColumnsRenamed({"_p": side, "_n": name}), side)
    ordered = samples.select(*cols, (F.col("_img_n") + F.col("_txt_n")).alias("_bytes")).orderBy(
        F.md5(F.concat(F.col("key"), F.lit(str(seed)))))
    write_tar_shards(R.dense_positions(ordered, "row_id"), shards, maxcount=int(maxcount), maxsize=maxsize, prefix=shard_prefix,
                     compression="gzip" if compression else None, check=False, packing="prefix", size_col="_bytes",
                     path_fields=[img_key, cap_key])
    counts = P.pair_counts(files.withColumn("valid", F.lit(True)), scope)
    invalid, written = profiles.where(~F.col("valid")).count(), valid.count()
    return counts.select("texts", "images", "pairs", F.lit(invalid).alias("invalid_images"),
                         F.lit(written).alias("written"))


def shards_from_tfrecords(spark: SparkSession, data: str, shards: str, features: str | None = TFRECORD_FEATURES,
                          keep_keys: str = "image.pyd,label.cls", use_encoder: bool = False,
                          remove_duplicates: str = "image", min_max_size: str = "192,320",
                          maxsize: float = 1e9, maxcount: float = 100000, shard_prefix: str = "wds_",
                          compression: bool = False) -> DataFrame:
    """TFRecord examples -> first copy per ``md5(remove_duplicates)`` (in file order, before the
    size rule) -> discard / resize / keep by ``min_max_size`` -> kept keys -> tar shards.

    ``features`` is the schema, or None to infer it from the first record; an empty ``keep_keys`` keeps all
    fields.  Sample keys are ``%09d`` of the running record number (gaps where records were
    skipped).  Images are not scaled here: samples beyond the size get a field ``resize_to`` (``WxH``).
    Returns the run report (total, duplicates, discarded, to_resize, remaining).
    """
    from capset.sources import tfrecord

    check_bounds(maxsize, maxcount)
    tfrecord.register(spark)
    ddl = features or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tfrecord.infer_schema(data).fields)
    df = spark.read.format("tfrecord").schema(f"{ddl}, _file string, _index bigint").load(data)
    names = [c for c in df.columns if c not in ("_file", "_index")]
    # one decode decides everything; what it needs of a record is narrow and written down
    content = F.md5(F.col(remove_duplicates).cast("binary")) if remove_duplicates else F.lit(None).cast("string")
    sides = [F.col(c).cast("long").alias(c) if c in names else F.lit(None).cast("long").alias(c) for c in ("width", "height")]
    narrow = R.materialize(df.select("_file", "_index", content.alias("_md5"), *sides))
    narrow = R.with_row_id_from(narrow, "_file", "_index")
    narrow = D.flag_duplicates(narrow, "_md5", "row_id") if remove_duplicates else narrow.withColumn("is_duplicate", F.lit(False))
    if min_max_size:
        lo, hi = (int(x) for x in min_max_size.split(","))
        narrow = D.apply_size_rule(narrow, "width", "height", lo, hi)
        target = F.when(F.col("action") == "resize", F.concat_ws("x", "new_width", "new_height"))
    else:
        narrow, target = narrow.withColumn("action", F.lit("keep")), F.lit(None).cast("string")
    decided = R.materialize(narrow.withColumn("resize_to", target).select(
        "_file", "_index", "row_id", "is_duplicate", "action", "resize_to"))
    kept = decided.where(~F.col("is_duplicate") & (F.col("action") != "discard"))
    wanted = {k.split(".")[0]: k for k in keep_keys.split(",") if k} or {n: n for n in names}
    if missing := set(wanted) - set(names):
        raise ValueError(f"fields to keep that the records lack: {sorted(missing)}")
    again = df.select("_file", "_index", *[_raw(df, c).alias(c) for c in wanted])
    sized = again.join(kept, ["_file", "_index"]).withColumn("key", I.pad_id("row_id", 9))
    nbytes = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in wanted), F.lit(0))
    dense = R.dense_positions(kept.select("_file", "_index", "row_id").orderBy("row_id"), "_dense").select("_file", "_index", "_dense")
    samples = SM.to_samples(sized.join(dense, ["_file", "_index"]).withColumn("_bytes", nbytes), wanted | {
        "resize_to": "resize_to", "_dense": "row_id", "_bytes": "_bytes"}, use_encoder=use_encoder)
    write_tar_shards(samples, shards, maxcount=int(maxcount), maxsize=maxsize, prefix=shard_prefix,
                     compression="gzip" if compression else None, check=False, packing="prefix", size_col="_bytes")
    return D.run_report(decided)


def _raw(df: DataFrame, name: str):
    """A field's bytes: numbers and lists as text."""
    kind = dict(df.dtypes)[name]
    c = F.col(name)
    if kind == "binary":
        return c
    return F.encode(F.to_json(F.struct(c.alias("v"))) if kind.startswith("array") else c.cast("string"), "UTF-8")


def captions_from_manifest(spark: SparkSession, path: str, out: str | None = None, languages=("en",),
                           tag: str | None = "English:", per_folder: int = 50000, ledger: str | None = None,
                           folder_width: int = 5, done_folder: str | None = None) -> DataFrame:
    """Wide manifest -> languages -> caption (reference + attribution + alt text) cleaned ->
    ``English:`` lines kept -> pending rows -> ``(key, folder, caption, url)``.

    Pending = not done in the ``ledger`` table and, with ``done_folder``, not already present
    there as a text *and* an image file of the same id.  Written partitioned by folder when
    ``out`` is given."""
    df = M.read_wide_manifest(spark, path)
    df = filter_language(df, languages)
    caption = T.clean_caption(T.build_caption("caption_reference_description", "caption_attribution_description",
                                              "caption_alt_text_description"))
    if tag:
        caption = T.english_segment(caption, tag)
    res = df.select("row_id", I.pad_id("row_id", 9).alias("key"),
                    I.batch_name("row_id", per_folder, folder_width).alias("folder"),
                    caption.alias("caption"), F.col("image_url").alias("url"),
                    I.media_kind("image_url").alias("media_kind"))
    if ledger:
        res = RS.pending(res, RS.done_and_failed(spark.read.parquet(ledger)))
    if done_folder:
        res = RS.pending(res, done_in_folder(spark, done_folder))
    if out:
        write_captions(res, out)
    return res


def done_in_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Ids whose text and image file both exist below ``folder`` (``<id>.txt`` + ``<id>.jpg`` ...)."""
    files = FS.scan_files(spark, folder, exts=["txt"] + list(P.IMAGE_EXTS))
    ids = files.select(I.file_number("path").alias("row_id"), (F.col("ext") == "txt").alias("_t")) \
               .where(F.col("row_id").isNotNull())
    per_id = ids.groupBy("row_id").agg(F.bool_or("_t").alias("t"), F.bool_or(~F.col("_t")).alias("i"))
    return per_id.where("t AND i").select("row_id")


def captions_from_labels(spark: SparkSession, annotations: dict, dictionary: str, templates, endings, narratives=None,
                         images: str | None = None, out: str | None = None, seed: int = 0, image_root: str = "images/256px/",
                         split_order=("validation", "train", "test")) -> DataFrame:
    """Label annotation CSVs per split -> labels per image (certain = confidence 1, repeats kept) with names ->
    template captions -> narratives replace captions -> one row per image, later splits win.

    ``templates`` and ``endings``: see ``labels.render_captions``.  With ``images`` (the folder that holds
    ``image_root``) images without a file count as dropped.  Of several narratives of an image the last
    one in the order of the files given, then of their lines, is taken."""
    ann = M.read_annotations(spark, annotations)
    names = M.read_dictionary(spark, dictionary)
    present = None if images is None else FS.scan_files(spark, images).select(F.col("rel").alias("path"))
    per_split = []
    for split in split_order:
        if split not in annotations:
            continue
        a = ann.where(F.col("split") == split)
        per = L.labels_per_image(a, image="ImageID", label="LabelName", confidence="Confidence",
                                 order="order", dictionary=names, repeats=True)
        per = per.withColumn("path", SM.image_path(F.lit(split), "image_id", image_root))
        per = L.flag_dropped(per, present)
        caps = L.render_captions(per, templates, endings, seed=seed)
        per_split.append(caps.select("image_id", "path", "caption", "dropped"))
    merged = L.last_wins_union(per_split, key="image_id")
    if narratives:
        n = M.read_narratives(spark, narratives, order="_n_order")
        merged = L.override_captions(merged, n, on="image_id", dedupe="last", order="_n_order") \
                  .drop("_n_order")
    res = merged.select("image_id", "path", "caption", "dropped")
    if out:
        write_captions_json(res, out)
    return res


def vocabulary_from_shards(spark: SparkSession, source: str, text_key: str = "label", coverage: float = 0.9999,
                           vocab_size: int = 4096, output_folder: str | None = None
                           ) -> tuple[DataFrame, DataFrame]:
    """Texts of tar shards (field ``text_key``, HTML entities decoded) or ``.txt`` files ->
    ``(vocab(token, id), merges(rank, left, right, freq))``."""
    from capset.sources import tarshard

    if not source.lower().endswith(".txt") and tarshard._list_shards(source):
        tarshard.register(spark)
        shards = spark.read.format("tarshard").schema(f"key string, `{text_key}` binary").load(source)
        texts = shards.select(T.html_unescape(T.decode_utf8(F.col(text_key))).alias("text")) \
                      .where(F.col("text").isNotNull())
    else:
        texts = M.read_corpus(spark, source).select("text")
    alpha = V.alphabet(texts, coverage=coverage).cache()
    n_chars = alpha.where("kept").count()
    merges = V.bpe_merges(V.word_freq(texts), max(0, vocab_size - n_chars))
    vocab = V.vocabulary(merges, alpha)
    if output_folder:
        from capset.sinks import write_vocabulary

        write_vocabulary(vocab, merges, output_folder)
    return vocab, merges


def score_candidates(spark: SparkSession, images: DataFrame, captions: DataFrame, out: str | None = None,
                     save_embeddings: str | None = None, threshold: float = 0.3, key: str = "row_id"
                     ) -> tuple[DataFrame, DataFrame]:
    """Caption candidates scored against their image.

    ``images(row_id, embedding)`` and ``captions(row_id, field, embedding)`` (one row per
    non-null candidate field) -> wide similarity table (one column per field, rounded to 4,
    sorted by id when written as TSV to ``out``) and the best caption per image (ties to the
    earlier field, ``above`` = best score > ``threshold``).  ``save_embeddings`` writes the image
    vectors as Parquet, 5,000 per file.
    """
    from capset.operators import scoring as SC
    from capset.sinks import write_embeddings, write_similarities

    order = F.array_position(F.array(*[F.lit(f) for f in SC.CAPTION_FIELDS]), F.col("field")) - 1
    cands = captions.select(key, "field", order.alias("field_idx"), F.col("embedding").alias("text_vec"))
    imgs = images.select(key, F.col("embedding").alias("image_vec"))
    scored = SC.score(imgs, cands, key).select(key, "field", "field_idx", "score")
    wide = SC.scores_wide(scored, key)
    best = SC.best_caption(scored, key, threshold=threshold)
    if out:
        write_similarities(wide, out, key)
    if save_embeddings:
        write_embeddings(images.select(key, "embedding"), save_embeddings)
    return wide, best


def check_folder(spark: SparkSession, dataset_folder: str, min_characters: int = 5,
                 output_file: str | None = None) -> DataFrame:
    """Pair check of a dataset folder: per folder the incomplete, corrupt, empty and to-delete
    files (nothing is deleted)."""
    from capset.sinks import write_fault_report

    report = P.fault_report(FS.file_tree(spark, dataset_folder), int(min_characters))
    if output_file:
        write_fault_report(report, output_file)
    return report
