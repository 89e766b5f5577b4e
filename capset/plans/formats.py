"""File formats of the library: whole tables are written to the shared scratch folder and read back.

TFRecord (``sources.tfrecord``), JSON sidecars (``scan_sidecars``), ``image_profiles`` and ``write_vocabulary``
have no query here; pytest covers them on generated files.

The rows that come back go through the library's reader and are held against the table itself.  The
files lie in the session's checkpoint folder, under a name of their own for each run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capset import sinks as K
from capset.operators import pairs as P
from capset.plans import files as FP
from capset.plans import sqltext as S
from capset.plans.registry import load, register
from capset.session import scratch_path
from capset.sources import files as FS
from capset.sources import manifests as M
from capset.sources.images import write_files
from capset.sources.listing import scan_tree


def _flat(c) -> F.Column:
    """A text in one line: line ends become blanks."""
    return F.regexp_replace(c, r"[\r\n]", " ")


_FLAT_SQL = r"regexp_replace({0}, '[\r\n]', ' ', 'g')"


@register("manifest_tsv", oracle=f"""
SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS row_id, CAST(doc_id AS VARCHAR) AS url,
       md5('"' || {_FLAT_SQL.format('text')}) AS caption_md5 FROM documents
""")
def manifest_tsv(spark: SparkSession, sf: str) -> DataFrame:
    """Two columns without a header, quotes inside; row ids in file order."""
    path = scratch_path(spark, "manifest_tsv")
    d = load(spark, sf, "documents").orderBy("doc_id")
    d.select(F.col("doc_id").cast("string"), F.concat(F.lit('"'), _flat("text"))).write.option("sep", "\t").option("escape", '"').csv(path)
    return M.read_manifest(spark, path).select("row_id", "url", F.md5("caption").alias("caption_md5"))


@register("manifest_header", oracle="SELECT CAST(toxic AS VARCHAR) AS toxic, CAST(doc_id AS VARCHAR) AS doc_id FROM labels")
def manifest_header(spark: SparkSession, sf: str) -> DataFrame:
    """Separated by bars, with a header; two of the columns are kept."""
    path = scratch_path(spark, "manifest_header")
    load(spark, sf, "labels").write.option("sep", "|").option("header", True).csv(path)
    return M.read_manifest(spark, path, sep="|", header=True, keep=["toxic", "doc_id"], row_ids=False)


@register("manifest_wide", oracle=f"""
SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS row_id, lang AS language, source AS page_url,
       md5({_FLAT_SQL.format('text')} || '"') AS text_md5, CAST(n_chars AS INTEGER) AS original_height, doc_id % 2 = 0 AS is_main_image
FROM documents
""")
def manifest_wide(spark: SparkSession, sf: str) -> DataFrame:
    """17 typed columns in gzip files with a header, quotes and empty fields; row ids in file order."""
    names = [c.split()[0] for c in M.WIDE_MANIFEST_DDL.split(", ")]
    own = {"language": F.col("lang"), "page_url": F.col("source"), "caption_reference_description": F.concat(_flat("text"), F.lit('"')),
           "original_height": F.col("n_chars"), "is_main_image": F.col("doc_id") % 2 == 0}
    path = scratch_path(spark, "manifest_wide")
    load(spark, sf, "documents").orderBy("doc_id").select(
        *[own.get(n, F.lit(None).cast("string")).cast("string").alias(n) for n in names]).write.option("sep", "\t") \
        .option("header", True).option("escape", '"').option("compression", "gzip").csv(path)
    r = M.read_wide_manifest(spark, path)
    return r.select("row_id", "language", "page_url", F.md5("caption_reference_description").alias("text_md5"), "original_height", "is_main_image")


@register("input_listing", oracle="""
SELECT file, present FROM (SELECT DISTINCT 'lang=' || lang AS file, true AS present FROM documents
UNION ALL SELECT 'lang=xx', false)
""")
def input_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a folder tree listed and held against those that are expected."""
    from capset.operators.resume import missing_inputs

    path = scratch_path(spark, "input_listing")
    load(spark, sf, "documents").select("lang", "doc_id").repartition("lang").write.partitionBy("lang").option("sep", "\t") \
        .option("compression", "gzip").csv(path)
    files = M.list_inputs(spark, path, glob="*.csv.gz", exclude_substring="1percent")
    folder = F.regexp_extract("path", r"(lang=[^/]+)/[^/]+$", 1)
    present = files.select(folder.alias("file")).distinct()
    expected = load(spark, sf, "documents").select(F.concat(F.lit("lang="), "lang").alias("file")).distinct().union(
        spark.sql("SELECT 'lang=xx' AS file"))
    missing = missing_inputs(expected, present, "file").select("file", F.lit(False).alias("present"))
    return missing.union(present.select("file", F.lit(True)))


@register("annotation_csv", oracle="""
SELECT CASE event_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END AS split,
       CAST(row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id) - 1 AS BIGINT) AS "order",
       CAST(user_id AS VARCHAR) AS ImageID, 'Name, ' || event_type AS name, CAST(value >= 100 AS DOUBLE) AS Confidence
FROM events
""")
def annotation_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Label annotations in a file set for each split, their dictionary, names with commas."""
    from capset.operators.labels import with_label_names

    path = scratch_path(spark, "annotation_csv")
    ev = load(spark, sf, "events")
    splits = ("train", "validation", "test")
    for k, split in enumerate(splits):
        ev.where(F.col("event_id") % 3 == k).orderBy("event_id").select(
            F.col("user_id").alias("ImageID"), F.col("event_type").alias("LabelName"),
            (F.col("value") >= 100).cast("double").alias("Confidence")).write.option("header", True).csv(f"{path}/{split}")
    ev.select("event_type", F.concat(F.lit("Name, "), "event_type")).distinct().write.csv(f"{path}/dictionary")
    rows = M.read_annotations(spark, {s: f"{path}/{s}" for s in splits})
    names = M.read_dictionary(spark, f"{path}/dictionary")
    named = with_label_names(rows.withColumnRenamed("LabelName", "code"), names, on_unknown="drop")
    return named.select("split", "order", "ImageID", "name", "Confidence")


@register("narrative_json", oracle="""
SELECT image_id, md5(text) AS narrative_md5, CAST(row_number() OVER (ORDER BY rank, conv_id, turn) - 1 AS BIGINT) AS place FROM (
  SELECT CAST(conv_id AS VARCHAR) AS image_id, text, conv_id, turn, CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END AS rank
  FROM conversations)
""")
def narrative_json(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines of three inputs in the order given, the whole text of each line."""
    from capset.operators.rows import dense_positions

    path = scratch_path(spark, "narrative_json")
    conv = load(spark, sf, "conversations")
    groups = {"a": F.col("role") == "user", "b": F.col("role") == "assistant", "c": ~F.col("role").isin("user", "assistant")}
    for name, cond in groups.items():
        K.write_captions_json(conv.where(cond).orderBy("conv_id", "turn").select(
            F.col("conv_id").cast("string").alias("image_id"), F.col("text").alias("caption")), f"{path}/{name}")
    n = M.read_narratives(spark, [f"{path}/{name}" for name in groups], order="at")
    return dense_positions(n.orderBy("at"), "place").select("image_id", F.md5("narrative").alias("narrative_md5"), "place")


@register("caption_map", oracle="""
SELECT 'events_' || source AS key, source AS image_id, CAST(count(*) AS VARCHAR) AS caption FROM documents GROUP BY source
""")
def caption_map(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON object of objects, an entry for each source of the corpus."""
    path = scratch_path(spark, "caption_map")
    entries = load(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).cast("string").alias("caption")).select(
        F.struct(F.concat(F.lit("events_"), "source").alias("key"),
                 F.struct(F.concat("source", F.lit(".jpg")).alias("path"), "caption").alias("value")).alias("e"))
    # as many entries as sources
    entries.groupBy().agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("value")).write.text(path)
    return M.read_caption_map(spark, path).select("key", "image_id", "caption")


@register("file_scan", oracle=f"""
SELECT CAST(page_id AS VARCHAR) AS page_id, md5({_FLAT_SQL.format('html')} || chr(10)) AS content_md5, 'txt' AS ext,
       CAST(length({_FLAT_SQL.format('html')}) + 1 AS BIGINT) AS text_len, 1 AS depth
FROM pages
""")
def file_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One file a page, in a folder of its own: listing by tasks, contents read once, text lengths, folders that hold a text."""
    path = scratch_path(spark, "file_scan")
    pages = load(spark, sf, "pages").select(F.format_string("page_id=%d/page.txt", "page_id").alias("name"),
                                            F.encode(F.concat(_flat("html"), F.lit("\n")), "UTF-8").alias("content"))
    write_files(pages, path)
    files = scan_tree(spark, path, exts=["txt"], with_content=True, depth=1)
    return files.select(F.regexp_extract("folder", r"page_id=(\d+)$", 1).alias("page_id"), F.md5("content").alias("content_md5"),
                        "ext", F.length(F.decode("content", "UTF-8")).cast("long").alias("text_len"), "depth") \
        .join(FS.folders_with_text(scan_tree(spark, path)).select(F.regexp_extract("folder", r"page_id=(\d+)$", 1).alias("page_id")), "page_id")


@register("text_corpus", oracle=f"SELECT md5({_FLAT_SQL.format('text')}) AS line_md5, count(*) AS n FROM documents GROUP BY 1")
def text_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Texts to a corpus of one line each, read back line by line."""
    path = scratch_path(spark, "text_corpus")
    K.write_corpus(load(spark, sf, "documents").withColumn("text", _flat("text")), path)
    lines = M.read_corpus_lines(spark, path).select(F.col("text").alias("line"))
    return lines.groupBy(F.md5("line").alias("line_md5")).agg(F.count(F.lit(1)).alias("n"))


@register("captions_by_folder", oracle=f"""
SELECT {S.pad_id('doc_id', 9)} AS key, {S.shard_dir('doc_id', 100, 5)} AS folder, md5(text) AS caption_md5, n_chars AS width FROM documents
""")
def captions_by_folder(spark: SparkSession, sf: str) -> DataFrame:
    """Captions, and images with their captions, in numbered folders; both are read back and joined."""
    from capset.functions.ids import pad_id, shard_dir

    path = scratch_path(spark, "captions_by_folder")
    d = load(spark, sf, "documents").select(pad_id("doc_id", 9).alias("key"), shard_dir("doc_id", 100).alias("folder"),
                                            F.col("text").alias("caption"), F.encode("text", "UTF-8").alias("content"), F.col("n_chars").alias("width"))
    K.write_captions(d.select("key", "caption", "folder"), f"{path}/captions")
    K.write_images(d.select("key", "content", "caption", "width", "folder"), f"{path}/images")
    captions = spark.read.schema("key string, caption string, folder string").parquet(f"{path}/captions")
    images = spark.read.schema("key string, content binary, caption string, width long, folder string").parquet(f"{path}/images")
    both = captions.join(images.withColumnRenamed("caption", "beside"), ["key", "folder"]).where(
        (F.md5("content") == F.md5("caption")) & (F.col("beside") == F.col("caption")))
    return both.select("key", "folder", F.md5("caption").alias("caption_md5"), "width")


@register("ledger_files", oracle="""
SELECT doc_id AS row_id, 'fetch' AS stage, CASE toxic WHEN 1 THEN 'failed' ELSE 'done' END AS status FROM labels
""")
def ledger_files(spark: SparkSession, sf: str) -> DataFrame:
    """Marks of done and failed rows appended in two runs."""
    path = scratch_path(spark, "ledger_files")
    lab = load(spark, sf, "labels")
    for toxic, status in ((0, "done"), (1, "failed")):
        K.append_ledger(lab.where(F.col("toxic") == toxic).select(
            F.col("doc_id").alias("row_id"), F.lit("fetch").alias("stage"), F.lit(status).alias("status"),
            F.lit(None).cast("string").alias("error"), F.lit(1).alias("attempts")), path)
    return spark.read.parquet(path).select("row_id", "stage", "status")


@register("score_files", oracle="SELECT vec_id, CAST(round(embedding[1], 4) AS DOUBLE) AS score, len(embedding) AS dims FROM embeddings")
def score_files(spark: SparkSession, sf: str) -> DataFrame:
    """A score table as sorted TSV, and vectors in numbered Parquet files of 100 rows."""
    path = scratch_path(spark, "score_files")
    e = load(spark, sf, "embeddings")
    K.write_similarities(e.select("vec_id", F.round(F.col("embedding")[0], 4).cast("double").alias("score")), f"{path}/scores", "vec_id")
    K.write_embeddings(e.select("vec_id", "embedding"), f"{path}/vectors", per_file=100)
    scores = spark.read.schema("vec_id long, score double").option("sep", "\t").option("header", True).csv(f"{path}/scores")
    return scores.join(spark.read.parquet(f"{path}/vectors"), "vec_id").select("vec_id", "score", F.size("embedding").cast("long").alias("dims"))


#: Names in a list of the report.
_LIST = 100


@register("fault_report_file", oracle=FP._FAULT_ROWS_SQL + f""", placed AS (
SELECT *, row_number() OVER (PARTITION BY folder, kind ORDER BY file) - 1 AS place FROM rows)
SELECT folder, kind, CAST(place // {_LIST} AS VARCHAR) AS part, CAST(count(*) AS VARCHAR) AS n, to_json(list(file ORDER BY file)) AS files
FROM placed GROUP BY folder, kind, place // {_LIST}
""")
def fault_report_file(spark: SparkSession, sf: str) -> DataFrame:
    """The report with lists, of all faults of the file tree, separated by bars: a long list goes on in the next part."""
    path = scratch_path(spark, "fault_report_file")
    K.write_fault_report(P.fault_report_parts(FP._files(spark, sf), FP.MIN_CHARS, _LIST), path)
    return spark.read.option("sep", "|").option("header", True).option("escape", '"').csv(path)


@register("fault_rows_file", oracle=FP._FAULT_ROWS_SQL + "SELECT folder, kind, file FROM rows")
def fault_rows_file(spark: SparkSession, sf: str) -> DataFrame:
    """The report of all faults of the file tree, one fault a line: no list grows with a folder."""
    path = scratch_path(spark, "fault_rows_file")
    K.write_fault_report(P.fault_rows(FP._files(spark, sf), FP.MIN_CHARS), path)
    return spark.read.schema("folder string, kind string, file string").option("sep", "|").option("header", True) \
        .option("escape", '"').csv(path)


@register("tar_append", oracle=f"""
SELECT {S.pad_id('doc_id', 9)} AS key, md5(text) AS cap_md5, CAST(doc_id % 2 AS INTEGER) AS run FROM documents
""")
def tar_append(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered shards in two runs, the second appended: nothing of the first is lost."""
    from capset.functions.ids import pad_id
    from capset.operators.rows import with_row_id
    from capset.sources import tarshard

    path = scratch_path(spark, "tar_append")
    halves = scratch_path(spark, "tar_append_halves")
    d = load(spark, sf, "documents")
    for run in (0, 1):
        d.where(F.col("doc_id") % 2 == run).select("doc_id", "text", "n_chars").write.parquet(f"{halves}/{run}")
        half = with_row_id(spark.read.parquet(f"{halves}/{run}")).select(
            "row_id", pad_id("doc_id", 9).alias("key"), F.encode("text", "UTF-8").alias("cap"),
            F.lit(str(run)).alias("run"), "n_chars")
        K.write_tar_shards(half, path, maxcount=100, maxsize=1e8, packing="prefix", size_col="n_chars", mode="append")
    tarshard.register(spark)
    back = spark.read.format("tarshard").schema("key string, cap binary, run string").load(path)
    return back.select("key", F.md5("cap").alias("cap_md5"), F.col("run").cast("int").alias("run"))


@register("tar_greedy", oracle=f"SELECT {S.pad_id('conv_id * 1000 + turn', 9)} AS key, md5(text) AS cap_md5, role FROM conversations")
def tar_greedy(spark: SparkSession, sf: str) -> DataFrame:
    """Shards rolled by each task as it writes, in gzip."""
    from capset.functions.ids import pad_id
    from capset.sources import tarshard

    path = scratch_path(spark, "tar_greedy")
    d = load(spark, sf, "conversations").select(pad_id(F.col("conv_id") * 1000 + F.col("turn"), 9).alias("key"),
                                                F.encode("text", "UTF-8").alias("cap"), "role")
    K.write_tar_shards(d, path, maxcount=64, compression="gzip")
    tarshard.register(spark)
    back = spark.read.format("tarshard").schema("key string, cap binary, role string").load(path)
    return back.select("key", F.md5("cap").alias("cap_md5"), "role")


@register("tar_published", oracle=f"""
SELECT {S.pad_id('doc_id', 9)} AS key, md5(text) AS cap_md5, CAST(doc_id % 2 AS INTEGER) AS run FROM documents
""")
def tar_published(spark: SparkSession, sf: str) -> DataFrame:
    """Shards in two runs that a list makes visible: nothing is renamed, a file that no list names is not read."""
    from capset.functions.ids import pad_id
    from capset.sources import tarshard

    path = scratch_path(spark, "tar_published")
    d = load(spark, sf, "documents").select(pad_id("doc_id", 9).alias("key"), F.encode("text", "UTF-8").alias("cap"),
                                            (F.col("doc_id") % 2).cast("string").alias("run"))
    for run in ("0", "1"):
        K.write_tar_shards(d.where(F.col("run") == run), path, maxcount=500, mode="append", commit="list")
    write_files(spark.range(1).select(F.lit("ds_999999-lost.tar").alias("name"), F.encode(F.lit("no tar"), "UTF-8").alias("content")), path)
    tarshard.register(spark)
    back = spark.read.format("tarshard").schema("key string, cap binary, run string").load(path)
    return back.select("key", F.md5("cap").alias("cap_md5"), F.col("run").cast("int").alias("run"))
