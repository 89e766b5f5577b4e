"""Row ranges, counts, file choices, flags, metrics and file streams over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capset.operators import pairs as P
from capset.operators import rows as R
from capset.plans import sqltext as S
from capset.plans.registry import load, register
from capset.session import scratch_path

RANGE_START, RANGE_ROWS = 100, 250
STEMS = 10


@register("row_range", oracle=f"""
SELECT doc_id, row_id FROM (SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS row_id FROM documents)
WHERE row_id >= {RANGE_START} AND row_id < {RANGE_START + RANGE_ROWS}
""")
def row_range(spark: SparkSession, sf: str) -> DataFrame:
    """One batch of a manifest by its row numbers: the range is the feature."""
    return R.row_range(R.with_row_id(load(spark, sf, "documents").select("doc_id")), RANGE_START, RANGE_ROWS).select("doc_id", "row_id")


@register("count_images", oracle="SELECT count(DISTINCT user_id) AS n_images FROM events")
def count_images(spark: SparkSession, sf: str) -> DataFrame:
    from capset.operators.labels import count_images as count

    return count(load(spark, sf, "events").select(F.col("user_id").alias("image_id")))


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    """A file listing off the part table: several files a stem, of several kinds."""
    ext = F.element_at(F.array(*[F.lit(e) for e in ("png", "JPG", "jpeg", "bmp", "txt")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    stem = F.floor(F.col("p_partkey") / STEMS).cast("string")
    return load(spark, sf, "part").select(
        (F.col("p_size") % 7).cast("string").alias("folder"), stem.alias("stem"), F.lower(ext).alias("ext"),
        F.concat_ws("/", (F.col("p_size") % 7).cast("string"), F.concat(stem, F.lit("-"), F.col("p_partkey").cast("string"), F.lit("."), ext)).alias("path"),
        F.col("p_partkey").alias("length"))


_LISTING_SQL = f"""
WITH files AS (
  SELECT CAST(p_size % 7 AS VARCHAR) AS folder, CAST(p_partkey // {STEMS} AS VARCHAR) AS stem,
         lower(['png', 'JPG', 'jpeg', 'bmp', 'txt'][p_partkey % 5 + 1]) AS ext,
         CAST(p_size % 7 AS VARCHAR) || '/' || CAST(p_partkey // {STEMS} AS VARCHAR) || '-' || CAST(p_partkey AS VARCHAR) || '.' ||
         ['png', 'JPG', 'jpeg', 'bmp', 'txt'][p_partkey % 5 + 1] AS path FROM part)
"""


@register("one_file_per_stem", oracle=_LISTING_SQL + """
, r AS (SELECT *, row_number() OVER (PARTITION BY folder, stem ORDER BY list_position(['png', 'jpg', 'jpeg', 'bmp'], ext) DESC, path DESC) AS n
  FROM files WHERE ext <> 'txt')
SELECT folder, stem, ext, path FROM r WHERE n = 1
""")
def one_file_per_stem(spark: SparkSession, sf: str) -> DataFrame:
    """Of the images of a stem, the one that is scanned last."""
    images = P.by_extension(_listing(spark, sf), P.IMAGE_EXTS)
    return P.one_file_per_stem(images).select("folder", "stem", "ext", "path")


@register("exists_flag", oracle=_LISTING_SQL + """
SELECT path, ext IN ('png', 'bmp') AS "exists" FROM files
""")
def exists_flag(spark: SparkSession, sf: str) -> DataFrame:
    """Is the file of a row in the listing."""
    from capset.operators.filters import with_exists

    files = _listing(spark, sf)
    return with_exists(files.select("path"), P.by_extension(files, ["PNG", "bmp"]), "path")


@register("delete_list", oracle=_LISTING_SQL + """
, f AS (SELECT *, bool_or(ext = 'txt') OVER (PARTITION BY folder, stem) AS t, bool_or(ext <> 'txt') OVER (PARTITION BY folder, stem) AS i FROM files)
SELECT folder, path FROM f WHERE NOT (t AND i)
""")
def delete_list(spark: SparkSession, sf: str) -> DataFrame:
    """Files of incomplete pairs as rows, one each; nothing is deleted."""
    files = _listing(spark, sf).withColumns({"name": F.regexp_extract("path", r"([^/]+)$", 1), "text_len": F.lit(10).cast("long"),
                                             "valid": F.lit(True)})
    return P.delete_plan(files)


@register("input_groups", oracle="""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'onepercent' WHEN doc_id % 3 = 1 THEN 'main' || printf('%05d', CAST(doc_id AS BIGINT)) ELSE 'other' END AS grp
FROM documents
""")
def input_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of input files by their names."""
    from capset.functions.ids import group_tag

    kind = F.col("doc_id") % 3
    name = F.when(kind == 0, F.lit("a.1percent.tsv.gz")).when(kind == 1, F.format_string("a-%05d-of-00010.tsv.gz", "doc_id")).otherwise(F.lit("a.tsv.gz"))
    return load(spark, sf, "documents").select("doc_id", group_tag(name).alias("grp"))


@register("sorted_output", oracle="""
SELECT vec_id, CAST(row_number() OVER (ORDER BY label, vec_id) - 1 AS BIGINT) AS place FROM embeddings
""")
def sorted_output(spark: SparkSession, sf: str) -> DataFrame:
    """Places of rows in a globally sorted output."""
    e = load(spark, sf, "embeddings").select("vec_id", "label")
    return R.dense_positions(e.orderBy("label", "vec_id"), "place").select("vec_id", "place")


@register("run_metrics", oracle="""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE toxic = 1) AS BIGINT) AS duplicates FROM labels
""")
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Counters that fill while a job runs, as a row."""
    from capset.operators.samples import run_metrics as observed

    df, counters = observed(load(spark, sf, "labels").withColumn("dup", F.col("toxic") == 1), "labels", duplicate="dup")
    df.write.parquet(scratch_path(spark, "run_metrics"))
    got = counters.get
    return spark.createDataFrame([(got["rows"], got["duplicates"])], "rows long, duplicates long")


@register("stream_ingest", oracle="SELECT doc_id, md5(text) AS text_md5, lang FROM documents")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """New files in two runs of a file stream: the second run reads only what the first has not seen."""
    from capset.streaming.ingest import ingest_stream

    base = scratch_path(spark, "stream_ingest")
    d = load(spark, sf, "documents")
    for run in (0, 1):
        d.where(F.col("doc_id") % 2 == run).write.mode("append").parquet(f"{base}/in")
        ingest_stream(spark, f"{base}/in", d.schema, f"{base}/out", f"{base}/_checkpoint", fmt="parquet", maxFilesPerTrigger=1,
                      transform=lambda s: s.select("doc_id", F.md5("text").alias("text_md5"), "lang"))
    return spark.read.parquet(f"{base}/out")
