"""Outputs of a run read back: sidecars, finished output files, failed rows, vocabulary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capset.functions.ids import pad_id, shard_dir
from capset.operators import filters, resume
from capset.operators import vocab as V
from capset.plans import vocab as VP
from capset.plans.registry import ORACLES, load, register
from capset.session import scratch_path
from capset.sinks import write_vocabulary
from capset.sources.files import scan_sidecars
from capset.sources.images import write_files
from capset.sources.listing import list_tree


@register("sidecar_scan", oracle="""
SELECT CAST(page_id AS VARCHAR) AS stem, CASE WHEN page_id % 11 = 0 THEN NULL ELSE '{"id":' || page_id || ',"url":' || to_json(url) || '}' END AS json,
  page_id % 11 = 0 AS corrupt FROM pages
""")
def sidecar_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON file beside each page, keys and blanks in any order, some cut short: normalised, or marked as corrupt."""
    path = scratch_path(spark, "sidecars")
    quoted = F.regexp_extract(F.to_json(F.struct("url")), r'(?s)^\{"url":(.*)\}$', 1)
    text = F.concat(F.lit('{ "url" : '), quoted, F.lit(', "id": '), F.col("page_id").cast("string"), F.lit(" }"))
    body = F.when(F.col("page_id") % 11 == 0, F.expr("left(text, length(text) - 3)")).otherwise(F.col("text"))
    files = load(spark, sf, "pages").withColumn("text", text)
    write_files(files.select(F.concat_ws("/", shard_dir("page_id", 500), F.concat(F.col("page_id").cast("string"), F.lit(".json"))).alias("name"),
                             F.encode(body, "UTF-8").alias("content")), path)
    return scan_sidecars(spark, path).select("stem", "json", "corrupt")


@register("finished_files", oracle="""
SELECT doc_id AS row_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)
""")
def finished_files(spark: SparkSession, sf: str) -> DataFrame:
    """A run stopped half way and taken up again: finished ids are read off the names of its files, failed rows made none."""
    path = scratch_path(spark, "finished")
    lab = load(spark, sf, "labels").withColumn("status", F.when(F.col("toxic") == 0, "ok").otherwise("failed"))
    done = filters.ok_rows(lab)
    write_files(done.select(F.concat_ws("/", shard_dir("doc_id", 1000), F.concat(pad_id("doc_id", 9), F.lit(".txt"))).alias("name"),
                            F.encode(F.col("quality").cast("string"), "UTF-8").alias("content")), path)
    ids = resume.ids_from_files(list_tree(spark, path))
    return resume.pending(load(spark, sf, "documents").select(F.col("doc_id").alias("row_id")), ids, "row_id").select("row_id")


@register("vocabulary_tables", oracle=f"""
WITH chars AS ({ORACLES['char_coverage']}), merges AS ({ORACLES['bpe_merges']}),
k AS (SELECT char AS token, row_number() OVER (ORDER BY n DESC, char) - 1 AS id FROM chars WHERE kept)
SELECT token, CAST(id AS INTEGER) AS id, CAST(NULL AS BIGINT) AS freq FROM k
UNION ALL SELECT "left" || "right", CAST(rank + (SELECT count(*) FROM k) AS INTEGER), freq FROM merges
""")
def vocabulary_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The tables of a vocabulary (kept characters and the first merges) written and read back, merges beside their tokens."""
    path = scratch_path(spark, "vocabulary")
    d = load(spark, sf, "documents").select("text")
    chars = V.alphabet(d, coverage=VP.COVERAGE)
    merges = V.bpe_merges(V.word_freq(d), VP.NUM_MERGES)
    write_vocabulary(V.vocabulary(merges, chars), merges, path)
    made = spark.read.parquet(f"{path}/merges").select(F.concat("left", "right").alias("token"), "freq")
    return spark.read.parquet(f"{path}/vocab").join(made, "token", "left").select("token", "id", "freq")
