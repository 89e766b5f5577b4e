"""TFRecord files written and read by tasks, and damaged input: whole tables through the shared scratch folder."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capset.operators.ordering import weighted_interleave
from capset.plans.registry import load, register
from capset.session import scratch_path
from capset.sources import quarantine as Q
from capset.sources import tfrecord

_DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@register("tfrecord_roundtrip", oracle="""
SELECT mode, doc_id, md5(text) AS text_md5, lang, source, CAST(n_chars AS BIGINT) AS n_chars FROM documents, (VALUES ('given'), ('inferred')) m(mode)
""")
def tfrecord_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the corpus as records; read by a given feature description and by that of the first record."""
    tfrecord.register(spark)
    path = scratch_path(spark, "tfrecord_roundtrip")
    load(spark, sf, "documents").select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long")).write.format("tfrecord") \
        .mode("append").option("maxrecords", 2000).save(path)
    given = spark.read.format("tfrecord").schema(_DDL).load(path)
    inferred = spark.read.format("tfrecord").load(path)
    both = [d.select(F.lit(mode).alias("mode"), "doc_id", F.md5("text").alias("text_md5"), F.col("lang").cast("string").alias("lang"),
                     F.col("source").cast("string").alias("source"), "n_chars") for mode, d in (("given", given), ("inferred", inferred))]
    return both[0].unionByName(both[1])


#: A file is a source's documents of a range of ids, so none grows with the table and a large source has many.
_RANGE = 5000
_FILE_SQL = f"source || '-' || CAST(doc_id // {_RANGE} AS VARCHAR)"
#: Files that are not named weigh 1.
_WEIGHTS = {"src0-0": 3.0, "src1-0": 0.5}
_SEED = 11


def _file() -> F.Column:
    return F.concat_ws("-", "source", F.floor(F.col("doc_id") / _RANGE).cast("string"))


@register("tfrecord_interleave", oracle=f"""
WITH r AS (SELECT doc_id, md5(text) AS text_md5, {_FILE_SQL} AS file, CAST(row_number() OVER (PARTITION BY source, doc_id // {_RANGE} ORDER BY doc_id) - 1 AS BIGINT) AS index FROM documents)
SELECT doc_id, text_md5, file, index, (index + CAST('0x' || substr(md5(file || ':' || CAST(index AS VARCHAR) || '{_SEED}'), 1, 8) AS BIGINT) / 4294967296.0)
  / CASE file {' '.join(f"WHEN '{f}' THEN {w}" for f, w in _WEIGHTS.items())} ELSE 1.0 END AS turn FROM r
""")
def tfrecord_interleave(spark: SparkSession, sf: str) -> DataFrame:
    """Files of unequal size; read in splits through an index, mixed by weight."""
    tfrecord.register(spark)
    path, index = scratch_path(spark, "tfrecord_files"), scratch_path(spark, "tfrecord_index")
    d = load(spark, sf, "documents").select("doc_id", "text", _file().alias("file"))
    d.repartition("file").sortWithinPartitions("file", "doc_id").write.format("tfrecord").mode("append").option("fileColumn", "file").save(path)
    rows = tfrecord.read_indexed(spark, path, index, "doc_id bigint, text string, _file string, _index bigint", split_bytes=1 << 20)
    named = rows.select("doc_id", F.md5("text").alias("text_md5"), F.col("_index").alias("index"),
                        F.regexp_extract("_file", r"([^/]+)-\d{5}-[0-9a-f]{12}\.tfrecord$", 1).alias("file"))
    return weighted_interleave(named, "file", "index", _WEIGHTS, _SEED).select("doc_id", "text_md5", "file", "index", "turn")


_TEXT = r"regexp_replace({0}, '[\r\n\t\"]', ' ', 'g')"


@register("quarantine_csv", oracle=rf"""
WITH t AS (SELECT doc_id, doc_id % 7 AS k, lang, CAST(n_chars AS VARCHAR) AS n, {_TEXT.format('text')} AS x FROM documents),
l AS (SELECT doc_id, k, x, doc_id || chr(9) || CASE k WHEN 0 THEN lang WHEN 1 THEN lang || chr(9) || n || chr(9) || '"' || x || '"' || chr(9) || 'more'
  WHEN 2 THEN lang || chr(9) || n || chr(9) || '"' || x WHEN 3 THEN lang || chr(9) || 'x' || n || chr(9) || '"' || x || '"'
  ELSE lang || chr(9) || n || chr(9) || '"' || x || '"' END AS line FROM t)
SELECT CASE WHEN k > 3 THEN doc_id END AS doc_id, CASE WHEN k > 3 THEN md5(x) ELSE md5(line) END AS md5,
  CASE k WHEN 0 THEN '2 of 4 fields' WHEN 1 THEN '5 fields, 4 expected' WHEN 2 THEN 'unclosed quote' WHEN 3 THEN 'wrong type' END AS reason FROM l
""")
def quarantine_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that are short, long, unclosed or of a wrong type, planted all over the table; good and bad rows from one scan."""
    path = scratch_path(spark, "quarantine_csv")
    d = load(spark, sf, "documents").withColumns({"x": F.regexp_replace("text", r'[\r\n\t"]', " "), "k": F.col("doc_id") % 7})
    quoted = F.concat(F.lit('"'), "x", F.lit('"'))
    line = F.when(F.col("k") == 0, F.concat_ws("\t", "doc_id", "lang")).when(F.col("k") == 1, F.concat_ws("\t", "doc_id", "lang", "n_chars", quoted, F.lit("more"))) \
        .when(F.col("k") == 2, F.concat_ws("\t", "doc_id", "lang", "n_chars", F.concat(F.lit('"'), "x"))) \
        .when(F.col("k") == 3, F.concat_ws("\t", "doc_id", "lang", F.concat(F.lit("x"), "n_chars"), quoted)) \
        .otherwise(F.concat_ws("\t", "doc_id", "lang", "n_chars", quoted))
    d.select(line.alias("value")).write.text(f"{path}/in")
    rows = Q.read_delimited(spark, f"{path}/in", "doc_id bigint, lang string, n_chars bigint, text string")
    good, bad = Q.split_quarantined(rows, f"{path}/out")
    return good.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("md5"), F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select(F.lit(None).cast("long").alias("doc_id"), F.md5("raw").alias("md5"), "reason"))


def _flipped(rows: DataFrame, path: str) -> None:
    """Records of ``doc_id, text`` in a file for each ``file``; where ``flip`` holds, the last byte of the data is another than the checksum was made of."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import posixpath

        filesystem, base = tfrecord._fs(path)
        filesystem.create_dir(base, recursive=True)
        at, out = None, None
        for df in batches:
            for file, i, text, flip in df[["file", "doc_id", "text", "flip"]].itertuples(index=False, name=None):
                if file != at:
                    if out is not None:
                        out.close()
                    at, out = file, filesystem.open_output_stream(posixpath.join(base, f"{file}.tfrecord"))
                frame = bytearray(tfrecord.frame_record(tfrecord.encode_example([("doc_id", "int64", [i]), ("text", "bytes", [text])])))
                frame[-5] ^= int(flip)
                out.write(bytes(frame))
            yield df[["doc_id"]].head(0)
        if out is not None:
            out.close()

    files = rows.repartition("file").sortWithinPartitions("file", "doc_id")
    files.mapInPandas(run, "doc_id long").write.format("noop").mode("overwrite").save()


@register("quarantine_tfrecord", oracle=f"""
SELECT {_FILE_SQL} AS file, doc_id, CAST(1 AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS reason FROM documents WHERE doc_id % 9 <> 0
UNION ALL SELECT {_FILE_SQL}, NULL, count(*), 'wrong checksum of the data' FROM documents WHERE doc_id % 9 = 0 GROUP BY 1
""")
def quarantine_tfrecord(spark: SparkSession, sf: str) -> DataFrame:
    """Records with a flipped byte all over the table: good rows, and the bad ones by file and reason."""
    path = scratch_path(spark, "quarantine_tfrecord")
    _flipped(load(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _file().alias("file"),
                                                 (F.col("doc_id") % 9 == 0).alias("flip")), f"{path}/in")
    good, bad = Q.split_quarantined(Q.read_tfrecord(spark, f"{path}/in", "doc_id bigint, text string")
                                    .withColumn("file", F.regexp_extract("_file", r"([^/]+)\.tfrecord$", 1)), f"{path}/out")
    bad = bad.groupBy(F.regexp_extract("file", r"([^/]+)\.tfrecord$", 1).alias("file"), F.regexp_extract("reason", "^(.*) at byte", 1).alias("reason")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return good.select("file", "doc_id", F.lit(1).cast("long").alias("n"), F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select("file", F.lit(None).cast("long").alias("doc_id"), "n", "reason"))
