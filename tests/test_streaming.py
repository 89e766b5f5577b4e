"""Incremental ingestion: a re-run processes only new files; resume against a ledger."""

import os

from pyspark.sql import functions as F

from capset.streaming import ingest as ST
from fixtures import write

SCHEMA = "url string, caption string"


def test_ingest_only_new_files(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    write(f"{src}/a.tsv", "u1\tc1\nu2\tc2\n")
    ST.ingest_stream(spark, src, SCHEMA, out, ck, fmt="csv", sep="\t")
    assert spark.read.parquet(out).count() == 2
    ST.ingest_stream(spark, src, SCHEMA, out, ck, fmt="csv", sep="\t")
    assert spark.read.parquet(out).count() == 2  # nothing new, nothing added
    write(f"{src}/b.tsv", "u3\tc3\n")
    ST.ingest_stream(spark, src, SCHEMA, out, ck, fmt="csv", sep="\t")
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["u1", "u2", "u3"]


def test_pending_stream_against_ledger(spark, tmp_dir):
    src, out, ck, ledger = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck", f"{tmp_dir}/ledger"
    os.makedirs(src)
    spark.range(0, 20).withColumnRenamed("id", "row_id").write.mode("overwrite").parquet(f"{src}/p1")
    spark.range(0, 5).withColumnRenamed("id", "row_id").write.parquet(ledger)
    s = ST.read_stream(spark, f"{src}/p1", "row_id long", "parquet")
    ST.pending_stream(s, lambda: spark.read.parquet(ledger), out, ck)
    got = sorted(r.row_id for r in spark.read.parquet(out).collect())
    assert got == list(range(5, 20))


def test_dedup_stream(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    write(f"{src}/a.tsv", "u1\tsame\nu2\tsame\nu3\tother\n")
    df = ST.read_stream(spark, src, SCHEMA, "csv", sep="\t").withColumn("h", F.md5("caption"))
    q = (ST.dedup_stream(df, "h").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    write(f"{src}/b.tsv", "u4\tsame\n")
    q = (ST.dedup_stream(ST.read_stream(spark, src, SCHEMA, "csv", sep="\t").withColumn("h", F.md5("caption")), "h")
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.caption for r in spark.read.parquet(out).collect()) == ["other", "same"]


def test_dedup_within_watermark(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    write(f"{src}/a.csv", "2024-01-01 00:00:00,h1\n2024-01-01 00:00:05,h1\n2024-01-01 00:00:07,h2\n")
    df = ST.read_stream(spark, src, "ts timestamp, h string", "csv")
    q = (ST.dedup_stream(df, "h", watermark=("ts", "10 minutes")).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.h for r in spark.read.parquet(out).collect()) == ["h1", "h2"]


def test_pending_query_reads_a_table_of_several_files(spark, tmp_dir):
    from capset.plans import QUERIES

    docs = spark.range(0, 40).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"))
    labels = spark.range(0, 40, 4).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    docs.repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    labels.repartition(2).write.parquet(f"{tmp_dir}/labels.parquet")
    got = QUERIES["stream_pending"](spark, tmp_dir).collect()
    assert sorted(r.doc_id for r in got) == [i for i in range(40) if i % 4]
    assert {r.lang for r in got} == {"en"}
