"""Streaming queries: the driver's ``documents`` file is consumed as a stream source.

Each query runs a ``trigger(availableNow=True)`` stream over the whole table into a fresh
folder below the session's checkpoint dir, then returns the written result as a batch
DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from capset.plans.registry import load, register
from capset.session import scratch_path
from capset.streaming import ingest as ST


def _docs_stream(spark, sf):
    schema = load(spark, sf, "documents").schema
    table = f"{sf.rstrip('/')}/documents.parquet"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return ST.read_stream(spark, table, schema, "parquet")
    # the file source watches a folder; of a table that is one file, the glob filter picks it
    return ST.read_stream(spark, sf.rstrip("/"), schema, "parquet", pathGlobFilter="documents.parquet")


@register("stream_dedup", oracle="SELECT DISTINCT md5(text) AS md5 FROM documents")
def stream_dedup(spark, sf):
    """Several files, a micro-batch each: what one batch has seen is dropped from the next."""
    base = scratch_path(spark, "stream_dedup")
    docs = load(spark, sf, "documents").select("doc_id", F.md5("text").alias("md5"))
    docs.repartition(4, "doc_id").write.parquet(f"{base}/in")
    d = ST.dedup_stream(ST.read_stream(spark, f"{base}/in", docs.schema, "parquet", maxFilesPerTrigger=1).select("md5"), "md5")
    q = (d.writeStream.format("parquet").option("checkpointLocation", f"{base}/_checkpoint")
         .option("path", f"{base}/out").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register("stream_pending", oracle="""
SELECT doc_id, lang FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
""")
def stream_pending(spark, sf):
    base = scratch_path(spark, "stream_pending")
    s = _docs_stream(spark, sf).select(F.col("doc_id").alias("row_id"), "lang")
    ST.pending_stream(s, lambda: load(spark, sf, "labels").where("toxic = 1")
                      .select(F.col("doc_id").alias("row_id")), f"{base}/out", f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/out").select(F.col("row_id").alias("doc_id"), "lang")


#: The events come in so many parts of time, one after the other; the watermark waits a little longer than a part takes.
_PARTS = 4


@register("stream_dedup_watermark", oracle="SELECT event_id, ts FROM events")
def stream_dedup_watermark(spark, sf):
    """Events delivered twice, in runs that stop and start again: each comes once, late strangers are dropped, the state stays bounded.

    A part's file also holds the part before once more (copies, in time) and, in the last, the first part's events under new
    ids (late: older than the watermark)."""
    base = scratch_path(spark, "stream_watermark")
    ev = load(spark, sf, "events").select("event_id", "ts")
    seconds = F.col("ts").cast("timestamp_ltz").cast("double")
    low, high = ev.agg(F.min(seconds), F.max(seconds)).first()
    length = max(1.0, ((high or 0.0) - (low or 0.0)) / _PARTS)
    parts = ev.withColumn("part", F.least(F.lit(_PARTS - 1), F.floor((seconds - F.lit(low or 0.0)) / F.lit(length))).cast("int"))
    rows = []
    for k in range(_PARTS):
        new = parts.where((F.col("part") == k) | (F.col("part") == k - 1)).select("event_id", "ts")
        if k == _PARTS - 1:
            new = new.unionByName(parts.where("part = 0").select((-1 - F.col("event_id")).alias("event_id"), "ts"))
        new.write.mode("append").parquet(f"{base}/in")
        q = ST.dedup_increment(spark, f"{base}/in", ev.schema, "event_id", f"{base}/out", f"{base}/_checkpoint",
                               ("ts", f"{int(length * 1.1) + 1} seconds"), lambda d: d.withColumn("ts", F.col("ts").cast("timestamp_ltz")), fmt="parquet")
        rows += ST.state_rows(q)
    if low is not None and low < high and rows[-1] >= ev.count():
        raise RuntimeError(f"the state was never cleared: {rows}")
    return spark.read.schema("event_id long, ts timestamp_ltz").parquet(f"{base}/out").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
